"""Operator 7, license scan: ordered signature rules, in DataFrame functions alone.

Texts that hold none of a few words, one of which every rule needs, are done
with; the others are cut into lower-cased words, joined by single blanks (a "+" stays at the end of a version), and each rule whose
keyword occurs is tried. A match is marked in the text and gives an interval
of words. A detection falls away if a detection of higher priority, or of equal
priority and more words, contains its interval; the labels are those of the
detections that stay, beside those of the base phrases, and the score is their
highest confidence.

Defined results
  null and empty texts: no words, nothing found, empty labels, score 0; words of
  letters beyond ASCII count as words and match no rule; repeated rows and equal
  or null ids: every row is judged by itself; empty table: no rows; extra
  columns are ignored. The work of a text grows with its words and, for the
  containment test, with the square of its detections.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.license_rules import GATE, PAIRS, Rule, rules

#: A word, a run of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``: written by what it holds and without
#: backtracking, which Java matches several times faster; and the same before capitals are made small.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]++"
RAW_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]++"
#: The same, with the "+" that ends a version: as many words, at the same places.
RULE_WORD = WORD + r"(?:(?<=[0-9])\+(?![0-9a-z+\x{80}-\x{10FFFF}]))?"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
RULE_TYPE = "array<struct<label:string,keyword:string,regex:string,priority:int,confidence:double>>"
OPEN, CLOSE = "\x01", "\x02"


def _places(words: Column, phrase: str) -> Column:
    """Indexes at which the phrase's words stand."""
    parts = phrase.split(" ")
    here = lambda i: F.get(words, i) == parts[0]

    def all_here(i):
        out = here(i)
        for k, p in enumerate(parts[1:], 1):
            out = out & (F.get(words, i + k) == p)
        return out
    last = F.size(words) - len(parts)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), all_here)).otherwise(F.array().cast("array<int>"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _detections(joined: Column, keywords: Column, table: Column) -> Column:
    """A struct ``(start, stop, label, priority, confidence)`` for each match of each rule."""
    def intervals(marked):
        index = F.sequence(F.lit(0), F.size(marked) - 1)
        ends = F.filter(index, lambda i: F.get(marked, i).endswith(CLOSE))
        starts = F.filter(index, lambda i: F.get(marked, i).startswith(OPEN))
        return F.arrays_zip(starts.alias("a"), ends.alias("b"))

    def of_rule(r):
        regex = F.concat(F.lit("(?<= )"), r["regex"], F.lit("(?= )"))
        marked = F.split(F.trim(F.regexp_replace(joined, regex, F.lit(f"{OPEN}$0{CLOSE}"))), " ")
        return F.transform(_let(marked, intervals), lambda x: F.struct(
            x["a"].alias("start"), x["b"].alias("stop"), r["label"].alias("label"),
            r["priority"].alias("priority"), r["confidence"].alias("confidence")))

    def tried(present):
        return F.filter(table, lambda r: F.array_contains(present, r["keyword"]) & F.regexp_like(
            joined, F.concat(F.lit("(?<= )"), r["regex"], F.lit("(?= )"))))

    present = F.filter(keywords, lambda k: F.contains(joined, k))
    return F.flatten(F.transform(_let(present, tried), of_rule))


def _uncontained(found: Column) -> Column:
    def outdone(d):
        def by(e):
            wider = (e["stop"] - e["start"]) > (d["stop"] - d["start"])
            return (e["start"] <= d["start"]) & (e["stop"] >= d["stop"]) & (
                (e["priority"] > d["priority"]) | ((e["priority"] == d["priority"]) & wider))
        return F.exists(found, by)
    return F.filter(found, lambda d: ~outdone(d))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         extra: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the
    detections kept, for every row. ``extra`` rules join those of the library."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    every_rule = [*rules(), *(extra or [])]
    table = F.from_json(F.lit(json.dumps([r.__dict__ for r in every_rule])), RULE_TYPE)
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in every_rule})])
    low = F.lower(text)
    gate = F.lit(False)
    for word, regex in PAIRS:
        gate = gate | F.contains(low, F.lit(word)) & text.rlike(regex)
    for word in [*GATE, *sorted({r.keyword for r in extra or []})]:
        gate = F.contains(low, F.lit(word)) | gate
    # ``extra`` rules must hold a keyword as one piece of the text, like those of the library
    rows = docs.select(F.col(id_col).alias("doc_id"), F.regexp_count(text, F.lit(RAW_WORD)).cast("long").alias("n_words"),
                       F.when(gate, F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))).alias("words"),
                       F.when(gate & F.contains(text, F.lit("+")), F.regexp_extract_all(
                           F.translate(text, UPPER, LOWER), F.lit(RULE_WORD), F.lit(0))).alias("plus"))
    rows = rows.withColumn("words", F.when(F.size("words") > 0, F.col("words")))
    said = F.when(F.col("plus").isNotNull(), F.col("plus")).otherwise(F.col("words"))
    rows = rows.withColumn("joined", F.when(F.col("words").isNotNull(), F.concat(F.lit(" "), F.array_join(said, " "), F.lit(" "))))
    rows = rows.withColumns({f"p_{k}": _places(F.col("words"), p) for k, p in enumerate(PHRASES)})
    rows = rows.withColumn("found", F.when(F.col("joined").isNotNull(), _detections(F.col("joined"), keywords, table)))
    rows = rows.withColumn("kept", _uncontained(F.col("found")))
    places = F.concat(*[F.col(f"p_{k}") for k in range(len(PHRASES))])
    base = F.concat(*[F.when(F.size(f"p_{k}") > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
                      for k, label in enumerate(PHRASES.values())])
    none = F.array().cast("array<string>")
    rows = rows.withColumn("places", F.when(F.col("words").isNotNull(), places))
    rows = rows.withColumn("base", F.coalesce(F.when(F.col("words").isNotNull(), base), none))
    every = F.concat("base", F.coalesce(F.transform("kept", lambda d: d["label"]), none))
    return rows.select(
        "doc_id", "n_words", F.when(F.col("places").isNull(), F.lit(0)).otherwise(F.size("places")).cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
        F.col("kept").alias("detections"))
