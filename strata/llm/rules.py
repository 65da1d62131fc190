"""Operator 6, quality rules: learned decision lists.

Each text is reduced to counts (words, symbols, repeated lines and windows,
capitals, ...). Sequential covering learns from labelled rows when a text is
bad: on two thirds of a bounded sample a rule grows by the threshold condition
of most information gain until it covers no good row; on the other third its
last conditions are pruned while that does not make it worse; a rule that is
not precise enough there ends the list. The rows a rule covers are taken out
and the next rule is learned. The list becomes one ordered conditional
expression over the counts, which Spark evaluates on every row.

Defined results
  null, empty and blank texts: all counts 0, so the base test fails (fewer than
  10 words) and the row is not kept; no labels, or labels of one kind: no rules,
  the base test alone decides; null ids: held out from learning; equal ids:
  learned from once, every row returned; ties: of conditions that gain the same the one
  with the widest gap between its values, then the first; equal texts have equal verdicts;
  very long texts: counted whole, a few texts to a batch; empty table: no rows; extra
  columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, cut, labelled_sample, small_batches

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Labelled rows of each kind that rules are learned from, at most.
PER_CLASS = 5000
MAX_CONDITIONS, MAX_RULES, LEAST_PRECISION, LEAST_COVER = 3, 12, 0.9, 3
CUTS = 48
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_caps", "n_same", "n_distinct", "n_marks"]
#: What the rules may test, as SQL over the counts.
STATISTICS = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "caps_share": "n_caps / greatest(n_words, 1)",
    "same_share": "n_same / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
}


def _ranks(*columns: np.ndarray) -> np.ndarray:
    """Number of each row's combination of two columns."""
    a, b = columns
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def repeated_words(ids: np.ndarray, of: np.ndarray, n: int, window: int = WINDOW) -> np.ndarray:
    """Per text (``of`` numbers each word's text): the words inside windows that the text
    holds at least twice, the first one included. Exact: windows are ranked, not hashed."""
    m = len(ids) - window + 1
    if m <= 0:
        return np.zeros(n, np.int64)
    gram = _ranks(ids, of)  # equal only within one text
    for size in range(2, window + 1):
        gram = _ranks(gram[:len(ids) - size + 1], ids[size - 1:])
    at = np.flatnonzero(of[:m] == of[window - 1:])
    gram = gram[at]
    again = at[np.bincount(gram)[gram] > 1]
    covered = np.zeros(len(ids) + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + window, -1)
    return np.bincount(of[np.cumsum(covered)[:-1] > 0], minlength=n)


def count_texts(texts: list[str | None]) -> pd.DataFrame:
    """``COUNTS`` of each text."""
    texts = [t or "" for t in texts]
    number: dict[bytes, int] = {}
    ids, lengths, rows = [], [], []
    for t in texts:
        words = t.encode("utf-8", "surrogatepass").split()
        ids += [number.setdefault(w, len(number)) for w in words]
        lengths.append(len(words))
        lines = [x for x in t.split("\n") if x.strip("\t\n\x0b\x0c\r ")]
        rows.append((len(t) - sum(t.count(c) for c in "\t\n\x0b\x0c\r "), sum(t.count(c) for c in SYMBOLS),
                     len(lines) - len(set(lines)), len(lines), t.count("!") + t.count("?")))
    n = len(texts)
    ids, of = np.array(ids, np.int64), np.repeat(np.arange(n), lengths)
    caps = np.fromiter((w.isupper() and len(w) > 1 for w in (x.decode("utf-8", "replace") for x in number)), bool, len(number))
    same = np.flatnonzero((ids[1:] == ids[:-1]) & (of[1:] == of[:-1]))
    first = np.unique(of * max(len(number), 1) + ids) // max(len(number), 1)
    chars, symbols, dup, lines, marks = np.array(rows, np.int64).reshape(n, 5).T
    return pd.DataFrame({
        "n_words": np.array(lengths, np.int64), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup,
        "n_repeat_words": repeated_words(ids, of, n), "n_lines": lines, "n_caps": np.bincount(of[caps[ids]], minlength=n),
        "n_same": np.bincount(of[same], minlength=n), "n_distinct": np.bincount(first, minlength=n), "n_marks": marks})


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``COUNTS`` of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = count_texts(list(pdf["t"]))
            out.insert(0, "doc_id", pdf["doc_id"].array)
            yield out

    rows = docs.select(as_text(F.col(id_col)).alias("doc_id"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "doc_id string, " + ", ".join(f"{c} long" for c in COUNTS)).withColumn(
        "doc_id", F.col("doc_id").cast("long"))


Condition = tuple[str, str, float]  # statistic, "<=" or ">", threshold


def _covers(x: pd.DataFrame, rule: list[Condition]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, op, value in rule:
        out &= (x[name].to_numpy() <= value) if op == "<=" else (x[name].to_numpy() > value)
    return out


def _gain(p0: int, n0: int, p1: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Information that a condition gains on the bad rows it keeps."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p1 > 0, p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p0 / (p0 + n0))), -np.inf)


def _grow(x: pd.DataFrame, bad: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        best = ((0.0, 0.0), None)
        p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
        for name in x.columns:
            v = x[name].to_numpy()[inside]
            cuts = np.unique(np.quantile(np.unique(v), np.linspace(0, 1, CUTS)))
            cuts = (cuts[1:] + cuts[:-1]) / 2
            if not len(cuts):
                continue
            up = v[:, None] > cuts
            p, n = up[bad[inside]].sum(0), up[~bad[inside]].sum(0)
            for op, a, b in ((">", p, n), ("<=", p0 - p, n0 - n)):
                gain = _gain(p0, n0, a, b)
                for k in np.flatnonzero(gain >= gain.max() - 1e-9):
                    # of equal gains the threshold in the middle of the widest gap holds best on new rows
                    below, above = v[~up[:, k]].max(), v[up[:, k]].min()
                    worth = (round(float(gain[k]), 6), (above - below) / (v.std() + 1e-9))
                    if gain[k] > 1e-9 and worth > best[0]:
                        best = (worth, (name, op, float((above + below) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= _covers(x, rule[-1:])
    return rule


def _worth(x: pd.DataFrame, bad: np.ndarray, rule: list[Condition]) -> float:
    c = _covers(x, rule)
    p, n = int((c & bad).sum()), int((c & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(x: pd.DataFrame, bad: np.ndarray, seed: int = 5) -> list[list[Condition]]:
    """The decision list: rules for bad rows, in order."""
    rules: list[list[Condition]] = []
    rng = np.random.default_rng(seed)
    left = np.ones(len(x), bool)
    third = rng.permutation(len(x)) % 3 == 0
    while len(rules) < MAX_RULES and (left & bad & ~third).sum() >= LEAST_COVER:
        grow, prune = left & ~third, left & third
        rule = _grow(x[grow], bad[grow])
        if not rule:
            break
        held, truth = x[prune], bad[prune]
        worths = [_worth(held, truth, rule[:k]) for k in range(1, len(rule) + 1)]
        rule = rule[:int(np.argmax(worths)) + 1] if max(worths) > -1 else rule
        c = _covers(x, rule) & left
        if bad[c].sum() < LEAST_COVER or bad[c].mean() < LEAST_PRECISION or _worth(held, truth, rule) < 2 * LEAST_PRECISION - 1 and max(worths) > -1:
            break
        rules.append(rule)
        left &= ~c
    return rules


def as_expression(rules: list[list[Condition]]) -> Column:
    """True for the rows that no rule covers: one ordered conditional expression."""
    out = None
    for rule in rules:
        test = F.lit(True)
        for name, op, value in rule:
            stat = F.expr(STATISTICS[name]).cast("double")
            test = test & ((stat <= value) if op == "<=" else (stat > value))
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(found: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        per_class: int = PER_CLASS) -> list[list[Condition]]:
    """Rules learned from the counts of at most ``2 * per_class`` labelled rows that pass the base test."""
    sample = cut(labelled_sample(labels, per_class, label_col, id_col), "rule-sample")
    stats = [F.expr(sql).cast("double").alias(name) for name, sql in STATISTICS.items()]
    rows = (found.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label")  # at most 2 * per_class ids
            .agg(*[F.min(c).alias(c) for c in COUNTS]).filter(~base_failed())
            .select("doc_id", "label", *stats).toPandas().sort_values("doc_id", ignore_index=True))
    if rows["label"].nunique() < 2:
        return []
    return learn(rows[list(STATISTICS)], (rows["label"] == 0).to_numpy())


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", label_id: str = "doc_id") -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row."""
    found = cut(counts(docs, id_col, text_col), "counts")
    rules = fit(found, labels, label_col, label_id)
    return (found.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & as_expression(rules)))
