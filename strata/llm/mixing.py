"""Operator 4, mixing sources to target weights: Sainte-Lague apportionment.

Every source's words, in document order, are cut into blocks of equal size, ``block_words``
or one less; a source of fewer than ``LEAST_BLOCKS`` such blocks has smaller ones (down to a
word), so that a few words come as near their target as many do. A source claims its target
in blocks of its own, ``target * blocks / source_size``, and the mix has as many seats as the
claims add up to. Seats go to sources by the highest quotients ``claim / (2k + 1)``; the
seats of output shard ``i`` are those that the same rule gives between house sizes
``M*(i-1)/shards`` and ``M*i/shards`` (the rule never takes a seat back when the house
grows), which makes the integer quotas per shard. A source then fills its seats with whole
passes over its blocks and, for the rest, with the blocks that a seeded permutation puts first.

Targets: sources by code point, null last, weigh 1, 2, 3, repeating; a target
stops at ``max_epochs`` times the source's words and the excess is shared again
by weight. The quotients need not be listed: all but a few seats of each source
follow from the divisor, and only the candidates around it are ranked.

Defined results
  null or empty text: size 0, taken 0; null source: a source of its own, last;
  equal ids: ordered by size and text hash, so reruns agree; repeated rows: each
  has its own words in the source's sequence; empty table or no words at all:
  targets and taken 0; one source: its target is its size; extra columns are
  carried by ``mixed_documents`` and ignored by ``mix``, whatever their names; very long
  texts: as many blocks as their words fill, each taken or not for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, cut, numbered, permute

BLOCK_WORDS = 32
#: Blocks of a source at least, as far as its words go.
LEAST_BLOCKS = 64
SHARDS = 8
MAX_EPOCHS = 3
SEED = "strata-mix"


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds rank, weight and target to one row per source (source, source_size).

    Water filling: with sources sorted by ``cap / weight``, the capped ones are
    the shortest prefix after which an equal level per weight fits the next.
    Cross-multiplied integers decide, so no rounding does.
    """
    big = "decimal(38,0)"
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], {"source_start": "source_size"}, "mix-sources", "rank")
    ranked = ranked.withColumn("weight", (F.col("rank") % 3 + 1).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_epochs)
    ranked = cut(ranked, "mix-ranked")
    whole = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
                       F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()
    by_ratio = [(F.col("cap") / F.col("weight")).asc(), F.col("rank").asc()]
    caps = numbered(ranked, by_ratio, {"caps_before": "cap", "weights_before": "weight"}, "mix-caps", "_at")
    left = F.lit(whole["all"]).cast(big) - F.col("caps_before").cast(big)
    share = F.lit(whole["w"]) - F.col("weights_before")
    fits = left * F.col("weight") <= F.col("cap").cast(big) * share
    caps = cut(caps.withColumn("_left", left.cast("long")).withColumn("_share", share)
               .withColumn("_fits", fits), "mix-level")
    level = caps.filter("_fits").agg(F.min_by(F.struct("_at", "_left", "_share"), "_at").alias("l")).first()["l"]
    if level is None:  # every source is at its cap: only when there are no words
        return caps.withColumn("target", F.col("cap").cast("double")).drop("_left", "_share", "_fits", "_at")
    free = (F.col("weight") * F.lit(level["_left"])).cast("double") / F.lit(float(level["_share"]))
    return (caps.withColumn("target", F.when(F.col("_at") < level["_at"], F.col("cap").cast("double")).otherwise(free))
            .drop("_left", "_share", "_fits", "_at", "caps_before", "weights_before"))


def quotas(wanted: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS,
           max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds to one row per source: blocks, claim, seats, and quotas (seats per output shard)."""
    blocks = F.greatest(F.ceil(F.col("source_size") / block_words), F.least(F.col("source_size"), F.lit(LEAST_BLOCKS)))
    wanted = wanted.withColumn("blocks", blocks.cast("long"))
    claim = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = cut(wanted.withColumn("claim", claim), "mix-wanted")
    s = wanted.agg(F.coalesce(F.sum("claim"), F.lit(0.0)).alias("t"), F.count("*").alias("n")).first()
    total, n = s["t"], s["n"]
    house = max(1, int(total + 0.5)) if total > 0 else 0
    cap = F.col("blocks") * max_epochs
    if not house:
        return wanted.withColumn("seats", F.lit(0).cast("long")).withColumn(
            "quotas", F.array_repeat(F.lit(0).cast("long"), shards))
    sizes = [house * (i + 1) // shards for i in range(shards)]
    houses = F.explode(F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(m).cast("long").alias("house"))
                                 for i, m in enumerate(sizes)]))
    rows = wanted.select("rank", "claim", houses.alias("h")).select("rank", "claim", "h.shard", "h.house")
    # seats(d) = floor(claim / d + 1/2) sums to at most total / d + n / 2 and at least
    # total / d - n / 2, so the last seat's divisor lies between these two:
    high = F.lit(total) / F.greatest(F.col("house") - n / 2.0, F.lit(0.25))
    low = F.lit(total) / (F.col("house") + n / 2.0)
    rows = rows.withColumn("sure", F.greatest(F.floor(F.col("claim") / high + 0.5) - 1, F.lit(0)).cast("long"))
    rows = rows.withColumn("sure", F.when(F.col("house") - n / 2.0 < 0.25, F.lit(0).cast("long")).otherwise(F.col("sure")))
    rows = cut(rows.withColumn("most", (F.floor(F.col("claim") / low + 0.5) + 1).cast("long")), "mix-bounds")
    sure = rows.groupBy("shard").agg(F.sum("sure").alias("given"))
    near = rows.filter("claim > 0").select(
        "shard", "rank", "claim", F.explode(F.sequence(F.col("sure"), F.col("most"))).alias("k"))
    near = near.withColumn("quotient", F.col("claim") / (2 * F.col("k") + 1))
    order = numbered(near, [F.col("shard").asc(), F.col("quotient").desc(), F.col("rank").asc()], name="mix-quotients")
    first = order.groupBy("shard").agg(F.min("_row").alias("_first"))
    per = rows.select("shard", "house").distinct().join(sure, "shard").join(first, "shard")
    won = (order.join(F.broadcast(per), "shard")  # one row per output shard
           .filter(F.col("_row") - F.col("_first") < F.col("house") - F.col("given"))
           .groupBy("shard", "rank").agg(F.count("*").alias("more")))
    held = (rows.join(won, ["shard", "rank"], "left")
            .withColumn("upto", F.col("sure") + F.coalesce(F.col("more"), F.lit(0))))
    lists = held.groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("shard", "upto"))).alias("h"))
    lists = lists.select("rank", F.transform("h", lambda x: x["upto"]).alias("ends"))
    out = wanted.join(lists, "rank")
    ends = F.transform("ends", lambda e: F.least(e, cap))
    out = out.withColumn("_ends", ends)
    return (out.withColumn("seats", F.element_at("_ends", shards))
            .withColumn("quotas", F.transform("_ends", lambda e, i: e - F.when(
                i > 0, F.get(F.col("_ends"), i - 1)).otherwise(F.lit(0)))).drop("_ends", "ends"))


def _spans(seed: str) -> Column:
    """Of a row with size > 0: its spans ``(start, words, turn)``, one per block it touches;
    ``turn`` is the block's place in the seeded order of its source. The first ``_longer``
    blocks of a source hold ``_words + 1`` words, the others ``_words``."""
    words, longer, offset, size = (F.col(c) for c in ("_words", "_longer", "offset", "size"))

    def block_of(w):
        head = longer * (words + 1)
        return F.when(w < head, F.floor(w / (words + 1))).otherwise(longer + F.floor((w - head) / words)).cast("long")

    def start_of(b):
        return b * words + F.least(b, longer)

    def span(b):
        begin = F.greatest(start_of(b), offset)
        end = F.least(start_of(b + 1), offset + size)
        return F.struct((begin - offset).alias("start"), (end - begin).alias("words"),
                        permute(b, F.col("blocks"), seed).alias("turn"))
    return F.transform(F.sequence(block_of(offset), block_of(offset + size - 1)), span)


def digests(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    """What the plan needs of every row: doc_id, source, size and text hash, and ``more``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("hash"), *more)


def placed(rows: DataFrame, block_words: int, shards: int, max_epochs: int) -> DataFrame:
    """Every one of ``rows`` (written digests) with its source's figures and its offset among the source's words."""
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = quotas(targets(cut(per_source, "mix-sizes"), max_epochs), block_words, shards, max_epochs)
    plan = cut(plan.select("source", "source_size", "target", "source_start", "blocks", "seats", "quotas"), "mix-plan")
    order = [F.col("source").asc_nulls_last(), "doc_id", "size", "hash"]
    at = numbered(rows, order, {"_before": "size"}, "mix-rows")
    joined = at.alias("a").join(plan.alias("p"), F.col("a.source").eqNullSafe(F.col("p.source")))
    some = F.col("blocks") > 0
    return (joined.drop(F.col("p.source"))
            .withColumn("offset", F.col("_before") - F.col("source_start"))
            .withColumn("_words", F.when(some, F.expr("source_size div blocks")).otherwise(F.lit(0)))
            .withColumn("_longer", F.when(some, F.col("source_size") % F.col("blocks")).otherwise(F.lit(0)))
            .withColumn("passes", F.when(some, F.expr("seats div blocks")).otherwise(F.lit(0)))
            .withColumn("rest", F.when(some, F.col("seats") % F.col("blocks")).otherwise(F.lit(0))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_words: int = BLOCK_WORDS, shards: int = SHARDS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row; seats and blocks of its source follow."""
    rows = cut(digests(docs, id_col, text_col, source_col), "mix-digest")
    at = placed(rows, block_words, shards, max_epochs)
    part = F.aggregate(_spans(seed), F.lit(0).cast("long"),
                       lambda s, x: s + F.when(x["turn"] < F.col("rest"), x["words"]).otherwise(F.lit(0)))
    part = F.when((F.col("size") > 0) & (F.col("rest") > 0), part).otherwise(F.lit(0))
    return at.select("doc_id", "size", "source_size", "target",
                     (F.col("passes") * F.col("size") + part).cast("long").alias("taken"),
                     "source", "blocks", "seats")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", chars_col: str | None = "n_chars",
                    block_words: int = BLOCK_WORDS, shards: int = SHARDS,
                    max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row for every whole pass over a
    document, and one for the words taken from it in the last pass (each word with the
    white space before it), if there are any. ``chars_col``, if given, is set to the
    text's length."""
    names = docs.columns
    whole = cut(digests(docs, id_col, text_col, source_col, F.monotonically_increasing_id().alias("_line"),
                        *[F.col(c).alias(f"in_{c}") for c in names]), "mix-texts")
    # numbers alone are sorted and planned; the texts then meet the numbers of their rows
    at = placed(whole.select("doc_id", "source", "size", "hash", "_line"), block_words, shards, max_epochs)
    pieces = F.regexp_extract_all(F.col(f"in_{text_col}"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    chosen = F.filter(_spans(seed), lambda x: x["turn"] < F.col("rest"))
    at = at.withColumn("_spans", F.when((F.col("size") > 0) & (F.col("rest") > 0), chosen))
    at = at.select("_line", "size", "passes", "_spans").join(whole.select("_line", *[f"in_{c}" for c in names]), "_line")
    part = F.array_join(F.flatten(F.transform("_spans", lambda x: F.slice(
        F.col("_pieces"), (x["start"] + 1).cast("int"), x["words"].cast("int")))), "")
    at = at.withColumn("_pieces", F.when(F.size(F.coalesce("_spans", F.array())) > 0, pieces))
    rows = F.concat(F.when(F.col("size") > 0, F.array_repeat(F.col(f"in_{text_col}"), F.col("passes").cast("int")))
                    .otherwise(F.array().cast("array<string>")),
                    F.when(F.col("_pieces").isNotNull(), F.array(part)).otherwise(F.array().cast("array<string>")))
    out = at.withColumn("_text", F.explode(rows))
    fresh = {text_col: F.col("_text")} | ({chars_col: F.char_length("_text").cast("long")} if chars_col in names else {})
    return out.select(*[fresh.get(c, F.col(f"in_{c}")).alias(c) for c in names])
