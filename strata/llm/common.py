"""Helpers shared by the operators of this package.

* ``cut``: cuts lineage with a Parquet table in the cluster's shared folder
  (``spark.checkpoint.dir``), so a lost executor never recomputes or renumbers
  what later steps read.
* ``numbered``: global row numbers and running sums without a one-task window.
* ``permute``: a Feistel permutation of ``0 .. n-1`` as a column expression.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir, small_batches  # noqa: F401

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def shared_path(spark: SparkSession, name: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/strata-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the written table."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def numbered(df: DataFrame, order: list, sums: dict[str, str] | None = None,
             name: str = "numbered", row: str = "_row") -> DataFrame:
    """``df`` with its 0-based position ``row`` in the given total order and, for each
    ``{new column: column}`` of ``sums``, the sum of that column over all earlier rows.

    Rows are range-partitioned and sorted, written once, and shifted by the
    counts and sums of earlier partitions: one row per partition travels.
    Rows equal in every order column are interchangeable; their place in the
    input breaks the tie, which also lets a heavy key be split between ranges.
    Null order keys sort as the given order says. An empty input stays empty.
    """
    spark, sums = df.sparkSession, sums or {}
    keys = [c if isinstance(c, Column) else F.col(c) for c in order] + [F.col("_tie")]
    placed = (df.withColumn("_tie", F.monotonically_increasing_id())
              .repartitionByRange(shuffle_partitions(spark), *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_seq", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
              .drop("_tie"))
    placed = cut(placed, name)
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    local = Window.partitionBy("_part").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the range shuffle: bounded by its partition count
    per = placed.groupBy("_part").agg(F.count("*").alias("_n"), *[
        F.sum(F.col(c).cast("long")).alias(f"_sum_{out}") for out, c in sums.items()])
    starts = per.select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_n"), *[
        F.coalesce(F.sum(f"_sum_{out}").over(upto), F.lit(0)).alias(f"_sum_{out}") for out in sums])
    out = placed
    if sums:
        out = out.withColumns({f"_in_{k}": F.coalesce(F.sum(F.col(c).cast("long")).over(local), F.lit(0))
                               for k, c in sums.items()})
    out = out.join(F.broadcast(starts), "_part").withColumn(row, F.col("_n") + F.col("_seq"))
    out = out.withColumns({k: F.col(f"_sum_{k}") + F.col(f"_in_{k}") for k in sums}) if sums else out
    return out.drop("_part", "_seq", "_n", *[f"_{w}_{k}" for w in ("in", "sum") for k in sums])


#: Rounds of the permutation, and the most walks back into the range. A walk
#: passes at most ceil(sqrt(n)) values, so up to n = 4096 the bound is exact;
#: beyond, leaving the range 64 times in a row has a chance under 64 ** -64.
ROUNDS, WALKS = 6, 64


def _mixed(seed: str, step: Column, half: Column) -> Column:
    text = F.concat_ws(":", F.lit(seed), step.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def _feistel(x: Column, a: Column, b: Column, seed: str) -> Column:
    def turn(s, i):
        left = F.pmod(s["l"] + _mixed(seed, i, s["r"]), a)
        right = F.pmod(s["r"] + _mixed(seed, i, s["l"]), b)
        even = i % 2 == 0
        return F.struct(F.when(even, left).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(right).alias("r"))
    start = F.struct(F.pmod(x, a).alias("l"), F.floor(x / a).cast("long").alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn,
                       lambda s: s["l"] + a * s["r"])


def permute(x: Column, n: Column, seed: str) -> Column:
    """Where a seeded permutation of ``0 .. n-1`` sends ``x`` (``n`` a long column).

    The two halves live in ``[0, a)`` and ``[0, b)`` with ``a = ceil(sqrt n)`` and
    ``b = ceil(n / a)``, so fewer than ``a`` values of the domain lie beyond ``n``;
    from those the cycle is walked until it is back in range.
    """
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = F.ceil(n / a).cast("long")
    walk = lambda q: F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), q,
                                 lambda p, _: F.when(p < n, p).otherwise(_feistel(p, a, b, seed)))
    # the fold over one element names the first value, so that it is worked out once
    return F.aggregate(F.array(F.lit(0)), _feistel(x.cast("long"), a, b, seed),
                       lambda p, _: F.when(p < n, p).otherwise(walk(p)),
                       lambda p: F.when(p < n, p).otherwise(
                           F.raise_error(F.lit("permutation left its range")).cast("long")))


def as_text(ids: Column) -> Column:
    """Ids on their way through pandas, which makes a column of longs with nulls one of
    doubles: beyond 2 ** 53 they would change."""
    return ids.cast("string")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model may learn labels from; a row without an id is one of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(labels: DataFrame, per_class: int, label_col: str = "quality",
                    id_col: str = "doc_id") -> DataFrame:
    """At most ``per_class`` ids of each label, with the label: those of the least id hash.

    Held-out ids, null ids and labels other than 0 and 1 are left out; an id with
    several labels has the least of them.
    """
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    parts = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1])
