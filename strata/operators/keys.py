"""Surrogate keys (KEY-1) and smart date keys (KEY-2).

``assign_keys`` numbers rows densely ``start+1, start+2, ...`` in the order of
``order_cols`` *without* a single-partition window:

1. the rows are written once as a table in the session's checkpoint folder, and
   counted while they are written: the input is evaluated once;
2. the key space is cut into buckets of about ``BUCKET_ROWS`` rows (``MAX_BUCKETS``
   at most, larger ones then) at bounds drawn from a sample of the key columns; for
   as many rows as one bucket holds there is nothing to draw;
3. a row's key is the count of the buckets before its own, a literal, plus its
   ``row_number`` in the bucket. Buckets are what the window is partitioned by.

``order_cols`` must be unique, so the numbering is a function of the written rows and
the bounds: evaluating it again, after a lost executor or in another query, gives the
same keys, and nothing need be written a second time. Only key columns are read for
the bounds and the counts; at most ``MAX_BUCKETS`` of each reach the driver.

Only *new* rows get keys; existing rows keep theirs (``start`` is the current
maximum).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

BUCKET_ROWS, MAX_BUCKETS = 1 << 16, 1000
#: Keys sampled for each bound.
_SAMPLES = 50


def with_known_rows(df: DataFrame, n: int) -> DataFrame:
    """Remember a proven upper bound of the row count on this DataFrame
    object (used by size-checked broadcasts instead of another count)."""
    df._strata_rows = int(n)
    return df


def known_rows(df: DataFrame):
    return getattr(df, "_strata_rows", None)


def materialize(df: DataFrame, label: str = "t", partition_by: tuple = ()) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back:
    cuts the lineage and fixes any non-deterministic column on storage. The rows are
    counted as they are written (``known_rows`` of the result)."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # one folder per application: a finished run's intermediates go together
    path = f"{base}/strata-tables/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    stored = with_known_rows(spark.read.schema(df.schema).parquet(path).select(*df.columns), seen.get["n"])
    stored._strata_path = path
    return stored


def discard(df: DataFrame) -> None:
    """Delete the folder that ``materialize`` wrote; nothing may read ``df`` afterwards."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._strata_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def next_key_start(df: DataFrame, key_col: str) -> int:
    """Current maximum of ``key_col`` (0 for an empty table): a single scalar."""
    row = df.agg(F.max(key_col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def _bucket(keys: list, bounds: list, types: list) -> Column:
    """The number of ``bounds`` (ascending rows) below the row's keys, by binary search."""
    key = F.struct(*keys)

    def upto(bound) -> Column:
        return key <= F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip(keys, bound, types)])

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(upto(bounds[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))
    return search(0, len(bounds))


def assign_keys(df: DataFrame, order_cols: list, key_col: str, start: int = 0,
                key_type: str = "int") -> DataFrame:
    """``df`` with ``key_col`` = ``start + 1, start + 2, ...`` in the order of ``order_cols``.
    Rows that ``materialize`` has written are not written again."""
    stored = df if known_rows(df) is not None else materialize(df, "keys")
    n = known_rows(stored)
    buckets = min(MAX_BUCKETS, -(-n // BUCKET_ROWS))
    bounds, offsets = [], [0]
    keys = stored.select(*order_cols)
    if buckets > 1:
        drawn = keys.sample(min(1.0, _SAMPLES * buckets / n), seed=7).orderBy(*order_cols).collect()
        bounds = sorted({len(drawn) * k // buckets for k in range(1, buckets)})
        bounds = [drawn[k] for k in bounds if k < len(drawn)]
    bucket = _bucket(order_cols, bounds, [keys.schema[c].dataType for c in order_cols])
    if bounds:
        sizes = {r["b"]: r["n"] for r in keys.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for k in range(len(bounds)):
            offsets.append(offsets[-1] + sizes.get(k, 0))
    place = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order_cols))
    before = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("__bucket") + 1)
    out = stored.withColumn("__bucket", bucket).withColumn(key_col, (F.lit(start) + before + place).cast(key_type))
    return with_known_rows(out.drop("__bucket"), n)


def date_key(d) -> Column:
    """KEY-2: ``to_char(d,'YYYYMMDD')::int`` as arithmetic (no string round trip)."""
    c = F.col(d) if isinstance(d, str) else d
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
