"""Bronze landing (SINK-1, SINK-2, SCAL-11, SCAL-12).

A bronze table is append-only: raw payload text plus provenance
(``source_params``, ``source``, ``loaded_at``, ``record_hash = md5(payload)``)
and a row id. One batch shares one ``loaded_at`` (the reference stamps each
record separately, Q13); ties are broken by the row id, which follows the
order of arrival: that of ``order_cols``, or, for staged envelopes, of file, line and
array position, worked out from where each envelope was read (``arrival_ids``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.keys import assign_keys, known_rows, materialize, with_known_rows
from strata.operators.lookup import broadcast_if_small

# The four bronze targets (whitelist, SINK-2).
BRONZE_TABLES = ("leagues", "teams", "fixtures", "standings")

BRONZE_COLUMNS = ["id", "payload", "source_params", "source", "loaded_at", "record_hash"]


def bronze_schema() -> T.StructType:
    return T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("payload", T.StringType(), False),
        T.StructField("source_params", T.StringType()),
        T.StructField("source", T.StringType(), False),
        T.StructField("loaded_at", T.TimestampType(), False),
        T.StructField("record_hash", T.StringType()),
    ])


def check_target(table: str) -> str:
    if table not in BRONZE_TABLES:
        raise ValueError(f"refusing to land into unknown bronze table {table!r}")
    return table


def arrival_ids(staged: DataFrame, start: int) -> DataFrame:
    """The elements of written ``staged`` envelopes, each with its ``id`` above ``start``:
    source_file, source_params, pos, payload, id.

    An input split owns a range of ids, as many as its lines times its longest array; the
    ranges follow each other by file and place in the file. Within a split the line and
    the array position are the offset. So ids are unique, ascend with arrival and need no
    sort: the one aggregation has a row per input split (the splits are what the driver has
    listed to read them) and reads no payload, and the payloads stay where they are read.
    """
    splits = staged.groupBy("source_file", "block").agg(
        F.min("line").alias("first"), (F.max("line") - F.min("line") + 1).alias("lines"),
        (F.coalesce(F.max("pos"), F.lit(0)) + 1).alias("width"))
    before = Window.orderBy("source_file", "block").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialize(splits.withColumn("base", F.coalesce(F.sum(F.col("lines") * F.col("width")).over(before), F.lit(0))), "splits")
    rows = staged.filter(F.col("pos").isNotNull()).join(broadcast_if_small(splits.drop("lines")), ["source_file", "block"])
    place = F.col("base") + (F.col("line") - F.col("first")) * F.col("width") + F.col("pos")
    return rows.select("source_file", "source_params", "pos", "payload", (F.lit(start + 1) + place).cast("bigint").alias("id"))


def land_bronze(rows: DataFrame, table: str, loaded_at: Column, start_id: int = 0,
                order_cols: list | None = None, source_params: Column | None = None,
                source=None, payload_col: str = "payload", id_col: str | None = None) -> DataFrame:
    """Bronze rows for ``rows`` (one per payload). ``source`` defaults to the
    entity name, as the column default does in the reference.

    Ids are those of ``id_col`` (see ``arrival_ids``); without it the rows are numbered
    ``start_id + 1, start_id + 2, ...`` in the order of ``order_cols`` (unique)."""
    check_target(table)
    if source_params is None:
        source_params = F.col("source_params") if "source_params" in rows.columns else F.lit(None)
    staged = rows.select(
        F.col(payload_col).alias("payload"),
        source_params.cast("string").alias("source_params"),
        (source if isinstance(source, Column) else F.lit(source or table)).alias("source"),
        loaded_at.alias("loaded_at"),
        F.md5(F.col(payload_col)).alias("record_hash"),
        *[F.col(c) for c in (order_cols or []) if c != payload_col],
        *([F.col(id_col).cast("bigint").alias("id")] if id_col else []),
    )
    if id_col:
        return staged.select(*BRONZE_COLUMNS)
    keyed = assign_keys(staged, order_cols or ["record_hash"], "id", start_id, key_type="bigint")
    return with_known_rows(keyed.select(*BRONZE_COLUMNS), known_rows(keyed))
