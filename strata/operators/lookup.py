"""Surrogate-key lookups from facts into dimensions (JOIN-1..6).

A lookup is ``(dim, [(fact expr, dim column), ...], dim key column, output
name, how)``. Dimensions are pre-filtered to the current version *before* the
join (FILT-2), so the join is a plain equi-join the optimizer can broadcast.

Broadcast policy: a dimension is broadcast only after its size in bytes is
checked (rows, by proof or by count, times the width of its fixed columns, plus
the measured bytes of its strings). All dimensions of one fact share one budget
of ``max_bytes`` (default: ``broadcast_budget``). Only the join columns, the surrogate key and any requested
attributes are projected before the broadcast. Beyond the budget the join is
left to the optimizer (sort-merge; AQE may still convert it at runtime).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import driver_heap

DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024
#: The driver builds all tables of a fact at the same time, and each takes up to some five times its bytes meanwhile.
HEAP_SHARE = 16
_ROW_BYTES = 16  # of a row's header


def broadcast_budget(spark: SparkSession) -> int:
    """Bytes that one query may broadcast: ``DEFAULT_BROADCAST_BYTES``, less on a small driver."""
    return min(DEFAULT_BROADCAST_BYTES, driver_heap(spark) // HEAP_SHARE)


def size_in_bytes(df: DataFrame, known_rows: int | None = None) -> int:
    """Bytes of ``df``'s rows: fixed-width columns by type, strings as measured.
    ``known_rows`` saves the count when the row count is proven and no column varies."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary", "array", "map", "struct")]
    fixed = _ROW_BYTES + 8 * (len(df.columns) - len(texts))
    if known_rows is not None and not texts:
        return known_rows * fixed
    row = df.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(F.octet_length(F.col(c).cast("string"))), F.lit(0)).alias(f"b{i}")
                                            for i, c in enumerate(texts)]).first()
    return row["n"] * (fixed + 8 * len(texts)) + sum(row[f"b{i}"] for i in range(len(texts)))


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None,
                       known_rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` has at most ``max_bytes`` (default: ``broadcast_budget``).

    ``known_rows`` skips the count when the size is proven by construction
    (e.g. a calendar of ``end - start + 1`` days)."""
    known_rows = known_rows if known_rows is not None else getattr(df, "_strata_rows", None)
    max_bytes = broadcast_budget(df.sparkSession) if max_bytes is None else max_bytes
    return F.broadcast(df) if size_in_bytes(df, known_rows) <= max_bytes else df


@dataclass
class Lookup:
    name: str
    dim: DataFrame
    on: list            # [(fact column name or Column, dim column name)]
    key_col: str        # dimension surrogate key
    out: str            # output column on the fact
    how: str = "inner"  # "inner" drops unmatched facts (Q10); "left" keeps them with NULL
    current_flag: str | None = None
    broadcast_rows: int | None = None  # proven size, skips the count
    extra: list = field(default_factory=list)  # more dim columns to carry, as (dim col, out name)


def _prepared(lk: Lookup, i: int, left: list) -> tuple[DataFrame, list]:
    """The lookup's narrow dimension, broadcast if the bytes ``left`` of the budget hold it."""
    d = lk.dim
    bound = lk.broadcast_rows if lk.broadcast_rows is not None else getattr(d, "_strata_rows", None)
    if lk.current_flag:
        d = d.filter(F.col(lk.current_flag))
    names = [f"__lk{i}_{j}" for j in range(len(lk.on))]
    d = d.select(*[F.col(dc).alias(n) for (_, dc), n in zip(lk.on, names)],
                 F.col(lk.key_col).alias(lk.out),
                 *[F.col(c).alias(o) for c, o in lk.extra])
    size = size_in_bytes(d, bound)
    if size <= left[0]:
        left[0] -= size
        d = F.broadcast(d)
    return d, names


def _fact_side(fact: DataFrame, lk: Lookup, names: list) -> DataFrame:
    for (fc, _), n in zip(lk.on, names):
        fact = fact.withColumn(n, F.col(fc) if isinstance(fc, str) else fc)
    return fact


def lookup_keys(fact: DataFrame, lookups: list, max_bytes: int | None = None) -> DataFrame:
    """Add one surrogate-key column per lookup; inner lookups drop facts with
    no match, left lookups keep them with a NULL key (JOIN-5)."""
    left = [broadcast_budget(fact.sparkSession) if max_bytes is None else max_bytes]
    for i, lk in enumerate(lookups):
        d, names = _prepared(lk, i, left)
        fact = _fact_side(fact, lk, names).join(d, names, lk.how).drop(*names)
    return fact


def rejected_rows(fact: DataFrame, lookups: list, max_bytes: int | None = None) -> DataFrame:
    """Fact rows an inner lookup would drop, with the failing lookup's name.
    A row that fails several lookups is listed once per failure. One pass over
    the fact: every lookup marks its hits, and the names without one are exploded."""
    left = [broadcast_budget(fact.sparkSession) if max_bytes is None else max_bytes]
    cols, missed = fact.columns, []
    out = fact
    for i, lk in enumerate(lookups):
        if lk.how != "inner":
            continue
        d, names = _prepared(lk, i, left)
        hit = f"__hit{i}"
        out = _fact_side(out, lk, names).join(d.select(*names, F.lit(True).alias(hit)), names, "left").drop(*names)
        missed.append(F.when(F.col(hit).isNull(), F.lit(lk.name)))
    if not missed:
        return fact.limit(0).withColumn("failed_lookup", F.lit(None).cast("string"))
    return out.select(*cols, F.explode(F.array_compact(F.array(*missed))).alias("failed_lookup"))
