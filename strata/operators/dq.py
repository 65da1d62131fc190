"""Data-quality checks that replace the reference's constraints (DQ-1..4).

Each check returns the *violating rows*; ``assert_clean`` raises if any check
found one, which is how a layer is refused before it is published (Q12). All
checks are aggregations with map-side partial aggregation, so a hot key costs
one partial row per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.keys import known_rows
from strata.operators.lookup import broadcast_budget, size_in_bytes


class DataQualityError(Exception):
    pass


def dq_unique(df: DataFrame, keys: list) -> DataFrame:
    """DQ-1: key values that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def dq_not_null(df: DataFrame, cols: list) -> DataFrame:
    """DQ-2: one pass over ``df``; one row ``(column_name, null_count)`` per
    column that has NULLs."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols
    ])).alias("x")).select("x.*")
    return stacked.filter(F.col("null_count") > 0)


def dq_fk_orphans(fact: DataFrame, dim: DataFrame, fact_cols: list, dim_cols: list | None = None) -> DataFrame:
    """DQ-3: fact rows whose (non-NULL) foreign key has no row in ``dim``.
    A NULL foreign key is not a violation, as in SQL."""
    dim_cols = dim_cols or fact_cols
    d = dim.select(*[F.col(dc).alias(fc) for fc, dc in zip(fact_cols, dim_cols)])  # an anti join needs no distinct
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fact_cols])
    return fact.filter(nn).join(d, fact_cols, "left_anti")


def key_and_null_checks(df: DataFrame, name: str, keys: list, not_null: list, uniques: list = ()) -> DataFrame:
    """DQ-1 and DQ-2 of a table in one frame: the names (``check``) of those that fail. Keys and
    nulls share one scan and one aggregation; every further unique key adds one."""
    nulls = [f"__null{i}" for i in range(len(not_null))]
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(a) for c, a in zip(not_null, nulls)])
    whole = per.agg(F.max("__n").alias("__n"), *[F.max(a).alias(a) for a in nulls])
    some = reduce(lambda a, b: a | b, [F.col(a) > 0 for a in nulls], F.lit(False))
    found = F.array(F.when(F.col("__n") > 1, F.lit(f"{name}.unique")), F.when(some, F.lit(f"{name}.not_null")))
    out = whole.select(F.explode(F.array_compact(found)).alias("check"))
    for i, u in enumerate(uniques):
        out = out.unionByName(dq_unique(df, u).select(F.lit(f"{name}.unique{i}").alias("check")).limit(1))
    return out


def fk_checks(fact: DataFrame, name: str, fks: list, max_bytes: int | None = None) -> DataFrame:
    """DQ-3 of all foreign keys of a fact in one scan: the names (``check``) of those with orphans.
    Dimensions are unique on these columns (DQ-1); a repeated key would only repeat a marker.

    ``fks``: ``(fact columns, dimension, dimension columns)`` each. Every dimension's keys are
    joined as a marker (broadcast as far as one budget of bytes goes), and the names of the
    keys that are not NULL and found no marker come out of the one pass."""
    out, missed = fact.select(*sorted({c for cols, _, _ in fks for c in cols})), []
    left = broadcast_budget(fact.sparkSession) if max_bytes is None else max_bytes
    for i, (cols, dim, dim_cols) in enumerate(fks):
        names = [f"__fk{i}_{j}" for j in range(len(cols))]
        d = dim.select(*[F.col(c).alias(n) for c, n in zip(dim_cols, names)])
        size = size_in_bytes(d, known_rows(dim))
        if size <= left:
            left, d = left - size, F.broadcast(d)
        on = reduce(lambda a, b: a & b, [F.col(c) == F.col(n) for c, n in zip(cols, names)])
        out = out.join(d.withColumn(f"__hit{i}", F.lit(True)), on, "left").drop(*names)
        there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        missed.append(F.when(there & F.col(f"__hit{i}").isNull(), F.lit(f"{name}.{cols[0]}_fk")))
    return out.select(F.explode(F.array_compact(F.array(*missed))).alias("check")).distinct()


def dq_one_current(dim: DataFrame, key: list, flag: str = "is_current") -> DataFrame:
    """DQ-4: business keys with more than one current version."""
    return dq_unique(dim.filter(F.col(flag)), key)


def failing_checks(checks: dict, at_once: int | None = None) -> list:
    """Names of the checks that found violations, in one Spark action, or one for every ``at_once``
    frames: the driver holds the plans and broadcast keys of an action's frames together. A frame of the one
    column ``check`` holds such names itself; any other frame holds the violations of the check
    it is filed under, and contributes at most one row."""
    parts = [df if df.columns == ["check"] else df.select(F.lit(name).alias("check")).limit(1) for name, df in checks.items()]
    step = at_once or max(1, len(parts))
    jobs = [reduce(DataFrame.unionByName, parts[i:i + step]) for i in range(0, len(parts), step)]
    return sorted({r["check"] for job in jobs for r in job.collect()})


def assert_clean(checks: dict, at_once: int | None = None) -> None:
    """Raise ``DataQualityError`` naming every check that found violations."""
    bad = failing_checks(checks, at_once)
    if bad:
        raise DataQualityError("data-quality checks failed: " + ", ".join(bad))
