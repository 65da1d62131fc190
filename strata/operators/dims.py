"""Dimensions: calendar (PIPE-7), Type 1 (PIPE-8) and Type 2 (PIPE-9/10).

All dimension functions return the *new version* of the dimension table.
Surrogate keys are assigned only to inserted rows (``assign_keys``), above the
current maximum, so existing keys never change.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exprs import iso_day_of_week, row_is_distinct, season_year
from strata.operators.keys import (assign_keys, date_key, known_rows, materialize, next_key_start,
                                  with_known_rows)
from strata.operators.merge import update_from

# Fixed values of the reference model: open-ended validity sentinel and the
# weekend days by ISO number (Saturday, Sunday).
END_OF_TIME = "9999-12-31"
WEEKEND_ISO_DAYS = (6, 7)

DIM_DATE_COLUMNS = ["date_key", "full_date", "year", "quarter", "month", "month_name",
                    "day", "day_of_week", "day_name", "week", "is_weekend", "season_year"]


def _as_date(x) -> Column:
    if isinstance(x, Column):
        return x.cast("date")
    if isinstance(x, (_dt.date, _dt.datetime)):
        x = x.strftime("%Y-%m-%d")
    return F.lit(x).cast("date")


def build_dim_date(spark: SparkSession, start=None, end=None, bounds: DataFrame | None = None,
                   season_start_month: int = 8) -> DataFrame:
    """One row per day in ``[start, end]`` with the 12 calendar columns.

    ``bounds`` may be a one-row DataFrame with ``start`` and ``end`` columns
    derived from data (e.g. min/max of a fact date); otherwise literals are
    used. The day count is ``end - start + 1`` (6,209 for 2010..2026), so the
    generator is bounded by the range, not by the data volume.
    """
    if bounds is None:
        bounds = spark.range(1).select(_as_date(start).alias("start"), _as_date(end).alias("end"))
    days = bounds.select(F.explode(F.sequence(F.col("start").cast("date"), F.col("end").cast("date"),
                                              F.expr("INTERVAL 1 DAY"))).alias("d"))
    d = F.col("d")
    dow = iso_day_of_week(d)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week"),
        dow.isin(*WEEKEND_ISO_DAYS).alias("is_weekend"),
        season_year(d, season_start_month).cast("int").alias("season_year"),
    )


def scd1(target: DataFrame, source: DataFrame, key: list, attrs: list, key_col: str,
         overwrite: bool = True) -> DataFrame:
    """PIPE-8. ``overwrite=False`` is the reference code (insert new natural
    keys, ``ON CONFLICT DO NOTHING``); ``overwrite=True`` is the documented
    Type 1 behaviour (attributes of existing keys are replaced). Existing
    surrogate keys never change; new keys are numbered in natural-key order."""
    src = source.select(*key, *attrs)
    if overwrite:
        kept = update_from(target, src, key,
                           {a: (lambda t, s, a=a: s(a)) for a in attrs})
    else:
        kept = target
    new = materialize(src.join(target.select(*key), key, "left_anti"), "new_members")
    start = next_key_start(target, key_col)
    new = assign_keys(new, key, key_col, start)
    return kept.unionByName(new.select(*target.columns))


def scd_initial(source: DataFrame, key: list, attrs: list, key_col: str, run_date=None,
                from_col="valid_from", to_col="valid_to", flag="is_current",
                key_type: str = "int") -> DataFrame:
    """First load of a dimension into an empty target: every source row gets a
    key in natural-key order; with ``run_date`` (Type 2) it also becomes the
    current version valid from ``run_date``. Same result as ``scd1`` /
    ``scd2_apply`` on an empty target without their joins."""
    cols = [*key, *attrs]
    if run_date is not None:
        cols += [_as_date(run_date).alias(from_col), F.lit(END_OF_TIME).cast("date").alias(to_col),
                 F.lit(True).alias(flag)]
    keyed = assign_keys(source.select(*cols), key, key_col, 0, key_type)
    return with_known_rows(keyed.select(key_col, *[c for c in keyed.columns if c != key_col]),
                           known_rows(keyed))


def _classify(target: DataFrame, source: DataFrame, key: list, tracked: list, flag: str):
    cur = target.filter(F.col(flag)).withColumn("__t", F.lit(True))
    s = source.select(*key, *[F.col(c).alias("__s_" + c) for c in tracked],
                      F.lit(True).alias("__s"))
    j = cur.join(s, key, "full_outer")
    both = F.col("__t").isNotNull() & F.col("__s").isNotNull()
    changed = both & row_is_distinct([F.col(c) for c in tracked],
                                     [F.col("__s_" + c) for c in tracked])
    return j, changed


def _current_rows(j: DataFrame, changed, target: DataFrame, run_date, to_col, flag) -> DataFrame:
    """The joined current rows, expired (``valid_to = run_date - 1``, not
    current) where the tracked tuple changed, unchanged otherwise."""
    expired_to = F.date_sub(_as_date(run_date), 1)

    def out(c):
        if c == to_col:
            v = F.when(changed, expired_to).otherwise(F.col(c))
        elif c == flag:
            v = F.when(changed, F.lit(False)).otherwise(F.col(c))
        else:
            v = F.col(c)
        return v.cast(target.schema[c].dataType).alias(c)

    return j.filter(F.col("__t").isNotNull()).select(*[out(c) for c in target.columns])


def _new_versions(rows: DataFrame, key: list, tracked: list, target: DataFrame,
                  key_col: str, run_date, from_col, to_col, flag) -> DataFrame:
    """Insert rows (``current_date, date '9999-12-31', true``) with new keys."""
    ins = rows.select(*key, *[F.col("__s_" + c).alias(c) for c in tracked],
                      _as_date(run_date).alias(from_col),
                      F.lit(END_OF_TIME).cast("date").alias(to_col),
                      F.lit(True).alias(flag))
    start = next_key_start(target, key_col)
    if known_rows(rows) is not None:
        ins = with_known_rows(ins, known_rows(rows))
    ins = assign_keys(ins, key, key_col, start, key_type=target.schema[key_col].dataType.simpleString())
    return ins.select(*[F.col(c).cast(target.schema[c].dataType) for c in target.columns])


def scd2_expire(target: DataFrame, source: DataFrame, key: list, tracked: list,
                run_date, to_col="valid_to", flag="is_current") -> DataFrame:
    """Step 1 of the reference: current rows whose tracked tuple IS DISTINCT
    FROM the source get ``valid_to = run_date - 1`` and ``is_current = false``.
    Keys absent from the source stay current (no delete branch, Q11)."""
    j, changed = _classify(target, source, key, tracked, flag)
    cur_rows = _current_rows(j, changed, target, run_date, to_col, flag)
    return target.filter(~F.col(flag)).unionByName(cur_rows)


def scd2_insert(target: DataFrame, source: DataFrame, key: list, tracked: list, key_col: str,
                run_date, from_col="valid_from", to_col="valid_to", flag="is_current") -> DataFrame:
    """Step 2 of the reference: source keys with no current row (brand-new or
    just expired) are inserted as current versions. Returns target + inserts."""
    cur = target.filter(F.col(flag)).select(*key)
    s = source.select(*key, *[F.col(c).alias("__s_" + c) for c in tracked])
    new = materialize(s.join(cur, key, "left_anti"), "new_members")
    ins = _new_versions(new, key, tracked, target, key_col, run_date, from_col, to_col, flag)
    return target.unionByName(ins)


def scd2_apply(target: DataFrame, source: DataFrame, key: list, tracked: list, key_col: str,
               run_date, from_col="valid_from", to_col="valid_to",
               flag="is_current") -> DataFrame:
    """PIPE-9 in one pass over ``current ⟗ source``: each source key is new,
    changed or unchanged; output = history ∪ unchanged/absent current rows ∪
    expired versions of changed rows ∪ new versions (new + changed).

    Equal to ``scd2_insert(scd2_expire(target))`` including Q7 (a second
    change on the same day expires a version with ``valid_to < valid_from``).
    The source must be unique on ``key`` (DQ-1) and the target have at most
    one current row per key (DQ-4); then no key can be hot in the join.
    """
    j, changed = _classify(target, source, key, tracked, flag)
    # the classifying join runs once: its rows are written, and all branches scan them
    j = materialize(j, "classified")
    hist = target.filter(~F.col(flag))
    cur_rows = _current_rows(j, changed, target, run_date, to_col, flag)
    to_insert = with_known_rows(j.filter(F.col("__t").isNull() | changed), known_rows(j))
    ins = _new_versions(to_insert, key, tracked, target, key_col, run_date,
                        from_col, to_col, flag)
    return hist.unionByName(cur_rows).unionByName(ins)


__all__ = ["build_dim_date", "scd1", "scd_initial", "scd2_apply", "scd2_expire", "scd2_insert",
           "END_OF_TIME", "DIM_DATE_COLUMNS"]
