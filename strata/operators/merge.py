"""Keyed write semantics on immutable files (SINK-3..7, JOIN-8).

SQL ``MERGE`` / ``UPDATE`` are not available on plain Parquet tables, so each
statement is a join that computes the *new version* of the target, which the
store then writes as a new table version:

* ``merge_upsert``  MERGE ... WHEN MATCHED UPDATE / WHEN NOT MATCHED INSERT
* ``insert_absent`` INSERT ... ON CONFLICT DO NOTHING
* ``update_from``   UPDATE t SET ... FROM s WHERE ...

Presence of each side is carried as a literal flag through the full outer
join; values are never ``coalesce``d, so a NULL in the source overwrites a
non-NULL target value as MERGE does. Keys must be non-NULL on both sides and
the source unique on them (checked by the DQ operators before publishing).
Both sides are hash-partitioned on the keys once; a source produced by
``latest_by`` on the same keys is already partitioned that way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_S = "__s_"


def _src(c: str) -> Column:
    return F.col(_S + c)


def merge_upsert(target: DataFrame, source: DataFrame, keys: list,
                 update_cols: list | None = None,
                 insert_cols: list | None = None,
                 not_older_by: str | None = None) -> DataFrame:
    """Rows of ``target`` after ``MERGE INTO target USING source ON keys``.

    ``update_cols`` are overwritten on a match (default: every non-key target
    column the source has); columns outside it keep the target value (SINK-4).
    ``insert_cols`` are taken from the source for new keys (default: every
    target column the source has); other columns are NULL on insert. No delete
    branch: target rows absent from the source are kept (Q11).

    With ``not_older_by`` a match updates only if the source's value of that
    column is not below the target's, so merging loads in any order ends in
    the same table as merging all of them at once.
    """
    tcols = target.columns
    scols = set(source.columns)
    non_keys = [c for c in tcols if c not in keys]
    if update_cols is None:
        update_cols = [c for c in non_keys if c in scols]
    if insert_cols is None:
        insert_cols = [c for c in tcols if c in scols]
    needed = [c for c in non_keys if c in set(update_cols) | set(insert_cols)]
    t = target.withColumn("__t", F.lit(True))
    s = source.select(*keys, *[F.col(c).alias(_S + c) for c in needed],
                      F.lit(True).alias("__s"))
    j = t.join(s, on=keys, how="full_outer")
    t_only, s_only = F.col("__s").isNull(), F.col("__t").isNull()
    out = []
    for c in tcols:
        if c in keys:
            out.append(F.col(c).cast(target.schema[c].dataType).alias(c))
            continue
        ins = _src(c) if c in insert_cols else F.lit(None)
        upd = _src(c) if c in update_cols else F.col(c)
        if not_older_by and c in update_cols:
            upd = F.when(_src(not_older_by) < F.col(not_older_by), F.col(c)).otherwise(upd)
        out.append(F.when(t_only, F.col(c)).when(s_only, ins).otherwise(upd)
                   .cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


def insert_absent(target: DataFrame, source: DataFrame, keys: list) -> DataFrame:
    """``INSERT INTO target SELECT * FROM source ON CONFLICT (keys) DO NOTHING``:
    the target plus the source rows whose key is not there yet (first write
    wins)."""
    new = source.join(target.select(*keys), on=keys, how="left_anti")
    return target.unionByName(new.select(*target.columns))


def update_from(target: DataFrame, source: DataFrame, keys: list,
                assignments: dict, condition=None) -> DataFrame:
    """``UPDATE target t SET col = expr FROM source s WHERE t.keys = s.keys
    AND condition``. ``assignments`` maps a target column to a function
    ``(t, s) -> Column`` where ``t(c)`` / ``s(c)`` name the two sides;
    ``condition`` is such a function returning a boolean. The row count of
    the target never changes (source unique on ``keys``)."""
    tcol = F.col
    scols = [c for c in source.columns if c not in keys]
    s = source.select(*keys, *[F.col(c).alias(_S + c) for c in scols],
                      F.lit(True).alias("__s"))
    j = target.join(s, on=keys, how="left")
    hit = F.col("__s").isNotNull()
    if condition is not None:
        hit = hit & F.coalesce(condition(tcol, _src), F.lit(False))
    out = []
    for c in target.columns:
        if c in assignments:
            out.append(F.when(hit, assignments[c](tcol, _src)).otherwise(F.col(c))
                       .cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)
