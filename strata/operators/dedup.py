"""AGG-10 / SORT-1: ``SELECT DISTINCT ON (keys) ... ORDER BY keys, loaded_at DESC``.

Written as ``row_number() OVER (PARTITION BY keys ORDER BY ...) = 1``. Spark
(3.5+) plans this with a partial ``WindowGroupLimit`` *before* the shuffle, so
every map task already keeps only its best row per key: a key that holds a
third of all rows sends one row per map task through the exchange, not the
whole group. The ordering must be total for a deterministic winner (Q6, Q13):
callers pass explicit tie-breaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_first(col: str) -> Column:
    """PostgreSQL ``DESC`` puts NULLs first; Spark's ``desc`` puts them last."""
    return F.col(col).desc_nulls_first()


def latest_by(df: DataFrame, keys: list, order: list) -> DataFrame:
    """Exactly one row per distinct ``keys`` value (NULL keys group together,
    as ``DISTINCT ON`` does): the first row under ``order``."""
    order_cols = [latest_first(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))
