"""Connected components of an edge table in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge, root being its component's least node.

    ``edges`` has two long columns ``u, v``. Alternates the large-star and
    small-star steps: each keeps the components and points nodes at ever smaller
    neighbours, until every edge leads from a node to its root; the rounds grow
    with the logarithm of a component's size. Minima are combined before the
    shuffle, and a node with very many edges is split by the skew join. Each
    round's edges are written to the shared folder, two numbers come back.
    """
    e = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(e)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = cut(small, "edges")
        mark, old = _mark(e), mark
        if mark == old:
            break
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
