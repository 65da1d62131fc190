"""Physical-plan properties that matter at scale (checked on sf0.001)."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def explain(spark, name):
    df = E.queries()[name](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_latest_by_limits_groups_before_the_shuffle(spark):
    txt = explain(spark, "distinct_on_latest")
    partial = txt.index("WindowGroupLimit")
    assert "Partial" in txt and "Final" in txt
    # the partial limit sits below (after, in the tree text) the exchange
    tree = txt.split("\n\n")[0]
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")
    assert partial >= 0


def test_fact_lookups_are_broadcast_and_pruned(spark):
    txt = explain(spark, "fact_match")
    tree = txt.split("\n\n")[0]
    assert tree.count("BroadcastHashJoin") == 5  # the lookups; keys are numbered without a join
    assert "SortMergeJoin" not in tree
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," \
           "o_orderdate:timestamp_ntz>" in txt               # only the used order columns


def test_current_filter_reaches_a_stored_dimension(spark, tmp_path):
    from pyspark.sql import functions as F
    from strata.operators.lookup import Lookup, lookup_keys
    dim = spark.createDataFrame([(1, 10, True), (2, 10, False)], "team_key int, team_id int, is_current boolean")
    dim.write.parquet(str(tmp_path / "dim"))
    stored = spark.read.parquet(str(tmp_path / "dim"))
    fact = spark.createDataFrame([(100, 10)], "fixture_id int, home_team_id int")
    out = lookup_keys(fact, [Lookup("home", stored, [("home_team_id", "team_id")], "team_key",
                                    "home_team_key", current_flag="is_current")])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain(mode="formatted")
    txt = buf.getvalue()
    assert "EqualTo(is_current,true)" in txt and "BroadcastHashJoin" in txt
    assert [r["home_team_key"] for r in out.collect()] == [1]


def test_first_load_does_not_join_an_empty_target(spark):
    tree = explain(spark, "fact_snapshot").split("\n\n")[0]
    assert "FullOuter" not in tree


def test_marts_aggregate_partially_and_reuse_partitioning(spark):
    tree = explain(spark, "mart_team_season").split("\n\n")[0]
    assert tree.count("HashAggregate") >= 4                  # partial + final on both sides
    # the drill-across join adds no exchange of its own above the aggregates
    top = tree.split("SortMergeJoin LeftOuter")[0]
    assert "Exchange" not in top


def test_json_documents_are_parsed_once(spark):
    txt = explain(spark, "json_project_typed")
    assert txt.count("from_json(") == 2  # one in each branch: the documents of version 1 and of version 2


def test_season_filter_prunes_fact_partitions(spark, tmp_path):
    from pyspark.sql import functions as F
    from strata.plans.store import LayerStore
    from strata.schemas import schema_of
    store = LayerStore(spark, str(tmp_path / "lake"))
    rows = [(i, 20230101, 1, 1, 2, None, 2022 + i % 2, "FT", 1, 0, 1, 1) for i in range(4)]
    df = spark.createDataFrame(rows, schema_of("gold", "fact_fixture"))
    store.write("gold", "fact_fixture", df, 1)
    store.publish("gold", 1)
    q = store.read("gold", "fact_fixture").filter(F.col("season") == 2023)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain(mode="formatted")
    assert "PartitionFilters: [isnotnull(season" in buf.getvalue()
    assert q.count() == 2


def test_upsert_and_scd2_run_one_outer_join(spark, monkeypatch):
    """The join is in the eager job alone: what is returned scans its written rows."""
    from strata.operators import dims, facts
    seen = []

    def plan(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue()

    for module in (dims, facts):
        keep = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label="t", keep=keep: (seen.append(plan(df)), keep(df, label))[1])
    target = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "key int, k int, v string")
    out = facts.upsert_fact(target, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"], key_col="key")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, "a"), (2, 2, "c"), (3, 3, "d")]
    assert sum("FullOuter" in p for p in seen) == 1 and "FullOuter" not in plan(out)
    seen.clear()
    dim = spark.sql("select 1 as key, 7 as id, 'x' as n, date '2024-01-01' as valid_from, date '9999-12-31' as valid_to, true as is_current")
    out = dims.scd2_apply(dim, spark.createDataFrame([(7, "y"), (8, "z")], "id int, n string"), ["id"], ["n"], "key", "2024-02-01")
    assert out.count() == 3
    assert sum("FullOuter" in p for p in seen) == 1 and "FullOuter" not in plan(out)

