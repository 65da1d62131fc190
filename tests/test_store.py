"""Publishing, partitioned writes and load ledgers of the layer store."""

import threading

import pytest
from pyspark.sql import functions as F

from strata.plans.store import LayerStore, StoreConflict
from strata.schemas import schema_of
from tests.test_operators import plan_of


def test_of_two_runs_from_one_version_exactly_one_publishes(spark, tmp_path):
    one = LayerStore(spark, str(tmp_path))
    for _ in range(6):
        one.publish("gold", one.begin("gold"))
    assert one.current_version("gold") == 6
    stores = [LayerStore(spark, str(tmp_path)) for _ in range(8)]
    versions = [s.begin("gold") for s in stores]
    assert sorted(versions) == list(range(7, 15))
    for store, v in zip(stores, versions):
        store.write("gold", "t", spark.createDataFrame([(v,)], "x int"), v)
    won, lost, ready = [], [], threading.Barrier(8)

    def publish(store, v):
        ready.wait()
        try:
            store.publish("gold", v)
            won.append(v)
        except StoreConflict:
            lost.append(v)

    threads = [threading.Thread(target=publish, args=a) for a in zip(stores, versions)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and len(lost) == 7 and one.current_version("gold") == won[0]
    # a run that began before that publication cannot follow it either, a new one can
    with pytest.raises(StoreConflict):
        stores[0 if versions[0] != won[0] else 1].publish("gold", versions[0 if versions[0] != won[0] else 1])
    later = one.begin("gold")
    assert later == 15
    one.publish("gold", later)
    assert one.current_version("gold") == 15 and not list((tmp_path / "gold" / "_published").glob(".draft*"))


def test_a_large_season_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 40_000, numPartitions=16).select(
        F.col("id").cast("int").alias("fixture_id"), F.lit(20230101).alias("date_key"), F.lit(1).alias("league_key"),
        (F.col("id") % 97).cast("int").alias("home_team_key"), (F.col("id") * 31 % 89).cast("int").alias("away_team_key"),
        F.lit(None).cast("int").alias("venue_key"), F.when(F.col("id") % 10 > 0, 2023).otherwise(F.col("id") % 8 + 2000).cast("int").alias("season"),
        F.sha2(F.col("id").cast("string"), 256).alias("status_short"), F.lit(1).alias("goals_home"), F.lit(0).alias("goals_away"),
        F.lit(1).alias("goals_total"), F.lit(1).cast("smallint").alias("result"))
    assert "REBALANCE" in plan_of(rows.hint("rebalance", "season"))
    store = LayerStore(spark, str(tmp_path))
    keep = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "262144")
    try:
        out = store.write("gold", "fact_fixture", rows, store.begin("gold"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", keep)
    files = {p.name: len(list(p.glob("part-*"))) for p in (tmp_path / "gold" / "v000001" / "fact_fixture").glob("season=*")}
    assert len(files) == 5 and files["season=2023"] >= 4 and all(n <= 2 for s, n in files.items() if s != "season=2023")
    assert out.count() == 40_000 and out._strata_rows == 40_000


def test_unmerged_loads_prune_the_scan(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    schema = schema_of("bronze", "teams")
    for k in range(12):
        df = spark.createDataFrame([(k, f'{{"n": {k}}}', None, "teams", None, "h")], "id long, payload string, source_params string, source string, loaded_at timestamp, record_hash string")
        store.append_bronze("teams", df.withColumn("loaded_at", F.current_timestamp()), f"stream-q-{k:012d}")
    ledger = spark.createDataFrame([("teams", f"stream-q-{k:012d}") for k in range(10)] + [("leagues", "stream-q-000000000010")], "bronze string, load string")
    rows = store.unmerged("teams", ledger)
    assert rows.columns == schema.fieldNames() and sorted(r["id"] for r in rows.collect()) == [10, 11]
    assert "dynamicpruning" in plan_of(rows)
    assert store.unmerged("fixtures", ledger).count() == 0


def test_upsert_reads_untouched_seasons_past_the_join(spark, tmp_path, monkeypatch):
    from strata.operators import facts
    cols = "fixture_id int, season int, goals int"
    spark.createDataFrame([(k, 2000 + k % 6 if k % 7 else None, k) for k in range(60)], cols).write.partitionBy("season").parquet(str(tmp_path / "f"))
    target = spark.read.schema(cols).parquet(str(tmp_path / "f")).select("fixture_id", "season", "goals")
    before = {r[0]: tuple(r) for r in target.collect()}
    # a new match of 2003, one changed in place, one moved from 2001 to 2003
    moved = next(k for k, r in before.items() if r[1] == 2001)
    same = next(k for k, r in before.items() if r[1] == 2003)
    rows = [(100, 2003, 1), (same, 2003, -1), (moved, 2003, -2)]
    joined = []
    keep = facts.merge_upsert
    monkeypatch.setattr(facts, "merge_upsert", lambda t, *a, **k: (joined.append(plan_of(t)), keep(t, *a, **k))[1])
    out = facts.upsert_partitions(target, spark.createDataFrame(rows, cols), ["fixture_id"], "season")
    got = {r[0]: tuple(r) for r in out.collect()}
    assert got == before | {r[0]: r for r in rows} and out.count() == 61
    assert "PartitionFilters" in joined[0] and "2003" in joined[0] and "2001" in joined[0] and "2004" not in joined[0]
    null = facts.upsert_partitions(target, spark.createDataFrame([(7, None, 5)], cols), ["fixture_id"], "season")
    assert {r[0]: tuple(r) for r in null.collect()} == before | {7: (7, None, 5)}
    keyed = target.selectExpr("fixture_id + 1 as key", "fixture_id", "season", "goals").filter("season is not null")
    out = facts.upsert_partitions(keyed, spark.createDataFrame([(200, 2001, 0), (1, 2001, -9)], cols), ["fixture_id", "season"], "season", "key")
    assert sorted(r["key"] for r in out.filter("fixture_id = 200 or goals = -9").collect()) == [2, 61]


def many_loads(spark, store, n):
    rows = spark.range(0, n, numPartitions=4).select(
        F.col("id"), F.concat(F.lit('{"n": '), F.col("id"), F.lit("}")).alias("payload"), F.lit(None).cast("string").alias("source_params"),
        F.lit("teams").alias("source"), F.timestamp_seconds("id").alias("loaded_at"), F.lit("h").alias("record_hash"),
        F.format_string("stream-q-%012d", "id").alias("load"))
    rows.write.partitionBy("load").parquet(store.table_path("bronze", "teams"))


def test_two_thousand_loads_are_merged_and_compacted_without_a_list_on_the_driver(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    many_loads(spark, store, 2000)
    version = store.begin("silver")
    listed = store.bronze("teams").select(F.lit("teams").alias("bronze"), "load").filter("id < 1990").distinct()
    listed.coalesce(1).write.parquet(f"{store.base}/silver/v{version:06d}/_loads")
    store.publish("silver", version)
    ledger = lambda: spark.read.parquet(f"{store.base}/silver/v{version:06d}/_loads")
    assert sorted(r["id"] for r in store.unmerged("teams", ledger()).collect()) == list(range(1990, 2000))
    name = store.compact_bronze("teams")
    loads = {p.name for p in (tmp_path / "bronze" / "teams").glob("load=*")}
    assert len(loads) == 11 and f"load={name}" in loads
    assert len(list((tmp_path / "bronze" / "teams" / f"load={name}").glob("part-*"))) <= 8
    assert sorted(r["id"] for r in store.read("bronze", "teams").collect()) == list(range(2000))
    assert sorted(r["id"] for r in store.unmerged("teams", ledger()).collect()) == list(range(1990, 2000))
    assert store.compact_bronze("teams") is None and store.compact_bronze("fixtures") is None


def test_a_compaction_that_was_cut_short_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    store = LayerStore(spark, str(tmp_path))
    many_loads(spark, store, 6)
    version = store.begin("silver")
    spark.createDataFrame([("teams", f"stream-q-{k:012d}") for k in range(4)], "bronze string, load string").write.parquet(
        f"{store.base}/silver/v{version:06d}/_loads")
    store.publish("silver", version)
    calls = []
    keep = LayerStore._finish_compactions
    monkeypatch.setattr(LayerStore, "_finish_compactions", lambda self, root: (calls.append(1), keep(self, root) if len(calls) == 1 else 1 / 0))
    with pytest.raises(ZeroDivisionError):
        store.compact_bronze("teams")
    monkeypatch.setattr(LayerStore, "_finish_compactions", keep)
    seen = [r["id"] for r in store.read("bronze", "teams").collect()]
    assert sorted(set(seen)) == list(range(6)) and len(seen) == 10  # twice for a while, never missing
    store.compact_bronze("teams")
    assert sorted(r["id"] for r in store.read("bronze", "teams").collect()) == list(range(6))
    assert not any((tmp_path / "bronze" / "teams" / "_compacted").glob("*"))
