import json
import os

from pyspark.sql import functions as F

from strata.streaming import land_stream


def test_land_stream_exactly_once(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    ok = {"errors": [], "results": 2, "response": [{"team": {"id": 1}}, {"team": {"id": 2}}]}
    (src / "a.json").write_text(json.dumps(ok))
    (src / "b.json").write_text(json.dumps({"errors": {"token": "bad"}, "response": [{"x": 1}]}))
    base, ckpt = str(tmp_path / "lake"), str(tmp_path / "ckpt")
    land_stream(spark, "teams", str(src), base, ckpt).awaitTermination()
    # a second file arrives; the first is not landed again
    (src / "c.json").write_text(json.dumps({"errors": [], "response": [{"team": {"id": 3}}]}))
    land_stream(spark, "teams", str(src), base, ckpt).awaitTermination()
    bronze = spark.read.parquet(os.path.join(base, "bronze", "teams"))
    ids = sorted(r["id"] for r in bronze.collect())
    assert ids == [1, 2, 3]
    teams = sorted(r["t"] for r in bronze.select(F.get_json_object("payload", "$.team.id").alias("t")).collect())
    assert teams == ["1", "2", "3"]
    rejected = spark.read.parquet(os.path.join(base, "rejected", "teams"))
    assert rejected.count() == 1


def test_batch_and_stream_loads_share_bronze(spark, tmp_path):
    import datetime as dt
    from strata.plans.pipeline import land
    from strata.plans.store import LayerStore
    src = tmp_path / "incoming"
    src.mkdir()
    (src / "a.json").write_text(json.dumps({"errors": [], "response": [{"team": {"id": 1}}]}))
    base = str(tmp_path / "lake")
    land_stream(spark, "teams", str(src), base, str(tmp_path / "ckpt")).awaitTermination()
    batch = tmp_path / "batch"
    batch.mkdir()
    (batch / "b.json").write_text(json.dumps({"errors": [], "response": [{"team": {"id": 2}}]}))
    store = LayerStore(spark, base)
    assert land(spark, store, "teams", str(batch), dt.datetime(2024, 1, 1)) == 1
    assert store.read("bronze", "teams").count() == 2


def test_streams_with_new_checkpoints_keep_each_others_loads(spark, tmp_path):
    base = str(tmp_path / "lake")
    for k in (1, 2):
        src = tmp_path / f"in{k}"
        src.mkdir()
        (src / "a.json").write_text(json.dumps({"errors": [], "response": [{"team": {"id": k}}]}))
        (src / "b.json").write_text(json.dumps({"errors": ["x"], "response": []}))
        land_stream(spark, "teams", str(src), base, str(tmp_path / f"ckpt{k}")).awaitTermination()
    assert spark.read.parquet(os.path.join(base, "bronze", "teams")).count() == 2
    assert spark.read.parquet(os.path.join(base, "rejected", "teams")).count() == 2


def test_ids_are_unique_over_batch_and_stream_loads(spark, tmp_path):
    import datetime as dt
    from strata.operators.dq import dq_not_null, dq_unique
    from strata.plans.pipeline import land
    from strata.plans.store import LayerStore
    base = str(tmp_path / "lake")
    store = LayerStore(spark, base)
    for k, how in enumerate(("batch", "stream", "batch", "stream")):
        src = tmp_path / f"in{k}"
        src.mkdir()
        for f in range(3):
            (src / f"{f}.json").write_text(json.dumps({"errors": [], "response": [{"team": {"id": 10 * k + f}}, {"team": {"id": 5}}]}))
        if how == "batch":
            land(spark, store, "teams", str(src), dt.datetime(2024, 1, 1 + k))
        else:
            land_stream(spark, "teams", str(src), base, str(tmp_path / f"ckpt{k}")).awaitTermination()
    bronze = store.read("bronze", "teams")
    assert bronze.count() == 24 and dq_unique(bronze, ["id"]).isEmpty() and dq_not_null(bronze, ["id", "payload"]).isEmpty()
