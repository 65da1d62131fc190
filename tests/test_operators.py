"""Unit tests of the operators on small inline frames (edge cases)."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions.exprs import bool_pct, exact_avg, result_sign, row_is_distinct
from strata.operators.dedup import latest_by
from strata.operators.dims import build_dim_date, scd2_apply, scd2_expire, scd2_insert, scd_initial
from strata.operators.dq import (DataQualityError, assert_clean, dq_fk_orphans, dq_not_null,
                                 dq_one_current, dq_unique)
from strata.operators.keys import assign_keys
from strata.operators.merge import insert_absent, merge_upsert, update_from
from strata.sources.bronze import check_target
from strata.sources.envelope import explode_response, gate_errors, parse_envelopes

import pytest


def _key(t):
    return tuple((v is not None, v if v is not None else 0) if not isinstance(v, str) else (True, v)
                 for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_merge_null_overwrites_and_partial_update(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, frozen string")
    s = spark.createDataFrame([(1, None, "z"), (3, "c", "w")], "k int, v string, frozen string")
    out = merge_upsert(t, s, ["k"], update_cols=["v"])
    assert rows(out, "k", "v", "frozen") == [(1, None, "x"), (2, "b", "y"), (3, "c", "w")]


def test_insert_absent_first_write_wins(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "new"), (2, "b")], "k int, v string")
    assert rows(insert_absent(t, s, ["k"]), "k", "v") == [(1, "a"), (2, "b")]


def test_update_from_keeps_row_count(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    s = spark.createDataFrame([(1, "a"), (2, "B"), (3, None)], "k int, v string")
    out = update_from(t, s, ["k"], {"v": lambda tc, sc: sc("v")},
                      condition=lambda tc, sc: row_is_distinct([tc("v")], [sc("v")]))
    assert rows(out, "k", "v") == [(1, "a"), (2, "B"), (3, None)]


def test_latest_by_nulls_first_and_tiebreak(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1, 0), (1, None, 2, 0),
                                (2, dt.datetime(2024, 1, 2), 5, 1), (2, dt.datetime(2024, 1, 2), 5, 0)],
                               "k int, loaded_at timestamp, id int, pos int")
    out = latest_by(df, ["k"], [F.col("loaded_at").desc_nulls_first(), F.col("id").desc(),
                                F.col("pos").asc()])
    assert rows(out, "k", "id", "pos") == [(1, 2, 0), (2, 5, 0)]


def test_assign_keys_is_dense_for_any_partitioning(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7 % 3001).alias("k"))
    a = rows(assign_keys(df, ["k"], "key", 10), "k", "key")
    assert a == rows(assign_keys(df.repartition(5), ["k"], "key", 10), "k", "key")
    assert [key for _, key in a] == list(range(11, 3011))
    assert assign_keys(df.limit(0), ["k"], "key", 10).count() == 0


def test_result_sign_and_exact_decimals(spark):
    df = spark.createDataFrame([(3, 0), (1, 1), (0, 2), (None, 1)], "h int, a int")
    assert [r["r"] for r in df.select(result_sign("h", "a").alias("r")).collect()] == [1, 0, -1, None]
    g = spark.createDataFrame([(1, v) for v in [3] * 27 + [2] * 13], "g int, v int")  # 107 / 40
    out = g.groupBy("g").agg(exact_avg("v", 4, 2).alias("avg"), bool_pct(F.col("v") == 3).alias("pct"))
    r = out.first()
    assert str(r["avg"]) == "2.68" and str(r["pct"]) == "67.50"


def test_row_is_distinct_null_cases(spark):
    df = spark.createDataFrame([(None, None), (None, "x"), ("x", None), ("x", "y"), ("x", "x")],
                               "a string, b string")
    out = df.select(row_is_distinct([F.col("a")], [F.col("b")]).alias("d")).collect()
    assert [r["d"] for r in out] == [False, True, True, True, False]


def test_dim_date_calendar_rules(spark):
    d = build_dim_date(spark, "2022-12-31", "2025-01-05")
    by = {r["full_date"]: r for r in d.collect()}
    assert by[dt.date(2023, 1, 1)]["week"] == 52 and by[dt.date(2024, 12, 30)]["week"] == 1
    assert by[dt.date(2023, 7, 31)]["season_year"] == 2022 and by[dt.date(2023, 8, 1)]["season_year"] == 2023
    sun = by[dt.date(2023, 1, 1)]
    assert (sun["day_of_week"], sun["day_name"], sun["is_weekend"], sun["month_name"]) == (7, "Sunday", True, "January")
    assert sun["date_key"] == 20230101 and sun["quarter"] == 1
    full = build_dim_date(spark, "2010-01-01", "2026-12-31")
    assert full.count() == 6209


def _scd_frames(spark):
    src1 = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], "id int, n string, m string")
    tgt = scd_initial(src1, ["id"], ["n", "m"], "sk", "2024-01-01")
    src2 = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", "z")], "id int, n string, m string")
    return tgt, src2


def test_scd2_one_pass_equals_two_steps(spark):
    tgt, src2 = _scd_frames(spark)
    one = scd2_apply(tgt, src2, ["id"], ["n", "m"], "sk", "2024-02-01")
    two = scd2_insert(scd2_expire(tgt, src2, ["id"], ["n", "m"], "2024-02-01"), src2, ["id"], ["n", "m"],
                      "sk", "2024-02-01")
    cols = ["sk", "id", "n", "m", "valid_from", "valid_to", "is_current"]
    assert rows(one, *cols) == rows(two, *cols)
    cur = {r["id"]: r for r in one.filter("is_current").collect()}
    assert set(cur) == {1, 2, 3, 4}                    # 3 absent from source stays current (Q11)
    assert cur[1]["sk"] == 1                            # NULL -> NULL is not a change
    assert cur[2]["sk"] == 4 and cur[4]["sk"] == 5      # x -> NULL is a change; new key 4
    assert dq_one_current(one, ["id"]).count() == 0


def test_scd2_same_day_second_change_inverts_interval(spark):
    tgt, src2 = _scd_frames(spark)
    day2 = scd2_apply(tgt, src2, ["id"], ["n", "m"], "sk", "2024-02-01")
    src3 = spark.createDataFrame([(2, "B", None)], "id int, n string, m string")
    day2b = scd2_apply(day2, src3, ["id"], ["n", "m"], "sk", "2024-02-01")
    inverted = day2b.filter((F.col("id") == 2) & (F.col("valid_to") < F.col("valid_from")))
    assert inverted.count() == 1                        # Q7


def test_dq_checks(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (2, 3)], "k int, v int")
    assert rows(dq_unique(df, ["k"]), "k", "n") == [(1, 2)]
    assert rows(dq_not_null(df, ["k", "v"]), "column_name", "null_count") == [("v", 1)]
    dim = spark.createDataFrame([(2,), (3,)], "v int")
    assert rows(dq_fk_orphans(df, dim, ["v"]), "k", "v") == []
    with pytest.raises(DataQualityError):
        assert_clean({"u": dq_unique(df, ["k"])})


def test_envelope_gate_cases(spark):
    bodies = [
        ('{"errors":[],"results":1,"response":[{"a":1}]}', True),
        ('{"errors":{},"results":0,"response":[]}', True),
        ('{"results":1,"response":[{"a":2}]}', True),
        ('{"errors":{"token":"bad"},"response":[{"a":3}]}', False),
        ('{"errors":["x"],"response":[]}', False),
        ('{"errors":null,"response":[{"a":4}]}', False),
        ('not json', False),
    ]
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(bodies)], "i int, body string")
    good, bad = gate_errors(parse_envelopes(df))
    assert sorted(r["i"] for r in good.collect()) == [i for i, (_, ok) in enumerate(bodies) if ok]
    items = explode_response(good, keep=["i"])
    assert rows(items, "i", "pos", "payload") == [(0, 0, '{"a":1}'), (2, 0, '{"a":2}')]


def test_payloads_stay_as_received(spark):
    from strata.sources.envelope import raw_parts
    element = '{"a": 1.10, "b":12345678901234567890123.5,  "c":[1 , 2],"d":"\\u00e9]"}'
    body = '{"get":"x", "errors":[], "response":[' + element + ' , 7,null,"t"] }'
    df = spark.createDataFrame([(0, body)], "i int, body string")
    good, _ = gate_errors(parse_envelopes(df))
    got = [r["payload"] for r in explode_response(good).orderBy("pos").collect()]
    assert got == [element, "7", "null", '"t"']
    for bad in (None, "", "[]", "{", '{"response":[1}', '{"response":[NaN]}', '{"response":{}}', '{"response":[1]} x', "not json"):
        assert raw_parts(bad)[1] is None
    assert raw_parts('{"errors":[ ],"response":null}') == ("[ ]", []) and raw_parts("{}") == (None, [])


@pytest.mark.parametrize("doc", ['{"league":{"id":1},"seasons":[{"year":2020},5,{"year":2021}]}',
                                 '{"league":{"id":1},"seasons":{"year":2020}}', '{"league":{"id":1},"seasons":[null]}'])
def test_wrong_array_types_fail_the_layer(spark, doc):
    from strata.plans.football import project_seasons, project_standings
    df = spark.createDataFrame([(doc,)], "payload string").selectExpr("payload", "timestamp '2024-01-01' as loaded_at", "1L as id")
    with pytest.raises(Exception, match="is not an array|is not an object"):
        project_seasons(df).collect()
    table = df.withColumn("payload", F.lit('{"league":{"id":1,"season":2020,"standings":[[5]]}}'))
    with pytest.raises(Exception, match="is not an object"):
        project_standings(table).collect()


def test_older_records_do_not_update(spark):
    from strata.operators.merge import merge_upsert
    schema = "k int, v string, loaded_at int"
    target = spark.createDataFrame([(1, "new", 5), (2, "old", 1)], schema)
    source = spark.createDataFrame([(1, "late", 3), (2, None, 2), (3, "first", 0)], schema)
    out = merge_upsert(target, source, ["k"], not_older_by="loaded_at")
    assert rows(out, "k", "v", "loaded_at") == [(1, "new", 5), (2, None, 2), (3, "first", 0)]


def test_staging_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace
    from strata.session import _set_checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077",
                         getConf=lambda: SimpleNamespace(get=lambda *a: None))
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _set_checkpoint_dir(session, sc)


def test_store_raises_instead_of_reading_empty(spark, tmp_path):
    from strata.plans.store import LayerStore, StoreConflict
    store = LayerStore(spark, str(tmp_path))
    assert store.read("gold", "dim_team").count() == 0
    one, two = store.begin("gold"), LayerStore(spark, str(tmp_path))
    other = two.begin("gold")
    assert (one, other) == (1, 2)
    store.publish("gold", one)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read("gold", "dim_team")
    with pytest.raises(StoreConflict):
        two.publish("gold", other)


def test_bronze_whitelist():
    assert check_target("teams") == "teams"
    with pytest.raises(ValueError):
        check_target("gold.dim_team")


def plan_of(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_arrival_ids_need_no_payload_exchange(spark, tmp_path):
    """Files, lines and array positions in order, above the start, equal in a second evaluation."""
    import json
    from strata.operators.keys import materialize
    from strata.sources.bronze import arrival_ids, land_bronze
    from strata.sources.envelope import parse_envelopes, read_envelopes, staged
    n = 0
    for f in range(4):
        with open(tmp_path / f"p{f}.json", "w") as out:
            for line in range(30 * f % 70 + 1):
                items = [{"n": n + k} for k in range((line + f) % 5)]
                n += len(items)
                out.write(json.dumps({"get": "teams", "errors": [], "response": items}) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        whole = materialize(staged(parse_envelopes(read_envelopes(spark, str(tmp_path), True))))
        blocks = whole.select("source_file", "block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    landed = land_bronze(arrival_ids(whole, 500), "teams", F.current_timestamp(), id_col="id")
    first = {r["payload"]: r["id"] for r in landed.collect()}
    assert blocks > 4 and first == {r["payload"]: r["id"] for r in landed.collect()}
    in_order = [first[f'{{"n": {k}}}'] for k in range(n)]
    assert len(first) == n and in_order == sorted(set(in_order)) and in_order[0] > 500
    tree = plan_of(landed).split("\n\n")[0]
    assert "BroadcastHashJoin" in tree and tree.count("Exchange") == tree.count("BroadcastExchange")


def test_assign_keys_over_many_buckets(spark, monkeypatch):
    from strata.operators import keys
    monkeypatch.setattr(keys, "BUCKET_ROWS", 100)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(x):
        calls.add(1)
        return x
    df = spark.range(0, 3000, numPartitions=4).select((F.col("id") * 7 % 3001).cast("int").alias("k"), F.concat(F.lit("n"), F.col("id") % 11).alias("s"))
    out = assign_keys(df.withColumn("v", seen("k")), ["s", "k"], "key", 10)
    got = sorted((r["key"], r["s"], r["k"]) for r in out.collect())
    assert [g[0] for g in got] == list(range(11, 3011)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
    assert calls.value == 3000  # the input is evaluated once
    assert sorted((r["key"], r["s"], r["k"]) for r in out.collect()) == got
    with_null = spark.createDataFrame([(None,), (1,), (2,)] + [(k,) for k in range(3, 400)], "k int")
    keyed = {r["k"]: r["key"] for r in assign_keys(with_null, ["k"], "key").collect()}
    assert keyed[None] == 1 and [keyed[k] for k in range(1, 400)] == list(range(2, 401))


def test_one_scan_checks_all_foreign_keys(spark):
    from strata.operators.dq import failing_checks, fk_checks, key_and_null_checks
    dates = spark.createDataFrame([(1,), (2,)], "date_key int")
    teams = spark.createDataFrame([(7,), (8,)], "team_key int")
    fact = spark.createDataFrame([(1, 7, None), (2, 8, 7), (2, 7, 9)], "date_key int, home int, away int")
    fks = [(["date_key"], dates, ["date_key"]), (["home"], teams, ["team_key"]), (["away"], teams, ["team_key"])]
    checks = fk_checks(fact, "f", fks)
    assert failing_checks({"f": checks}) == ["f.away_fk"]
    assert failing_checks({"f": fk_checks(fact, "f", fks, max_bytes=0)}) == ["f.away_fk"]
    assert plan_of(fk_checks(fact, "f", fks)).split("\n\n")[0].count("Scan") == 4  # the fact once, a dimension for each key
    assert failing_checks({"t": key_and_null_checks(fact, "t", ["home"], ["away"], [["date_key"]])}) == ["t.not_null", "t.unique", "t.unique0"]
    assert failing_checks({"t": key_and_null_checks(fact.limit(0), "t", ["home"], ["away"], [["date_key"]])}) == []


def test_envelopes_reach_python_few_at_a_time(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, 10000)
    try:
        df = spark.range(0, 500, 1, 1).selectExpr("id page", """concat('{"errors":[],"response":[{"id":', id, '}]}') body""")
        good, bad = gate_errors(parse_envelopes(df))
        assert 0 < int(spark.conf.get(key)) <= 64  # bodies, each with all its elements
        assert explode_response(good, keep=["page"]).count() == 500 and bad.count() == 0
    finally:
        spark.conf.set(key, before)


def test_long_envelopes_reach_python_in_several_batches(spark):
    from strata.session import small_batches
    from strata.sources.envelope import BYTES_AT_ONCE
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[1], "64m")
        df = spark.range(0, 50, 1, 1).selectExpr("id page", f"""concat('{{"errors":[],"response":["', repeat('x', {BYTES_AT_ONCE // 10}), id, '"]}}') body""")
        parsed = parse_envelopes(df)
        assert int(spark.conf.get(keys[1])) == BYTES_AT_ONCE
        assert explode_response(gate_errors(parsed)[0], keep=["page"]).count() == 50

        @F.pandas_udf("int")
        def at_once(bodies):
            import pandas as pd
            return pd.Series([len(bodies)] * len(bodies))
        assert df.select(at_once("body").alias("n")).agg(F.max("n")).first()[0] <= 10
        spark.conf.set(keys[1], "1m")
        small_batches(spark, 64, BYTES_AT_ONCE)
        assert spark.conf.get(keys[1]) == "1m"  # a smaller bound stays
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_envelopes_and_tables_are_written_compressed(spark, tmp_path):
    import glob

    from strata.operators.keys import materialize
    from strata.plans import inputs
    from strata.sources.envelope import read_envelopes
    paths = inputs.write_envelopes(spark, "/root/testdata/sf0.001", str(tmp_path))
    for path in paths.values():
        assert glob.glob(path + "/part-*") and all(f.endswith(".gz") for f in glob.glob(path + "/part-*"))
    stored = materialize(read_envelopes(spark, paths["teams"], True), "compressed")
    assert stored.filter("body like '{%}'").count() == stored.count() > 0
    assert all(f.endswith(".zstd.parquet") for f in stored.inputFiles())


def test_staged_envelopes_are_read_back_by_the_element(spark, tmp_path):
    """No stored row holds a page: the reader's batches are of elements. Every envelope keeps a row, and a rejected one its body."""
    import json
    from strata.operators.keys import materialize
    from strata.sources.bronze import arrival_ids
    from strata.sources.envelope import parse_envelopes, read_envelopes, staged
    pages = [([], [{"n": k} for k in range(3)]), ([], []), ({"token": "bad"}, [{"n": 7}, {"n": 8}]), ([], [{"n": 9}])]
    (tmp_path / "p.json").write_text("".join(json.dumps({"get": "teams", "errors": e, "response": r}) + "\n" for e, r in pages))
    whole = materialize(staged(parse_envelopes(read_envelopes(spark, str(tmp_path), True)), "body"))
    assert not any(f.dataType.typeName() in ("array", "map", "struct") for f in whole.schema)
    assert rows(whole, "line", "ok", "pos", "payload") == sorted(
        [(0, True, k, f'{{"n": {k}}}') for k in range(3)] + [(1, True, None, None), (2, False, None, None), (3, True, 0, '{"n": 9}')], key=str)
    bodies = {r["line"]: r["body"] for r in whole.filter("body is not null").collect()}
    assert whole.filter("body is not null").count() == 4 and '"bad"' in bodies[2]
    assert rows(arrival_ids(whole.drop("body"), 10), "id", "payload") == [(11, '{"n": 0}'), (12, '{"n": 1}'), (13, '{"n": 2}'), (20, '{"n": 9}')]
    tree = plan_of(arrival_ids(whole, 10))
    assert "Generate" not in tree and "body" not in tree.split("ReadSchema")[1].split("\n")[0]


def test_broadcasts_and_checks_fit_the_driver(spark, monkeypatch):
    from strata.operators import lookup
    from strata.operators.dq import failing_checks
    dim, fact = spark.createDataFrame([(1, 10), (2, 20)], "k int, id int"), spark.createDataFrame([(10,), (30,)], "team int")
    lookups = [lookup.Lookup("team", dim, [("team", "id")], "k", "team_key")]
    assert lookup.broadcast_budget(spark) <= lookup.driver_heap(spark) // lookup.HEAP_SHARE
    assert "ResolvedHint" in logical(lookup.lookup_keys(fact, lookups))
    monkeypatch.setattr(lookup, "driver_heap", lambda spark: 16 * lookup.HEAP_SHARE)
    assert "ResolvedHint" not in logical(lookup.lookup_keys(fact, lookups))
    assert rows(lookup.lookup_keys(fact, lookups), "team", "team_key") == [(10, 1)]
    assert rows(lookup.rejected_rows(fact, lookups), "team", "failed_lookup") == [(30, "team")]
    twice = spark.createDataFrame([(1,), (1,)], "k int")
    checks = {"a": dq_unique(twice, ["k"]), "b": dq_unique(dim, ["k"]), "c": dq_unique(twice, ["k"])}
    assert failing_checks(checks) == failing_checks(checks, 1) == failing_checks(checks, 2) == ["a", "c"]


def logical(df):
    return df._jdf.queryExecution().analyzed().toString()
