"""Query catalogue: one entry per operator of the survey, on driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the SQL oracle of the same name in ``oracle.py``. Queries read whole
tables; nothing is sampled or capped.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exprs import (bool_pct, coalesce0_sum, exact_avg, exact_ratio, result_sign,
                                    row_is_distinct)
from strata.functions.jsonpath import project
from strata.operators.dedup import latest_by
from strata.operators.dims import (build_dim_date, scd1, scd2_apply, scd2_expire, scd2_insert,
                                   scd_initial)
from strata.operators.dq import dq_fk_orphans, dq_not_null, dq_one_current, dq_unique
from strata.operators.facts import FACT_STANDING_GRAIN, fact_match, fact_snapshot, upsert_fact, upsert_partitions
from strata.operators.keys import assign_keys, materialize
from strata.operators.lookup import Lookup, lookup_keys, rejected_rows
from strata.operators.marts import (latest_snapshot, mart_league_month, mart_team_season,
                                    mart_venue_home, team_match_rows, team_season_agg)
from strata.operators.merge import insert_absent, merge_upsert, update_from
from strata.plans import football, inputs
from strata.plans import gold as gold_plan
from strata.plans.store import LayerStore
from strata.schemas import empty_frame, schema_of
from strata.session import apply_sql_conf, ensure_checkpoint_dir
from strata.sources.bronze import land_bronze
from strata.sources.envelope import explode_response, gate_errors, parse_envelopes
from strata.sources.tables import read_table

QUERIES: dict = {}


def query(name):
    def deco(fn):
        def run(spark: SparkSession, d: str) -> DataFrame:
            apply_sql_conf(spark)
            return fn(spark, d.rstrip("/"))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def _empty(spark, layer, table):
    return empty_frame(spark, schema_of(layer, table))


# ---------------------------------------------------------------------------
# gold chain on the synthetic matches
# ---------------------------------------------------------------------------

class _Dims(dict):
    """Dimensions of the gold chain, built on first use only: the calendar
    (data-derived range), Type 1 league and Type 2 team / venue dimensions as
    first loads. Keyed dimensions carry the row count proven while keying,
    which the lookups use as their broadcast bound."""

    def __init__(self, spark: SparkSession, d: str):
        super().__init__()
        self.spark, self.d = spark, d

    def __missing__(self, name):
        spark, d = self.spark, self.d
        if name in ("dim_date", "date_rows"):
            bounds = inputs.calendar_bounds(spark, d)
            b = bounds.first()  # two scalars: the range bounds the calendar size
            self["date_rows"] = (b["end"] - b["start"]).days + 1
            self["dim_date"] = build_dim_date(spark, bounds=bounds)
        elif name == "dim_league":
            self[name] = scd_initial(inputs.league_source(spark, d), ["league_id"],
                                     ["name", "type", "country_name", "country_code", "logo_url"],
                                     "league_key")
        elif name == "dim_team":
            self[name] = scd_initial(inputs.team_source(spark, d), ["team_id"],
                                     ["name", "code", "country", "founded", "national", "logo_url"],
                                     "team_key", inputs.RUN_DATE_1)
        elif name == "dim_venue":
            self[name] = scd_initial(inputs.venue_source(spark, d), ["venue_id"],
                                     ["name", "city", "address", "surface", "image", "capacity"],
                                     "venue_key", inputs.RUN_DATE_1)
        else:
            raise KeyError(name)
        return dict.__getitem__(self, name)


def dims(spark: SparkSession, d: str) -> dict:
    return _Dims(spark, d)


def _fact_fixture(spark, d, dm=None):
    dm = dm or dims(spark, d)
    return fact_match(inputs.matches(spark, d), dm["dim_date"], dm["dim_league"], dm["dim_team"],
                      dm["dim_venue"], dm["date_rows"]), dm


def _snapshot(spark, d, dm=None):
    """The snapshot fact without its identity key, for readers that do not use it."""
    dm = dm or dims(spark, d)
    return fact_snapshot(inputs.standings(spark, d), dm["dim_date"], dm["dim_league"],
                         dm["dim_team"], dm["date_rows"]), dm


def _fact_standing(spark, d, dm=None):
    """First load of the snapshot fact: every row is new, so the identity key
    is assigned in grain order (the ``upsert_fact`` query covers the upsert
    into an existing fact)."""
    rows, dm = _snapshot(spark, d, dm)
    keyed = assign_keys(rows, FACT_STANDING_GRAIN, "standing_key")
    return keyed.select("standing_key", *rows.columns), dm


@query("dim_date")
def q_dim_date(spark, d):
    """PIPE-7, SRC-6, KEY-2, SCAL-18..22: calendar over the order years."""
    return build_dim_date(spark, bounds=inputs.calendar_bounds(spark, d))


@query("surrogate_key_lookup")
def q_surrogate_key_lookup(spark, d):
    """JOIN-1, JOIN-2, SCAL-8: date key on a computed key, league key."""
    dm = dims(spark, d)
    m = inputs.matches(spark, d)
    out = lookup_keys(m, [
        Lookup("date", dm["dim_date"], [(F.to_date("kickoff"), "full_date")], "date_key",
               "date_key", broadcast_rows=dm["date_rows"]),
        Lookup("league", dm["dim_league"], [("league_id", "league_id")], "league_key", "league_key"),
    ])
    return out.select(F.col("fixture_id").cast("int"), "date_key", "league_key")


@query("role_playing_dim")
def q_role_playing_dim(spark, d):
    """JOIN-3, JOIN-4: one team dimension joined twice, current rows only."""
    dm = dims(spark, d)
    out = lookup_keys(inputs.matches(spark, d), [
        Lookup("home", dm["dim_team"], [("home_team_id", "team_id")], "team_key", "home_team_key",
               current_flag="is_current", extra=[("name", "home_team_name")]),
        Lookup("away", dm["dim_team"], [("away_team_id", "team_id")], "team_key", "away_team_key",
               current_flag="is_current", extra=[("name", "away_team_name")]),
    ])
    return out.select(F.col("fixture_id").cast("int"), "home_team_key", "home_team_name",
                      "away_team_key", "away_team_name")


@query("left_lookup_nullable")
def q_left_lookup_nullable(spark, d):
    """JOIN-5: nullable FK kept with a NULL key when the venue is unknown."""
    dm = dims(spark, d)
    out = lookup_keys(inputs.matches(spark, d), [
        Lookup("venue", dm["dim_venue"], [("venue_id", "venue_id")], "venue_key", "venue_key",
               how="left", current_flag="is_current")])
    return out.select(F.col("fixture_id").cast("int"), "venue_id", "venue_key")


@query("fact_match")
def q_fact_match(spark, d):
    """PIPE-11, PROJ-9/10/13: transaction fact with all five lookups."""
    return _fact_fixture(spark, d)[0]


@query("fact_snapshot")
def q_fact_snapshot(spark, d):
    """PIPE-12, KEY-1: periodic-snapshot fact with its identity key."""
    return _fact_standing(spark, d)[0]


@query("unpivot_union_all")
def q_unpivot(spark, d):
    """SET-1, PROJ-11: each played match as a home row and an away row."""
    ff, _ = _fact_fixture(spark, d)
    return team_match_rows(ff)


@query("lateral_top1")
def q_lateral_top1(spark, d):
    """JOIN-11, SORT-2: rank at the latest snapshot per team-season."""
    fs, _ = _snapshot(spark, d)
    return latest_snapshot(fs, ["league_key", "team_key", "season"], "snapshot_date_key", "rank",
                           "final_rank")


@query("drill_across")
def q_drill_across(spark, d):
    """JOIN-13, DQ-5: fixture-derived points beside the official final rank."""
    dm = dims(spark, d)
    ff, _ = _fact_fixture(spark, d, dm)
    fs, _ = _snapshot(spark, d, dm)
    agg = team_season_agg(ff).select("league_key", "team_key", "season", "played", "points")
    final = latest_snapshot(fs, ["league_key", "team_key", "season"], "snapshot_date_key", "rank",
                            "final_rank")
    return agg.join(final, ["league_key", "team_key", "season"], "left")


@query("mart_team_season")
def q_mart_team_season(spark, d):
    """PIPE-13: unpivot -> aggregate -> latest snapshot rank."""
    dm = dims(spark, d)
    ff, _ = _fact_fixture(spark, d, dm)
    fs, _ = _snapshot(spark, d, dm)
    return mart_team_season(ff, fs)


@query("mart_league_month")
def q_mart_league_month(spark, d):
    """PIPE-14: fact x calendar star join, then league-month KPIs."""
    ff, dm = _fact_fixture(spark, d)
    return mart_league_month(ff, dm["dim_date"], dm["date_rows"])


@query("mart_venue_home")
def q_mart_venue_home(spark, d):
    """PIPE-15: home KPIs per venue and season."""
    ff, _ = _fact_fixture(spark, d)
    return mart_venue_home(ff)


# ---------------------------------------------------------------------------
# sources: envelopes, bronze landing, JSON projection and unnesting
# ---------------------------------------------------------------------------

ORDER_ITEM_SPEC = [("id", ("id",), "bigint"), ("status", ("status",), None),
                   ("customer", ("customer",), "bigint")]


@query("envelope_explode")
def q_envelope_explode(spark, d):
    """SRC-1: accepted envelopes, one row per ``response`` element."""
    good, _ = gate_errors(parse_envelopes(inputs.envelope_bodies(spark, d)))
    rows = explode_response(good, keep=["page"])
    return project(rows, "payload", ORDER_ITEM_SPEC, keep=["page", "pos"])


@query("envelope_errors")
def q_envelope_errors(spark, d):
    """SRC-2: the error gate's verdict per envelope."""
    good, bad = gate_errors(parse_envelopes(inputs.envelope_bodies(spark, d)))
    cols = ["page", F.col("env.results").alias("results")]
    return (good.select(*cols, F.lit(True).alias("accepted"))
                .unionByName(bad.select(*cols, F.lit(False).alias("accepted"))))


@query("land_bronze")
def q_land_bronze(spark, d):
    """SINK-1, SCAL-11/12: events landed as bronze records with provenance,
    ids in arrival order."""
    ev = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    params = F.to_json(F.create_map(F.lit("user_id"), F.col("user_id").cast("string")))
    return land_bronze(ev.withColumnRenamed("props", "payload"), "fixtures", loaded_at=F.col("ts"),
                       order_cols=["ts", "event_id"], source_params=params,
                       source=F.col("event_type"))


@query("json_project_typed")
def q_json_project_typed(spark, d):
    """PROJ-1, SCAL-1..7: 28 typed paths of all fixture documents, both versions."""
    b = inputs.fixture_bronze(spark, d, 1).unionByName(inputs.fixture_bronze(spark, d, 2))
    return football.project_fixtures(b).drop("loaded_at", "id")


@query("json_fanout")
def q_json_fanout(spark, d):
    """SRC-5, PROJ-2, PROJ-3, FILT-1: teams and (present) venues out of one parse of the
    team documents, both versions."""
    docs = inputs.team_bronze(spark, d, 1).unionByName(inputs.team_bronze(spark, d, 2))
    return football.fan_out_teams(docs).drop("loaded_at", "id")


@query("json_unnest")
def q_json_unnest(spark, d):
    """JOIN-9, PROJ-5: lateral unnest of ``seasons[]`` of all documents."""
    return football.project_seasons(inputs.league_bronze(spark, d)).drop("loaded_at")


@query("json_unnest_nested")
def q_json_unnest_nested(spark, d):
    """JOIN-10, PROJ-6: chained unnest of ``standings[][]``."""
    return football.project_standings(inputs.standing_bronze(spark, d)).drop("loaded_at", "id")


# ---------------------------------------------------------------------------
# silver MERGEs: a first run on the early records, a second on all of them
# ---------------------------------------------------------------------------

def _two_runs(spark, entity, first: DataFrame, everything: DataFrame) -> DataFrame:
    target = _empty(spark, "silver", entity)
    once = materialize(football.merge_silver(target, first, entity), "first_run")  # as the store does between runs
    return football.merge_silver(once, everything, entity)


@query("silver_fixtures")
def q_silver_fixtures(spark, d):
    """PIPE-1, SINK-3, AGG-10."""
    v1 = inputs.fixture_bronze(spark, d, 1)
    return _two_runs(spark, "fixtures", v1, v1.unionByName(inputs.fixture_bronze(spark, d, 2)))


@query("silver_leagues")
def q_silver_leagues(spark, d):
    """PIPE-2."""
    b = inputs.league_bronze(spark, d)
    return _two_runs(spark, "leagues", b.filter(F.col("id") % 2 == 1), b)


@query("silver_seasons")
def q_silver_seasons(spark, d):
    """PIPE-3."""
    b = inputs.league_bronze(spark, d)
    return _two_runs(spark, "seasons", b.filter(F.col("id") % 2 == 1), b)


@query("silver_standings")
def q_silver_standings(spark, d):
    """PIPE-4, SINK-4: ``team_name`` keeps its first inserted value (Q5)."""
    return _two_runs(spark, "standings", inputs.standing_bronze(spark, d, before="1999-01-01"),
                     inputs.standing_bronze(spark, d))


@query("silver_teams")
def q_silver_teams(spark, d):
    """PIPE-5: a NULL in the newer record overwrites (founded)."""
    v1 = inputs.team_bronze(spark, d, 1)
    return _two_runs(spark, "teams", v1, v1.unionByName(inputs.team_bronze(spark, d, 2)))


@query("silver_venues")
def q_silver_venues(spark, d):
    """PIPE-6: filtered, composite key."""
    v1 = inputs.team_bronze(spark, d, 1)
    return _two_runs(spark, "venues", v1, v1.unionByName(inputs.team_bronze(spark, d, 2)))


# ---------------------------------------------------------------------------
# MERGE / UPSERT / UPDATE family on two overlapping slices of orders
# ---------------------------------------------------------------------------

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _order_slices(spark, d):
    o = read_table(spark, d, "orders", ORDER_COLS + ["o_orderdate"])
    target = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(*ORDER_COLS)
    source = o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", F.lower("o_orderstatus").alias("o_orderstatus"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority"))
    return target, source


@query("merge_upsert")
def q_merge_upsert(spark, d):
    """SINK-3, JOIN-8: matched rows take every source value, NULLs included."""
    t, s = _order_slices(spark, d)
    return merge_upsert(t, s, ["o_orderkey"])


@query("merge_partial_update")
def q_merge_partial_update(spark, d):
    """SINK-4: ``o_orderpriority`` is inserted but never updated."""
    t, s = _order_slices(spark, d)
    return merge_upsert(t, s, ["o_orderkey"],
                        update_cols=["o_custkey", "o_orderstatus", "o_totalprice"])


@query("insert_absent")
def q_insert_absent(spark, d):
    """SINK-6: ON CONFLICT DO NOTHING, first write wins."""
    t, s = _order_slices(spark, d)
    return insert_absent(t, s, ["o_orderkey"])


@query("update_from")
def q_update_from(spark, d):
    """SINK-7, JOIN-7: UPDATE .. FROM with a null-safe inequality condition."""
    t, s = _order_slices(spark, d)
    return update_from(t, s, ["o_orderkey"],
                       {"o_orderstatus": lambda tc, sc: sc("o_orderstatus"),
                        "o_totalprice": lambda tc, sc: sc("o_totalprice")},
                       condition=lambda tc, sc: row_is_distinct([tc("o_orderpriority")],
                                                                [sc("o_orderpriority")]))


@query("upsert_fact")
def q_upsert_fact(spark, d):
    """SINK-5 on the 4-column snapshot grain with an identity key outside it."""
    dm = dims(spark, d)
    rows = fact_snapshot(inputs.standings(spark, d), dm["dim_date"], dm["dim_league"],
                         dm["dim_team"], dm["date_rows"])
    target = assign_keys(rows.filter(F.col("snapshot_date_key") < 19990101), FACT_STANDING_GRAIN,
                         "standing_key")
    source = rows.filter(F.col("snapshot_date_key") >= 19980101).withColumn(
        "rank", (F.col("rank") + 100).cast("int"))
    return upsert_fact(target.select("standing_key", *rows.columns), source, FACT_STANDING_GRAIN,
                       key_col="standing_key")


@query("upsert_fact_seasons")
def q_upsert_fact_seasons(spark, d):
    """SINK-5 into a stored fact of which the source touches the later seasons only."""
    dm = dims(spark, d)
    rows = fact_snapshot(inputs.standings(spark, d), dm["dim_date"], dm["dim_league"],
                         dm["dim_team"], dm["date_rows"])
    first = assign_keys(rows.filter(F.col("snapshot_date_key") < 19990101), FACT_STANDING_GRAIN, "standing_key")
    store = LayerStore(spark, ensure_checkpoint_dir(spark).rstrip("/") + f"/strata-catalogue-store-{uuid.uuid4().hex}")
    target = store.write("gold", "fact_standing", first.select("standing_key", *rows.columns), store.begin("gold"))
    source = rows.filter(F.col("snapshot_date_key") >= 19980101).withColumn("rank", (F.col("rank") + 100).cast("int"))
    return upsert_partitions(target, source, FACT_STANDING_GRAIN, "season", key_col="standing_key")


@query("full_refresh")
def q_full_refresh(spark, d):
    """SINK-9: the mart is written as a new table version and read back."""
    ff, _ = _fact_fixture(spark, d)
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/strata-catalogue-store-{uuid.uuid4().hex}"
    store = LayerStore(spark, base)
    version = store.begin("gold")
    out = store.write("gold", "agg_venue_home", mart_venue_home(ff), version)
    store.publish("gold", version)
    return out


@query("surrogate_key")
def q_surrogate_key(spark, d):
    """KEY-1: dense keys in natural-key order without a global window."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_name"])
    return assign_keys(c, ["c_custkey"], "customer_key")


@query("row_is_distinct")
def q_row_is_distinct(spark, d):
    """FILT-6: (a, b, c) IS DISTINCT FROM (x, y, z) with NULLs on both sides."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_nationkey",
                                          "c_acctbal"])
    bal, nk = F.col("c_acctbal"), F.col("c_nationkey")
    left = [F.col("c_name"), F.when(bal >= 0, F.col("c_mktsegment")), nk]
    right = [F.when(nk == 3, F.upper("c_name")).otherwise(F.col("c_name")),
             F.when(bal >= 100, F.col("c_mktsegment")), F.when(nk != 7, nk)]
    return c.select("c_custkey", row_is_distinct(left, right).alias("is_distinct"))


@query("distinct_on_latest")
def q_distinct_on_latest(spark, d):
    """AGG-10, SORT-1: latest event per (user, type)."""
    ev = read_table(spark, d, "events")
    return latest_by(ev, ["user_id", "event_type"], [F.col("ts").desc_nulls_first(),
                                                      F.col("event_id").desc()])


# ---------------------------------------------------------------------------
# SCD Type 1 / Type 2 on customers, SCD2 with pre-dedup on suppliers
# ---------------------------------------------------------------------------

def _scd1_inputs(spark, d):
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    v1 = c.filter(F.col("c_nationkey") < 15).select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    v2 = c.filter(F.col("c_nationkey") >= 10).select(
        "c_custkey", F.upper("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    target = scd_initial(v1, ["c_custkey"], ["name", "segment"], "cust_key")
    return target, v2


@query("scd1_insert_absent")
def q_scd1_insert_absent(spark, d):
    """PIPE-8 as coded in the reference: new keys only."""
    t, s = _scd1_inputs(spark, d)
    return scd1(t, s, ["c_custkey"], ["name", "segment"], "cust_key", overwrite=False)


@query("scd1_overwrite")
def q_scd1_overwrite(spark, d):
    """PIPE-8 as documented: attributes of existing keys are replaced."""
    t, s = _scd1_inputs(spark, d)
    return scd1(t, s, ["c_custkey"], ["name", "segment"], "cust_key", overwrite=True)


SCD2_TRACKED = ["name", "segment", "nation"]


def _scd2_inputs(spark, d):
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment",
                                          "c_acctbal"])
    bal, nk = F.col("c_acctbal"), F.col("c_nationkey")
    v1 = c.filter(nk < 20).select("c_custkey", F.col("c_name").alias("name"),
                                  F.when(bal >= 0, F.col("c_mktsegment")).alias("segment"),
                                  nk.alias("nation"))
    v2 = c.filter(nk != 0).select(
        "c_custkey", F.when(nk % 4 == 1, F.upper("c_name")).otherwise(F.col("c_name")).alias("name"),
        F.when(bal >= 500, F.col("c_mktsegment")).alias("segment"), nk.alias("nation"))
    target = scd_initial(v1, ["c_custkey"], SCD2_TRACKED, "cust_key", inputs.RUN_DATE_1)
    return target, v2


@query("scd2_expire")
def q_scd2_expire(spark, d):
    """PIPE-9 step 1: expire current versions whose tracked tuple changed."""
    t, s = _scd2_inputs(spark, d)
    return scd2_expire(t, s, ["c_custkey"], SCD2_TRACKED, inputs.RUN_DATE_2)


@query("scd2_insert")
def q_scd2_insert(spark, d):
    """PIPE-9 step 2 after step 1 (the reference's two statements)."""
    t, s = _scd2_inputs(spark, d)
    expired = scd2_expire(t, s, ["c_custkey"], SCD2_TRACKED, inputs.RUN_DATE_2)
    return scd2_insert(expired, s, ["c_custkey"], SCD2_TRACKED, "cust_key", inputs.RUN_DATE_2)


@query("scd2_apply")
def q_scd2_apply(spark, d):
    """PIPE-9 in one pass (same result as expire + insert)."""
    t, s = _scd2_inputs(spark, d)
    return scd2_apply(t, s, ["c_custkey"], SCD2_TRACKED, "cust_key", inputs.RUN_DATE_2)


@query("scd2_dedup_apply")
def q_scd2_dedup_apply(spark, d):
    """PIPE-10: silver venues (keyed by supplier and nation) reduced to the
    latest row per venue, then SCD2 against the nation venues."""
    target = scd_initial(inputs.venue_source(spark, d, thin=False), ["venue_id"],
                         gold_plan.VENUE_TRACKED, "venue_key", inputs.RUN_DATE_1)
    s = read_table(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    nk, sk = F.col("s_nationkey"), F.col("s_suppkey")
    silver_venues = s.select(
        sk.cast("int").alias("team_id"), nk.cast("int").alias("venue_id"),
        F.concat(F.lit("Ground "), nk.cast("string"), F.lit("/"), sk.cast("string")).alias("venue_name"),
        F.concat(F.lit("City "), nk.cast("string")).alias("city"),
        F.concat(F.lit("Main St "), nk.cast("string")).alias("address"),
        F.lit("grass").alias("surface"), F.lit(None).cast("string").alias("image"),
        (sk * 10).cast("bigint").alias("capacity"),
        F.timestamp_seconds(sk).alias("loaded_at"))
    return scd2_apply(target, gold_plan.venue_source(silver_venues), ["venue_id"],
                      gold_plan.VENUE_TRACKED, "venue_key", inputs.RUN_DATE_2)


# ---------------------------------------------------------------------------
# aggregates, scalars, data quality, rejected facts
# ---------------------------------------------------------------------------

@query("agg_filtered_count")
def q_agg_filtered_count(spark, d):
    """AGG-1, AGG-2, AGG-9."""
    li = read_table(spark, d, "lineitem", ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"])
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_quantity") > 25).alias("big_qty"),
        F.count_if(F.col("l_discount") == 0).alias("no_discount"))


@query("agg_sum_case")
def q_agg_sum_case(spark, d):
    """AGG-5, AGG-3: 3-1-0 points by status."""
    o = read_table(spark, d, "orders", ["o_orderpriority", "o_orderstatus"])
    st = F.col("o_orderstatus")
    return o.groupBy("o_orderpriority").agg(
        F.sum(F.when(st == "F", 3).when(st == "O", 1).otherwise(0)).cast("bigint").alias("points"))


@query("agg_exact_avg")
def q_agg_exact_avg(spark, d):
    """AGG-6: exact ``round(avg(int), 2)``; NULLs are skipped."""
    li = read_table(spark, d, "lineitem", ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"])
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        exact_avg("l_linenumber", 4, 2).alias("avg_line"),
        exact_avg(F.when(F.col("l_quantity") <= 40, F.col("l_linenumber")), 4, 2).alias("avg_line_small"))


@query("agg_bool_pct")
def q_agg_bool_pct(spark, d):
    """AGG-7, SCAL-9: exact percentage of a boolean."""
    o = read_table(spark, d, "orders", ["o_orderpriority", "o_orderstatus"])
    return o.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), bool_pct(F.col("o_orderstatus") == "F").alias("pct_finished"))


@query("scalar_casts")
def q_scalar_casts(spark, d):
    """SCAL-3..8: text to int / bigint / boolean / date / timestamptz (with
    an offset), then to a UTC date."""
    ev = read_table(spark, d, "events", ["event_id", "ts", "value", "props"])
    k = project(ev, "props", [("k", ("k",), "int")], keep=["event_id", "ts", "value"])
    kick = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")).cast("timestamp")
    return k.select(
        "event_id", "k",
        F.col("event_id").cast("string").cast("bigint").alias("event_id_text"),
        F.when(F.col("value") > 10, "true").otherwise("false").cast("boolean").alias("big_value"),
        F.date_format("ts", "yyyy-MM-dd").cast("date").alias("event_date"),
        F.to_date(kick).alias("kick_utc_date"),
        F.date_format(kick, "yyyy-MM-dd HH:mm:ss").alias("kick_utc"))


@query("scalar_rounding")
def q_scalar_rounding(spark, d):
    """SCAL-10, SCAL-16, AGG-8: int -> numeric, exact division, HALF_UP."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    k = F.col("o_orderkey")
    return o.select("o_orderkey",
                    exact_ratio(k % 1000, F.lit(8), 8, 2).alias("eighths"),
                    exact_ratio("o_custkey", F.lit(40), 10, 2).alias("fortieths"),
                    exact_ratio(k % 100, k % 3, 8, 2).alias("guarded"))


@query("scalar_null_logic")
def q_scalar_null_logic(spark, d):
    """SCAL-13..15, PROJ-9..11: coalesce, nullif, CASE without ELSE, minus."""
    m = inputs.matches(spark, d)
    res = result_sign("goals_home", "goals_away")
    return m.select(F.col("fixture_id").cast("int"),
                    coalesce0_sum("goals_home", "goals_away").cast("int").alias("goals_total"),
                    res.alias("result"), F.negative(res).alias("neg_result"),
                    F.nullif(F.col("goals_home"), F.lit(0)).alias("nz_home"),
                    F.coalesce(F.col("venue_id"), F.lit(-1)).alias("venue_or_default"))


@query("dq_unique")
def q_dq_unique(spark, d):
    """DQ-1 on lineitem (its line key has real duplicates)."""
    return dq_unique(read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber"]),
                     ["l_orderkey", "l_linenumber"])


@query("dq_not_null")
def q_dq_not_null(spark, d):
    """DQ-2: one pass, NULL counts of the columns that have NULLs."""
    return dq_not_null(inputs.matches(spark, d), ["fixture_id", "league_id", "season", "kickoff",
                                                  "venue_id", "goals_home", "goals_away"])


@query("dq_fk_orphans")
def q_dq_fk_orphans(spark, d):
    """DQ-3: fixtures whose (non-NULL) venue has no current venue row."""
    dm = dims(spark, d)
    m = inputs.matches(spark, d).select(F.col("fixture_id").cast("int"), "venue_id")
    return dq_fk_orphans(m, dm["dim_venue"].filter("is_current"), ["venue_id"])


@query("dq_one_current")
def q_dq_one_current(spark, d):
    """DQ-4 on an SCD2 result with a second current row induced for nation 5."""
    t, s = _scd2_inputs(spark, d)
    res = scd2_apply(t, s, ["c_custkey"], SCD2_TRACKED, "cust_key", inputs.RUN_DATE_2)
    dup = res.filter(F.col("is_current") & (F.col("nation") == 5)).withColumn(
        "cust_key", F.col("cust_key") + 1000000000)
    return dq_one_current(res.unionByName(dup), ["c_custkey"])


@query("fact_rejects")
def q_fact_rejects(spark, d):
    """Q10: fixtures an inner lookup drops, by failing lookup (calendar
    without the first order year; team dimension without ids = 5 mod 6)."""
    dm = dims(spark, d)
    bounds = inputs.calendar_bounds(spark, d).select(F.add_months("start", 12).alias("start"), "end")
    short_cal = build_dim_date(spark, bounds=bounds)
    teams = dm["dim_team"].filter(F.col("team_id") % 6 != 5)
    lookups = [Lookup("date", short_cal, [(F.to_date("kickoff"), "full_date")], "date_key", "date_key",
                      broadcast_rows=dm["date_rows"]),
               Lookup("home_team", teams, [("home_team_id", "team_id")], "team_key", "home_team_key",
                      current_flag="is_current")]
    return rejected_rows(inputs.matches(spark, d), lookups).select(
        F.col("fixture_id").cast("int"), "failed_lookup")


# ---------------------------------------------------------------------------
# end to end
# ---------------------------------------------------------------------------

E2E_CALENDAR = ("1990-01-01", "2005-12-31")
#: Gold tables of a run and what is summed over each.
E2E_TABLES = {"dim_date": "date_key", "dim_league": "league_id", "dim_team": "team_id", "dim_venue": "venue_id",
              "fact_fixture": "goals_total", "fact_standing": "points", "agg_team_season": "points",
              "agg_league_month": "total_goals", "agg_venue_home": "home_goals"}


@query("end_to_end")
def q_end_to_end(spark, d):
    """PIPE-16: envelope files landed, merged into silver and built into gold; rows and
    one sum of each of the nine gold tables."""
    from strata.plans.pipeline import run_pipeline
    root = ensure_checkpoint_dir(spark).rstrip("/") + f"/strata-e2e-{uuid.uuid4().hex}"
    run_pipeline(spark, inputs.write_envelopes(spark, d, root + "/envelopes"), root + "/lake",
                 dt.datetime(2024, 1, 1, 6, 0), calendar=E2E_CALENDAR, line_delimited=True)
    store = LayerStore(spark, root + "/lake")
    parts = [store.read("gold", t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n"),
                                       F.sum(F.col(c).cast("long")).alias("total")) for t, c in E2E_TABLES.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
