"""End-to-end: envelope files -> bronze -> silver -> gold, on hand-written
payloads that cover the quirks (FIXTURES §5)."""

import copy
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.plans.pipeline import LoadRejected, run_pipeline
from strata.plans.store import LayerStore

COV = {"odds": True, "players": True, "injuries": True, "standings": True, "top_cards": False,
       "predictions": True, "top_assists": True, "top_scorers": True,
       "fixtures": {"events": True, "lineups": True, "statistics_players": False,
                    "statistics_fixtures": True}}

LEAGUES = [
    {"league": {"id": 39, "name": "Premier League", "type": "League", "logo": "l39"},
     "country": {"name": "England", "code": "GB", "flag": "f"},
     "seasons": [{"year": 2022, "start": "2022-08-05", "end": "2023-05-28", "current": False,
                  "coverage": COV},
                 {"year": 2023, "start": "2023-08-11", "end": "2024-05-19", "current": True,
                  "players": {"odds": True}, "coverage": COV}]},
    {"league": {"id": 40, "name": "Championship", "type": "League", "logo": "l40"},
     "country": {"name": "England", "code": "GB", "flag": "f"}, "seasons": []},
    {"league": {"id": 41, "name": "League One", "type": "League", "logo": "l41"},
     "country": {"name": "England", "code": "GB", "flag": "f"}, "seasons": None},
    {"league": {"id": 42, "name": "League Two", "type": "League", "logo": "l42"},
     "country": {"name": "England", "code": "GB", "flag": "f"}},
]

TEAMS = [
    {"team": {"id": 1, "name": "Reds", "code": "RED", "country": "England", "founded": 1892,
              "national": False, "logo": "t1"},
     "venue": {"id": 11, "name": "Field", "city": "A", "address": "1 Road", "surface": "grass",
               "image": "v11", "capacity": 50000}},
    {"team": {"id": 2, "name": "Blues", "code": "BLU", "country": "England", "founded": 1905,
              "national": False, "logo": "t2"},
     "venue": {"id": 12, "name": "Bridge", "city": "B", "address": "2 Road", "surface": "grass",
               "image": "v12", "capacity": 40000}},
    {"team": {"id": 3, "name": "Greens", "code": None, "country": "England", "founded": None,
              "national": False, "logo": "t3"},
     "venue": {"id": 11, "name": "Field", "city": "A", "address": "1 Road", "surface": "grass",
               "image": "v11", "capacity": 50000}},
    {"team": {"id": 4, "name": "Nomads", "code": "NOM", "country": "England", "founded": 1950,
              "national": False, "logo": "t4"},
     "venue": {"id": None, "name": None}},
]


def fixture(fid, date, home, away, gh, ga, venue=11, league=39, status="FT"):
    return {"fixture": {"id": fid, "date": date, "referee": "R",
                        "status": {"short": status, "long": "x", "elapsed": 90 if gh is not None else None},
                        "venue": {"id": venue, "name": "V", "city": "C"}},
            "league": {"id": league, "season": 2023, "round": "Regular Season - 1"},
            "teams": {"home": {"id": home, "name": f"T{home}", "winner": None},
                      "away": {"id": away, "name": f"T{away}", "winner": None}},
            "goals": {"home": gh, "away": ga},
            "score": {"halftime": {"home": None, "away": None}, "fulltime": {"home": gh, "away": ga},
                      "extratime": {"home": None, "away": None}, "penalty": {"home": None, "away": None}}}


FIXTURES = [
    fixture(100, "2023-08-11T19:00:00+00:00", 1, 2, 3, 0),
    fixture(101, "2023-08-11T23:30:00-05:00", 2, 3, 1, 1, venue=99),   # next UTC day, unknown venue
    fixture(102, "2023-08-19T14:00:00+00:00", 3, 1, None, None, venue=None, status="NS"),
    fixture(103, "2023-08-19T14:00:00+00:00", 1, 3, 2, 1, league=777),  # unknown league: dropped
    fixture(104, "2009-01-01T14:00:00+00:00", 1, 3, 2, 1),             # outside the calendar
    fixture(105, "2023-08-20T14:00:00+00:00", 999, 1, 0, 2),            # unknown home team
]


def row(team, name, rank, pts, upd="2024-05-20T00:00:00+00:00"):
    return {"team": {"id": team, "name": name}, "rank": rank, "points": pts, "goalsDiff": 5,
            "group": "G", "form": "WWW", "update": upd,
            "all": {"played": 38, "win": 20, "draw": 5, "lose": 13, "goals": {"for": 60, "against": 55}}}


STANDINGS = [{"league": {"id": 39, "season": 2023, "standings": [
    [row(1, "Reds", 1, 91), row(2, "Blues", 2, 80)], [], [row(3, "Greens", 3, 70)]]}}]


def envelope(get, response, errors=None):
    env = {"get": get, "parameters": {"league": "39", "season": "2023"},
           "errors": [] if errors is None else errors, "results": len(response),
           "paging": {"current": 1, "total": 1}, "response": response}
    return json.dumps(env)


def write_inputs(folder, leagues=LEAGUES, teams=TEAMS, fixtures=FIXTURES, standings=STANDINGS):
    os.makedirs(folder, exist_ok=True)
    paths = {}
    for name, resp in [("leagues", leagues), ("teams", teams), ("fixtures", fixtures),
                       ("standings", standings)]:
        p = os.path.join(folder, f"{name}.json")
        with open(p, "w") as f:
            f.write(envelope(name, resp))
        paths[name] = p
    return paths


def counts(store, layer, tables):
    return {t: store.read(layer, t).count() for t in tables}


SILVER = ["teams", "venues", "leagues", "seasons", "fixtures", "standings"]
GOLD = ["dim_date", "dim_league", "dim_team", "dim_venue", "fact_fixture", "fact_standing",
        "agg_team_season", "agg_league_month", "agg_venue_home"]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    inputs = write_inputs(str(tmp_path_factory.mktemp("in1")))
    res1 = run_pipeline(spark, inputs, base, dt.datetime(2024, 1, 1, 6, 0))
    store = LayerStore(spark, base)
    snap1 = {"silver": counts(store, "silver", SILVER), "gold": counts(store, "gold", GOLD),
             "team_keys": sorted(map(tuple, store.read("gold", "dim_team")
                                     .select("team_id", "team_key").collect()))}
    return spark, base, inputs, store, res1, snap1


def test_first_run_counts(run):
    spark, base, inputs, store, res1, snap1 = run
    assert res1["landed"] == {"leagues": 4, "teams": 4, "fixtures": 6, "standings": 1}
    assert snap1["silver"] == {"teams": 4, "venues": 3, "leagues": 4, "seasons": 2,
                               "fixtures": 6, "standings": 3}
    g = snap1["gold"]
    assert g["dim_date"] == 6209          # 2010-01-01 .. 2026-12-31
    assert g["dim_league"] == 4 and g["dim_team"] == 4 and g["dim_venue"] == 2
    assert g["fact_fixture"] == 3         # 103 (league), 104 (date), 105 (team) dropped (Q10)
    assert g["fact_standing"] == 3        # empty group dropped only itself


def test_rejected_facts_are_listed(run):
    spark, base, inputs, store, res1, snap1 = run
    v = store.current_version("gold")
    rej = spark.read.parquet(store.table_path("gold", "rejected_fixtures", v))
    got = sorted((r["fixture_id"], r["failed_lookup"]) for r in rej.collect())
    assert got == [(103, "league"), (104, "date"), (105, "home_team")]
    assert spark.read.parquet(store.table_path("gold", "rejected_standings", v)).count() == 0


def test_fact_semantics(run):
    spark, base, inputs, store, *_ = run
    ff = {r["fixture_id"]: r for r in store.read("gold", "fact_fixture").collect()}
    assert ff[101]["date_key"] == 20230812            # -05:00 kickoff lands on the next UTC day (Q9)
    assert ff[101]["venue_key"] is None               # unknown venue kept with NULL key (JOIN-5)
    assert ff[101]["result"] == 0 and ff[100]["result"] == 1
    assert ff[102]["result"] is None and ff[102]["goals_total"] == 0   # unplayed (Q15)
    assert ff[102]["venue_key"] is None


def test_seasons_and_players_path(run):
    spark, base, inputs, store, *_ = run
    s = {r["year"]: r for r in store.read("silver", "seasons").collect()}
    assert set(s) == {"2022", "2023"}                 # [] / null / missing seasons give no rows
    assert s["2023"]["players"] is True and s["2022"]["players"] is None   # players.odds (Q4)
    assert s["2023"]["start_date"] == dt.date(2023, 8, 11)


def test_marts(run):
    spark, base, inputs, store, *_ = run
    ts = {(r["team_key"]): r for r in store.read("gold", "agg_team_season").collect()}
    keys = dict(run[5]["team_keys"])
    reds = ts[keys[1]]
    assert (reds["played"], reds["won"], reds["points"], reds["clean_sheets"]) == (1, 1, 3, 1)
    assert str(reds["points_per_game"]) == "3.00" and reds["final_rank"] == 1   # by name (Q1)
    blues = ts[keys[2]]
    assert (blues["played"], blues["draw"], blues["lost"], blues["points"]) == (2, 1, 1, 1)
    vh = store.read("gold", "agg_venue_home").collect()
    assert len(vh) == 1 and vh[0]["home_matches"] == 1 and str(vh[0]["home_win_pct"]) == "100.00"
    lm = store.read("gold", "agg_league_month").collect()
    assert len(lm) == 1 and lm[0]["matches"] == 2 and str(lm[0]["goals_per_match"]) == "2.50"


def test_rerun_is_idempotent(run):
    spark, base, inputs, store, res1, snap1 = run
    res2 = run_pipeline(spark, inputs, base, dt.datetime(2024, 1, 1, 7, 0))
    assert res2["silver_version"] == res1["silver_version"] + 1
    assert store.read("bronze", "fixtures").count() == 12          # bronze doubles
    assert counts(store, "silver", SILVER) == snap1["silver"]
    assert counts(store, "gold", GOLD) == snap1["gold"]
    keys = sorted(map(tuple, store.read("gold", "dim_team").select("team_id", "team_key").collect()))
    assert keys == snap1["team_keys"]


def test_scd2_change_and_team_name_frozen(run, tmp_path):
    spark, base, inputs, store, *_ = run
    teams = copy.deepcopy(TEAMS)
    teams[0]["team"]["name"] = "Reds FC"        # tracked attribute changes
    teams[2]["team"]["founded"] = 1900           # NULL -> value is a change too
    st = copy.deepcopy(STANDINGS)
    st[0]["league"]["standings"][0][0]["team"]["name"] = "Reds FC"
    st[0]["league"]["standings"][0][0]["points"] = 92
    new_inputs = write_inputs(str(tmp_path / "in3"), teams=teams, standings=st)
    run_pipeline(spark, new_inputs, base, dt.datetime(2024, 2, 1, 6, 0))
    dim = store.read("gold", "dim_team")
    assert dim.count() == 6 and dim.filter("is_current").count() == 4
    old = dim.filter((F.col("team_id") == 1) & ~F.col("is_current")).first()
    assert old["valid_to"] == dt.date(2024, 1, 31) and old["name"] == "Reds"
    new = dim.filter((F.col("team_id") == 1) & F.col("is_current")).first()
    assert new["valid_from"] == dt.date(2024, 2, 1) and new["team_key"] > 4
    # facts take the current version (Q8)
    ff = store.read("gold", "fact_fixture").filter("fixture_id = 100").first()
    assert ff["home_team_key"] == new["team_key"]
    # silver standings: points updated, team_name frozen at first insert (Q5)
    s = store.read("silver", "standings").filter("team_id = 1").first()
    assert s["points"] == 92 and s["team_name"] == "Reds"


def test_rejected_envelope_fails_load(spark, tmp_path):
    base = str(tmp_path / "lake")
    folder = tmp_path / "bad"
    folder.mkdir()
    p = folder / "teams.json"
    p.write_text(envelope("teams", TEAMS, errors={"token": "invalid"}))
    with pytest.raises(LoadRejected):
        run_pipeline(spark, {"teams": str(p)}, base, dt.datetime(2024, 1, 1))
    p.write_text("<html>gateway timeout</html>")
    good = folder / "leagues.json"
    good.write_text(envelope("leagues", LEAGUES))
    with pytest.raises(LoadRejected):
        run_pipeline(spark, {"teams": str(p), "leagues": str(good)}, base, dt.datetime(2024, 1, 1))
    # nothing landed for the good endpoint either: the load is all or nothing
    assert LayerStore(spark, base).read("bronze", "leagues").count() == 0


def test_tie_break_same_payload_two_groups(spark):
    from strata.plans import football
    payload = json.dumps({"league": {"id": 39, "season": 2023, "standings": [
        [row(1, "Reds", 1, 91)], [row(1, "Reds", 7, 10)], None]}})
    older = json.dumps({"league": {"id": 39, "season": 2023, "standings": [[row(1, "Reds", 9, 1)]]}})
    bronze = spark.createDataFrame(
        [(1, older, dt.datetime(2024, 1, 1)), (2, payload, dt.datetime(2024, 1, 1))],
        "id bigint, payload string, loaded_at timestamp")
    out = football.silver_source(bronze, "standings").collect()
    assert len(out) == 1 and out[0]["rank"] == 1     # newest bronze id, then first group (Q6)


def test_bad_key_or_malformed_int_is_not_published(spark, tmp_path):
    base = str(tmp_path / "lake")
    bad_key = copy.deepcopy(TEAMS)
    bad_key[1]["team"]["id"] = None
    with pytest.raises(Exception):
        run_pipeline(spark, write_inputs(str(tmp_path / "a"), teams=bad_key), base,
                     dt.datetime(2024, 1, 1))
    store = LayerStore(spark, base)
    assert store.current_version("silver") == 0
    bad_int = copy.deepcopy(FIXTURES)
    bad_int[0]["fixture"]["status"]["elapsed"] = "ninety"
    with pytest.raises(Exception):
        run_pipeline(spark, write_inputs(str(tmp_path / "b"), fixtures=bad_int), base,
                     dt.datetime(2024, 1, 2))
    assert store.current_version("silver") == 0


def test_line_delimited_envelopes(spark, tmp_path):
    from strata.plans.pipeline import land
    folder = tmp_path / "nd"
    folder.mkdir()
    (folder / "part-0.txt").write_text(envelope("teams", TEAMS[:2]) + "\n" + envelope("teams", TEAMS[2:]) + "\n")
    store = LayerStore(spark, str(tmp_path / "lake"))
    assert land(spark, store, "teams", str(folder), dt.datetime(2024, 1, 1), line_delimited=True) == 4
    got = store.read("bronze", "teams").collect()
    ids = [r["id"] for r in got]
    assert len(set(ids)) == 4 and min(ids) >= 1
    # ids follow arrival order within an envelope: team 1 before team 2
    by_team = {json.loads(r["payload"])["team"]["id"]: r["id"] for r in got}
    assert by_team[1] < by_team[2] and by_team[3] < by_team[4]


def test_resent_teams_overwrite_in_an_end_to_end_run(spark, tmp_path):
    from strata.plans import inputs
    d = "/root/testdata/sf0.001"
    paths = inputs.write_envelopes(spark, d, str(tmp_path / "envelopes"))
    run_pipeline(spark, paths, str(tmp_path / "lake"), dt.datetime(2024, 1, 1, 6, 0),
                 calendar=("1990-01-01", "2005-12-31"), line_delimited=True)
    store = LayerStore(spark, str(tmp_path / "lake"))
    sent = spark.read.parquet(f"{d}/customer.parquet")
    resent = {r["c_custkey"] for r in sent.filter("c_mktsegment = 'BUILDING'").collect()}
    teams = {r["team_id"]: r for r in store.read("silver", "teams").collect()}
    assert resent and len(teams) == sent.count()
    assert all((r["founded"] is None and r["name"] == r["name"].upper()) == (k in resent) for k, r in teams.items())
    venues = store.read("silver", "venues").collect()
    assert all(r["capacity"] == r["team_id"] + 1000 + (r["team_id"] in resent) for r in venues)


def test_vacuum_keeps_newest_versions(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "lake"))
    df = spark.createDataFrame([(1,)], "x int")
    for v in (1, 2, 3):
        store.write("gold", "t", df, v)
        store.publish("gold", v)
    store.write("gold", "t", df, 4)            # a failed, unpublished run
    assert store.vacuum("gold", keep=2) == [1]
    assert store.versions("gold") == [2, 3] and store.current_version("gold") == 3
    assert os.path.exists(tmp_path / "lake" / "gold" / "v000004")
    assert not os.path.exists(tmp_path / "lake" / "gold" / "v000001")


def test_command_line_run_and_show(spark, tmp_path, capsys):
    from strata.__main__ import main
    paths = write_inputs(str(tmp_path / "in"))
    base = str(tmp_path / "lake")
    args = ["run", "--base", base, "--run-ts", "2024-01-01T06:00:00"]
    for e, p in paths.items():
        args += [f"--{e}", p]
    assert main(args) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["gold_version"] == 1 and out["landed"]["fixtures"] == 6
    assert main(["show", "--base", base, "--layer", "gold", "--table", "agg_venue_home"]) == 0
    assert "home_win_pct" in capsys.readouterr().out


def test_incremental_silver_equals_full_rerun(spark, tmp_path):
    teams = copy.deepcopy(TEAMS)
    teams[1]["team"]["name"] = "Blues United"
    teams[1]["venue"]["capacity"] = 41000
    fixtures = copy.deepcopy(FIXTURES)
    fixtures[2]["goals"] = {"home": 1, "away": 2}
    first = write_inputs(str(tmp_path / "a"))
    second = write_inputs(str(tmp_path / "b"), teams=teams, fixtures=fixtures)
    results = {}
    for mode in (False, True):
        base = str(tmp_path / f"lake-{mode}")
        run_pipeline(spark, first, base, dt.datetime(2024, 1, 1, 6), incremental_silver=mode)
        run_pipeline(spark, second, base, dt.datetime(2024, 2, 1, 6), incremental_silver=mode)
        store = LayerStore(spark, base)
        results[mode] = {t: sorted(map(tuple, store.read("silver", t).collect()), key=repr)
                         for t in SILVER}
    assert results[False] == results[True]
    assert any(r[1] == "Blues United" for r in results[True]["teams"])


def test_incremental_silver_takes_loads_in_any_order(spark, tmp_path):
    """A load with an earlier time (a backfill) is merged, and does not undo newer records."""
    from strata.plans.pipeline import land, run_silver
    extra = [{"team": {"id": 900 + k, "name": f"Late {k}"}, "venue": None} for k in range(2)]
    old = [dict(TEAMS[0], team=dict(TEAMS[0]["team"], name="Stale name"))]
    for name, docs in (("first", TEAMS), ("backfill", old + extra)):
        (tmp_path / f"{name}.json").write_text(envelope("teams", docs))
    found = {}
    for mode in (False, True):
        store = LayerStore(spark, str(tmp_path / f"lake-{mode}"))
        for name, when in (("first", dt.datetime(2024, 1, 1)), ("backfill", dt.datetime(2023, 6, 1))):
            land(spark, store, "teams", str(tmp_path / f"{name}.json"), when)
            run_silver(spark, store, incremental=mode)
        found[mode] = sorted(map(tuple, store.read("silver", "teams").collect()), key=repr)
    assert found[False] == found[True]
    names = {r[1] for r in found[True]}
    assert {"Late 0", "Late 1"} <= names and "Stale name" not in names
