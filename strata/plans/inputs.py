"""Football-shaped inputs derived from the driver's TPC-H-like tables.

Every catalogue query starts from these, so its work grows with the tables:
``orders`` become matches (fixtures) and monthly standings, ``region`` the
leagues, ``nation`` the teams and (thinned) venues, ``customer`` and
``supplier`` the larger dimensions of the SCD tests. The same definitions are
written as SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exprs import season_year
from strata.sources.tables import read_table

# Fixed run dates of the catalogue (the reference uses current_date).
RUN_DATE_1 = "2024-01-01"
RUN_DATE_2 = "2024-02-01"
LOAD_TS_1 = "2024-01-01 06:00:00"
LOAD_TS_2 = "2024-02-01 06:00:00"


def matches(spark: SparkSession, d: str) -> DataFrame:
    """FIXTURES §4 ``matches``: P = unplayed (goals NULL); every 10th order
    has no venue; home never equals away."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    k, c, st, dt = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_orderdate")
    return o.select(
        k.alias("fixture_id"),
        (c % 5).cast("int").alias("league_id"),
        season_year(dt).cast("int").alias("season"),
        dt.alias("kickoff"),
        st.alias("status_short"),
        (c % 25).cast("int").alias("home_team_id"),
        ((c + 1 + k % 24) % 25).cast("int").alias("away_team_id"),
        F.when(k % 10 != 0, c % 25).cast("int").alias("venue_id"),
        F.when(st != "P", k % 5).cast("int").alias("goals_home"),
        F.when(st != "P", F.floor(k / 5) % 4).cast("int").alias("goals_away"),
    )


def standings(spark: SparkSession, d: str) -> DataFrame:
    """FIXTURES §4 ``standings`` (one row per league, season, team, month)
    plus table measures derived from the grain, shaped like silver standings."""
    m = matches(spark, d)
    g = m.select("league_id", "season", F.col("home_team_id").alias("team_id"),
                 F.trunc("kickoff", "month").alias("snapshot_date"),
                 ((F.col("home_team_id") * 7 + F.month("kickoff") * 3 + F.col("season")) % 20 + 1)
                 .cast("int").alias("rank")).distinct()
    t, s, sd = F.col("team_id"), F.col("season"), F.col("snapshot_date")
    played = (F.month(sd) + 20).cast("int")
    win = ((t + s) % 15).cast("int")
    draw = ((t * 3) % 7).cast("int")
    gf = (t + 30).cast("int")
    ga = (s % 17 + 20).cast("int")
    return g.select(
        "league_id", "season", "team_id", "snapshot_date", "rank",
        (win * 3 + draw).cast("int").alias("points"),
        played.alias("played"), win.alias("win"), draw.alias("draw"),
        (played - win - draw).cast("int").alias("lose"),
        gf.alias("goals_for"), ga.alias("goals_against"), (gf - ga).cast("int").alias("goals_diff"),
        sd.cast("timestamp_ntz").alias("updated_at"),
    )


def calendar_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Whole calendar years covering every order date (one row)."""
    o = read_table(spark, d, "orders", ["o_orderdate"])
    return o.agg(F.make_date(F.year(F.min("o_orderdate")), F.lit(1), F.lit(1)).alias("start"),
                 F.make_date(F.year(F.max("o_orderdate")), F.lit(12), F.lit(31)).alias("end"))


def league_source(spark: SparkSession, d: str) -> DataFrame:
    r = read_table(spark, d, "region")
    return r.select(F.col("r_regionkey").cast("int").alias("league_id"), F.col("r_name").alias("name"),
                    F.lit("League").alias("type"), F.col("r_name").alias("country_name"),
                    F.upper(F.substring("r_name", 1, 3)).alias("country_code"),
                    F.concat(F.lit("https://logo/"), F.col("r_regionkey").cast("string")).alias("logo_url"))


def team_source(spark: SparkSession, d: str) -> DataFrame:
    n = read_table(spark, d, "nation")
    k = F.col("n_nationkey")
    return n.select(k.cast("int").alias("team_id"), F.col("n_name").alias("name"),
                    F.upper(F.substring("n_name", 1, 3)).alias("code"),
                    F.col("n_regionkey").cast("string").alias("country"),
                    (k + 1880).cast("int").alias("founded"), (k % 2 == 0).alias("national"),
                    F.concat(F.lit("https://team/"), k.cast("string")).alias("logo_url"))


def venue_source(spark: SparkSession, d: str, thin: bool = True) -> DataFrame:
    """Venues exist for most nations only (``thin``), so some fixtures miss
    (JOIN-5)."""
    n = read_table(spark, d, "nation")
    if thin:
        n = n.filter(F.col("n_nationkey") % 4 != 3)
    k = F.col("n_nationkey")
    return n.select(k.cast("int").alias("venue_id"),
                    F.concat(F.col("n_name"), F.lit(" Stadium")).alias("name"),
                    F.col("n_name").alias("city"),
                    F.concat(F.lit("Main St "), k.cast("string")).alias("address"),
                    F.when(k % 3 == 0, F.lit("artificial")).otherwise(F.lit("grass")).alias("surface"),
                    F.lit(None).cast("string").alias("image"),
                    ((k + 1) * 1000).cast("bigint").alias("capacity"))


# ---------------------------------------------------------------------------
# JSON documents shaped like the API's, derived from the driver tables. Each
# bronze frame has the bronze columns the silver projections read:
# ``id, payload, loaded_at``.
# ---------------------------------------------------------------------------

def _ts(lit_ts: str):
    return F.lit(lit_ts).cast("timestamp")


def _iso(col, offset_hours: int = 0):
    """ISO-8601 text with an explicit offset for a wall-clock timestamp."""
    local = col if offset_hours == 0 else col - F.expr(f"INTERVAL {abs(offset_hours)} HOURS")
    sign = "+00:00" if offset_hours == 0 else f"-{abs(offset_hours):02d}:00"
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(sign))


def fixture_bronze(spark: SparkSession, d: str, version: int) -> DataFrame:
    """Version 1 (all matches, before kickoff) and version 2 (played matches,
    later, with scores; kickoff written at -05:00, venue possibly gone)."""
    m = matches(spark, d)
    if version == 2:
        m = m.filter(F.col("status_short") != "P")
    gh, ga, v2 = F.col("goals_home"), F.col("goals_away"), version == 2
    venue_id = F.col("venue_id") if v2 else F.col("home_team_id")
    side = lambda t, w: F.struct(F.col(t).alias("id"),
                                 F.concat(F.lit("T"), F.col(t).cast("string")).alias("name"),
                                 w.alias("winner"))
    pair = lambda h, a: F.struct(h.alias("home"), a.alias("away"))
    nul = F.lit(None).cast("int")
    doc = F.struct(
        F.struct(F.col("fixture_id").alias("id"),
                 _iso(F.col("kickoff"), 5 if v2 else 0).alias("date"),
                 F.concat(F.lit("Ref "), (F.col("home_team_id") % 7).cast("string")).alias("referee"),
                 F.struct((F.col("status_short") if v2 else F.lit("NS")).alias("short"),
                          F.lit("Match Finished" if v2 else "Not Started").alias("long"),
                          (F.lit(90) if v2 else nul).alias("elapsed")).alias("status"),
                 F.struct(venue_id.alias("id"),
                          F.concat(F.lit("Ground "), venue_id.cast("string")).alias("name"),
                          F.concat(F.lit("City "), venue_id.cast("string")).alias("city")).alias("venue"),
                 ).alias("fixture"),
        F.struct(F.col("league_id").alias("id"), F.col("season").alias("season"),
                 F.concat(F.lit("Round "), F.month("kickoff").cast("string")).alias("round")).alias("league"),
        F.struct(side("home_team_id", gh > ga if v2 else F.lit(None).cast("boolean")).alias("home"),
                 side("away_team_id", ga > gh if v2 else F.lit(None).cast("boolean")).alias("away")).alias("teams"),
        pair(gh if v2 else nul, ga if v2 else nul).alias("goals"),
        F.struct(pair(F.expr("goals_home div 2") if v2 else nul,
                      F.expr("goals_away div 2") if v2 else nul).alias("halftime"),
                 pair(gh if v2 else nul, ga if v2 else nul).alias("fulltime"),
                 pair(nul, nul).alias("extratime"), pair(nul, nul).alias("penalty")).alias("score"),
    )
    return m.select((F.col("fixture_id") * 2 + version).alias("id"), F.to_json(doc).alias("payload"),
                    _ts(LOAD_TS_2 if v2 else LOAD_TS_1).alias("loaded_at"))


def team_bronze(spark: SparkSession, d: str, version: int) -> DataFrame:
    """Teams from customers; every 10th customer has no venue. Version 2
    re-sends the BUILDING segment with an upper-case name, no founding year
    (a NULL that must overwrite) and a larger venue."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                          "c_mktsegment"])
    v2 = version == 2
    if v2:
        c = c.filter(F.col("c_mktsegment") == "BUILDING")
    k, nk = F.col("c_custkey"), F.col("c_nationkey")
    team = F.struct(k.alias("id"), (F.upper("c_name") if v2 else F.col("c_name")).alias("name"),
                    F.substring("c_mktsegment", 1, 3).alias("code"),
                    F.concat(F.lit("N"), nk.cast("string")).alias("country"),
                    (F.lit(None).cast("bigint") if v2 else k % 150 + 1850).alias("founded"),
                    (F.col("c_acctbal") < 0).alias("national"),
                    F.concat(F.lit("https://team/"), k.cast("string")).alias("logo"))
    venue = F.when(k % 10 != 0, F.struct(
        nk.alias("id"), F.concat(F.lit("Arena "), nk.cast("string")).alias("name"),
        F.concat(F.lit("City "), nk.cast("string")).alias("city"),
        F.concat(k.cast("string"), F.lit(" Road")).alias("address"), F.lit("grass").alias("surface"),
        F.lit(None).cast("string").alias("image"),
        (k + 1000 + (1 if v2 else 0)).alias("capacity")))
    return c.select((k * 2 + version).alias("id"),
                    F.to_json(F.struct(team.alias("team"), venue.alias("venue"))).alias("payload"),
                    _ts(LOAD_TS_2 if v2 else LOAD_TS_1).alias("loaded_at"))


LEAGUE_CHUNK = 8   # orders per league document (o_orderkey is unique: a proven bound)


def league_bronze(spark: SparkSession, d: str) -> DataFrame:
    """League documents, one per chunk of 8 consecutive order keys, with the
    orders as ``seasons[]``. ``seasons`` is missing / ``[]`` / ``null`` for
    chunk mod 9 = 0 / 1 / 2. Chunks with id mod 3 = 0 are re-sent later
    (version 2) with a new name and the ``current`` flag flipped."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                        "o_orderpriority"])
    k, ck = F.col("o_orderkey"), F.col("o_custkey")

    def season(current):
        return F.struct(
            k.alias("year"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start"),
            F.date_format(F.date_add(F.to_date("o_orderdate"), 280), "yyyy-MM-dd").alias("end"),
            current.alias("current"),
            F.struct((k % 3 == 0).alias("odds")).alias("players"),
            F.struct((k % 2 == 0).alias("odds"), (ck % 2 == 0).alias("injuries"),
                     F.lit(True).alias("standings"),
                     F.struct((F.col("o_orderpriority") == "1-URGENT").alias("events"),
                              (ck % 3 == 0).alias("lineups")).alias("fixtures")).alias("coverage"))

    cur = F.col("o_orderstatus") == "O"
    chunks = o.groupBy(F.expr(f"o_orderkey div {LEAGUE_CHUNK}").alias("lid")).agg(
        F.array_sort(F.collect_list(season(cur))).alias("s1"),
        F.array_sort(F.collect_list(season(~cur))).alias("s2"))
    lid = F.col("lid")

    def payload(arr, suffix):
        league = F.struct(lid.alias("id"), F.concat(F.lit("League "), lid.cast("string"), F.lit(suffix)).alias("name"),
                          F.when(lid % 2 == 0, "League").otherwise("Cup").alias("type"),
                          F.concat(F.lit("https://league/"), lid.cast("string")).alias("logo"))
        country = F.struct(F.concat(F.lit("C"), (lid % 20).cast("string")).alias("name"),
                           F.concat(F.lit("K"), (lid % 20).cast("string")).alias("code"),
                           F.concat(F.lit("https://flag/"), (lid % 20).cast("string")).alias("flag"))
        seasons = (F.when(lid % 9 == 0, F.lit("")).when(lid % 9 == 1, F.lit(',"seasons":[]'))
                   .when(lid % 9 == 2, F.lit(',"seasons":null'))
                   .otherwise(F.concat(F.lit(',"seasons":'), F.to_json(arr))))
        return F.concat(F.lit('{"league":'), F.to_json(league), F.lit(',"country":'), F.to_json(country),
                        seasons, F.lit("}"))

    v1 = chunks.select((lid * 2 + 1).alias("id"), payload(F.col("s1"), "").alias("payload"),
                       _ts(LOAD_TS_1).alias("loaded_at"))
    v2 = chunks.filter(lid % 3 == 0).select((lid * 2 + 2).alias("id"), payload(F.col("s2"), " v2").alias("payload"),
                                            _ts(LOAD_TS_2).alias("loaded_at"))
    return v1.unionByName(v2)


def standing_bronze(spark: SparkSession, d: str, before: str | None = None) -> DataFrame:
    """One standings document per league, season and monthly snapshot with two
    groups (even / odd team ids); league 0 also carries an empty group and
    league 1 a null group. Loaded at the snapshot date. A group holds at most
    the 25 team ids of the model (a proven bound)."""
    s = standings(spark, d)
    if before:
        s = s.filter(F.col("snapshot_date") < F.lit(before).cast("date"))
    t = F.col("team_id")
    row = F.struct(
        F.struct(t.alias("id"), F.concat(F.lit("Team "), t.cast("string"), F.lit(" @"),
                                         F.month("snapshot_date").cast("string")).alias("name")).alias("team"),
        F.col("rank").alias("rank"), F.col("points").alias("points"),
        F.col("goals_diff").alias("goalsDiff"),
        F.concat(F.lit("Group "), (t % 2).cast("string")).alias("group"), F.lit("WDL").alias("form"),
        F.struct(F.col("played").alias("played"), F.col("win").alias("win"), F.col("draw").alias("draw"),
                 F.col("lose").alias("lose"),
                 F.struct(F.col("goals_for").alias("for"), F.col("goals_against").alias("against")).alias("goals")
                 ).alias("all"),
        _iso(F.col("updated_at")).alias("update"))
    g = s.groupBy("league_id", "season", "snapshot_date").agg(
        F.array_sort(F.collect_list(F.when(t % 2 == 0, row))).alias("even"),
        F.array_sort(F.collect_list(F.when(t % 2 == 1, row))).alias("odd"))
    lg = F.col("league_id")
    extra = F.when(lg == 0, F.lit(",[]")).when(lg == 1, F.lit(",null")).otherwise(F.lit(""))
    payload = F.concat(F.lit('{"league":{"id":'), lg.cast("string"), F.lit(',"season":'),
                       F.col("season").cast("string"), F.lit(',"standings":['), F.to_json("even"),
                       F.lit(","), F.to_json("odd"), extra, F.lit("]}}"))
    bid = (F.year("snapshot_date") * 1000000 + F.month("snapshot_date") * 10000
           + lg * 100 + F.col("season") % 100).cast("bigint")
    return g.select(bid.alias("id"), payload.alias("payload"),
                    F.col("snapshot_date").cast("timestamp").alias("loaded_at"))


ENVELOPE_PAGE = 100   # orders per API page (o_orderkey is unique: a proven bound)


def envelope_bodies(spark: SparkSession, d: str) -> DataFrame:
    """API response bodies, one per page of 100 order keys. Pages carry
    ``errors`` = ``{"token":..}`` (mod 7 = 3), ``["quota"]`` (mod 13 = 6),
    ``{}`` (mod 7 = 5), none (mod 11 = 4) or ``[]``; mod 17 = 8 is not JSON."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_custkey"])
    pages = o.groupBy(F.expr(f"o_orderkey div {ENVELOPE_PAGE}").alias("page")).agg(
        F.count(F.lit(1)).alias("n"),
        F.to_json(F.array_sort(F.collect_list(F.struct(
            F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
            F.col("o_custkey").alias("customer"))))).alias("resp"))
    p = F.col("page")
    err = (F.when(p % 7 == 3, F.lit('{"token":"bad"}')).when(p % 13 == 6, F.lit('["quota"]'))
           .when(p % 7 == 5, F.lit("{}")).when(p % 11 == 4, F.lit(None)).otherwise(F.lit("[]")))
    err_part = F.when(err.isNull(), F.lit("")).otherwise(F.concat(F.lit('"errors":'), err, F.lit(",")))
    body = F.when(p % 17 == 8, F.concat(F.lit("<html>busy "), p.cast("string"))).otherwise(F.concat(
        F.lit('{"get":"orders","parameters":{"page":"'), p.cast("string"), F.lit('"},'), err_part,
        F.lit('"results":'), F.col("n").cast("string"), F.lit(',"paging":{"current":1,"total":1},"response":'),
        F.col("resp"), F.lit("}")))
    return pages.select("page", body.alias("body"))


def envelope_lines(payloads: DataFrame, get: str, page) -> DataFrame:
    """Pack bronze-shaped payloads into API response bodies, one per page.
    ``page`` must map at most a bounded number of unique ids to one page."""
    pages = payloads.groupBy(page.alias("page")).agg(
        F.count(F.lit(1)).alias("n"), F.concat_ws(",", F.transform(F.array_sort(F.collect_list(
            F.struct("id", "payload"))), lambda x: x["payload"])).alias("items"))
    return pages.select(F.concat(
        F.lit(f'{{"get":"{get}","parameters":{{"page":"'), F.col("page").cast("string"),
        F.lit('"},"errors":[],"results":'), F.col("n").cast("string"),
        F.lit(',"paging":{"current":1,"total":1},"response":['), F.col("items"), F.lit("]}")).alias("body"))


def write_envelopes(spark: SparkSession, d: str, out: str) -> dict:
    """Newline-delimited envelope files (gzip, one for each task) for every entity, derived from the
    driver tables: fixtures before and after kickoff, team and league documents and
    those re-sent (100 ids per page; one standings table per page). Records of one
    run share their load time; the later position in a page is the newer one."""
    out = out.rstrip("/")
    sets = {
        "fixtures": envelope_lines(fixture_bronze(spark, d, 1).unionByName(fixture_bronze(spark, d, 2)), "fixtures",
                                   F.expr("(id - 1) div 200")),
        "teams": envelope_lines(team_bronze(spark, d, 1).unionByName(team_bronze(spark, d, 2)), "teams",
                                F.expr("(id - 1) div 200")),
        "leagues": envelope_lines(league_bronze(spark, d), "leagues", F.expr("(id - 1) div 200")),
        "standings": envelope_lines(standing_bronze(spark, d), "standings", F.col("id")),
    }
    paths = {}
    for entity, df in sets.items():
        paths[entity] = f"{out}/{entity}"
        df.write.mode("overwrite").option("compression", "gzip").text(paths[entity])
    return paths
