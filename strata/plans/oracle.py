"""DuckDB SQL oracles for the query catalogue (same column names and types).

Exact decimals: DuckDB divides decimals as doubles, so averages rounded to two
places are written with integer half-up arithmetic,
``(num * 200 + den) // (2 * den)`` hundredths, for non-negative ``num``.
"""

from __future__ import annotations

ORACLE: dict = {}

MATCHES = """matches AS (
  SELECT o_orderkey AS fixture_id, CAST(o_custkey % 5 AS INTEGER) AS league_id,
    CAST(CASE WHEN month(o_orderdate) >= 8 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER) AS season,
    o_orderdate AS kickoff, o_orderstatus AS status_short,
    CAST(o_custkey % 25 AS INTEGER) AS home_team_id,
    CAST((o_custkey + 1 + o_orderkey % 24) % 25 AS INTEGER) AS away_team_id,
    CAST(CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey % 25 END AS INTEGER) AS venue_id,
    CAST(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 5 END AS INTEGER) AS goals_home,
    CAST(CASE WHEN o_orderstatus <> 'P' THEN floor(o_orderkey / 5) % 4 END AS INTEGER) AS goals_away
  FROM orders)"""

STANDINGS = """st0 AS (
  SELECT DISTINCT league_id, season, home_team_id AS team_id,
    CAST(date_trunc('month', kickoff) AS DATE) AS snapshot_date,
    CAST((home_team_id * 7 + month(kickoff) * 3 + season) % 20 + 1 AS INTEGER) AS rank
  FROM matches),
standings AS (
  SELECT league_id, season, team_id, snapshot_date, rank,
    CAST(((team_id + season) % 15) * 3 + (team_id * 3) % 7 AS INTEGER) AS points,
    CAST(month(snapshot_date) + 20 AS INTEGER) AS played,
    CAST((team_id + season) % 15 AS INTEGER) AS win,
    CAST((team_id * 3) % 7 AS INTEGER) AS draw,
    CAST(month(snapshot_date) + 20 - (team_id + season) % 15 - (team_id * 3) % 7 AS INTEGER) AS lose,
    CAST(team_id + 30 AS INTEGER) AS goals_for,
    CAST(season % 17 + 20 AS INTEGER) AS goals_against,
    CAST(team_id + 30 - (season % 17 + 20) AS INTEGER) AS goals_diff,
    CAST(snapshot_date AS TIMESTAMP) AS updated_at
  FROM st0)"""

DIM_DATE = """bounds AS (
  SELECT make_date(CAST(year(min(o_orderdate)) AS BIGINT), 1, 1) AS s,
         make_date(CAST(year(max(o_orderdate)) AS BIGINT), 12, 31) AS e FROM orders),
cal AS (SELECT CAST(g AS DATE) AS d FROM (
  SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS g FROM bounds)),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
    CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
    strftime(d, '%A') AS day_name, CAST(week(d) AS INTEGER) AS week,
    isodow(d) IN (6, 7) AS is_weekend,
    CAST(CASE WHEN month(d) >= 8 THEN year(d) ELSE year(d) - 1 END AS INTEGER) AS season_year
  FROM cal)"""

DIMS = """dim_league AS (
  SELECT CAST(row_number() OVER (ORDER BY r_regionkey) AS INTEGER) AS league_key,
    CAST(r_regionkey AS INTEGER) AS league_id, r_name AS name, 'League' AS type,
    r_name AS country_name, upper(substr(r_name, 1, 3)) AS country_code,
    'https://logo/' || CAST(r_regionkey AS VARCHAR) AS logo_url
  FROM region),
dim_team AS (
  SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS INTEGER) AS team_key,
    CAST(n_nationkey AS INTEGER) AS team_id, n_name AS name, upper(substr(n_name, 1, 3)) AS code,
    CAST(n_regionkey AS VARCHAR) AS country, CAST(n_nationkey + 1880 AS INTEGER) AS founded,
    n_nationkey % 2 = 0 AS national, 'https://team/' || CAST(n_nationkey AS VARCHAR) AS logo_url,
    DATE '2024-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
  FROM nation),
dim_venue AS (
  SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS INTEGER) AS venue_key,
    CAST(n_nationkey AS INTEGER) AS venue_id, n_name || ' Stadium' AS name, n_name AS city,
    'Main St ' || CAST(n_nationkey AS VARCHAR) AS address,
    CASE WHEN n_nationkey % 3 = 0 THEN 'artificial' ELSE 'grass' END AS surface,
    CAST(NULL AS VARCHAR) AS image, CAST((n_nationkey + 1) * 1000 AS BIGINT) AS capacity,
    DATE '2024-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
  FROM nation WHERE n_nationkey % 4 <> 3)"""

# The facts are checked against the rules that generate the inputs, without any
# lookup: keys of leagues and teams are their ids plus one, a venue's key counts
# the nations up to it that have a venue, and a date's key is its digits.
FACT_FIXTURE = """drawn AS (
  SELECT o_orderkey AS n, o_custkey % 25 AS ground, o_orderdate AS day, o_orderstatus AS state,
    CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderkey % 5 END AS scored,
    CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderkey // 5 % 4 END AS let_in
  FROM orders),
fact_fixture AS (
  SELECT n::INTEGER AS fixture_id, strftime(day, '%Y%m%d')::INTEGER AS date_key,
    (ground % 5 + 1)::INTEGER AS league_key, (ground + 1)::INTEGER AS home_team_key,
    ((ground + 1 + n % 24) % 25 + 1)::INTEGER AS away_team_key,
    CASE WHEN n % 10 > 0 AND ground % 4 < 3 THEN ground + 1 - (ground + 1) // 4 END::INTEGER AS venue_key,
    year(day - INTERVAL 7 MONTH)::INTEGER AS season, state AS status_short,
    scored::INTEGER AS goals_home, let_in::INTEGER AS goals_away,
    (ifnull(scored, 0) + ifnull(let_in, 0))::INTEGER AS goals_total, sign(scored - let_in)::SMALLINT AS result
  FROM drawn)"""

FACT_STANDING = """monthly AS (
  SELECT DISTINCT o_custkey % 25 AS team, date_trunc('month', o_orderdate)::DATE AS day FROM orders),
tables AS (
  SELECT team, day, year(day - INTERVAL 7 MONTH) AS season, month(day) + 20 AS games,
    (team + year(day - INTERVAL 7 MONTH)) % 15 AS wins, team * 3 % 7 AS draws FROM monthly),
fact_standing AS (
  SELECT row_number() OVER (ORDER BY day, team % 5, season, team)::INTEGER AS standing_key,
    strftime(day, '%Y%m%d')::INTEGER AS snapshot_date_key, (team % 5 + 1)::INTEGER AS league_key,
    (team + 1)::INTEGER AS team_key, season::INTEGER AS season,
    ((team * 7 + (games - 20) * 3 + season) % 20 + 1)::INTEGER AS rank, (3 * wins + draws)::INTEGER AS points,
    games::INTEGER AS played, wins::SMALLINT AS won, draws::SMALLINT AS draw, (games - wins - draws)::SMALLINT AS lost,
    (team + 30)::INTEGER AS goals_for, (season % 17 + 20)::INTEGER AS goals_against,
    (team + 10 - season % 17)::INTEGER AS goal_diff
  FROM tables)"""

GOLD = ",\n".join([MATCHES, DIM_DATE, DIMS, FACT_FIXTURE])
GOLD_ALL = ",\n".join([MATCHES, STANDINGS, DIM_DATE, DIMS, FACT_FIXTURE, FACT_STANDING])


def half_up(num: str, den: str, p: int, s: int = 2) -> str:
    """round(num / den, 2) half up for num >= 0, den > 0, as DECIMAL(p, 2)."""
    return (f"CAST(CAST((({num}) * 200 + ({den})) // (2 * ({den})) AS DECIMAL(18,0)) * 0.01 "
            f"AS DECIMAL({p},{s}))")


SIDE_ROWS = """side_rows AS (
  SELECT f.fixture_id, f.league_key, f.season, s.team_key, s.scored, s.conceded, s.outcome
  FROM fact_fixture f,
  LATERAL (VALUES (f.home_team_key, f.goals_home, f.goals_away, f.result),
                  (f.away_team_key, f.goals_away, f.goals_home, CAST(-f.result AS SMALLINT)))
    AS s(team_key, scored, conceded, outcome)
  WHERE f.result IS NOT NULL)"""

# From the drawn matches: a side's lead is its goals less the other's; who leads wins.
SEASON_TOTALS = """sides AS (
  SELECT ground % 5 AS league, ground AS team, year(day - INTERVAL 7 MONTH) AS term, scored AS made, scored - let_in AS lead
  FROM drawn WHERE state <> 'P'
  UNION ALL
  SELECT ground % 5, (ground + 1 + n % 24) % 25, year(day - INTERVAL 7 MONTH), let_in, let_in - scored FROM drawn WHERE state <> 'P'),
summed AS (
  SELECT league, team, term, count(*) AS games, sum(made) AS made, sum(lead) AS lead, sum(sign(lead)) AS balance,
    sum((lead = 0)::INTEGER) AS even, sum((made = lead)::INTEGER) AS shut
  FROM sides GROUP BY ALL),
season_totals AS (
  SELECT (league + 1)::INTEGER AS league_key, (team + 1)::INTEGER AS team_key, term::INTEGER AS season, games::INTEGER AS played,
    wins::INTEGER AS won, even::INTEGER AS draw, (games - even - wins)::INTEGER AS lost, made::INTEGER AS goals_for,
    (made - lead)::INTEGER AS goals_against, lead::INTEGER AS goal_diff, (3 * wins + even)::INTEGER AS points, shut::INTEGER AS clean_sheets
  FROM (SELECT *, (games - even + balance)::BIGINT // 2 AS wins FROM summed))"""

LATEST_RANK = """last_rank AS (
  SELECT league_key, team_key, season, arg_max(rank, snapshot_date_key) AS final_rank
  FROM fact_standing GROUP BY league_key, team_key, season)"""

ORACLE["dim_date"] = f"WITH {DIM_DATE} SELECT * FROM dim_date"

ORACLE["surrogate_key_lookup"] = f"""WITH {GOLD}
SELECT CAST(m.fixture_id AS INTEGER) AS fixture_id, cal.date_key, lg.league_key FROM matches m
JOIN dim_date cal ON cal.full_date = CAST(m.kickoff AS DATE)
JOIN dim_league lg ON lg.league_id = m.league_id"""

ORACLE["role_playing_dim"] = f"""WITH {GOLD}
SELECT CAST(m.fixture_id AS INTEGER) AS fixture_id, hm.team_key AS home_team_key,
  hm.name AS home_team_name, aw.team_key AS away_team_key, aw.name AS away_team_name
FROM matches m
JOIN dim_team hm ON hm.team_id = m.home_team_id AND hm.is_current
JOIN dim_team aw ON aw.team_id = m.away_team_id AND aw.is_current"""

ORACLE["left_lookup_nullable"] = f"""WITH {GOLD}
SELECT CAST(m.fixture_id AS INTEGER) AS fixture_id, m.venue_id, ven.venue_key FROM matches m
LEFT JOIN dim_venue ven ON ven.venue_id = m.venue_id AND ven.is_current"""

ORACLE["fact_match"] = f"WITH {GOLD} SELECT * FROM fact_fixture"

ORACLE["fact_snapshot"] = f"WITH {GOLD_ALL} SELECT * FROM fact_standing"

ORACLE["unpivot_union_all"] = f"WITH {GOLD}, {SIDE_ROWS} SELECT * FROM side_rows"

ORACLE["lateral_top1"] = f"WITH {GOLD_ALL}, {LATEST_RANK} SELECT * FROM last_rank"

ORACLE["drill_across"] = f"""WITH {GOLD_ALL}, {SEASON_TOTALS}, {LATEST_RANK}
SELECT t.league_key, t.team_key, t.season, t.played, t.points, l.final_rank
FROM season_totals t LEFT JOIN last_rank l USING (league_key, team_key, season)"""

ORACLE["mart_team_season"] = f"""WITH {GOLD_ALL}, {SEASON_TOTALS}, {LATEST_RANK}
SELECT t.league_key, t.team_key, t.season, t.played, t.won, t.draw, t.lost, t.goals_for,
  t.goals_against, t.goal_diff, t.points, {half_up('t.points', 't.played', 4)} AS points_per_game,
  t.clean_sheets, l.final_rank
FROM season_totals t LEFT JOIN last_rank l USING (league_key, team_key, season)"""

ORACLE["mart_league_month"] = f"""WITH {GOLD}
SELECT fx.league_key, fx.season, cal.year, cal.month, cal.month_name,
  CAST(count(*) AS INTEGER) AS matches, CAST(sum(fx.goals_total) AS INTEGER) AS total_goals,
  {half_up('sum(fx.goals_total)', 'count(fx.goals_total)', 4)} AS goals_per_match,
  {half_up('100 * count(*) FILTER (WHERE fx.result = 1)', 'count(*)', 5)} AS home_win_pct,
  {half_up('100 * count(*) FILTER (WHERE fx.result = 0)', 'count(*)', 5)} AS draw_pct,
  {half_up('100 * count(*) FILTER (WHERE fx.result = -1)', 'count(*)', 5)} AS away_win_pct
FROM fact_fixture fx JOIN dim_date cal ON cal.date_key = fx.date_key
WHERE fx.result IS NOT NULL
GROUP BY fx.league_key, fx.season, cal.year, cal.month, cal.month_name"""

ORACLE["mart_venue_home"] = f"""WITH {GOLD}
SELECT fx.venue_key, fx.season, CAST(count(*) AS INTEGER) AS home_matches,
  CAST(sum(fx.goals_home) AS INTEGER) AS home_goals,
  {half_up('sum(fx.goals_home)', 'count(fx.goals_home)', 4)} AS home_goals_per_match,
  CAST(count(*) FILTER (WHERE fx.result = 1) AS INTEGER) AS home_wins,
  {half_up('100 * count(*) FILTER (WHERE fx.result = 1)', 'count(*)', 5)} AS home_win_pct
FROM fact_fixture fx WHERE fx.venue_key IS NOT NULL AND fx.result IS NOT NULL
GROUP BY fx.venue_key, fx.season"""


# ---------------------------------------------------------------------------
# sources
# ---------------------------------------------------------------------------

ORACLE["envelope_explode"] = """
SELECT o_orderkey // 100 AS page,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
  o_orderkey AS id, o_orderstatus AS status, o_custkey AS customer
FROM orders
WHERE NOT ((o_orderkey // 100) % 17 = 8 OR (o_orderkey // 100) % 7 = 3 OR (o_orderkey // 100) % 13 = 6)"""

ORACLE["envelope_errors"] = """
WITH p AS (SELECT o_orderkey // 100 AS page, count(*) AS n FROM orders GROUP BY 1)
SELECT page,
  CASE WHEN page % 17 = 8 THEN NULL ELSE CAST(n AS INTEGER) END AS results,
  NOT (page % 17 = 8 OR page % 7 = 3 OR page % 13 = 6) AS accepted
FROM p"""

ORACLE["land_bronze"] = """
SELECT CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS id, props AS payload,
  '{"user_id":"' || CAST(user_id AS VARCHAR) || '"}' AS source_params, event_type AS source,
  ts AS loaded_at, md5(props) AS record_hash
FROM events"""

FIXTURE_V2 = """
  SELECT CAST(fixture_id AS INTEGER) AS fixture_id, league_id, season,
    'Round ' || CAST(month(kickoff) AS VARCHAR) AS round, kickoff, status_short,
    'Match Finished' AS status_long, 90 AS status_elapsed,
    'Ref ' || CAST(home_team_id % 7 AS VARCHAR) AS referee, venue_id,
    'Ground ' || CAST(venue_id AS VARCHAR) AS venue_name, 'City ' || CAST(venue_id AS VARCHAR) AS venue_city,
    home_team_id, 'T' || CAST(home_team_id AS VARCHAR) AS home_team_name,
    away_team_id, 'T' || CAST(away_team_id AS VARCHAR) AS away_team_name,
    goals_home > goals_away AS home_winner, goals_away > goals_home AS away_winner,
    goals_home, goals_away, CAST(goals_home // 2 AS INTEGER) AS ht_home,
    CAST(goals_away // 2 AS INTEGER) AS ht_away, goals_home AS ft_home, goals_away AS ft_away,
    CAST(NULL AS INTEGER) AS et_home, CAST(NULL AS INTEGER) AS et_away,
    CAST(NULL AS INTEGER) AS pen_home, CAST(NULL AS INTEGER) AS pen_away
  FROM matches WHERE status_short <> 'P'"""

FIXTURE_V1 = """
  SELECT CAST(fixture_id AS INTEGER) AS fixture_id, league_id, season,
    'Round ' || CAST(month(kickoff) AS VARCHAR) AS round, kickoff, 'NS' AS status_short,
    'Not Started' AS status_long, CAST(NULL AS INTEGER) AS status_elapsed,
    'Ref ' || CAST(home_team_id % 7 AS VARCHAR) AS referee, home_team_id AS venue_id,
    'Ground ' || CAST(home_team_id AS VARCHAR) AS venue_name,
    'City ' || CAST(home_team_id AS VARCHAR) AS venue_city,
    home_team_id, 'T' || CAST(home_team_id AS VARCHAR) AS home_team_name,
    away_team_id, 'T' || CAST(away_team_id AS VARCHAR) AS away_team_name,
    CAST(NULL AS BOOLEAN) AS home_winner, CAST(NULL AS BOOLEAN) AS away_winner,
    CAST(NULL AS INTEGER) AS goals_home, CAST(NULL AS INTEGER) AS goals_away,
    CAST(NULL AS INTEGER) AS ht_home, CAST(NULL AS INTEGER) AS ht_away,
    CAST(NULL AS INTEGER) AS ft_home, CAST(NULL AS INTEGER) AS ft_away,
    CAST(NULL AS INTEGER) AS et_home, CAST(NULL AS INTEGER) AS et_away,
    CAST(NULL AS INTEGER) AS pen_home, CAST(NULL AS INTEGER) AS pen_away
  FROM matches WHERE status_short = 'P'"""

ORACLE["json_project_typed"] = f"""WITH {MATCHES} {FIXTURE_V2} UNION ALL {FIXTURE_V1.replace("WHERE status_short = 'P'", "")}"""

ORACLE["silver_fixtures"] = f"""WITH {MATCHES}
SELECT *, TIMESTAMP '2024-02-01 06:00:00' AS loaded_at FROM ({FIXTURE_V2})
UNION ALL
SELECT *, TIMESTAMP '2024-01-01 06:00:00' AS loaded_at FROM ({FIXTURE_V1})"""

VENUE_ROWS = """
  SELECT CAST(c_custkey AS INTEGER) AS team_id, c_nationkey AS venue_id,
    'City ' || CAST(c_nationkey AS VARCHAR) AS city, 'Arena ' || CAST(c_nationkey AS VARCHAR) AS venue_name,
    CAST(NULL AS VARCHAR) AS image, CAST(c_custkey AS VARCHAR) || ' Road' AS address, 'grass' AS surface,
    CAST(c_custkey + 1000 + CASE WHEN {v2} THEN 1 ELSE 0 END AS BIGINT) AS capacity
  FROM customer WHERE c_custkey % 10 <> 0"""

TEAM_DOCS = """
  SELECT 'teams' AS entity, CAST(c_custkey AS INTEGER) AS team_id, {name} AS name, substr(c_mktsegment, 1, 3) AS code,
    'N' || CAST(c_nationkey AS VARCHAR) AS country, CAST({founded} AS INTEGER) AS founded, c_acctbal < 0 AS national,
    'https://team/' || CAST(c_custkey AS VARCHAR) AS logo_url FROM customer"""

ORACLE["json_fanout"] = f"""
{TEAM_DOCS.format(name="c_name", founded="c_custkey % 150 + 1850")}
UNION ALL BY NAME
{TEAM_DOCS.format(name="upper(c_name)", founded="NULL")} WHERE c_mktsegment = 'BUILDING'
UNION ALL BY NAME
SELECT 'venues' AS entity, * FROM ({VENUE_ROWS.format(v2="false")})
UNION ALL BY NAME
SELECT 'venues' AS entity, * FROM ({VENUE_ROWS.format(v2="true")} AND c_mktsegment = 'BUILDING')"""

ORACLE["silver_venues"] = f"""
SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '2024-02-01 06:00:00'
               ELSE TIMESTAMP '2024-01-01 06:00:00' END AS loaded_at
FROM ({VENUE_ROWS.format(v2="c_mktsegment = 'BUILDING'").replace(
    "FROM customer", ", c_mktsegment FROM customer")})""".replace("SELECT *,", "SELECT * EXCLUDE (c_mktsegment),", 1)

ORACLE["silver_teams"] = """
SELECT CAST(c_custkey AS INTEGER) AS team_id,
  CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_name END AS name,
  substr(c_mktsegment, 1, 3) AS code, 'N' || CAST(c_nationkey AS VARCHAR) AS country,
  CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey % 150 + 1850 END AS INTEGER) AS founded,
  c_acctbal < 0 AS national, 'https://team/' || CAST(c_custkey AS VARCHAR) AS logo_url,
  CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '2024-02-01 06:00:00'
       ELSE TIMESTAMP '2024-01-01 06:00:00' END AS loaded_at
FROM customer"""

SEASON_ROWS = """
  SELECT CAST(o_orderkey // 8 AS INTEGER) AS league_id, CAST(o_orderkey AS VARCHAR) AS year,
    CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + 280 AS end_date,
    CASE WHEN {flip} THEN o_orderstatus <> 'O' ELSE o_orderstatus = 'O' END AS current,
    o_orderkey % 2 = 0 AS odds, o_orderkey % 3 = 0 AS players,
    o_orderpriority = '1-URGENT' AS events, o_custkey % 3 = 0 AS lineups,
    CAST(NULL AS BOOLEAN) AS statistics_players, CAST(NULL AS BOOLEAN) AS statistics_fixtures,
    o_custkey % 2 = 0 AS injuries, true AS standings, CAST(NULL AS BOOLEAN) AS top_cards,
    CAST(NULL AS BOOLEAN) AS predictions, CAST(NULL AS BOOLEAN) AS top_assists,
    CAST(NULL AS BOOLEAN) AS top_scorers{extra}
  FROM orders WHERE (o_orderkey // 8) % 9 NOT IN (0, 1, 2)"""

_SEASON_POS = """,
    CAST(row_number() OVER (PARTITION BY o_orderkey // 8 ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
    CAST(o_orderkey // 8 * 2 + {version} AS BIGINT) AS id"""

ORACLE["json_unnest"] = (SEASON_ROWS.format(flip="false", extra=_SEASON_POS.format(version=1)) + " UNION ALL "
                         + SEASON_ROWS.format(flip="true", extra=_SEASON_POS.format(version=2))
                         + " AND (o_orderkey // 8) % 3 = 0")

ORACLE["silver_seasons"] = SEASON_ROWS.format(flip="(o_orderkey // 8) % 3 = 0", extra=""",
    CASE WHEN (o_orderkey // 8) % 3 = 0 THEN TIMESTAMP '2024-02-01 06:00:00'
         ELSE TIMESTAMP '2024-01-01 06:00:00' END AS loaded_at""")

ORACLE["silver_leagues"] = """
WITH l AS (SELECT DISTINCT o_orderkey // 8 AS lid FROM orders)
SELECT lid AS league_id, 'League ' || CAST(lid AS VARCHAR) || CASE WHEN lid % 3 = 0 THEN ' v2' ELSE '' END AS league_name,
  CASE WHEN lid % 2 = 0 THEN 'League' ELSE 'Cup' END AS type,
  'C' || CAST(lid % 20 AS VARCHAR) AS country_name, 'K' || CAST(lid % 20 AS VARCHAR) AS country_code,
  'https://league/' || CAST(lid AS VARCHAR) AS logo, 'https://flag/' || CAST(lid % 20 AS VARCHAR) AS flag,
  CASE WHEN lid % 3 = 0 THEN TIMESTAMP '2024-02-01 06:00:00' ELSE TIMESTAMP '2024-01-01 06:00:00' END AS loaded_at
FROM l"""

STANDING_ROWS = """
  SELECT league_id, season, team_id,
    'Team ' || CAST(team_id AS VARCHAR) || ' @' || CAST(month(snapshot_date) AS VARCHAR) AS team_name,
    rank, points, goals_diff, 'Group ' || CAST(team_id % 2 AS VARCHAR) AS group_name, 'WDL' AS form,
    played, win, draw, lose, goals_for, goals_against, updated_at, snapshot_date
  FROM standings"""

ORACLE["json_unnest_nested"] = f"""WITH {MATCHES}, {STANDINGS}
SELECT * EXCLUDE (snapshot_date), CAST(team_id % 2 AS INTEGER) AS group_pos,
  CAST(row_number() OVER (PARTITION BY league_id, season, snapshot_date, team_id % 2 ORDER BY team_id) - 1
       AS INTEGER) AS row_pos
FROM ({STANDING_ROWS})"""

ORACLE["silver_standings"] = f"""WITH {MATCHES}, {STANDINGS}, sr AS ({STANDING_ROWS}),
fin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY league_id, season, team_id
                                                     ORDER BY snapshot_date DESC) AS rn FROM sr) WHERE rn = 1),
early AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY league_id, season, team_id
                                                      ORDER BY snapshot_date DESC) AS rn
                         FROM sr WHERE snapshot_date < DATE '1999-01-01') WHERE rn = 1)
SELECT f.league_id, f.season, f.team_id, coalesce(e.team_name, f.team_name) AS team_name, f.rank, f.points,
  f.goals_diff, f.group_name, f.form, f.played, f.win, f.draw, f.lose, f.goals_for, f.goals_against,
  f.updated_at, CAST(f.snapshot_date AS TIMESTAMP) AS loaded_at
FROM fin f LEFT JOIN early e ON e.league_id = f.league_id AND e.season = f.season AND e.team_id = f.team_id"""

# ---------------------------------------------------------------------------
# MERGE / UPSERT / UPDATE family
# ---------------------------------------------------------------------------

ORDER_SLICES = """t AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
  WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (
  SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""

ORACLE["merge_upsert"] = f"""WITH {ORDER_SLICES}
SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)"""

ORACLE["merge_partial_update"] = f"""WITH {ORDER_SLICES}
SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice,
  CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
FROM s LEFT JOIN t ON t.o_orderkey = s.o_orderkey
UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)"""

ORACLE["insert_absent"] = f"""WITH {ORDER_SLICES}
SELECT * FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)"""

ORACLE["update_from"] = f"""WITH {ORDER_SLICES}
SELECT t.o_orderkey, t.o_custkey,
  CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderpriority IS DISTINCT FROM s.o_orderpriority
       THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderpriority IS DISTINCT FROM s.o_orderpriority
       THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  t.o_orderpriority
FROM t LEFT JOIN s ON s.o_orderkey = t.o_orderkey"""

GRAIN_EQ = """u.snapshot_date_key = v.snapshot_date_key AND u.league_key = v.league_key
  AND u.season = v.season AND u.team_key = v.team_key"""

ORACLE["upsert_fact"] = f"""WITH {GOLD_ALL},
ft AS (SELECT CAST(row_number() OVER (ORDER BY snapshot_date_key, league_key, season, team_key) AS INTEGER)
         AS standing_key, * EXCLUDE (standing_key) FROM fact_standing WHERE snapshot_date_key < 19990101),
fsrc AS (SELECT * EXCLUDE (standing_key, rank), rank + 100 AS rank FROM fact_standing
         WHERE snapshot_date_key >= 19980101),
upd AS (SELECT u.standing_key, v.* FROM ft u JOIN fsrc v ON {GRAIN_EQ}),
keep AS (SELECT u.* FROM ft u WHERE NOT EXISTS (SELECT 1 FROM fsrc v WHERE {GRAIN_EQ})),
ins AS (SELECT v.* FROM fsrc v WHERE NOT EXISTS (SELECT 1 FROM ft u WHERE {GRAIN_EQ}))
SELECT standing_key, snapshot_date_key, league_key, team_key, season, rank, points, played, won, draw, lost,
  goals_for, goals_against, goal_diff FROM upd
UNION ALL
SELECT standing_key, snapshot_date_key, league_key, team_key, season, rank, points, played, won, draw, lost,
  goals_for, goals_against, goal_diff FROM keep
UNION ALL
SELECT CAST((SELECT max(standing_key) FROM ft) + row_number() OVER (
         ORDER BY snapshot_date_key, league_key, season, team_key) AS INTEGER),
  snapshot_date_key, league_key, team_key, season, rank, points, played, won, draw, lost,
  goals_for, goals_against, goal_diff FROM ins"""

ORACLE["upsert_fact_seasons"] = ORACLE["upsert_fact"]

ORACLE["full_refresh"] = ORACLE["mart_venue_home"]

ORACLE["surrogate_key"] = """
SELECT c_custkey, c_name, CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS customer_key FROM customer"""

ORACLE["row_is_distinct"] = """
SELECT c_custkey,
  c_name IS DISTINCT FROM (CASE WHEN c_nationkey = 3 THEN upper(c_name) ELSE c_name END)
  OR (CASE WHEN c_acctbal >= 0 THEN c_mktsegment END) IS DISTINCT FROM (CASE WHEN c_acctbal >= 100 THEN c_mktsegment END)
  OR c_nationkey IS DISTINCT FROM (CASE WHEN c_nationkey <> 7 THEN c_nationkey END) AS is_distinct
FROM customer"""

ORACLE["distinct_on_latest"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""

# ---------------------------------------------------------------------------
# SCD
# ---------------------------------------------------------------------------

SCD1 = """t AS (
  SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS cust_key, c_custkey, c_name AS name,
    c_mktsegment AS segment FROM customer WHERE c_nationkey < 15),
s AS (SELECT c_custkey, upper(c_name) AS name, c_mktsegment AS segment FROM customer WHERE c_nationkey >= 10),
n AS (SELECT CAST((SELECT max(cust_key) FROM t) + row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS cust_key,
        c_custkey, name, segment FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM t))"""

ORACLE["scd1_insert_absent"] = f"WITH {SCD1} SELECT * FROM t UNION ALL SELECT * FROM n"

ORACLE["scd1_overwrite"] = f"""WITH {SCD1}
SELECT t.cust_key, t.c_custkey,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.name ELSE t.name END AS name,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.segment ELSE t.segment END AS segment
FROM t LEFT JOIN s ON s.c_custkey = t.c_custkey
UNION ALL SELECT * FROM n"""

SCD2 = """t AS (
  SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS cust_key, c_custkey, c_name AS name,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment, c_nationkey AS nation,
    DATE '2024-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
  FROM customer WHERE c_nationkey < 20),
s AS (
  SELECT c_custkey, CASE WHEN c_nationkey % 4 = 1 THEN upper(c_name) ELSE c_name END AS name,
    CASE WHEN c_acctbal >= 500 THEN c_mktsegment END AS segment, c_nationkey AS nation
  FROM customer WHERE c_nationkey <> 0),
chg AS (
  SELECT t.c_custkey FROM t JOIN s ON s.c_custkey = t.c_custkey
  WHERE t.name IS DISTINCT FROM s.name OR t.segment IS DISTINCT FROM s.segment
     OR t.nation IS DISTINCT FROM s.nation),
expired AS (
  SELECT cust_key, c_custkey, name, segment, nation, valid_from,
    CASE WHEN c_custkey IN (SELECT c_custkey FROM chg) THEN DATE '2024-01-31' ELSE valid_to END AS valid_to,
    c_custkey NOT IN (SELECT c_custkey FROM chg) AS is_current
  FROM t),
ins AS (
  SELECT CAST((SELECT max(cust_key) FROM t) + row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS cust_key,
    c_custkey, name, segment, nation, DATE '2024-02-01' AS valid_from, DATE '9999-12-31' AS valid_to,
    true AS is_current
  FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM t) OR c_custkey IN (SELECT c_custkey FROM chg)),
applied AS (SELECT * FROM expired UNION ALL SELECT * FROM ins)"""

ORACLE["scd2_expire"] = f"WITH {SCD2} SELECT * FROM expired"
ORACLE["scd2_insert"] = f"WITH {SCD2} SELECT * FROM applied"
ORACLE["scd2_apply"] = f"WITH {SCD2} SELECT * FROM applied"

ORACLE["scd2_dedup_apply"] = """WITH t AS (
  SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS INTEGER) AS venue_key,
    CAST(n_nationkey AS INTEGER) AS venue_id, n_name || ' Stadium' AS name, n_name AS city,
    'Main St ' || CAST(n_nationkey AS VARCHAR) AS address,
    CASE WHEN n_nationkey % 3 = 0 THEN 'artificial' ELSE 'grass' END AS surface,
    CAST(NULL AS VARCHAR) AS image, CAST((n_nationkey + 1) * 1000 AS BIGINT) AS capacity,
    DATE '2024-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
  FROM nation),
sv AS (
  SELECT CAST(s_nationkey AS INTEGER) AS venue_id,
    'Ground ' || CAST(s_nationkey AS VARCHAR) || '/' || CAST(s_suppkey AS VARCHAR) AS name,
    'City ' || CAST(s_nationkey AS VARCHAR) AS city, 'Main St ' || CAST(s_nationkey AS VARCHAR) AS address,
    'grass' AS surface, CAST(NULL AS VARCHAR) AS image, CAST(s_suppkey * 10 AS BIGINT) AS capacity,
    row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) AS rn
  FROM supplier),
s AS (SELECT * EXCLUDE (rn) FROM sv WHERE rn = 1),
chg AS (
  SELECT t.venue_id FROM t JOIN s ON s.venue_id = t.venue_id
  WHERE t.name IS DISTINCT FROM s.name OR t.city IS DISTINCT FROM s.city OR t.address IS DISTINCT FROM s.address
     OR t.surface IS DISTINCT FROM s.surface OR t.image IS DISTINCT FROM s.image
     OR t.capacity IS DISTINCT FROM s.capacity)
SELECT venue_key, venue_id, name, city, address, surface, image, capacity, valid_from,
  CASE WHEN venue_id IN (SELECT venue_id FROM chg) THEN DATE '2024-01-31' ELSE valid_to END AS valid_to,
  venue_id NOT IN (SELECT venue_id FROM chg) AS is_current
FROM t
UNION ALL
SELECT CAST((SELECT max(venue_key) FROM t) + row_number() OVER (ORDER BY venue_id) AS INTEGER), venue_id, name,
  city, address, surface, image, capacity, DATE '2024-02-01', DATE '9999-12-31', true
FROM s WHERE venue_id NOT IN (SELECT venue_id FROM t) OR venue_id IN (SELECT venue_id FROM chg)"""

# ---------------------------------------------------------------------------
# aggregates, scalars, data quality
# ---------------------------------------------------------------------------

ORACLE["agg_filtered_count"] = """
SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (WHERE l_quantity > 25) AS big_qty,
  count(*) FILTER (WHERE l_discount = 0) AS no_discount
FROM lineitem GROUP BY l_returnflag, l_linestatus"""

ORACLE["agg_sum_case"] = """
SELECT o_orderpriority,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 3 WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS points
FROM orders GROUP BY o_orderpriority"""

ORACLE["agg_exact_avg"] = f"""
SELECT l_returnflag, l_linestatus,
  {half_up('sum(l_linenumber)', 'count(l_linenumber)', 4)} AS avg_line,
  {half_up('sum(CASE WHEN l_quantity <= 40 THEN l_linenumber END)',
           'count(CASE WHEN l_quantity <= 40 THEN l_linenumber END)', 4)} AS avg_line_small
FROM lineitem GROUP BY l_returnflag, l_linestatus"""

ORACLE["agg_bool_pct"] = f"""
SELECT o_orderpriority, count(*) AS n,
  {half_up("100 * count(*) FILTER (WHERE o_orderstatus = 'F')", 'count(*)', 5)} AS pct_finished
FROM orders GROUP BY o_orderpriority"""

ORACLE["scalar_casts"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CAST(CAST(event_id AS VARCHAR) AS BIGINT) AS event_id_text, value > 10 AS big_value,
  CAST(ts AS DATE) AS event_date,
  CAST(date_trunc('second', ts) + INTERVAL 5 HOUR AS DATE) AS kick_utc_date,
  strftime(date_trunc('second', ts) + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS kick_utc
FROM events"""

ORACLE["scalar_rounding"] = """
SELECT o_orderkey,
  CAST(CAST(((o_orderkey % 1000) * 200 + 8) // 16 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(8,2)) AS eighths,
  CAST(CAST((o_custkey * 200 + 40) // 80 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS fortieths,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE
    CAST(CAST(((o_orderkey % 100) * 200 + o_orderkey % 3) // (2 * (o_orderkey % 3)) AS DECIMAL(18,0)) * 0.01
         AS DECIMAL(8,2)) END AS guarded
FROM orders"""

ORACLE["scalar_null_logic"] = f"""WITH {MATCHES}
SELECT CAST(fixture_id AS INTEGER) AS fixture_id,
  CAST(coalesce(goals_home, 0) + coalesce(goals_away, 0) AS INTEGER) AS goals_total,
  CAST(CASE WHEN goals_home > goals_away THEN 1 WHEN goals_home < goals_away THEN -1
            WHEN goals_home = goals_away THEN 0 END AS SMALLINT) AS result,
  CAST(-(CASE WHEN goals_home > goals_away THEN 1 WHEN goals_home < goals_away THEN -1
              WHEN goals_home = goals_away THEN 0 END) AS SMALLINT) AS neg_result,
  nullif(goals_home, 0) AS nz_home, coalesce(venue_id, -1) AS venue_or_default
FROM matches"""

ORACLE["dq_unique"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLE["dq_not_null"] = f"""WITH {MATCHES}, c AS (
  SELECT 'fixture_id' AS column_name, count(*) FILTER (WHERE fixture_id IS NULL) AS null_count FROM matches
  UNION ALL SELECT 'league_id', count(*) FILTER (WHERE league_id IS NULL) FROM matches
  UNION ALL SELECT 'season', count(*) FILTER (WHERE season IS NULL) FROM matches
  UNION ALL SELECT 'kickoff', count(*) FILTER (WHERE kickoff IS NULL) FROM matches
  UNION ALL SELECT 'venue_id', count(*) FILTER (WHERE venue_id IS NULL) FROM matches
  UNION ALL SELECT 'goals_home', count(*) FILTER (WHERE goals_home IS NULL) FROM matches
  UNION ALL SELECT 'goals_away', count(*) FILTER (WHERE goals_away IS NULL) FROM matches)
SELECT * FROM c WHERE null_count > 0"""

ORACLE["dq_fk_orphans"] = f"""WITH {GOLD}
SELECT CAST(m.fixture_id AS INTEGER) AS fixture_id, m.venue_id FROM matches m
WHERE m.venue_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_venue v WHERE v.venue_id = m.venue_id AND v.is_current)"""

ORACLE["dq_one_current"] = """
SELECT c_custkey, CAST(2 AS BIGINT) AS n FROM customer WHERE c_nationkey = 5"""

ORACLE["fact_rejects"] = f"""WITH {MATCHES}
SELECT CAST(fixture_id AS INTEGER) AS fixture_id, 'date' AS failed_lookup FROM matches
WHERE year(kickoff) = (SELECT min(year(o_orderdate)) FROM orders)
UNION ALL
SELECT CAST(fixture_id AS INTEGER), 'home_team' FROM matches WHERE home_team_id % 6 = 5"""

# Matches and table rows of teams that are no customer are dropped.
ORACLE["end_to_end"] = """
WITH m AS (
  SELECT o_orderkey AS k, o_custkey % 5 AS league, o_custkey % 25 AS home, (o_custkey + 1 + o_orderkey % 24) % 25 AS away,
    o_orderdate AS day, year(o_orderdate - INTERVAL 7 MONTH) AS season, o_orderstatus <> 'P' AS played,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey % 25 END AS ground, o_orderkey % 5 AS scored, o_orderkey // 5 % 4 AS let_in
  FROM orders),
teams AS (SELECT c_custkey AS id FROM customer),
f AS (SELECT * FROM m WHERE home IN (SELECT id FROM teams) AND away IN (SELECT id FROM teams)),
p AS (SELECT * FROM f WHERE played),
venues AS (SELECT DISTINCT c_nationkey AS id FROM customer WHERE c_custkey % 10 <> 0),
sides AS (
  SELECT league, season, home AS team, scored - let_in AS lead FROM p UNION ALL SELECT league, season, away, let_in - scored FROM p),
tables AS (
  SELECT DISTINCT ON (league, season, home) home AS team, season FROM m WHERE home IN (SELECT id FROM teams)),
at_home AS (SELECT ground, season, scored FROM p WHERE ground IN (SELECT id FROM venues))
SELECT 'dim_date' AS table_name, count(*) AS n, sum(strftime(d, '%Y%m%d')::BIGINT)::BIGINT AS total
  FROM generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2005-12-31', INTERVAL 1 DAY) g(d)
UNION ALL SELECT 'dim_league', count(*), sum(id)::BIGINT FROM (SELECT DISTINCT o_orderkey // 8 AS id FROM orders)
UNION ALL SELECT 'dim_team', count(*), sum(c_custkey)::BIGINT FROM customer
UNION ALL SELECT 'dim_venue', count(*), sum(id)::BIGINT FROM venues
UNION ALL SELECT 'fact_fixture', count(*), sum(CASE WHEN played THEN scored + let_in ELSE 0 END)::BIGINT FROM f
UNION ALL SELECT 'fact_standing', count(*), sum((team + season) % 15 * 3 + team * 3 % 7)::BIGINT FROM tables
UNION ALL SELECT 'agg_team_season', (SELECT count(*) FROM (SELECT DISTINCT league, team, season FROM sides)),
  (SELECT sum(CASE WHEN lead > 0 THEN 3 WHEN lead = 0 THEN 1 ELSE 0 END)::BIGINT FROM sides)
UNION ALL SELECT 'agg_league_month', (SELECT count(*) FROM (SELECT DISTINCT league, season, year(day), month(day) FROM p)),
  (SELECT sum(scored + let_in)::BIGINT FROM p)
UNION ALL SELECT 'agg_venue_home', (SELECT count(*) FROM (SELECT DISTINCT ground, season FROM at_home)),
  (SELECT sum(scored)::BIGINT FROM at_home)"""
