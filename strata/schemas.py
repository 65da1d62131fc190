"""Table registry (SINK-10): fixed schemas of the silver and gold tables,
their keys and their not-null columns, used for first-run bootstrap (an empty
DataFrame with the right schema) and by the data-quality gate."""

from __future__ import annotations

from pyspark.sql import types as T

from strata.sources.bronze import BRONZE_TABLES, bronze_schema


def _st(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(ddl)


SILVER = {
    "teams": ("team_id INT, name STRING, code STRING, country STRING, founded INT, national BOOLEAN, "
              "logo_url STRING, loaded_at TIMESTAMP", ["team_id"]),
    "venues": ("team_id INT, venue_id INT, venue_name STRING, city STRING, address STRING, "
               "surface STRING, image STRING, capacity BIGINT, loaded_at TIMESTAMP",
               ["team_id", "venue_id"]),
    "leagues": ("league_id BIGINT, league_name STRING, type STRING, country_name STRING, "
                "country_code STRING, logo STRING, flag STRING, loaded_at TIMESTAMP", ["league_id"]),
    "seasons": ("league_id INT, year STRING, start_date DATE, end_date DATE, current BOOLEAN, "
                "odds BOOLEAN, players BOOLEAN, events BOOLEAN, lineups BOOLEAN, "
                "statistics_players BOOLEAN, statistics_fixtures BOOLEAN, injuries BOOLEAN, "
                "standings BOOLEAN, top_cards BOOLEAN, predictions BOOLEAN, top_assists BOOLEAN, "
                "top_scorers BOOLEAN, loaded_at TIMESTAMP", ["league_id", "year"]),
    "fixtures": ("fixture_id INT, league_id INT, season INT, round STRING, kickoff TIMESTAMP, "
                 "status_short STRING, status_long STRING, status_elapsed INT, referee STRING, "
                 "venue_id INT, venue_name STRING, venue_city STRING, home_team_id INT, "
                 "home_team_name STRING, away_team_id INT, away_team_name STRING, "
                 "home_winner BOOLEAN, away_winner BOOLEAN, goals_home INT, goals_away INT, "
                 "ht_home INT, ht_away INT, ft_home INT, ft_away INT, et_home INT, et_away INT, "
                 "pen_home INT, pen_away INT, loaded_at TIMESTAMP", ["fixture_id"]),
    "standings": ("league_id INT, season INT, team_id INT, team_name STRING, rank INT, points INT, "
                  "goals_diff INT, group_name STRING, form STRING, played INT, win INT, draw INT, "
                  "lose INT, goals_for INT, goals_against INT, updated_at TIMESTAMP, "
                  "loaded_at TIMESTAMP", ["league_id", "season", "team_id"]),
}

GOLD = {
    "dim_date": ("date_key INT, full_date DATE, year INT, quarter INT, month INT, month_name STRING, "
                 "day INT, day_of_week INT, day_name STRING, week INT, is_weekend BOOLEAN, "
                 "season_year INT", ["date_key"]),
    "dim_league": ("league_key INT, league_id INT, name STRING, type STRING, country_name STRING, "
                   "country_code STRING, logo_url STRING", ["league_key"]),
    "dim_team": ("team_key INT, team_id INT, name STRING, code STRING, country STRING, founded INT, "
                 "national BOOLEAN, logo_url STRING, valid_from DATE, valid_to DATE, "
                 "is_current BOOLEAN", ["team_key"]),
    "dim_venue": ("venue_key INT, venue_id INT, name STRING, city STRING, address STRING, "
                  "surface STRING, image STRING, capacity BIGINT, valid_from DATE, valid_to DATE, "
                  "is_current BOOLEAN", ["venue_key"]),
    "fact_fixture": ("fixture_id INT, date_key INT, league_key INT, home_team_key INT, "
                     "away_team_key INT, venue_key INT, season INT, status_short STRING, "
                     "goals_home INT, goals_away INT, goals_total INT, result SMALLINT",
                     ["fixture_id"]),
    "fact_standing": ("standing_key INT, snapshot_date_key INT, league_key INT, team_key INT, "
                      "season INT, rank INT, points INT, played INT, won SMALLINT, draw SMALLINT, "
                      "lost SMALLINT, goals_for INT, goals_against INT, goal_diff INT",
                      ["standing_key"]),
    "agg_team_season": ("league_key INT, team_key INT, season INT, played INT, won INT, draw INT, "
                        "lost INT, goals_for INT, goals_against INT, goal_diff INT, points INT, "
                        "points_per_game DECIMAL(4,2), clean_sheets INT, final_rank INT",
                        ["league_key", "team_key", "season"]),
    "agg_league_month": ("league_key INT, season INT, year INT, month INT, month_name STRING, "
                         "matches INT, total_goals INT, goals_per_match DECIMAL(4,2), "
                         "home_win_pct DECIMAL(5,2), draw_pct DECIMAL(5,2), "
                         "away_win_pct DECIMAL(5,2)", ["league_key", "season", "year", "month"]),
    "agg_venue_home": ("venue_key INT, season INT, home_matches INT, home_goals INT, "
                       "home_goals_per_match DECIMAL(4,2), home_wins INT, "
                       "home_win_pct DECIMAL(5,2)", ["venue_key", "season"]),
}

# Season-grained tables are written partitioned by season, so readers that
# filter on a season prune whole directories.
PARTITION_BY = {
    ("silver", "fixtures"): ["season"],
    ("silver", "standings"): ["season"],
    ("gold", "fact_fixture"): ["season"],
    ("gold", "fact_standing"): ["season"],
}

# Not-null columns beyond the keys (reference DDL), checked before publish.
NOT_NULL = {
    "dim_date": GOLD["dim_date"][0],
    "dim_league": ["league_key", "league_id", "name", "type", "country_name", "country_code",
                   "logo_url"],
    "dim_team": ["team_key", "team_id", "name", "national", "valid_from", "valid_to", "is_current"],
    "dim_venue": ["venue_key", "venue_id", "valid_from", "valid_to", "is_current"],
    "fact_fixture": ["fixture_id", "date_key", "league_key", "home_team_key", "away_team_key"],
    "fact_standing": ["standing_key", "snapshot_date_key", "league_key", "team_key", "season"],
    "agg_team_season": ["league_key", "team_key", "season"],
    "agg_league_month": ["league_key", "season", "year", "month"],
    "agg_venue_home": ["venue_key", "season"],
}

# Unique keys beyond the primary key.
UNIQUE = {
    "dim_date": [["full_date"]],
    "dim_league": [["league_id"]],
    "fact_standing": [["snapshot_date_key", "league_key", "season", "team_key"]],
}

# Foreign keys: (fact columns, dimension table, dimension columns).
FOREIGN_KEYS = {
    "fact_fixture": [(["date_key"], "dim_date", ["date_key"]),
                     (["league_key"], "dim_league", ["league_key"]),
                     (["home_team_key"], "dim_team", ["team_key"]),
                     (["away_team_key"], "dim_team", ["team_key"]),
                     (["venue_key"], "dim_venue", ["venue_key"])],
    "fact_standing": [(["snapshot_date_key"], "dim_date", ["date_key"]),
                      (["league_key"], "dim_league", ["league_key"]),
                      (["team_key"], "dim_team", ["team_key"])],
    "agg_team_season": [(["league_key"], "dim_league", ["league_key"]),
                        (["team_key"], "dim_team", ["team_key"])],
    "agg_league_month": [(["league_key"], "dim_league", ["league_key"])],
    "agg_venue_home": [(["venue_key"], "dim_venue", ["venue_key"])],
}


def empty_frame(spark, schema: T.StructType):
    """An empty DataFrame the optimizer can see is empty (``WHERE false`` on a
    one-row relation), so joins against a first-run target are pruned away
    instead of shuffling the other side."""
    from pyspark.sql import functions as F
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                   for f in schema.fields]).where(F.lit(False))


def schema_of(layer: str, table: str) -> T.StructType:
    if layer == "bronze":
        if table not in BRONZE_TABLES:
            raise KeyError(table)
        return bronze_schema()
    ddl = (SILVER if layer == "silver" else GOLD)[table][0]
    return _st(ddl)


def keys_of(layer: str, table: str) -> list:
    if layer == "bronze":
        return ["id"]
    return (SILVER if layer == "silver" else GOLD)[table][1]


def not_null_of(table: str) -> list:
    v = NOT_NULL.get(table, [])
    if isinstance(v, str):
        return [f.name for f in _st(v).fields]
    return v
