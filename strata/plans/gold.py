"""Gold layer: dimension sources from silver and the per-table builders in
dependency order (dims -> facts -> marts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import latest_by

TEAM_TRACKED = ["name", "code", "country", "founded", "national", "logo_url"]
VENUE_TRACKED = ["name", "city", "address", "surface", "image", "capacity"]
LEAGUE_ATTRS = ["name", "type", "country_name", "country_code", "logo_url"]


def league_source(silver_leagues: DataFrame) -> DataFrame:
    """PROJ-7: silver.leagues renamed to the dimension's columns."""
    return silver_leagues.select(
        F.col("league_id").cast("int").alias("league_id"), F.col("league_name").alias("name"),
        "type", "country_name", "country_code", F.col("logo").alias("logo_url"))


def team_source(silver_teams: DataFrame) -> DataFrame:
    return silver_teams.select("team_id", *TEAM_TRACKED)


def venue_source(silver_venues: DataFrame) -> DataFrame:
    """PIPE-10: silver venues are keyed by (team, venue); the dimension by
    venue. Latest row per venue first (tie: lowest team id)."""
    latest = latest_by(silver_venues, ["venue_id"],
                       [F.col("loaded_at").desc_nulls_first(), F.col("team_id").asc()])
    return latest.select("venue_id", F.col("venue_name").alias("name"), "city", "address",
                         "surface", "image", "capacity")


def fixture_source(silver_fixtures: DataFrame) -> DataFrame:
    return silver_fixtures.select("fixture_id", "league_id", "season", "kickoff", "status_short",
                                  "home_team_id", "away_team_id", "venue_id", "goals_home",
                                  "goals_away")
