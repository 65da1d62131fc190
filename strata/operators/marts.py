"""Full-refresh KPI marts (PIPE-13..15) and their building blocks.

* ``unpivot_sides`` (SET-1): one scan of the fact, ``explode(array(struct,
  struct))`` gives the UNION ALL of the home and away views.
* ``latest_snapshot`` (JOIN-11): the lateral ``ORDER BY .. DESC LIMIT 1`` per
  key is ``max_by(value, order)`` in a grouped aggregate, which combines
  partially on the map side (a hot team-season never lands in one task).
* Marts aggregate first and join on the *same* keys afterwards (JOIN-13), so
  the drill-across join reuses the aggregation's hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.exprs import bool_pct, exact_avg, neg, safe_ratio
from strata.operators.lookup import broadcast_if_small

TEAM_SEASON_KEYS = ["league_key", "team_key", "season"]


def unpivot_sides(df: DataFrame, keep: list, sides: list) -> DataFrame:
    """``sides`` is a list of ``{out name: Column}`` with identical names; one
    output row per input row and side."""
    names = list(sides[0].keys())
    structs = [F.struct(*[side[n].alias(n) for n in names]) for side in sides]
    return df.select(*keep, F.explode(F.array(*structs)).alias("__side")).select(*keep, "__side.*")


def team_match_rows(fact_fixture: DataFrame) -> DataFrame:
    """Played matches (FILT-3) seen once from each side; the away view negates
    the result (PROJ-11)."""
    played = fact_fixture.filter(F.col("result").isNotNull())
    return unpivot_sides(played, ["fixture_id", "league_key", "season"], [
        {"team_key": F.col("home_team_key"), "scored": F.col("goals_home"),
         "conceded": F.col("goals_away"), "outcome": F.col("result")},
        {"team_key": F.col("away_team_key"), "scored": F.col("goals_away"),
         "conceded": F.col("goals_home"), "outcome": neg("result")},
    ])


def latest_snapshot(df: DataFrame, keys: list, order_col: str, value_col: str,
                    out: str | None = None) -> DataFrame:
    """Value at the largest ``order_col`` per key (order unique within a key)."""
    return df.groupBy(*keys).agg(F.max_by(value_col, order_col).alias(out or value_col))


SEASON_SUMS = ["won", "draw", "lost", "goals_for", "goals_against", "points", "clean_sheets"]


def side_measures(fact_fixture: DataFrame) -> DataFrame:
    """What one played match adds to the season of each of its two teams; the points
    stand in a row by outcome (lost, drawn, won)."""
    points = F.array(F.lit(0), F.lit(1), F.lit(3))

    def side(team, own, other, outcome):
        is_ = lambda k: (outcome == k).cast("int")
        return {"team_key": F.col(team), "won": is_(1), "draw": is_(0), "lost": is_(-1),
                "goals_for": F.col(own), "goals_against": F.col(other),
                "points": F.get(points, outcome + 1), "clean_sheets": (F.col(other) == 0).cast("int")}

    home = F.col("result").cast("int")
    return unpivot_sides(fact_fixture.filter(F.col("result").isNotNull()), ["league_key", "season"], [
        side("home_team_key", "goals_home", "goals_away", home),
        side("away_team_key", "goals_away", "goals_home", -home)])


def team_season_agg(fact_fixture: DataFrame) -> DataFrame:
    """AGG-1..5, AGG-9: a team's season as plain sums of its matches' measures."""
    sums = side_measures(fact_fixture).groupBy(*TEAM_SEASON_KEYS).agg(
        F.count("*").cast("int").alias("played"), *[F.sum(c).cast("int").alias(c) for c in SEASON_SUMS])
    return sums.withColumn("goal_diff", F.col("goals_for") - F.col("goals_against"))


def mart_team_season(fact_fixture: DataFrame, fact_standing: DataFrame) -> DataFrame:
    """PIPE-13 ``agg_team_season``. Columns are bound by name, so
    ``points_per_game`` and ``clean_sheets`` are not swapped (Q1)."""
    agg = team_season_agg(fact_fixture)
    final = latest_snapshot(fact_standing, TEAM_SEASON_KEYS, "snapshot_date_key", "rank", "final_rank")
    return agg.join(final, TEAM_SEASON_KEYS, "left").select(
        *TEAM_SEASON_KEYS, "played", "won", "draw", "lost", "goals_for", "goals_against",
        "goal_diff", "points", safe_ratio("points", "played", 4, 2).alias("points_per_game"),
        "clean_sheets", F.col("final_rank").cast("int"))


def mart_league_month(fact_fixture: DataFrame, dim_date: DataFrame,
                      date_rows: int | None = None) -> DataFrame:
    """PIPE-14 ``agg_league_month``: star join to the calendar, then
    aggregate per league, season and calendar month."""
    dd = broadcast_if_small(dim_date.select("date_key", "year", "month", "month_name"),
                            known_rows=date_rows)
    ff = fact_fixture.filter(F.col("result").isNotNull())
    res = F.col("result")
    return ff.join(dd, "date_key").groupBy("league_key", "season", "year", "month", "month_name").agg(
        F.count(F.lit(1)).cast("int").alias("matches"),
        F.sum("goals_total").cast("int").alias("total_goals"),
        exact_avg("goals_total", 4, 2).alias("goals_per_match"),
        bool_pct(res == 1).alias("home_win_pct"),
        bool_pct(res == 0).alias("draw_pct"),
        bool_pct(res == -1).alias("away_win_pct"),
    )


def mart_venue_home(fact_fixture: DataFrame) -> DataFrame:
    """PIPE-15 ``agg_venue_home``."""
    ff = fact_fixture.filter(F.col("venue_key").isNotNull() & F.col("result").isNotNull())
    return ff.groupBy("venue_key", "season").agg(
        F.count(F.lit(1)).cast("int").alias("home_matches"),
        F.sum("goals_home").cast("int").alias("home_goals"),
        exact_avg("goals_home", 4, 2).alias("home_goals_per_match"),
        F.count_if(F.col("result") == 1).cast("int").alias("home_wins"),
        bool_pct(F.col("result") == 1).alias("home_win_pct"),
    )
