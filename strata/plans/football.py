"""The football model: JSON paths, keys and update lists of each silver
entity (PIPE-1..6) and the silver projections built on them.

Every silver entity is ``bronze -> parse once -> [unnest] -> [filter] ->
cast -> latest per key -> merge into the silver target``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.jsonpath import leaf_schema, parse_payload, path_col, project_spec
from strata.operators.dedup import latest_by
from strata.operators.merge import merge_upsert

# ---------------------------------------------------------------------------
# The document paths the reference reads, with the cast applied
# after the text access (None = text). Output name, path, type.
# ---------------------------------------------------------------------------
FIXTURE_SPEC = [
    ("fixture_id", ("fixture", "id"), "int"),
    ("league_id", ("league", "id"), "int"),
    ("season", ("league", "season"), "int"),
    ("round", ("league", "round"), None),
    ("kickoff", ("fixture", "date"), "timestamp"),
    ("status_short", ("fixture", "status", "short"), None),
    ("status_long", ("fixture", "status", "long"), None),
    ("status_elapsed", ("fixture", "status", "elapsed"), "int"),
    ("referee", ("fixture", "referee"), None),
    ("venue_id", ("fixture", "venue", "id"), "int"),
    ("venue_name", ("fixture", "venue", "name"), None),
    ("venue_city", ("fixture", "venue", "city"), None),
    ("home_team_id", ("teams", "home", "id"), "int"),
    ("home_team_name", ("teams", "home", "name"), None),
    ("away_team_id", ("teams", "away", "id"), "int"),
    ("away_team_name", ("teams", "away", "name"), None),
    ("home_winner", ("teams", "home", "winner"), "boolean"),
    ("away_winner", ("teams", "away", "winner"), "boolean"),
    ("goals_home", ("goals", "home"), "int"),
    ("goals_away", ("goals", "away"), "int"),
    ("ht_home", ("score", "halftime", "home"), "int"),
    ("ht_away", ("score", "halftime", "away"), "int"),
    ("ft_home", ("score", "fulltime", "home"), "int"),
    ("ft_away", ("score", "fulltime", "away"), "int"),
    ("et_home", ("score", "extratime", "home"), "int"),
    ("et_away", ("score", "extratime", "away"), "int"),
    ("pen_home", ("score", "penalty", "home"), "int"),
    ("pen_away", ("score", "penalty", "away"), "int"),
]

LEAGUE_SPEC = [
    ("league_id", ("league", "id"), "bigint"),
    ("league_name", ("league", "name"), None),
    ("type", ("league", "type"), None),
    ("country_name", ("country", "name"), None),
    ("country_code", ("country", "code"), None),
    ("logo", ("league", "logo"), None),
    ("flag", ("country", "flag"), None),
]

# Paths inside one element of ``seasons[]``. ``players`` is read from
# ``players.odds`` (not ``coverage.players``), exactly as the reference does (Q4).
SEASON_ELEMENT_SPEC = [
    ("year", ("year",), None),
    ("start_date", ("start",), "date"),
    ("end_date", ("end",), "date"),
    ("current", ("current",), "boolean"),
    ("odds", ("coverage", "odds"), "boolean"),
    ("players", ("players", "odds"), "boolean"),
    ("events", ("coverage", "fixtures", "events"), "boolean"),
    ("lineups", ("coverage", "fixtures", "lineups"), "boolean"),
    ("statistics_players", ("coverage", "fixtures", "statistics_players"), "boolean"),
    ("statistics_fixtures", ("coverage", "fixtures", "statistics_fixtures"), "boolean"),
    ("injuries", ("coverage", "injuries"), "boolean"),
    ("standings", ("coverage", "standings"), "boolean"),
    ("top_cards", ("coverage", "top_cards"), "boolean"),
    ("predictions", ("coverage", "predictions"), "boolean"),
    ("top_assists", ("coverage", "top_assists"), "boolean"),
    ("top_scorers", ("coverage", "top_scorers"), "boolean"),
]
SEASONS_PATH = ("seasons",)

# Paths inside one team row of ``league.standings[][]``.
STANDING_ROW_SPEC = [
    ("team_id", ("team", "id"), "int"),
    ("team_name", ("team", "name"), None),
    ("rank", ("rank",), "int"),
    ("points", ("points",), "int"),
    ("goals_diff", ("goalsDiff",), "int"),
    ("group_name", ("group",), None),
    ("form", ("form",), None),
    ("played", ("all", "played"), "int"),
    ("win", ("all", "win"), "int"),
    ("draw", ("all", "draw"), "int"),
    ("lose", ("all", "lose"), "int"),
    ("goals_for", ("all", "goals", "for"), "int"),
    ("goals_against", ("all", "goals", "against"), "int"),
    ("updated_at", ("update",), "timestamp"),
]
STANDING_PARENT_SPEC = [("league_id", ("league", "id"), "int"),
                        ("season", ("league", "season"), "int")]
STANDINGS_PATH = ("league", "standings")

TEAM_SPEC = [
    ("team_id", ("team", "id"), "int"),
    ("name", ("team", "name"), None),
    ("code", ("team", "code"), None),
    ("country", ("team", "country"), None),
    ("founded", ("team", "founded"), "int"),
    ("national", ("team", "national"), "boolean"),
    ("logo_url", ("team", "logo"), None),
]

VENUE_SPEC = [
    ("team_id", ("team", "id"), "int"),
    ("venue_id", ("venue", "id"), "int"),
    ("city", ("venue", "city"), None),
    ("venue_name", ("venue", "name"), None),
    ("image", ("venue", "image"), None),
    ("address", ("venue", "address"), None),
    ("surface", ("venue", "surface"), None),
    ("capacity", ("venue", "capacity"), "bigint"),
]

# Business keys and the columns a re-sent record may not change.
SILVER_KEYS = {
    "fixtures": ["fixture_id"],
    "leagues": ["league_id"],
    "seasons": ["league_id", "year"],
    "standings": ["league_id", "season", "team_id"],
    "teams": ["team_id"],
    "venues": ["team_id", "venue_id"],
}
NOT_UPDATED = {"standings": ["team_name"]}   # inserted, never updated (Q5)
SILVER_SOURCE = {"fixtures": "fixtures", "leagues": "leagues", "seasons": "leagues",
                 "standings": "standings", "teams": "teams", "venues": "teams"}

# Tie-break after ``loaded_at DESC`` (Q6, Q13): newest bronze row, then the
# first array position.
META = ["loaded_at", "id"]


def _spec_schema(spec, arrays=None):
    return leaf_schema([p for _, p, _ in spec], arrays)


def project_fixtures(bronze: DataFrame) -> DataFrame:
    doc = parse_payload("payload", _spec_schema(FIXTURE_SPEC))
    return bronze.select(*META, doc.alias("_d")).select(*project_spec(F.col("_d"), FIXTURE_SPEC), *META)


def _elements(text, what: str):
    """The elements of a JSON array given as text, each as text. A missing or null
    array has none; anything but an array fails the layer, as unnesting it does in
    the reference."""
    return F.when(text.isNull(), F.lit(None)).when(
        F.ltrim(text).startswith("["), F.from_json(text, "array<string>")).otherwise(
        F.raise_error(F.concat(F.lit(f"{what} is not an array: "), F.substring(text, 1, 80))))


def _object(text, schema, what: str):
    """One array element as a struct; an element that is no object fails the layer."""
    return F.when(F.ltrim(F.coalesce(text, F.lit(""))).startswith("{"), F.from_json(text, schema)).otherwise(
        F.raise_error(F.concat(F.lit(f"an element of {what} is not an object: "), F.coalesce(F.substring(text, 1, 80), F.lit("null")))))


def fan_out_leagues(bronze: DataFrame) -> DataFrame:
    """SRC-5, JOIN-9: league documents parsed once, ``seasons[]`` unnested: a row of entity
    ``leagues`` per document and one of entity ``seasons`` per element. A missing, empty or
    null array has no season rows; the league row is unaffected."""
    schema = leaf_schema([p for _, p, _ in LEAGUE_SPEC] + [SEASONS_PATH])
    doc = F.col("_d")
    parsed = bronze.select(*META, parse_payload("payload", schema).alias("_d"))
    seasons = F.transform(F.coalesce(_elements(path_col(doc, SEASONS_PATH), "seasons"), F.array().cast("array<string>")),
                          lambda t, i: F.struct(F.lit("seasons").alias("entity"), i.alias("pos"), t.alias("_t")))
    own = F.array(F.struct(F.lit("leagues").alias("entity"), F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("_t")))
    rows = parsed.select(*META, *project_spec(doc, LEAGUE_SPEC), F.explode(F.concat(own, seasons)).alias("_x"))
    element = F.when(F.col("_x.entity") == "seasons", _object(F.col("_x._t"), _spec_schema(SEASON_ELEMENT_SPEC), "seasons"))
    rows = rows.select("*", "_x.entity", "_x.pos", element.alias("_e"))
    return rows.select("entity", *META, "pos", *[n for n, _, _ in LEAGUE_SPEC], *project_spec(F.col("_e"), SEASON_ELEMENT_SPEC))


def fan_out_teams(bronze: DataFrame) -> DataFrame:
    """SRC-5, FILT-1: team documents parsed once: a row of entity ``teams`` per document and,
    if its ``venue.id`` is present (tested on the text, before the cast), one of entity ``venues``."""
    schema = leaf_schema([p for _, p, _ in TEAM_SPEC + VENUE_SPEC])
    parsed = bronze.select(*META, parse_payload("payload", schema).alias("_d"))
    entities = F.when(F.col("_d.venue.id").isNotNull(), F.array(F.lit("teams"), F.lit("venues"))).otherwise(F.array(F.lit("teams")))
    rows = parsed.select(F.explode(entities).alias("entity"), *META, "_d")
    # the columns of an entity are read in its own rows only
    own = lambda entity, spec: [F.when(F.col("entity") == entity, c).alias(n) for c, (n, _, _) in zip(
        project_spec(F.col("_d"), spec), spec) if n != "team_id"]
    return rows.select("entity", *META, *project_spec(F.col("_d"), TEAM_SPEC[:1]), *own("teams", TEAM_SPEC), *own("venues", VENUE_SPEC))


#: Bronze tables whose documents feed two silver tables.
FAN_OUT = {"leagues": fan_out_leagues, "teams": fan_out_teams}


def _entity(bronze: DataFrame, source: str, entity: str, names: list, parsed: DataFrame | None) -> DataFrame:
    rows = parsed if parsed is not None else FAN_OUT[source](bronze)
    return rows.filter(F.col("entity") == entity).select(*names, *META)


def project_leagues(bronze: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    return _entity(bronze, "leagues", "leagues", [n for n, _, _ in LEAGUE_SPEC], parsed)


def project_seasons(bronze: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    names = [F.col("league_id").cast("int").alias("league_id"), *[n for n, _, _ in SEASON_ELEMENT_SPEC]]
    rows = parsed if parsed is not None else fan_out_leagues(bronze)
    return rows.filter(F.col("entity") == "seasons").select(*names, *META, "pos")


def project_standings(bronze: DataFrame) -> DataFrame:
    """JOIN-10: two chained unnests of ``league.standings[][]`` (group, then
    team row). An empty or null group drops only itself."""
    schema = leaf_schema([p for _, p, _ in STANDING_PARENT_SPEC] + [STANDINGS_PATH])
    parsed = bronze.select(*META, parse_payload("payload", schema).alias("_d"))
    groups = parsed.select(*META, *project_spec(F.col("_d"), STANDING_PARENT_SPEC), F.posexplode(
        _elements(path_col(F.col("_d"), STANDINGS_PATH), "standings")).alias("group_pos", "_g"))
    rows = groups.select(*META, "league_id", "season", "group_pos",
                         F.posexplode(_elements(F.col("_g"), "a standings group")).alias("row_pos", "_t"))
    rows = rows.withColumn("_r", _object(F.col("_t"), _spec_schema(STANDING_ROW_SPEC), "a standings group"))
    return rows.select("league_id", "season", *project_spec(F.col("_r"), STANDING_ROW_SPEC),
                       *META, "group_pos", "row_pos")


def project_teams(bronze: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    return _entity(bronze, "teams", "teams", [n for n, _, _ in TEAM_SPEC], parsed)


def project_venues(bronze: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    return _entity(bronze, "teams", "venues", [n for n, _, _ in VENUE_SPEC], parsed)


PROJECTORS = {
    "fixtures": (project_fixtures, []),
    "leagues": (project_leagues, []),
    "seasons": (project_seasons, ["pos"]),
    "standings": (project_standings, ["group_pos", "row_pos"]),
    "teams": (project_teams, []),
    "venues": (project_venues, []),
}


def silver_source(bronze: DataFrame, entity: str, parsed: DataFrame | None = None) -> DataFrame:
    """Typed, deduplicated source of one silver MERGE: the latest record per
    business key (``DISTINCT ON (keys) ORDER BY keys, loaded_at DESC``). ``parsed`` are the
    rows of ``FAN_OUT`` for the entity's documents, if they have been written for both merges."""
    fn, positions = PROJECTORS[entity]
    rows = fn(bronze) if parsed is None else fn(bronze, parsed)
    order = [F.col("loaded_at").desc_nulls_first(), F.col("id").desc_nulls_first(),
             *[F.col(p).asc() for p in positions]]
    return latest_by(rows, SILVER_KEYS[entity], order).drop("id", *positions)


def merge_silver(target: DataFrame, bronze: DataFrame, entity: str, parsed: DataFrame | None = None) -> DataFrame:
    """PIPE-1..6: the silver table after ``MERGE INTO target USING source``.
    A record older than the one merged before does not update it: with all of
    bronze as the source that never happens, and loads merged one by one in any
    order give the same table."""
    src = silver_source(bronze, entity, parsed).select(*target.columns)
    keys = SILVER_KEYS[entity]
    frozen = NOT_UPDATED.get(entity, [])
    upd = [c for c in target.columns if c not in keys and c not in frozen]
    return merge_upsert(target, src, keys, update_cols=upd, insert_cols=list(target.columns),
                        not_older_by="loaded_at")
