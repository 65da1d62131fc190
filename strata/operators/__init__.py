"""Relational operators of the medallion model; each returns a DataFrame."""

from strata.operators.dedup import latest_by, latest_first
from strata.operators.dims import build_dim_date, scd1, scd2_apply, scd2_expire, scd2_insert
from strata.operators.dq import (assert_clean, dq_fk_orphans, dq_not_null, dq_one_current,
                                 dq_unique, DataQualityError)
from strata.operators.facts import fact_match, fact_snapshot, fixture_rejects, upsert_fact
from strata.operators.keys import assign_keys, date_key, next_key_start
from strata.operators.lookup import Lookup, broadcast_if_small, lookup_keys, rejected_rows
from strata.operators.marts import (latest_snapshot, mart_league_month, mart_team_season,
                                    mart_venue_home, team_match_rows, team_season_agg, unpivot_sides)
from strata.operators.merge import insert_absent, merge_upsert, update_from

__all__ = [n for n in dir() if not n.startswith("_")]
