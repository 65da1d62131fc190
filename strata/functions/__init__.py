"""Column-level building blocks (no Python UDFs: all JVM-side expressions)."""

from strata.functions.exprs import (
    bool_pct, coalesce0_sum, exact_avg, exact_ratio, iso_day_of_week,
    neg, result_sign, row_is_distinct, safe_ratio, season_year,
)
from strata.functions.jsonpath import leaf_schema, parse_payload, project_spec

__all__ = [
    "bool_pct", "coalesce0_sum", "exact_avg", "exact_ratio", "iso_day_of_week",
    "neg", "result_sign", "row_is_distinct", "safe_ratio", "season_year",
    "leaf_schema", "parse_payload", "project_spec",
]
