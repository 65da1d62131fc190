"""Sources and sinks: API envelope files, bronze landing, driver tables."""

from strata.sources.bronze import BRONZE_TABLES, bronze_schema, land_bronze
from strata.sources.envelope import (ENVELOPE_SCHEMA, explode_response, gate_errors,
                                     parse_envelopes, read_envelopes)
from strata.sources.tables import read_table

__all__ = ["BRONZE_TABLES", "bronze_schema", "land_bronze", "ENVELOPE_SCHEMA", "explode_response",
           "gate_errors", "parse_envelopes", "read_envelopes", "read_table"]
