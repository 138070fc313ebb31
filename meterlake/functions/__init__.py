"""Column-level building blocks (JVM-side expressions only, no UDFs)."""

from meterlake.functions.calendar import (
    day_name,
    day_of_week,
    truncate_like,
)
from meterlake.functions.keys import surrogate_key
from meterlake.functions.text import iso_utc_text
from meterlake.functions.validation import rule_columns, valid_reading
from meterlake.functions.zones import federal_state, zone_name

__all__ = [
    "day_name",
    "day_of_week",
    "federal_state",
    "iso_utc_text",
    "rule_columns",
    "surrogate_key",
    "truncate_like",
    "valid_reading",
    "zone_name",
]
