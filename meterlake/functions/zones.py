"""Grid-zone lookups (searched CASE without ELSE: unknown zone -> NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.schemas import ZONE_NAMES, ZONE_STATES


def _lookup(col: Column, mapping: dict[str, str]) -> Column:
    out = None
    for key, value in mapping.items():
        out = F.when(col == key, value) if out is None else out.when(col == key, value)
    return out


def zone_name(col: Column | str = "grid_zone") -> Column:
    return _lookup(F.col(col) if isinstance(col, str) else col, ZONE_NAMES)


def federal_state(col: Column | str = "grid_zone") -> Column:
    return _lookup(F.col(col) if isinstance(col, str) else col, ZONE_STATES)


def zones_in_state(state: str) -> list[str]:
    """The zones the fixed mapping puts in ``state`` (a bounded list)."""
    return [z for z, s in ZONE_STATES.items() if s == state]
