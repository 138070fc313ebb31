"""Inputs: the log envelope, layer tables and the test-table adapter."""

from meterlake.sources.fixtures import load_events, meter_readings
from meterlake.sources.log import (
    envelope_from_messages,
    from_event_hubs,
    read_envelope_files,
    read_log,
)
from meterlake.sources.tables import read_layer, read_parquet_dir, source_table

__all__ = [
    "envelope_from_messages",
    "from_event_hubs",
    "load_events",
    "meter_readings",
    "read_envelope_files",
    "read_layer",
    "read_log",
    "read_parquet_dir",
    "source_table",
]
