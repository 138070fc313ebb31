"""Outputs: warehouse load table and published messages."""

from meterlake.sinks.publish import publish_messages
from meterlake.sinks.warehouse import LoadResult, load_silver, normalise_columns

__all__ = ["LoadResult", "load_silver", "normalise_columns", "publish_messages"]
