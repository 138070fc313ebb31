"""Generations of the reading's schema beside the tables they were written to.

A stream picks the newest generation when it starts. A generation may add
fields at the end; it never drops one or changes its type, so that files of all
generations are one table (older ones have NULL in the new fields) and the
streams go on from the same checkpoints.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from meterlake.schemas import READING_SCHEMA
from meterlake.sinks.manifest import Manifest


class SchemaChange(ValueError):
    """A field is missing from, or has another type in, what a start asks for."""


class SchemaGenerations:
    def __init__(self, spark: SparkSession, base: str):
        self.log = Manifest(spark, f"{base.rstrip('/')}/_schemas")

    def current(self) -> T.StructType:
        state = self.log.current()[1]
        return T.StructType.fromJson(json.loads(state["schema"])) if state else READING_SCHEMA

    def at_start(self, wanted: T.StructType | None) -> T.StructType:
        """The schema to read with: the newest one, with the fields that
        ``wanted`` adds, which become a new generation.

        A start that asks for an older generation still reads with the newest."""
        known = self.current()
        if wanted is None:
            return known
        merged = evolved(known, wanted)
        if merged != known:
            self.log.update(lambda state: {"schema": evolved(self.current(), wanted).json()})
            return self.current()
        return known


def evolved(known: T.StructType, wanted: T.StructType) -> T.StructType:
    """``known`` and the new fields of ``wanted``, nullable, after its own."""
    types = {f.name: f.dataType for f in known.fields}
    for f in wanted.fields:
        if f.name in types and types[f.name] != f.dataType:
            raise SchemaChange(f"{f.name} is {types[f.name].simpleString()} in the tables, not {f.dataType.simpleString()}")
    missing = [f.name for f in READING_SCHEMA.fields if f.name not in wanted.fieldNames()]
    if missing:
        raise SchemaChange(f"a reading has the field(s) {', '.join(missing)} in every generation")
    return T.StructType([*known.fields, *(T.StructField(f.name, f.dataType) for f in wanted.fields if f.name not in types)])
