"""Bronze, silver and gold from one query that parses the log once.

Every micro-batch is parsed once and held; bronze, silver and the window totals
are written from it, each as a new part, and one commit of the manifest makes
all of them visible. The state records the batch, so a batch that is run again
after a failure counts once, in every layer or in none.

Gold follows append mode: a row is late when its window ended at or before the
watermark that the batches before left; a window is emitted once, when the
watermark reaches its end. Here the open windows are a table as well
(``open_windows``: emitted and open windows together are the batch aggregate),
and late rows aren't lost but set aside (``late``: counted and late rows
together are all valid rows with a time). The open windows are zones x types x
windows within the watermark, whatever the volume: partial aggregates run
before their shuffle.

``compact`` merges the small parts of many batches while the stream goes on.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlake.operators import readings, windows
from meterlake.operators.readings import Clock
from meterlake.schemas import GOLD_WATERMARK, GOLD_WINDOW
from meterlake.sinks import dated
from meterlake.sinks.manifest import Manifest
from meterlake.streaming.generations import SchemaGenerations
from meterlake.streaming.layers import BRONZE_SCHEMA, GOLD_SCHEMA, SILVER_SCHEMA, with_trigger

ZONE = "grid_zone"
_PARTED_BY = {"bronze": ZONE, "silver": ZONE, "late": ZONE, "gold": None}


class OneParse:
    """The layers below ``base``. Clocks, window and watermark as for the chained layers."""

    def __init__(self, spark: SparkSession, base: str, bronze_clock: Clock = None, silver_clock: Clock = None,
                 window: str = GOLD_WINDOW, watermark: str = GOLD_WATERMARK, fan_in: int = dated.FAN_IN):
        self.spark, self.base = spark, base.rstrip("/")
        self.bronze_clock, self.silver_clock = bronze_clock, silver_clock
        self.window, self.watermark, self.fan_in = window, watermark, fan_in
        self.manifest = Manifest(spark, self.base)

    def start(self, envelope: DataFrame, trigger: str | None = "availableNow", schema: T.StructType | None = None) -> StreamingQuery:
        """Start the query on its checkpoint below ``base``; ``schema`` may be a
        later generation of the reading's."""
        reading = SchemaGenerations(self.spark, self.base).at_start(schema)
        bronze = readings.parse_envelope(envelope, self.bronze_clock, schema=reading)
        writer = bronze.writeStream.foreachBatch(self.add_batch).option("checkpointLocation", f"{self.base}/_checkpoints/one_parse")
        return with_trigger(writer, trigger).start()

    # --- one batch -----------------------------------------------------------------------

    def add_batch(self, parsed: DataFrame, batch: int) -> None:
        state = self.manifest.current()[1]
        if batch <= state.get("batch", -1):
            return  # committed before the query could note it
        bronze = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            silver = readings.silver(bronze, self.silver_clock)
            new = {"bronze": dated.write_part(self.manifest, "bronze", bronze, ZONE), "silver": dated.write_part(self.manifest, "silver", silver, ZONE)}
            timed = windows.with_watermark_time(silver).where(F.col("event_timestamp").isNotNull())
            counted, late = windows.split_late(timed, _time(state.get("watermark")), self.window)
            new["late"] = dated.write_part(self.manifest, "late", late, ZONE) if state.get("watermark") else None
            totals = windows.window_totals(counted, self.window)
            if state.get("open"):
                totals = windows.merged_window_totals(totals.unionByName(self._open(state)))
            newest = timed.agg((F.max("event_timestamp") - F.expr(f"INTERVAL {self.watermark}")).cast("string")).first()[0]
            reached = max(filter(None, [state.get("watermark"), newest]), default=None, key=_order)
            totals = totals.persist(StorageLevel.MEMORY_AND_DISK)
            closed = (F.col("window_end") <= _time(reached)) if reached else F.lit(False)
            new["gold"] = dated.write_part(self.manifest, "gold", windows.gold_from_totals(totals.where(closed)), None)
            open_ = self.manifest.fresh("open")
            totals.where(~closed).coalesce(1).write.parquet(self.manifest.at(open_))
            totals.unpersist()
        finally:
            bronze.unpersist()

        def commit(now: dict) -> dict:
            parts = {layer: [*now.get(layer, []), *([part] if part else [])] for layer, part in new.items()}
            schemas = {"bronze": bronze.schema.json(), "silver": silver.schema.json(), "open": totals.schema.json()}
            return {**now, **parts, "batch": batch, "watermark": reached, "open": open_, "schemas": schemas}

        self.manifest.update(commit)

    # --- reading ---------------------------------------------------------------------------

    def read(self, layer: str) -> DataFrame:
        """The committed rows of ``bronze``, ``silver``, ``gold`` or ``late`` (silver
        rows that came after their window was emitted)."""
        state = self.manifest.current()[1]
        return dated.read_parts(self.manifest, state.get(layer, []), self._schema(state, layer), _PARTED_BY[layer])

    def _schema(self, state: dict, layer: str) -> T.StructType:
        if layer == "gold":
            return GOLD_SCHEMA
        given = {"bronze": BRONZE_SCHEMA, "silver": SILVER_SCHEMA, "late": SILVER_SCHEMA}
        stored = state.get("schemas", {}).get("silver" if layer == "late" else layer)
        return T.StructType.fromJson(json.loads(stored)) if stored else given[layer]

    def _open(self, state: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(state["schemas"]["open"]))).parquet(self.manifest.at(state["open"]))

    def open_windows(self) -> DataFrame:
        """Gold rows of the windows that no watermark has closed yet, as they stand."""
        state = self.manifest.current()[1]
        if not state:
            return self.spark.createDataFrame([], GOLD_SCHEMA)
        return windows.gold_from_totals(self._open(state))

    # --- maintenance -------------------------------------------------------------------------

    def compact(self) -> int:
        """Merge the full size tiers of every layer into larger parts; the number of
        the state that shows them. Batches may be committed meanwhile; only one
        compaction at a time."""
        state = self.manifest.current()[1]
        merged, gone = {}, set()
        for layer, by in _PARTED_BY.items():
            before = state.get(layer, [])
            after = dated.merge_parts(self.manifest, layer, before, self._schema(state, layer), by, fan_in=self.fan_in)
            gone |= {e["folder"] for e in before if e not in after}
            merged[layer] = [e for e in after if e not in before]
        if not gone:
            return self.manifest.current()[0]
        return self.manifest.update(lambda now: {**now, **{
            layer: [*merged[layer], *(e for e in now.get(layer, []) if e["folder"] not in gone)] for layer in _PARTED_BY}})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the last ``keep`` states names. Not for use
        while the stream runs, or while a reader may use older states."""
        states = [self.manifest.state(n) for n in self.manifest.numbers()[-keep:]]
        live = [e["folder"] for s in states for layer in _PARTED_BY for e in s.get(layer, [])] + [s["open"] for s in states]
        return self.manifest.vacuum(live, [*_PARTED_BY, "open"], keep)


def _order(text: str) -> tuple[int, str]:
    """Time texts in the order of time (a year of five digits is longer)."""
    return text.index("-", 1), text


def _time(text: str | None) -> Column | None:
    return None if text is None else F.lit(text).cast("timestamp")
