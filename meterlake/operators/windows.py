"""Gold: tumbling-window aggregates per zone and meter type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.schemas import GOLD_COLUMNS, GOLD_WATERMARK, GOLD_WINDOW


def gold(
    silver: DataFrame,
    window: str = GOLD_WINDOW,
    watermark: str | None = GOLD_WATERMARK,
    time_col: str = "event_timestamp",
) -> DataFrame:
    """5-minute windows x zone x type.

    ``meter_count`` counts readings with a meter id (not distinct meters).
    Rows without event time never reach a window. With ``watermark`` (needed
    for a streaming input in append mode) state is bounded and a window is
    emitted once, when the watermark passes its end; a batch run may pass
    ``watermark=None``. The partial aggregate runs before the shuffle, so a
    zone holding most rows does not become one hot task.
    """
    df = silver
    if watermark is not None:
        df = with_watermark_time(df, time_col).withWatermark(time_col, watermark)
    agg = df.groupBy(F.window(F.col(time_col), window).alias("window"), "grid_zone", "meter_type").agg(
        F.avg("kwh_reading").alias("avg_kwh"),
        F.max("kwh_reading").alias("max_kwh"),
        F.sum("kwh_reading").alias("total_kwh"),
        F.count("meter_id").alias("meter_count"),
        F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).alias("anomaly_count"),
        F.avg("voltage").alias("avg_voltage"),
        F.avg("frequency").alias("avg_frequency"),
    )
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *GOLD_COLUMNS[2:],
    )


def with_watermark_time(df: DataFrame, time_col: str = "event_timestamp") -> DataFrame:
    """Watermarks need TIMESTAMP; under a UTC session the cast keeps the value."""
    if isinstance(df.schema[time_col].dataType, T.TimestampNTZType):
        return df.withColumn(time_col, F.col(time_col).cast(T.TimestampType()))
    return df


# --- window totals that merge ------------------------------------------------------------

_KEYS = ["window_start", "window_end", "grid_zone", "meter_type"]
_AVERAGED = {"kwh": "kwh_reading", "voltage": "voltage", "frequency": "frequency"}


def split_late(timed: DataFrame, watermark: Column | None, window: str = GOLD_WINDOW, time_col: str = "event_timestamp") -> tuple[DataFrame, DataFrame]:
    """The rows that still count, and those whose window ended at or before the
    watermark that the batches before left (none without one)."""
    if watermark is None:
        return timed, timed.limit(0)
    placed = timed.withColumn("__window", F.window(F.col(time_col), window))
    late = F.col("__window.end") <= watermark
    return placed.where(~late).drop("__window"), placed.where(late).drop("__window")


def window_totals(timed: DataFrame, window: str = GOLD_WINDOW, time_col: str = "event_timestamp") -> DataFrame:
    """Totals per window x zone x type from which gold follows, and which add up
    over parts of the rows (averages as sum and count)."""
    sums = [f(c).alias(f"{name}_{n}") for n, c in _AVERAGED.items() for f, name in ((F.sum, "sum"), (F.count, "count"))]
    agg = timed.groupBy(F.window(F.col(time_col), window).alias("window"), "grid_zone", "meter_type").agg(
        *sums, F.max("kwh_reading").alias("max_kwh"), F.count("meter_id").alias("meter_count"),
        F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).alias("anomaly_count"),
    )
    return agg.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "*").drop("window")


def merged_window_totals(totals: DataFrame) -> DataFrame:
    added = [F.sum(f"{name}_{n}").alias(f"{name}_{n}") for n in _AVERAGED for name in ("sum", "count")]
    counts = [F.sum(c).alias(c) for c in ("meter_count", "anomaly_count")]
    return totals.groupBy(*_KEYS).agg(*added, F.max("max_kwh").alias("max_kwh"), *counts).select(*totals.columns)


def gold_from_totals(totals: DataFrame) -> DataFrame:
    """Gold rows from (merged) window totals."""
    average = {f"avg_{n}": F.try_divide(f"sum_{n}", f"count_{n}") for n in _AVERAGED}
    return totals.withColumns({**average, "total_kwh": F.col("sum_kwh")}).select(*GOLD_COLUMNS)


def closed_windows(gold_batch: DataFrame, validated: DataFrame, watermark_delay: str = GOLD_WATERMARK) -> DataFrame:
    """Batch closed form of an append-mode stream over in-order data.

    A window is emitted once the watermark (max event time minus the delay)
    reaches its end; windows still open at the end are not emitted.
    """
    watermark = validated.select(
        F.max("event_timestamp") - F.expr(f"INTERVAL {watermark_delay}")
    ).scalar()
    return gold_batch.where(F.col("window_end") <= watermark)
