"""Run the models in dependency order, then the checks; publish if they pass.

The readings are scanned once, to the meter x hour grain; the fact and all
dimensions come from those totals. The marts of a run become visible together
after its gate (see ``increments``): a failing run leaves the marts of the last
one. Given as deliveries, readings are read once ever; given as a whole source,
totals and dimensions are rebuilt and the fact gets the hours after its newest.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from meterlake.operators import marts, readings
from meterlake.operators.quality import Check
from meterlake.plans.increments import Warehouse
from meterlake.plans.materialize import RunResult, as_view


@dataclass
class JobResult:
    fact_run: RunResult
    tables: dict[str, DataFrame]
    checks: DataFrame | None  # None for a delivery that was published before
    published: bool


def run_then_test(
    spark: SparkSession,
    source: DataFrame,
    out_dir: str,
    full_refresh: bool = False,
    fail_on_error: bool = True,
    delivery: str | None = None,
    late: str = "ignore",
    warn: Iterable[Check] = (),
) -> JobResult:
    """Build, evaluate the source and mart suites (20 checks) once, publish.

    ``delivery`` names a delivery of new readings (see ``Warehouse.apply``);
    ``late="merge"`` recomputes the dates that a delivery touches instead of
    ignoring late hours. Raises ``DataQualityError`` if a check fails, unless it
    is one of ``warn`` (reported only) or ``fail_on_error`` is off: then the
    marts are published all the same."""
    staged = as_view(readings.staging(source), "stg_meter_readings")
    as_view(readings.anomaly_alerts(staged), "stg_anomaly_alerts")
    as_view(marts.hourly_consumption(staged), "int_consumption_windowed")
    run = Warehouse(spark, out_dir, late).apply(source, delivery, full_refresh, gate=fail_on_error, warn=warn)
    for name, df in run.tables.items():
        as_view(df, name)  # SQL over the marts by model name
    return JobResult(RunResult(run.mode, run.high_water_mark), run.tables, run.checks, run.published)
