"""The warehouse models as one lazily planned DAG.

source -> staging -> {alerts, hourly -> fact, dim_meters, dim_grid_zones,
dim_dates}. Each model is a function of its parents; Catalyst sees the
whole chain, so filters and column pruning reach the scan of the source.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from meterlake.operators import marts, readings
from meterlake.plans.materialize import as_table


@dataclass
class Models:
    source: DataFrame

    @cached_property
    def staging(self) -> DataFrame:
        return readings.staging(self.source)

    @cached_property
    def alerts(self) -> DataFrame:
        return readings.anomaly_alerts(self.staging)

    @cached_property
    def hourly(self) -> DataFrame:
        return marts.hourly_consumption(self.staging)

    @cached_property
    def fact(self) -> DataFrame:
        return marts.fact_consumption(self.hourly)

    @cached_property
    def dim_meters(self) -> DataFrame:
        return marts.dim_meters(self.staging)

    @cached_property
    def dim_grid_zones(self) -> DataFrame:
        return marts.dim_grid_zones(self.staging)

    @cached_property
    def dim_dates(self) -> DataFrame:
        return marts.dim_dates(self.staging)

    def derived_once(self, path: str) -> dict[str, DataFrame]:
        """The marts from one pass over the source: meter x hour totals are
        written to ``path`` and all four marts are derived from that table."""
        mh = as_table(marts.meter_hours(self.staging), path)
        return marts.from_meter_hours(mh)

    def marts(self) -> dict[str, DataFrame]:
        return {
            "fct_energy_consumption": self.fact,
            "dim_meters": self.dim_meters,
            "dim_grid_zones": self.dim_grid_zones,
            "dim_dates": self.dim_dates,
        }
