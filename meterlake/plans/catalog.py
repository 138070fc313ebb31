"""Expose materialised marts to SQL under their model names.

After a build, ``spark.sql("select ... from fct_energy_consumption join
dim_grid_zones using (grid_zone)")`` runs unchanged against the published
marts of ``out_dir``: each name is a view over their parquet folders, so
Catalyst still prunes columns, pushes filters into the scan and prunes the
fact's date partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.plans.increments import DATES, FACT, METERS, ZONES, Warehouse

MART_NAMES = [FACT, METERS, ZONES, DATES]


def register_marts(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """Create (or replace) one temp view per mart published under ``out_dir``."""
    return Warehouse(spark, out_dir).register()
