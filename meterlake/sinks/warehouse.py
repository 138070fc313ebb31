"""Load the silver layer into a typed warehouse table.

The read and the write run on executors; only the loaded-row count (an
observed metric of the write itself, no second pass) reaches the driver.
Re-running appends the rows again: the load has no key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterlake.schemas import LOAD_TABLE_DDL
from meterlake.sources.tables import read_parquet_dir

# Index column some writers leave in parquet files; never loaded.
INTERNAL_COLUMNS = ["__NULL_DASK_INDEX__"]


def normalise_columns(df: DataFrame, drop: list[str] | None = None) -> DataFrame:
    """Upper-case every column name and drop internal columns if present."""
    out = df.toDF(*[c.upper() for c in df.columns])
    present = [c for c in (drop if drop is not None else INTERNAL_COLUMNS) if c in out.columns]
    return out.drop(*present) if present else out


def load_columns() -> list[tuple[str, str]]:
    cols = []
    for line in LOAD_TABLE_DDL.strip().splitlines():
        name, dtype = line.strip().rstrip(",").split()
        cols.append((name, dtype))
    return cols


@dataclass
class LoadResult:
    table: str
    rows_loaded: int


def create_load_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({LOAD_TABLE_DDL}) USING parquet{where}")


def load_silver(spark: SparkSession, silver_path: str, table: str, location: str | None = None) -> LoadResult:
    """Create the table if absent, then append every silver row.

    Columns are matched by name (after upper-casing) and cast to the
    table's types; zone-aware timestamps become zone-less.
    """
    create_load_table(spark, table, location)
    df = normalise_columns(read_parquet_dir(spark, silver_path))
    cols = load_columns()
    typed = df.select(*[F.col(name).cast(dtype).alias(name) for name, dtype in cols])
    observation = Observation("load")
    typed.observe(observation, F.count(F.lit(1)).alias("rows")).write.insertInto(table)
    return LoadResult(table, int(observation.get["rows"]))
