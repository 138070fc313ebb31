"""Declarative data-quality checks (not_null, unique, accepted_values).

A check passes when it finds no failures. ``failing_rows`` returns what a
check reports (the rows or values at fault); ``evaluate`` returns one row
per check, ``(model, column_name, check_type, failures)``, computed with few
passes: the not_null and accepted_values checks of a table share one scan,
and each unique check is one aggregation whose partial aggregate runs before
its shuffle.

``failures`` counts what the check's failing-rows query returns: NULL rows
for not_null, duplicated values for unique, distinct unaccepted values for
accepted_values (NULL is not a failure there).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.schemas import GRID_ZONES, METER_TYPES


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str  # "not_null" | "unique" | "accepted_values"
    values: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.kind


def _suite(model: str, spec: dict[str, list]) -> list[Check]:
    out = []
    for column, checks in spec.items():
        for check in checks:
            if isinstance(check, tuple):
                out.append(Check(model, column, "accepted_values", tuple(check)))
            else:
                out.append(Check(model, column, check))
    return out


ZONES = tuple(GRID_ZONES)
TYPES = tuple(METER_TYPES)

# Checks on the warehouse source table (6).
SOURCE_SUITE = _suite(
    "meter_readings",
    {
        "meter_id": ["not_null"],
        "kwh_reading": ["not_null"],
        "grid_zone": ["not_null", ZONES],
        "meter_type": ["not_null", TYPES],
    },
)

# Checks on the marts (14).
MART_SUITE = (
    _suite(
        "fct_energy_consumption",
        {
            "consumption_id": ["unique", "not_null"],
            "meter_id": ["not_null"],
            "consumption_hour": ["not_null"],
            "grid_zone": ["not_null", ZONES],
            "meter_type": ["not_null", TYPES],
        },
    )
    + _suite("dim_meters", {"meter_id": ["unique", "not_null"]})
    + _suite("dim_grid_zones", {"grid_zone": ["unique", "not_null"]})
    + _suite("dim_dates", {"date_hour": ["unique", "not_null"]})
)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """What the check reports; empty when it passes."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return df.where(c.isNull())
    if check.kind == "unique":
        return (
            df.where(c.isNotNull())
            .groupBy(c.alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1)
        )
    if check.kind == "accepted_values":
        return (
            df.where(c.isNotNull() & ~c.isin(*check.values))
            .groupBy(c.alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
        )
    raise ValueError(f"unknown check kind {check.kind!r}")


def _rows(checks: list[Check], counts: DataFrame) -> DataFrame:
    """Unpivot one-row counts (column ``c<i>`` per check) to one row per check."""
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c.model).alias("model"),
                        F.lit(c.column).alias("column_name"),
                        F.lit(c.name).alias("check_type"),
                        F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("failures"),
                    )
                    for i, c in enumerate(checks)
                ]
            )
        )
    )


def evaluate(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check with its failure count.

    Per table one scan serves all not_null and accepted_values checks: rows
    are reduced to one per combination of the columns with accepted values,
    with their NULL counts (partially before the shuffle), and the results
    come from that small frame. Each unique check is one group-by on its
    column, partially aggregated before the shuffle; a not_null check of the
    same column is answered by it too, so a dimension is read once.
    """
    parts: list[DataFrame] = []
    for model in dict.fromkeys(c.model for c in checks):
        df = tables[model]
        group = [c for c in checks if c.model == model]
        unique = [c for c in group if c.kind == "unique"]
        keyed = {c.column for c in unique}
        for c in unique:
            both = [c, *[x for x in group if x.kind == "not_null" and x.column == c.column]]
            n = df.groupBy(F.col(c.column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
            null, twice = F.col("v").isNull(), F.col("v").isNotNull() & (F.col("n") > 1)
            counts = n.agg(*[
                F.sum(F.when(twice, 1) if x.kind == "unique" else F.when(null, F.col("n"))).alias(f"c{i}") for i, x in enumerate(both)
            ])
            parts.append(_rows(both, counts))
        rest = [c for c in group if c.kind == "accepted_values" or (c.kind == "not_null" and c.column not in keyed)]
        if rest:
            parts.append(_rows(rest, _folded(df, rest)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _folded(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row of failure counts (``c<i>``) from one scan."""
    valued = list(dict.fromkeys(c.column for c in checks if c.kind == "accepted_values"))
    nulls = [c for c in checks if c.kind == "not_null"]
    small = df.groupBy(*valued).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.when(F.col(c.column).isNull(), 1).otherwise(0)).alias(f"null_{c.column}") for c in nulls],
    )
    return small.agg(*[
        F.sum(f"null_{c.column}").alias(f"c{i}") if c.kind == "not_null"
        else F.count_distinct(F.when(~F.col(c.column).isin(*c.values), F.col(c.column))).alias(f"c{i}")
        for i, c in enumerate(checks)
    ])


RESULT_SCHEMA = "model string, column_name string, check_type string, failures bigint"


def evaluated(results: DataFrame) -> DataFrame:
    """The results as values: the checks run here, once (at most one small row
    per check reaches the driver), however often the results are used after."""
    rows = [tuple(r) for r in results.collect()]
    return results.sparkSession.createDataFrame(rows, RESULT_SCHEMA)


def outcome(results: DataFrame) -> DataFrame:
    """The gate's verdict: checks run, checks failed, and whether the run passes."""
    failed = F.sum(F.when(F.col("failures") > 0, 1).otherwise(0))
    return results.agg(F.count(F.lit(1)).alias("checks"), failed.alias("failed"), (failed == 0).alias("passed"))


def duplicate_key_summary(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """For each unique check: duplicated keys, the rows they cover, the
    largest group."""
    parts = []
    for c in checks:
        if c.kind != "unique":
            continue
        dups = failing_rows(tables[c.model], c)
        parts.append(
            dups.agg(
                F.count(F.lit(1)).alias("duplicated_values"),
                F.coalesce(F.sum("n_records"), F.lit(0)).alias("duplicated_rows"),
                F.coalesce(F.max("n_records"), F.lit(0)).alias("max_records"),
            ).select(F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"), "*")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


class DataQualityError(RuntimeError):
    pass


def gate(results: DataFrame, warn: Iterable[Check] = ()) -> DataFrame:
    """Raise when any check failed; the failing checks are in the message. The
    checks in ``warn`` are in the results like the others but stop nothing."""
    warned = {(c.model, c.column, c.kind) for c in warn}
    failed = results.where(F.col("failures") > 0).collect()  # at most one row per check
    failed = [r for r in failed if (r.model, r.column_name, r.check_type) not in warned]
    if failed:
        lines = ", ".join(f"{r.model}.{r.column_name} {r.check_type}: {r.failures}" for r in failed)
        raise DataQualityError(f"{len(failed)} check(s) failed: {lines}")
    return results
