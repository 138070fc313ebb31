"""The reading validation rule (one expression shared by stream and batch)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.schemas import FREQUENCY_RANGE, MIN_KWH, VOLTAGE_RANGE


def rule_columns() -> dict[str, Column]:
    """Each validation rule as a boolean column (NULL counts as failed).

    ``between`` is inclusive; a NULL operand makes the rule NULL, which a
    filter drops. NaN kWh passes ``>= 0`` because NaN is the largest double.
    """
    kwh = F.col("kwh_reading")
    return {
        "meter_id_not_null": F.col("meter_id").isNotNull(),
        "kwh_not_null": kwh.isNotNull(),
        "kwh_non_negative": kwh >= MIN_KWH,
        "voltage_in_range": F.col("voltage").between(*VOLTAGE_RANGE),
        "frequency_in_range": F.col("frequency").between(*FREQUENCY_RANGE),
    }


def valid_reading() -> Column:
    """AND of all rules; use as ``df.where(valid_reading())``."""
    rules = list(rule_columns().values())
    cond = rules[0]
    for rule in rules[1:]:
        cond = cond & rule
    return cond
