"""Check results kept by part, so that only new parts are checked.

A part is a delivery or a date. Its state is a few rows ``(model, column_name,
check_type, part, value, n)``: the NULLs of a not_null check, every unaccepted
value, every value that occurs more than once within the part. States of parts
add up to the failures that the whole suite would count.

Values that occur once in each of two parts need one thing more: ``key_hashes``
keeps 64 bits per key, and ``met_hashes`` compares those of the new parts
with the stored ones. Only if some meet are the keys themselves read again
(``repeated_across``), and then only the rows with these hashes are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.quality import RESULT_SCHEMA, Check

STATE_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)
ACROSS = "across"  # the part of keys that several parts hold
STATE_COLUMNS = STATE_SCHEMA.fieldNames()


def part_state(df: DataFrame, checks: list[Check], part: Column | str) -> DataFrame:
    """The state rows of one model's new rows; ``part`` says which part a row is of.

    One scan reduces the rows to one per part and combination of the columns
    with accepted values (partially before the shuffle); each unique check is
    one more aggregate by its column."""
    part = F.lit(part) if isinstance(part, str) else part
    rows = df.withColumn("__part", part.cast("string"))
    valued = list(dict.fromkeys(c.column for c in checks if c.kind == "accepted_values"))
    nulls = [c for c in checks if c.kind == "not_null"]
    states = []
    if valued or nulls:
        small = rows.groupBy("__part", *valued).agg(
            F.count(F.lit(1)).alias("__n"), *[F.count(F.when(F.col(c.column).isNull(), 1)).alias(f"__null_{c.column}") for c in nulls]
        )
        found = []
        for c in checks:
            if c.kind == "not_null":
                value, n = F.lit(None).cast("string"), F.col(f"__null_{c.column}")
            elif c.kind == "accepted_values":
                value = F.when(~F.col(c.column).isin(*c.values), F.col(c.column).cast("string"))
                n = F.when(value.isNotNull(), F.col("__n")).otherwise(0)
            else:
                continue
            found.append(_row(c, F.col("__part"), value, n))
        states.append(small.select(F.inline(F.array(*found))))
    for c in checks:
        if c.kind == "unique":
            twice = rows.where(F.col(c.column).isNotNull()).groupBy("__part", c.column).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
            states.append(twice.select(F.inline(F.array(_row(c, F.col("__part"), F.col(c.column).cast("string"), F.col("__n"))))))
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out.where("n > 0").groupBy(*STATE_COLUMNS[:-1]).agg(F.sum("n").alias("n"))


def _row(c: Check, part: Column, value: Column, n: Column) -> Column:
    return F.struct(F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"), F.lit(c.kind).alias("check_type"),
                    part.alias("part"), value.alias("value"), n.cast("bigint").alias("n"))


def evaluate_state(state: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check with its failures over all parts."""
    failures = state.groupBy("model", "column_name", "check_type").agg(
        F.when(F.col("check_type") == "not_null", F.sum("n")).otherwise(F.count_distinct("value")).alias("failures")
    )
    listed = state.sparkSession.createDataFrame([(c.model, c.column, c.kind, 0) for c in checks], RESULT_SCHEMA).drop("failures")
    return listed.join(failures, ["model", "column_name", "check_type"], "left").withColumn("failures", F.coalesce("failures", F.lit(0)))


def key_hashes(df: DataFrame, column: str, part_col: str) -> DataFrame:
    """64 bits of every key, once per part."""
    return df.where(F.col(column).isNotNull()).select(F.xxhash64(column).alias("h"), part_col).distinct()


def met_hashes(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """Hashes (``key_hashes``) of new parts that other parts, new or old, hold as well."""
    several = new.groupBy("h").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("h")
    return several if old is None else several.union(new.join(old.select("h"), "h", "left_semi").select("h")).distinct()


def repeated_across(check: Check, met: DataFrame, rows: DataFrame) -> DataFrame:
    """State rows (part ``across``) for the keys of ``rows``, the whole model, that
    have one of these hashes and occur more than once."""
    keys = rows.where(F.col(check.column).isNotNull()).select(F.col(check.column).alias("k"), F.xxhash64(check.column).alias("h"))
    twice = keys.join(met, "h", "left_semi").groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.select(F.inline(F.array(_row(check, F.lit(ACROSS), F.col("k").cast("string"), F.col("n")))))
