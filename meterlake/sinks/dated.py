"""Tables kept as parts by date (or another column), listed in a manifest.

A part is a parquet folder partitioned by date; its manifest entry says which
of its dates are live. Appending adds a part, replacing dates takes them from
the older parts, so neither touches a file that a reader may have open.
Parts of similar size are merged once there are enough of them (size tiers):
a row is rewritten about once per tier, and a table has few parts per tier
however many deliveries it got.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import files
from meterlake.sinks.manifest import Manifest

NO_DATE = "__HIVE_DEFAULT_PARTITION__"
_PART = "part"  # folders are named part=<id>, so that all parts together are one table
FAN_IN = 8  # parts of one tier that are merged into one of the next


def write_part(manifest: Manifest, kind: str, df: DataFrame, date_col: str | None) -> dict | None:
    """Write the rows as a new part; its manifest entry, or None without rows.

    The rebalance hint lets AQE size the write tasks: a hot date is split,
    small ones are merged. Without ``date_col`` the part is one plain folder."""
    kind, name = manifest.fresh(kind).split("/")
    folder = f"{kind}/{_PART}={name}"
    writer = df.hint("rebalance", date_col).write.partitionBy(date_col) if date_col else df.hint("rebalance").write
    writer.parquet(manifest.at(folder))
    found = files.names(df.sparkSession, manifest.at(folder))
    dates = [n.removeprefix(f"{date_col}=") for n in found if n.startswith(f"{date_col}=")]
    if not dates and not (date_col is None and any(n.startswith("part-") for n in found)):
        return None
    return {"folder": folder, "dates": dates, "all": True, "bytes": files.size_of(df.sparkSession, manifest.at(folder))}


def read_parts(manifest: Manifest, entries: list[dict], schema: T.StructType, date_col: str | None) -> DataFrame:
    """The live rows of the parts in one scan, which date filters prune: whole
    parts by their folder, parts of which dates were replaced by their live dates."""
    if not entries:
        return manifest.spark.createDataFrame([], schema)
    paths = []
    for e in entries:
        base = manifest.at(e["folder"])
        paths += [base] if e["all"] else [f"{base}/{date_col}={d}" for d in e["dates"]]
    root = manifest.at(entries[0]["folder"].split("/")[0])
    listed = T.StructType([*schema.fields, T.StructField(_PART, T.StringType())])
    return manifest.spark.read.schema(listed).option("basePath", root).parquet(*paths).select(*schema.names)


def replaced(entries: list[dict], part: dict) -> list[dict]:
    """The entries after ``part`` has taken over its dates."""
    gone, out = set(part["dates"]), []
    for e in entries:
        left = [d for d in e["dates"] if d not in gone]
        if left:
            out.append({**e, "dates": left, "all": e["all"] and len(left) == len(e["dates"])})
    return [*out, part]


def tier(entry: dict) -> int:
    return int(math.log(max(entry["bytes"], 1), FAN_IN))


def merge_parts(manifest: Manifest, kind: str, entries: list[dict], schema: T.StructType, date_col: str | None,
                merge: Callable[[DataFrame], DataFrame] = lambda df: df, fan_in: int = FAN_IN) -> list[dict]:
    """Entries with every full tier merged into one part. ``merge`` may add up
    rows that belong together."""
    tiers: dict[int, list[dict]] = {}
    for e in entries:
        tiers.setdefault(tier(e), []).append(e)
    out = []
    for _, group in sorted(tiers.items()):
        if len(group) < fan_in:
            out += group
            continue
        merged = write_part(manifest, kind, merge(read_parts(manifest, group, schema, date_col)), date_col)
        out += [merged] if merged else []
    return out


def with_date(df: DataFrame, time_col: str, date_col: str) -> DataFrame:
    return df.withColumn(date_col, F.to_date(time_col))
