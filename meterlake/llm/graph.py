"""Connected components by label propagation with shortcuts."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.config import shared_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts the lineage.

    Then the driver's garbage is collected: only that lets Spark remove the
    shuffle files of the steps before, which nothing reads any more.
    """
    spark, schema = df.sparkSession, df.schema
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (smallest node reachable) for every node of edges (a, b).

    Each turn a node takes the smallest label around it, then the label of its
    label, until nothing changes: about the logarithm of the longest path. A
    node with very many neighbours is summed up by partial aggregates, and its
    rows in the joins are split at run time.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = stored(both.union(both.select("other", "node")).where("node <> other").distinct(), "edges")
    labels = stored(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")), "labels")
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node").agg(F.min("label").alias("near"))
        )
        near = labels.join(around, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        turned = near.join(jump, "label").select("node", F.least("label", "beyond").alias("label"), "before")
        turned = stored(turned, "labels")
        labels = turned.select("node", "label")
        if not turned.where("label <> before").limit(1).count():
            return labels
