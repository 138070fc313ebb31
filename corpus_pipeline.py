"""Corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All stages but the last return the columns of documents; what a
stage rejects is gone for those after it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import jaccard, packing, quality, toxicity
from meterlake.llm.graph import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Null, empty and wordless texts are
    rejected; other cases as for ``quality.keep_good``."""
    return quality.keep_good(docs)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; learned from the
    labels of the documents that are left, without the held-out fold. Cases as
    for ``toxicity.fit`` and ``toxicity.keep_clean``."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component one row of the document with the smallest id.
    Rows without an id and with equal texts are one document, after those with an
    id; texts without words are linked with nothing (``jaccard.keep_first``)."""
    return jaccard.keep_first(docs, one_row=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048 tokens; cases as for
    ``packing.pack_documents``."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", without_toxic),
    ("near_duplicates", one_per_group),
    ("best_fit_packing", packed),
]

# SQL can express neither the trained toxicity scores nor the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
