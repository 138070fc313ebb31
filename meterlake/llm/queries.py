"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import jaccard, language, licenses, negatives, packing, quality, runs, simhash, tokens, topk, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), 20)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_texts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        columns=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return language.predict(documents, language.fit(documents))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, _table(spark, sf_dir, "labels")))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.documents_as_files(_table(spark, sf_dir, "documents")))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.find_runs(_table(spark, sf_dir, "documents"), rearrange=runs.periodic_tail))


QUERIES: dict[str, Query] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_url_filters": op2_url_filters,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_token_counts": op6_token_counts,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_toxicity": op9_toxicity,
    "op10_license_scans": op10_license_scans,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_top_k": topk.TOP_K_SQL,
    "op8_quality_rules": quality.JUDGE_SQL,
    "op10_license_scans": licenses.scan_sql(),
    "op12_hard_negatives": negatives.HARD_NEGATIVES_SQL,
}
