from __future__ import annotations

import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from meterlake.llm import jaccard, quality, queries, toxicity
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    result = compare(queries.QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), queries.ORACLE_SQL[name])
    assert result["ok"], result


def test_stages_take_effect_one_after_another(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = [r.doc_id for r in quality.judge(docs).collect() if r.kept]
    left = docs.where(F.col("doc_id").isin(kept))
    model = toxicity.fit(left, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    kept = [r.doc_id for r in toxicity.score(left, model).collect() if r.predicted == 0]
    left = docs.where(F.col("doc_id").isin(kept))
    kept = [r.doc_id for r in jaccard.join_components(left).collect() if r.doc_id == r.component_id]
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted({r.doc_id for r in rows}) == sorted(kept)


def test_stages_on_edge_rows(spark, edge_documents, no_documents, tmp_dir):
    for name, df in (("edge", edge_documents), ("none", no_documents)):
        docs = df
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF_SMALL)
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == df.columns
            out.write.parquet(f"{tmp_dir}/{name}{k}")
            docs = spark.read.parquet(f"{tmp_dir}/{name}{k}")
        assert (docs.count() > 0) == (name == "edge")


def test_all_operators_are_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_nothing_outside_imports_the_subpackage():
    from pathlib import Path

    root = Path(sys.modules["meterlake"].__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "llm" not in path.read_text(), path
