from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from meterlake.llm import language
from meterlake.llm.sampling import sample_per_label
from tests.conftest import SF_MID


def _tree(texts, order=language.ORDER):
    letters = language.Letters(pa.array(texts))
    gram, count = np.unique(language.grams(letters, order), return_counts=True)
    return language.Tree(gram, count, order), letters


def _brute_cost(training: list[bytes], text: bytes, order: int) -> float:
    """PPM with method C escapes and exclusion, straight from the definition."""
    counts = defaultdict(Counter)
    for t in training:
        for i in range(len(t)):
            for k in range(min(i, order) + 1):
                counts[t[i - k : i]][t[i]] += 1
    bits = 0.0
    for i in range(len(text)):
        excluded: set[int] = set()
        for k in range(min(i, order), -1, -1):
            context = text[i - k : i]
            if context not in counts:
                continue
            left = {s: n for s, n in counts[context].items() if s not in excluded}
            if not left:
                continue
            whole = sum(left.values()) + len(left)
            if text[i] in left:
                bits += math.log2(whole / left[text[i]])
                break
            bits += math.log2(whole / len(left))
            excluded |= set(left)
        else:
            bits += math.log2(256 - len(excluded))
    return bits


def test_code_lengths_are_exact():
    training = ["the theory of the thing", "other things there", "a", ""]
    tree, letters = _tree(training)
    plain = [letters.text_bytes(i) for i in range(len(training))]
    texts = ["the others", "zzz the q", "a", "", "theory thing thing"]
    wanted = language.Letters(pa.array(texts))
    cost = tree.cost(language.grams(wanted)) / language.UNIT
    for i, _ in enumerate(texts):
        own = cost[wanted.offsets[i] : wanted.offsets[i + 1]].sum()
        assert own == pytest.approx(_brute_cost(plain, wanted.text_bytes(i), language.ORDER), abs=1e-3)


def test_a_context_codes_all_bytes_with_probability_one():
    tree, _ = _tree(["abracadabra abracadabra", "bar"])
    for context in (b"", b"a", b"abr", b"zz"):
        word = np.frombuffer(context.ljust(8, b"\0"), "<u8")[0]
        size = len(context)
        gram = np.array([int(word) | (b << (8 * size)) | ((size + 1) << 56) for b in range(256)], np.uint64)
        assert np.exp2(-tree.cost(gram) / language.UNIT).sum() == pytest.approx(1, abs=1e-3)


def test_held_out_accuracy_and_fold(spark):
    documents = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = language.predict(documents, language.fit(documents)).collect()
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    test = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in test) / len(test) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    rows = [(i, "aaaa bbbb cccc", "x" if zlib.crc32(str(i).encode()) % 4 != 2 else "y") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit(df).languages == ["x"]


def test_edge_rows(spark, edge_documents, clashing, no_documents):
    model = language.fit(edge_documents)
    for df in (edge_documents, clashing):
        rows = language.predict(df, model).collect()
        for r, d in zip(rows, df.collect(), strict=True):
            letters = any(c.isalpha() for c in d.text or "")
            assert r.doc_id == d.doc_id
            assert (r.lang_pred in model.languages) if letters else (r.lang_pred, r.score) == ("und", 0.0)
    assert language.predict(no_documents, model).collect() == []
    empty = language.fit(no_documents)
    assert {(r.lang_pred, r.score) for r in language.predict(edge_documents, empty).collect()} == {("und", 0.0)}


def test_sample_takes_about_so_many_rows_of_each_label(spark):
    df = spark.range(4000).selectExpr("id", "if(id < 3900, 'a', 'b') AS label")
    got = Counter(r.label for r in sample_per_label(df, "label", "id", 400).collect())
    assert 300 < got["a"] < 500 and got["b"] == 100


def test_sample_of_a_table_much_larger_than_it(spark):
    """The share may be far below one in a million: the threshold is not rounded to nothing."""
    df = spark.range(3_000_000).selectExpr("id", "'a' AS label")
    assert 0 < sample_per_label(df, "label", "id", 2).count() < 12
