from __future__ import annotations

import random
import re
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from meterlake.llm import graph, jaccard
from meterlake.llm.shingles import shingle_sets
from meterlake.llm.text import Texts
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    """Links between documents; rows with a null id and equal texts are one document."""
    sets = [(("text", t) if i is None else ("id", i), shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations([s for s in sets if s[1]], 2):
        if 100 * len(a & b) >= 75 * len(a | b) and find(i) != find(j):
            parent[find(i)] = find(j)
    least: dict = {}
    for node in parent:
        if node[0] == "id":
            least[find(node)] = min(node[1], least.get(find(node), node[1]))
    return sorted(((i, len(s), least.get(find(node))) for (i, _), (node, s) in zip(rows, sets, strict=True)), key=str)


def _run(df, **how):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_components(df, **how).collect()), key=str)


def _families(seed):
    """Copies with edits of all sizes: small sets, chains, a large family, a passage in many."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(40))
    rows, i = [], 0
    for size in (*range(1, 30), 60, 120, 400):
        base = [word() for _ in range(size)]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + size // 40)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.5:
                copy = copy[: max(1, len(copy) - rng.randint(0, 1 + size // 8))]
            rows.append((i, " ".join(copy)))
            i += 1
    chain = [word() for _ in range(100)]
    for _ in range(12):  # each similar to the one before only
        chain = chain[6:] + [word() for _ in range(6)]
        rows.append((i, " ".join(chain)))
        i += 1
    large = [word() for _ in range(80)]
    for _ in range(60):
        copy = list(large)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(80)] = word()
        rows.append((i, "\n".join(copy)))
        i += 1
    passage = " ".join(word() for _ in range(30))
    for _ in range(30):
        rows.append((i, passage + " " + " ".join(word() for _ in range(rng.randint(0, 14)))))
        i += 1
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = _families(1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _run(df) == brute(rows)


def test_long_lists_are_scanned_in_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_ROWS", 8)
    rows = _families(3)
    assert _run(spark.createDataFrame(rows, "doc_id long, text string"), sketch_bits=12) == brute(rows)


def test_every_boundary_gives_the_same(spark, monkeypatch):
    rows = [r for r in _families(4) if len(r[1].split()) < 34]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for boundary in (0, 11):
        monkeypatch.setattr(jaccard, "boundary_by_cost", lambda *a, b=boundary: b)
        assert _run(df) == brute(rows)


def test_edge_rows(clashing, no_documents):
    assert _run(clashing) == brute([(r.doc_id, r.text) for r in clashing.collect()])
    assert _run(no_documents) == []


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert _run(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_rows_that_repeat_an_id_are_one_document(spark):
    rows = [(1, "a b c d e f g h"), (1, "k l m n o p q r"), (2, "K L m n o p q r"), (0, "A b c d e f g h"), (3, "other words here")]
    got = _run(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [(i, c) for i, _, c in got] == [(0, 0), (1, 0), (1, 0), (2, 0), (3, 3)]


def test_keep_first_keeps_one_of_each_component(clashing):
    kept = jaccard.keep_first(clashing)
    assert kept.columns == clashing.columns
    first = {i: c for i, _, c in brute([(r.doc_id, r.text) for r in clashing.collect()])}
    wanted = [r for r in clashing.collect() if first[r.doc_id] == r.doc_id]
    assert sorted(map(str, kept.collect())) == sorted(map(str, wanted))


def test_pipeline_keeps_one_row_of_a_repeated_document(spark):
    import corpus_pipeline

    text = "one text of a document that occurs in very many rows of the table"
    rows = [(5, text, "en", k % 2) for k in range(1000)] + [(9, text, "en", 0), (7, "quite another text that only occurs in a single row here", "fr", 1)]
    rows += [(8, "an id with two texts, of which this is the first one", "de", 2), (8, "wholly different words under this very same number", "de", 3), (None, text, "en", 0)]
    lone = "a text that only rows without an id have and which is long enough"
    rows += [(None, lone, "en", k) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n int").repartition(4)
    kept = corpus_pipeline.one_per_group(spark, docs, "")
    assert kept.columns == docs.columns and set(map(tuple, kept.collect())) <= set(rows)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["5", "7", "8", "None"]
    assert [r.text for r in kept.where("doc_id is null").collect()] == [lone]


def test_rows_without_an_id_link_others(spark):
    words = [f"w{i}" for i in range(200)]
    steps = [" ".join(words[k * 10 : k * 10 + 100]) for k in range(4)]
    for ids in ((9, None, None, 4), (None, None, None, None)):
        rows = [*zip(ids, steps, strict=True), (None, "another text that is linked with nothing at all"), (None, None), (None, None), (50, None)]
        assert _run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert [c for _, _, c in brute([(1, steps[0]), (None, steps[1]), (2, steps[2])])] == [1, 1, 1]


def test_ids_without_room_for_others(spark):
    import pytest

    df = spark.createDataFrame([(2**63 - 1, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    with pytest.raises(ValueError, match="no numbers are left"):
        jaccard.join_components(df)
    assert _run(df.where("doc_id is not null")) == [(2**63 - 1, 2, 2**63 - 1)]


def test_boundary_weighs_subsets_against_postings():
    assert jaccard.subsets_listed(8, 20) == sum(comb(8, c) for c in (6, 7, 7, 8, 8))
    assert jaccard.boundary_by_cost({}) == 0
    assert jaccard.boundary_by_cost({4: 1000, 200: 10}) >= 4
    assert jaccard.boundary_by_cost({16: 1000}) < 16


def test_shingles_of_every_text():
    texts = ["", "A b", "a B", "a b c d e", "a b c d e f a b c d e", "x  y\tz\n w  v u", None, "é É ß 漢 字 😀", "word " * 300]
    hashed, offsets = shingle_sets(Texts(pa.array(texts)))
    sets = [hashed[offsets[i] : offsets[i + 1]].tolist() for i in range(len(texts))]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert all(s == sorted(set(s)) for s in sets)
    assert sets[1] == sets[2] and not set(sets[3]) & set(sets[1])
    alone, _ = shingle_sets(Texts(pa.array(texts[4:5])))
    assert alone.tolist() == sets[4] and np.all(alone[1:] > alone[:-1])


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 400)] + [(400, 399), (7, 7), (9, 8), (8, 9)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(pairs, "a long, b long").repartition(7)).collect()}
    wanted = {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, *range(200, 401)]} | {8: 8, 9: 8}
    assert got == wanted
    assert graph.components(spark.createDataFrame([], "a long, b long")).select(F.col("label")).collect() == []
