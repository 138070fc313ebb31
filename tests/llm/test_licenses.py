from __future__ import annotations

import math
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from meterlake.llm import licenses

SCHEMA = "doc_id long, path string, text string, license string"

FILES = [
    (1, "src0/LICENSE", "Licensed under the Apache License, Version 2.0"),
    (2, "src0/en/a.txt", "plain words without any notice"),
    (3, "src0/en/b.txt", "Some words first.\nReleased under the MIT License.\nand more words after it"),
    (4, "src0/fr/COPYING", "GNU General Public License version 3\n"),
    (5, "src0/fr/deep/er/c.txt", "rien du tout"),
    (6, "src1/d.txt", "nothing near"),
    (7, "src1/e.txt", None),
    (8, "src1/f.txt", ""),
    (9, "top.txt", "the license of this is not told, " * 20),
    (10, None, "no path"),
    (13, "src3/about.txt", "See here:\nReleased under the MIT License"),
    (14, "src3/other.txt", "prose that lies beside it"),
    (15, "src3/j.txt", "first\n// The words of this are also released under the MIT License, see there\nlast"),
    (None, "src0/en/g.txt", "no id"),
    (11, "src0/frx/h.txt", "a directory whose name starts like another"),
    (12, "src2/x/i.txt", "Licensed under CC BY-NC 4.0.\n" + "long text " * 5000),
    (12, "src2/x/i.txt", "Licensed under CC BY-NC 4.0.\n" + "long text " * 5000),
    *[(20 + 3 * k, f"full{k}/LICENSE", "Copyright (c) 2019-2021 Ada Example and others\n\n" + body) for k, (_, body) in enumerate(licenses.TEXTS)],
    *[(21 + 3 * k, f"full{k}/src/deep/a.py", "code without a notice") for k in range(len(licenses.TEXTS))],
    *[(22 + 3 * k, f"half{k}/story.txt", "a story of other things that goes on " * 40 + body) for k, (_, body) in enumerate(licenses.TEXTS)],
    *[(50 + k, f"half{k}/beside.txt", "prose beside it") for k in range(len(licenses.TEXTS))],
]


def brute(files):
    def words(t):
        return "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in (t or "").lower()).split()

    n = len(files)
    every = licenses.TEMPLATES + licenses.TEXTS
    vocab = {t for _, text in every for t in words(text)}
    df = Counter(t for _, _, text in files for t in set(words(text)))
    idf = lambda t, whole=False: math.log((n + 1) / ((0 if whole and t not in vocab else df[t]) + 1)) + 1
    pooled: dict = {}
    for i, p, text in files:
        pooled.setdefault((i, p), []).append(text or "")

    def best(unit, whole=False):
        tf = Counter(words(unit))
        length = math.sqrt(sum((k * idf(t, whole)) ** 2 for t, k in tf.items()))
        found = []
        for k, (name, text) in enumerate(every):
            notice = k < len(licenses.TEMPLATES)
            least = (licenses.FILE_LEAST if notice else licenses.TEXT_LEAST) if whole else licenses.HEADER_LEAST
            w = {t: k * idf(t) for t, k in Counter(words(text)).items()}
            dot = sum(k * idf(t) * w.get(t, 0) for t, k in tf.items())
            share = sum(k for t, k in tf.items() if t in w) / max(1, sum(tf.values()))
            score = round(dot / length / math.sqrt(sum(x * x for x in w.values())), 6) if length else 0.0
            if score >= least and (share >= licenses.FILE_SHARE if whole else notice):
                found.append((-score, name))
        return min(found, default=(0.0, ""))

    own, held = {}, {}
    for key, texts in pooled.items():
        text = texts[0]
        whole = best(text, whole=True)
        if whole[0]:
            own[key] = ("file", whole)
            folder = (key[1] or "").rpartition("/")[0]
            held[folder] = min(held.get(folder, whole), whole)
        else:
            line = min((best(x) for x in text.split("\n")), default=(0.0, ""))
            if line[0]:
                own[key] = ("header", line)
    out = []
    for key in pooled:
        if key in own:
            via, (minus, name) = own[key]
            out.append((*key, name, via, -minus, None))
            continue
        folder = (key[1] or "").rpartition("/")[0]
        while folder not in held and folder:
            folder = folder.rpartition("/")[0]
        if folder in held:
            out.append((*key, held[folder][1], "inherited", -held[folder][0], folder + "/" if folder else ""))
        else:
            out.append((*key, None, None, None, None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([(*f, "taken") for f in FILES], SCHEMA)


def test_against_brute_force(files):
    got = [tuple(r) for r in licenses.scan(files).select("doc_id", "path", "license", "via", "score", "from_directory").collect()]
    wanted = brute(FILES)
    assert [g[:4] + g[5:] for g in sorted(got, key=str)] == [w[:4] + w[5:] for w in wanted]
    assert [g[4] for g in sorted(got, key=str)] == [pytest.approx(w[4], abs=2e-6) if w[4] else w[4] for w in wanted]
    by_id = {g[0]: g for g in got}
    assert by_id[13][3] == "header" and by_id[14][2:4] == (None, None)
    assert by_id[5][2:4] == ("GPL-3.0", "inherited") and by_id[11][2:4] == ("Apache-2.0", "inherited")
    for k, (name, _) in enumerate(licenses.TEXTS):
        assert by_id[20 + 3 * k][2:4] == (name, "file") and by_id[21 + 3 * k][2:4] == (name, "inherited")
        assert by_id[22 + 3 * k][3] != "file" and by_id[50 + k][2] is None


@pytest.mark.parametrize("others", [100, 3000])
def test_a_licence_text_is_a_file_beside_many_others(spark, others):
    """Whatever the number of files, and with wrapped lines, a holder and signs around them."""
    rows = [(i, f"d{i}/x", "the copyright of this software and any other work is not told under these conditions") for i in range(others)]
    for k, (_, body) in enumerate(licenses.TEXTS):
        strange = "Copyright 2020 Example GmbH <ada@example.com>\n" + "\n".join(f" *   {line}" for line in body.split("\n"))
        rows += [(others + 2 * k, f"p{k}/COPYING", strange), (others + 2 * k + 1, f"p{k}/lib/b.c", None)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).where("license is not null").collect()
    assert {(r.doc_id - others, r.license, r.via) for r in got} == {
        (2 * k + part, name, via) for k, (name, _) in enumerate(licenses.TEXTS) for part, via in enumerate(("file", "inherited"))
    }


@pytest.mark.parametrize("others", [20, 2000])
def test_common_words_beside_a_notice_do_not_hide_it(spark, others):
    """Words of no template weigh by their real share, so a header is found on a table of any size."""
    common = "copyright 2020 example corp see the version 2.0 under this license"
    notice = "// Copyright 2020 Example Corp. Licensed under the Apache License, Version 2.0"
    prose = " ".join(f"rare{k}" for k in range(60))
    texts = [(i, f"d{i}/x", common if i else f"{prose}\n{notice}") for i in range(others + 1)]
    got = licenses.scan(spark.createDataFrame(texts, "doc_id long, path string, text string"))
    rows = {r.doc_id: r for r in got.where("license is not null").collect()}
    seen = [set(licenses._terms(t.replace("//", ""))) for _, _, t in texts]
    idf = lambda t: math.log((others + 2) / (sum(t in s for s in seen) + 1)) + 1
    line, wanted = Counter(licenses._terms(notice)), Counter(licenses._terms(licenses.TEMPLATES[0][1]))
    dot, *norms = (sum(a[t] * b[t] * idf(t) ** 2 for t in a) for a, b in ((line, wanted), (line, line), (wanted, wanted)))
    assert {i: (r.license, r.via) for i, r in rows.items()} == {0: ("Apache-2.0", "header")}
    assert rows[0].score == pytest.approx(dot / math.sqrt(norms[0] * norms[1]), abs=2e-6)


def test_sql_states_the_same_rule(spark):
    """Also on lines with words of no template, which weigh by their real share."""
    rows = [(i, "en", "src", t) for i, (_, _, t) in enumerate(FILES) if t is not None]
    rows += [(100 + k, "en", f"d{k % 7}", "also see there the words of this text" if k % 3 else "Copyright 2020 first") for k in range(60)]
    con = duckdb.connect()
    con.register("documents", pa.table({n: [r[k] for r in rows] for k, n in enumerate(("doc_id", "lang", "source", "text"))}))
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    got = licenses.scan(licenses.documents_as_files(df)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(con.execute(licenses.scan_sql()).fetchall(), key=str)
    assert {r.via for r in got} >= {"header", "file", None}


def test_empty_table(files):
    assert licenses.scan(files.limit(0)).collect() == []


def test_units_without_an_anchor_stay_below_the_threshold():
    _, vectors = licenses.template_weights({}, 1000)
    for least in (0.3, 0.5, 0.8, 0.9):
        held = set(licenses.anchors(vectors, least))
        assert all(math.sqrt(sum(w * w for t, w in v.items() if t not in held)) < least for v in vectors)


def test_no_python_runs(files):
    import re

    plan = licenses.scan(files)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
