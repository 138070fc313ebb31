from __future__ import annotations

import re
import unicodedata
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

from meterlake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    symbols = sum(c in quality.SYMBOLS for c in t)
    base = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    upper, letters = sum("A" <= c <= "Z" for c in t), sum(unicodedata.category(c)[0] == "L" for c in t)
    dup = len(lines) - len(set(lines))
    same = sum(a == b for a, b in zip(w, w[1:], strict=False))
    bad = (base or 100 * symbols > 10 * len(w) or 100 * upper > 50 * letters
           or 100 * dup > 50 * len(lines) or 100 * same > 20 * len(w))
    return (len(w), sum(map(len, w)), symbols, dup, len(inside), base, not bad)


def test_judge_edge_rows(edge_documents, clashing, no_documents):
    for df in (edge_documents, clashing):
        for r, d in zip(quality.judge(df).collect(), df.collect(), strict=True):
            assert (r.doc_id, *tuple(r)[1:]) == (d.doc_id, *brute(d.text))
    assert quality.judge(no_documents).collect() == []


def test_keep_good_keeps_the_rows_that_judge_keeps(clashing, no_documents):
    kept = quality.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in clashing.collect() if brute(r.text)[-1])
    assert quality.keep_good(no_documents).collect() == []


def test_order_is_by_rejections_per_second_of_what_is_left():
    rejects = [np.array(x, bool) for x in ([1, 1, 1, 0, 0, 0], [1, 1, 1, 1, 0, 0], [0, 0, 0, 0, 1, 0])]
    # 1 rejects most per second; then 0 has nothing left to reject, 2 has one.
    assert quality.greedy_order([1.0, 1.0, 5.0], rejects) == [1, 2, 0]
    assert quality.greedy_order([0.1, 1.0, 5.0], rejects) == [0, 1, 2]


def test_verdict_does_not_depend_on_the_order(edge_documents):
    a = quality.keep_good(edge_documents, rules=quality.RULES)
    b = quality.keep_good(edge_documents, rules=quality.RULES[::-1])
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_an_acronym_in_another_script_is_not_mostly_capitals(spark):
    scripts = {
        "Cyrillic": "съешь ещё этих мягких французских булок да выпей же чаю потом снова",
        "Greek": "ξεσκεπάζω την ψυχοφθόρα βδελυγμία και πάλι από την αρχή μέχρι το τέλος",
        "Arabic": "نص حكيم له سر قاطع وذو شأن عظيم مكتوب على ثوب أخضر ومغلف",
        "Hindi": "ऋषियों को सताने वाले दुष्ट राक्षसों के राजा का सर्वनाश करने वाले विष्णु",
        "Korean": "키스의 고유 조건은 입술끼리 만나야 하고 특별한 기술은 필요치 않다 라고 한다",
        "one word": "",
    }
    rows = [(k, f"{text} DNA") for k, text in enumerate(scripts.values())]
    rows += [(10, "THE SAME LETTERS OVER THERE ARE CAPITALS IN ALL WORDS É È"), (11, "ABCDEFGH IJKLMNOP QRST UVWX Ω A B C D E F G 😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀😀")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    judged = {r.doc_id: tuple(r)[1:] for r in quality.judge(df).collect()}
    assert sorted(i for i, r in judged.items() if r[-1]) == [0, 1, 2, 3, 4]
    assert judged == {i: brute(t) for i, t in rows}
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}))
    assert judged == {r[0]: r[1:] for r in con.execute(quality.JUDGE_SQL).fetchall()}
    assert sorted(r.doc_id for r in quality.keep_good(df).collect()) == [0, 1, 2, 3, 4]
