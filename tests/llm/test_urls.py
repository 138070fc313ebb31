from __future__ import annotations

import pytest

from meterlake.llm import urls


def brute(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = []
    for verdict, rule in urls.RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return host, path, max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "http:///path", "http://EXAMPLE.org/es/1?x#y", "https://a.Example.ORG/en/12", "http://example.org",
    "http://example.org?q=/es/", "http://org/", "http://notexample.org/es/", "http://x.com/fr/a#b?c", "http://x.com/de/", "http://com/de/1",
    "ftp://x.net/a://b/c", "http://x.net/" + "y" * 5000, "http://ÄB.com/fr/", "http://x.com\n/fr/", "http://cheap-pills.test/", "http://x.com/fr",
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, "taken") for i, u in enumerate(URLS)] + [(None, URLS[5], "taken"), (5, URLS[5], "taken")],
                                 "page_id long, url string, rule string")


def test_host_path_rule_and_verdict(pages):
    rows = urls.judge_urls(pages).collect()
    assert len(rows) == pages.count()
    for r, given in zip(rows, pages.collect(), strict=True):
        host, path, (rule, verdict) = brute(given.url)
        assert (r.page_id, r.host, r.path, r.rule) == (given.page_id, host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


def test_model_tells_its_table_apart_and_generalises():
    import pyarrow as pa

    table = urls.labelled_urls()
    model = urls.train(table)
    hosts, paths = [u.partition("/")[0] for u, _ in table], ["/" + u.partition("/")[2] for u, _ in table]
    assert ((model.scores(pa.array(hosts), pa.array(paths)) > 0.5) == [y == 1 for _, y in table]).all()
    score = lambda *hosts: model.scores(pa.array(hosts), pa.array(["/en/1"] * len(hosts)))
    assert (score("the-cheapest-pills.net", "freebets24.com") > 0.5).all()
    assert (score("www.city-library.org", "blog.gardening.net") < 0.5).all()
    assert urls.train([]).scores(pa.array([""]), pa.array([""]))[0] < 0.5
    assert urls.train([("a/", 1)]).scores(pa.array([""]), pa.array([""]))[0] > 0.5


def test_logits_against_a_plain_sum():
    import pyarrow as pa

    model = urls.train(urls.labelled_urls())
    hosts, paths = ["a.b", "", "casino.test"], ["/x", "", "/win"]
    buckets, offsets = urls._features(pa.array(hosts), pa.array(paths))
    got = model.scores(pa.array(hosts), pa.array(paths))
    import math

    for i in range(3):
        own = buckets[offsets[i] : offsets[i + 1]]
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(sum(model.weights[b] for b in own) / math.sqrt(len(own)) + model.bias))))
        sizes = [len(s.encode()) + 2 for s in (hosts[i], paths[i])]
        assert len(own) == sum(1 + sum(max(0, n - k + 1) for k in urls.GRAM_SIZES) for n in sizes)


def test_empty_table(pages):
    assert urls.judge_urls(pages.limit(0)).collect() == []
