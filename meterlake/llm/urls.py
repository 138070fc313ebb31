"""URL filters: host and path rules, and a learned verdict where no rule fits.

Hosts, paths and rules are column expressions. The learned verdict is a
logistic regression on hashed character n-grams of host and path, trained in
numpy on a small labelled URL table that the caller gives (or the built-in
one); it needs no shuffle and its size is fixed.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.text import Texts, segment_sums, subword_hashes, text_chunks

# Fixed values: (verdict, host and path start). A rule fits its host and all
# its subdomains where the URL's path starts with the rule's.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)

GRAM_SIZES = (3, 4, 5)
BUCKETS = 1 << 15
STEPS = 400
PENALTY = 1e-4

# A small labelled table: hosts with a path, by verdict.
BLOCKED_URLS = (
    "cheap-pills-online.test/buy", "cheap-meds.test/en/3", "best-pills.test/order", "discount-pharmacy.test/pills", "diet-pills.test/sale",
    "free-bets-now.test/win", "free-casino.test/bonus", "big-bets.test/odds", "casino-bonus.test/free", "lucky-slots.test/spin",
    "poker-bets.test/play", "spam-mail.test/list", "spam-links.test/farm", "link-farm.test/seo", "content-farm.test/1",
    "ads-network.test/click", "ads-server.test/banner", "track-click.test/pixel", "ad-tracker.test/track", "ads-track.test/ref",
    "click-track.test/go", "cheap-loans.test/apply", "free-money.test/now", "payday-loans.test/fast", "cheap-watches.test/replica",
    "hot-dating.test/free", "win-prize.test/claim", "free-iphone.test/win", "cheap-tickets-scam.test/x", "malware-download.test/exe",
    "crack-keys.test/free", "spam-farm-seo.test/page", "cheap-followers.test/buy", "free-spins.test/bets", "pills-shop.test/cart",
    "online-casino.test/join", "casino-jackpot.test/win", "royal-casino.test/slots", "win-big-casino.test/en", "instant-win.test/prize",
)
ALLOWED_URLS = (
    "library.test/catalogue", "museum.test/visit", "university.test/courses", "city-news.test/local", "weather.test/today",
    "cooking.test/recipes", "garden.test/plants", "history.test/articles", "science.test/papers", "music.test/concerts",
    "docs.test/manual", "wiki.test/page", "blog.theater.test/en/12", "blog.travel.test/fr/3", "m.newspaper.test/en/45",
    "www.school.test/de/7", "www.health-institute.test/en/9", "blog.mathematics.test/en/100", "forum.chess.test/games", "maps.test/route",
    "books.test/review", "films.test/critics", "football.test/results", "trains.test/timetable", "parliament.test/debates",
    "courts.test/rulings", "physics.test/lectures", "languages.test/grammar", "painting.test/exhibition", "radio.test/programme",
    "www.thestory.test/en/5", "m.thinker.test/es/8", "blog.nation.test/en/77", "archive.test/1998", "www.therapist.test/fr/20",
    "another.test/en/31.html", "www.other.test/de/44", "the-observer.test/en/2", "m.theory.test/en/61", "blog.station.test/es/14",
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without a scheme."""
    return F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits (on ties a blocking one), else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1]))
    found = F.lit(None).cast("string")
    for _, rule in reversed(ordered):
        own, start = rule[: rule.index("/")].lower(), rule[rule.index("/") :]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _features(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of host and path, one URL after another, and their offsets."""
    parts = []
    for side, column in enumerate((hosts, paths)):
        texts = Texts(column)
        hashes, offsets = subword_hashes(texts.data, texts.offsets[:-1], np.diff(texts.offsets), GRAM_SIZES)
        parts.append((np.repeat(np.arange(len(texts)), np.diff(offsets)), (hashes % np.uint64(BUCKETS // 2)).astype(np.int64) + side * (BUCKETS // 2)))
    owner = np.concatenate([p[0] for p in parts])
    order = np.argsort(owner, kind="stable")
    return np.concatenate([p[1] for p in parts])[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(hosts)))])


class Model:
    """Weights by bucket and a bias; a URL's logit is the sum over its n-grams
    over the root of their number."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scores(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        buckets, offsets = _features(hosts, paths)
        logit = segment_sums(self.weights[buckets], offsets) / np.sqrt(np.maximum(1, np.diff(offsets))) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def labelled_urls() -> list[tuple[str, int]]:
    """The built-in table: (host and path, 1 for block)."""
    return [(u, 1) for u in BLOCKED_URLS] + [(u, 0) for u in ALLOWED_URLS]


def train(table: Sequence[tuple[str, int]], steps: int = STEPS, penalty: float = PENALTY) -> Model:
    """Logistic regression by full gradient steps with an L2 penalty.

    ``table``: (host and path without scheme, 1 to block or 0 to allow), a
    few thousand rows at most. Without both labels the model always allows.
    """
    y = np.array([label for _, label in table], float)
    weights, bias = np.zeros(BUCKETS), 0.0
    if not len(y) or y.min() == y.max():
        return Model(weights, -10.0 if not len(y) or y[0] == 0 else 10.0)
    cuts = [(u + "/").index("/") for u, _ in table]
    hosts = pa.array([u[:c].lower() for (u, _), c in zip(table, cuts, strict=True)])
    paths = pa.array([u[c:] for (u, _), c in zip(table, cuts, strict=True)])
    buckets, offsets = _features(hosts, paths)
    size = np.sqrt(np.maximum(1, np.diff(offsets)))
    owner = np.repeat(np.arange(len(y)), np.diff(offsets))
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(segment_sums(weights[buckets], offsets) / size + bias)))
        error = (p - y) * weight
        weights -= 4.0 * (np.bincount(buckets, weights=(error / size)[owner], minlength=BUCKETS) + penalty * weights)
        bias -= 0.5 * error.sum()
    return Model(weights, float(bias))


def judge_urls(df: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES,
               model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """Host, path, rule and verdict of every URL: the rule's verdict, else the model's.

    Returns page_id, host, path, rule, verdict (allow or block) and score (the
    model's probability of block, also where a rule decides).

    Defined cases: a null URL or one without ``://`` has an empty host and path
    and gets the model's verdict on them; repeated rows give equal rows; a null
    id stays null; a URL of any length is read whole; other input columns are
    ignored; an empty table gives no rows.
    """
    model = model or train(labelled_urls())
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for rows, _ in text_chunks(batches, 2):
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(own.scores(rows.column(1), rows.column(2)))],
                                             names=[*rows.schema.names, "score"])

    parsed = df.select(F.col(id_col).cast("bigint").alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    scored = parsed.mapInArrow(run, "page_id bigint, host string, path string, score double")
    verdicts = {rule: verdict for verdict, rule in sorted(rules)}  # of one rule with both, block holds
    decided = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    for rule, verdict in verdicts.items():
        decided = F.when(F.col("rule") == rule, verdict).otherwise(decided)
    ruled = scored.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    return ruled.select("page_id", "host", "path", "rule", decided.alias("verdict"), "score")
