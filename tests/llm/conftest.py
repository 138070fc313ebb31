from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties."""
    long = " ".join(f"word{i % 997} and{i}" for i in range(30_000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \t\n ", "en", "s", 4),
        (4, "one", "en", "s", 3),
        (4, "one", "en", "s", 3),
        (5, "the same words again and again the same words again and again", "en", None, 5),
        (6, "the same words again and again the same words again and again", "en", "s", 5),
        (None, "a text without an id of its own that is long enough to pass the rules", "en", "s", 5),
        (7, "Grüße aus der Straße, 1234 + 5678 = ½ … 漢字 😀 <|endoftext|> it's they'll 'S", "de", "s", 5),
        (8, "line one here\nline one here\n\nline two\r\nline one here", "fr", "s", 5),
        (9, "#*$%&|<>" * 40, "en", "s", 320),
        (10, long, "en", "s", len(long)),
        (11, "x" * 50_000, "en", "s", 50_000),
        (-3, "negative id with a few words in it to be kept as it is here", "en", "s", 5),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge_documents):
    """The same with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ("n_tokens", "score", "rank", "shard", "piece", "key", "n", "label", "path", "host", "node", "part", "held_out")
    return edge_documents.withColumns({c: F.lit("taken") for c in names})


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
