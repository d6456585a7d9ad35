import random

import pytest

#: Names that operators use inside, or for what they return, as extra columns of the input.
CLASHING = ["fp", "n_words", "spans", "items", "d", "th", "t", "row__", "c0", "k0", "t__", "size", "shard", "row", "x",
            "words", "runs", "n_removed", "ids", "n_tokens", "kept", "root", "toxic"]


def edge_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(7)
    vocab = ["the", "of", "and", "la", "der", "alpha", "Beta", "gamma", "über", "naïve", "日本", "x1", "*"]
    prose = lambda n: " ".join(rng.choice(vocab) + str(rng.randrange(40)) for _ in range(n))
    long_text = "\n".join(prose(30) for _ in range(400))
    shared = "\n".join([prose(30), prose(30), "short line"])
    rows = [
        (1, prose(80), "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (4, "   \n\t ", "de", "b", 5),
        (None, prose(60), "en", "a", 9), (None, None, "en", "a", 9), (5, long_text, "en", "a", 10**6),
        (6, shared, "en", "a", 7), (7, "intro\n" + shared + "\noutro", "en", "b", 7), (8, shared, "fr", "a", 7),
        (8, shared, "fr", "a", 7), (9, shared + "\n" + shared, "fr", "a", 7), (10, "one", "es", "c", 3),
        (11, "one two", "es", "c", 7), (12, "A\x00b▁c 　 d\r\ne", "en", "c", 9), (13, "🎉" * 50, "en", "c", 50),
        (-5, prose(80), "en", "a", 400), (14, prose(55) + "\n\n" + prose(55), "en", "a", 400),
    ]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def wide(edges):
    """The same documents with extra columns whose names clash."""
    from pyspark.sql import functions as F
    return edges.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    """Sorted (doc_id, columns...) with nulls first, for comparison as a multiset."""
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=repr)
