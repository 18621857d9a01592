import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls in every column, empty and blank texts, one very long text, repeated rows and ids."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "ette", "theta", "jota", "kappa", "über", "naïve"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base = text(120)
    long = text(60_000)
    rows = [(1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1),
            (3, base[:300] + " other " + base[300:], "en", None, 1), (4, None, "de", "b", None), (5, "", None, "b", 0),
            (6, " \n\t ", None, None, 4), (None, base, None, "a", 1), (None, "only one", None, "a", 1), (7, long, "en", "c", 1),
            (8, "x" + long[5000:9000], "en", "c", 1), (9, "one two", "fr", "a", 7), (10, "12345 !!", "fr", "a", 8)]
    rows += [(i, text(rng.randrange(1, 90)), rng.choice(["en", "de", None]), rng.choice("abc"), None) for i in range(20, 60)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
