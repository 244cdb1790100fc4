import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, digest string, fp long, token string, size long, score double, rid long, part int"


@pytest.fixture(scope="session")
def make(spark):
    """Documents out of (doc_id, text[, lang, source]), with further columns whose names operators use themselves."""

    def docs(rows):
        full = [(*r, *["en", "s"][len(r) - 2 :], 0, 7, "k", "d", 7, "t", 7, 0.5, 7, 7) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return docs


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and long texts, ties, repeated rows, rows that share an id."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Über", "naïve", "the", "of"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    a, b = prose(40), prose(60)
    return [
        (1, a, "en", "x"), (2, a, "en", "x"), (2, a, "en", "x"), (3, b, "de", None), (3, "another text", "de", None), (4, None, None, None), (5, "", "en", "y"),
        (6, " \t\n", "en", "y"), (7, b + " tail", "de", "y"), (8, "12 34 !!", None, "z"), (9, prose(5000), "en", "z"), (10, "x" * 200_000, "en", "z"), (None, "no id here", "en", "x"), (None, None, None, None), (11, "日本語 текст", "xx", "x"),
    ]
