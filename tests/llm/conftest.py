import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def made(spark):
    """Documents of a few rows: (doc_id, text, lang, source) to a table with columns that clash with inner names."""

    def build(rows, clash=True):
        full = [(i, t, lang, source, len(t) if t is not None else None) for i, t, lang, source in rows]
        df = spark.createDataFrame(full, DOCS)
        names = ("print", "key", "place", "start", "end", "size", "rank", "failed", "kind", "blob", "ids", "_group", "chance")
        if clash:
            for name in names:
                df = df.selectExpr("*", f"'x' as `{name}`")
        return df

    return build


WORDS = ["ba", "co", "di", "fu", "ge", "ha", "lo", "mi", "nu", "po", "ra", "se", "ti", "vu"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 5))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd():
    """Rows that every operator must take: nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(4)
    long = " ".join(words(rng, 30_000))
    plain = " ".join(words(rng, 80))
    return [
        (None, None, None, None),
        (None, plain, "en", None),
        (1, None, "en", "a"),
        (2, "", None, "a"),
        (3, " \n\t ", "en", "b"),
        (4, long, "de", "b"),
        (5, plain, "en", "a"),
        (5, plain, "en", "a"),
        (5, plain + " x", "en", "a"),
        (6, "é 😀 日本語 123", "fr", "ä"),
        (7, "12 34 %%", "fr", ""),
        (8, "word " * 3000, "en", "a"),
        (-9, plain, "en", "b"),
    ]
