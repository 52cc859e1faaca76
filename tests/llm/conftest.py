from __future__ import annotations

import random

import pytest

LEXICON = [a + b for a in "ba ke li mo nu ra se ti vo zu da fe".split() for b in ("n", "r", "st", "l", "m", "th", "", "nd")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int) -> str:
    out, n = [], 0
    while n < words:
        k = min(words - n, rng.randint(4, 12))
        out.append(" ".join(rng.choice(LEXICON) for _ in range(k)).capitalize() + ".")
        n += k
    return " ".join(out)


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in every column, empty and blank texts, repeated rows, copies, near copies, one long text, odd signs."""
    rng = random.Random(4)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    shared = prose(rng, 70)
    rows = [
        (1, base, "en", "a", len(base)),
        (2, base, "en", "a", len(base)),
        (3, " ".join(near), "en", "b", 1),
        (4, None, None, "a", None),
        (5, "", "en", None, 0),
        (6, " \t\n ", "en", None, 4),
        (7, "one two", "en", "b", 7),
        (8, prose(rng, 40) + " " + shared + " " + prose(rng, 30), "en", "c", 0),
        (9, prose(rng, 50) + " and then " + shared + "\n" + prose(rng, 20), "en", "c", 0),
        (None, prose(rng, 60), "en", "a", 0),
        (None, None, None, None, None),
        (11, prose(rng, 30000), "en", "a", 0),
        (12, "word " * 4000, "en", "a", 0),
        (13, "été \U0001f600 你好 $$$ " * 30, "fr", "d", 0),
        (14, prose(rng, 90), "en", "c", 0),
        (14, prose(rng, 90), "en", "c", 0),
        (15, base, "en", "a", len(base)),
        (15, base, "en", "a", len(base)),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf(spark):
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def some(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
