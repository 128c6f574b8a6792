"""Texts and rows the tests of the corpus operators share."""

import random

import pytest

SYLLABLES = ["an", "er", "ti", "on", "re", "ou", "st", "ha", "ing", "ble", "é", "ß", "nd", "ly"]


def prose(rng: random.Random, n: int) -> str:
    """``n`` invented words with line breaks."""
    out = []
    for _ in range(n):
        out.append("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))))
        out.append("\n" if rng.random() < 0.03 else " ")
    return "".join(out).strip()


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, white space, one very long text, repeated rows, ties, a null id."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    rows = [
        (1, prose(rng, 200)), (2, None), (3, ""), (4, "  \n\t "), (5, "one two"), (6, "One  two"), (7, long),
        (8, long + " tail"), (9, "x" * 50_000), (10, prose(rng, 80)), (10, "same id, other text"),
        (11, "twice the same row"), (11, "twice the same row"), (None, "a row without id"), (12, "a　b  c\x85d"),
        (13, "'s <|endoftext|> 1a2b don't\x1c?"), (0, prose(rng, 2)), (14, "Ünï cödé " * 40),
    ]
    return [(i, t, "en", f"src{k % 3}", len(t or ""), "clash", 7, "clash", 1.5, 3) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """Those rows with further columns whose names the operators use inside."""
    return spark.createDataFrame(
        odd_rows,
        "doc_id long, text string, lang string, source string, n_chars long, key string, node long, "
        "hash string, score double, `_doc` int",
    )


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
