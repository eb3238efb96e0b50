from __future__ import annotations

import random

import pytest

WORDS = "the of and to river stone light under window carry seven morning paper quiet green walk hold open letter".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns named like results."""
    rng = random.Random(3)
    long = prose(rng, 60_000)
    rows = [
        (1, prose(rng, 80), "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "en", "b"),
        (5, long, "en", "a"), (6, "x" * 5000, "en", "a"), (None, prose(rng, 60), "en", "a"), (None, None, None, None),
        (7, "same text here for both of them", "en", "b"), (7, "same text here for both of them", "en", "b"),
        (8, "one\ntwo\none\n\n", "de", "b"), (9, "É à ß token = \"abcdef123\" İ <|endoftext|> \x00", "de", "a"),
    ]
    clashing = "long as score, int as shard, string as kept, string as spans, string as host, string as text_key, " \
        "int as salt, string as class, int as label, string as line, string as whole"
    extra = ", ".join(f"cast(null as {c.split(' as ')[0]}) as `{c.split(' as ')[1]}`" for c in clashing.split(", "))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
        "*", "cast(length(text) as bigint) as n_chars", *extra.split(", ")
    ).coalesce(2)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
