import random

import pytest

#: Names that operators add or use inside.
CLASHING = ["size", "score", "n_words", "copies", "node", "key", "root", "place", "target", "_text", "text_crc32"]


def sentence(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, source): nulls, empty and blank texts, repeated rows and ids, copies, a very long text."""
    r = random.Random(3)
    base, long = sentence(r, 120), sentence(r, 30_000)
    return [
        (1, base, "a"), (2, base, "b"), (3, None, "a"), (4, "", None), (5, " \n\t ", ""), (6, long, "a"), (7, "one two three", "a"),
        (7, "one two three", "a"), (8, "One TWO three", "b"), (9, sentence(r, 40) + " " + base, None), (None, base, "a"),
        (None, None, None), (10, "Émile… ünïcode ﬁ ’s x́ <|endoftext|> don't", "c"), (10, sentence(r, 60), "c"), (11, base + " tail", "b"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    rows = [(*row, *range(len(CLASHING))) for row in odd_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} int" for c in CLASHING))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
