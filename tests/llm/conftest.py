import random

import pytest

WORDS = ["the", "of", "river", "stone", "Été", "naïve", "x1", "light", "over", "blue", "was", "and", "größe", "to",
         "seven", "walk", "field", "cloud", "paper", "quick"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """doc_id, text: nulls, empty, blank, one word, ties, repeated rows, a long text."""
    rng = random.Random(5)
    body = [(i, sentence(rng, rng.randrange(1, 60))) for i in range(40)]
    return body + [(100, None), (101, ""), (102, "  \t\n "), (103, "one"), (104, "Two WORDS"), (104, "Two WORDS"),
                   (105, "same id, first"), (105, "same id, second text"), (None, "no id at all"), (None, None),
                   (106, sentence(rng, 30_000)), (107, "日本語 の テキスト 😀 mixed ok"), (108, body[3][1]), (109, body[3][1])]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The rows with the columns of documents and extra columns whose names
    the operators use inside."""
    rows = [(i, t, "en" if k % 3 else None, None if k % 7 == 0 else f"src{k % 4}", None if t is None else len(t),
             k, "x", 1.0) for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "key long, value string, score double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
