import random

import pytest

SYLLABLES = {"en": "the er on an re he in ed nd ha", "de": "der ein sch ung lich ver kei ten zu be"}


@pytest.fixture(scope="session")
def words():
    """Seeded made-up text of n words in one of two languages."""

    def make(n, seed, lang="en"):
        rng = random.Random(f"{seed}-{lang}")
        parts = SYLLABLES[lang].split()
        return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_rows(words):
    """Nulls, blanks, repeats, a very long text, and a key on two rows."""
    long = words(30_000, 99)
    return [
        (1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (None, words(80, 1), "en"), (4, words(80, 2), "en"),
        (4, words(80, 2), "en"), (5, words(80, 2), None), (4, words(80, 3), "en"), (6, long, "en"), (7, "x", "de"),
    ]


@pytest.fixture()
def docs(spark):
    """Documents with columns whose names the operators use themselves."""

    def make(rows):
        schema = (
            "doc_id long, text string, lang string, n long, cls binary, shard int, score double, token long, "
            "row long, rid long, kept boolean, perplexity double, tox_score double, lang_pred string, offset long"
        )
        return spark.createDataFrame([(*r, *[None] * 12) for r in rows], schema)

    return make
