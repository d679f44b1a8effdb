"""Rows that no operator may stumble over, alone and beside ordinary ones."""

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, score double, "
          "print long, fingerprint string, shard int, slot long, _row long, copies int, block int")


def prose(rng: random.Random, words: int) -> str:
    syllables = "the an on er re tion ing ly ent is at or".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) + rng.choice(["", "", "", "."])
                    for _ in range(words))


def rows() -> list[tuple]:
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    texts += [texts[0], texts[1], "", "", " \t\n ", None, None, "one", "two words", "ÄÖ ß 漢字 \U0001F600 x",
              prose(rng, 30_000), "A" * 70_000, "!!! " * 500]
    made = [(i, text, "en", ["a", "b", None][i % 3], len(text or ""), 7, 0.1, 3, "f", 1, 2, 3, 4, 5)
            for i, text in enumerate(texts)]
    made += [made[3], made[3], (None, "no id", "en", "c", 5, 7, 0.1, 3, "f", 1, 2, 3, 4, 5),
             (None, None, None, None, None, None, None, None, None, None, None, None, None, None)]
    made += [(200 + i, "the same text again and again", "en", "hot", 1, 7, 0.1, 3, "f", 1, 2, 3, 4, 5) for i in range(30)]
    return made


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
