"""Small tables with the awkward rows every text operator must take."""

import random

WORDS = ["the", "river", "stone", "quietly", "über", "señal", "forêt", "lamp", "seven", "winds", "garden"]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def awkward(spark, extra=()):
    """Nulls, empty and very long texts, repeated rows and ids, and columns that clash."""
    rng = random.Random(5)
    long = sentence(rng, 30_000)
    rows = [
        (1, "plain words about nothing", "en"),
        (1, "plain words about nothing", "en"),
        (1, "another text under the same id", None),
        (2, None, None),
        (3, "", "en"),
        (4, " \n\t ", "de"),
        (None, "a text without an id", "en"),
        (5, "12345 !!! ???", "en"),
        (6, long, "en"),
        (7, long + " end", "en"),
        (8, "a" * 3000, "xx"),
        *extra,
    ]
    clash = [(*r, "c", 1, 2.0, "n") for r in rows]
    return spark.createDataFrame(
        clash,
        "doc_id long, text string, lang string, th string, fp int, score double, spans string",
    )


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
