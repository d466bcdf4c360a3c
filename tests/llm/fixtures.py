"""Small tables with every awkward row, shared by the tests of the training-data operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("k", "k_id", "k_text", "row", "size", "key", "gone", "node", "h")]])
TOPICS = [("the of and to in is that river stone light winter harbour").split(), "le la et les des une que pour maison jardin".split()]


def sentence(rng: random.Random, n: int) -> str:
    words = TOPICS[rng.random() < 0.3]
    return " ".join(rng.choice(words) + rng.choice(["", "", str(rng.randint(0, 40)) + "x"]) for _ in range(n)) + "."


def rows(seed: int = 1, n: int = 40) -> list[tuple]:
    rng = random.Random(seed)
    made = []
    for i in range(n):
        text = "\n".join(sentence(rng, rng.randint(4, 14)) for _ in range(rng.randint(3, 9)))
        made.append([i * 3, text, f"s{i % 4}"])
    shared = "\n".join(sentence(rng, 12) for _ in range(4))
    for i in (5, 9, 21):
        made[i][1] += "\n" + shared
    for i in (30, 31, 32):  # near copies
        made[i][1] = made[7][1] + f" word{i}"
    made[33][1] = made[34][1] = made[3][1]  # exact copies
    made += [[200, None, "s1"], [201, "", "s1"], [202, " \n\t \n", "s2"], [203, "one", None], [204, "one two", None], [205, "a\nb\nc\nb\nc\na\nb\nc", "s3"],
             [206, (sentence(rng, 9) + "\n") * 60, "s0"], [207, "é " * 400 + "😀" * 300, "s2"], [None, "no id here at all but some words", "s1"], [None, None, None]]
    made.append(list(made[4]))  # a row twice
    made.append([made[6][0], "another text under the same id", "s0"])
    return [(i, t, "en", s, len(t or ""), *["clash"] * 9) for i, t, s in made]


def table(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
