"""Odd documents that every operator must take: nulls, empty, blank and very long texts, repeated rows, ties, and
columns whose names clash with the operators' own."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in ("score", "shard", "node", "term", "label", "kept", "length", "bucket", "n", "values", "_gone", "_key", "_mark", "row", "gone", "judged")],
    ]
)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice("abcdefghij") + draw.choice(["tion", "er", "le", "ous", "ing", "a"]) + str(draw.randrange(40)) for _ in range(words))


def odd_rows() -> list[tuple]:
    long = prose(1, 30_000)
    texts = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "b"), (5, "one", "b"), (6, "ONE", "b"),
        (7, long, "c"), (8, long + " more", "c"), (9, "żółć 中文　字   😀 <|endoftext|> don't", None), (10, prose(2, 60), "a"),
        (10, prose(2, 60), "a"), (None, prose(2, 60), "a"), (None, None, None), (12, "x" * 40_000, "d"), (13, "a b c d", "d"),
    ]
    return [(i, t, s, *["?"] * 16) for i, t, s in texts]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
