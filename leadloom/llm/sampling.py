"""A bounded, class-balanced sample of labelled texts to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class that a fit uses at most.
ROWS_PER_CLASS = 4096


def remainder(key: str, modulus: int):
    """crc32 of the key's decimal text, modulo ``modulus``; a null key gives null."""
    return F.crc32(F.col(key).cast("string")) % modulus


def sampled_texts(docs: DataFrame, sample: DataFrame, key: str, text: str) -> DataFrame:
    """``_key``, ``_label`` and ``_text`` of the sampled keys, one row a key: of differing texts under one key that with the smallest hash.
    However often a key is repeated, tasks send on one text of it each."""
    picked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(sample), "_key")
    return picked.groupBy("_key").agg(F.max("_label").alias("_label"), F.min_by("_text", F.xxhash64("_text")).alias("_text"))


def labels_by_key(labels: DataFrame, label: str, key: str) -> DataFrame:
    """``_key`` and ``_label``, one row a key: labels other than 0 and 1 and null keys are left out; a key with several labels takes the largest."""
    return (
        labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
        .where("_key is not null and _label in (0, 1)")
        .groupBy("_key")
        .agg(F.max("_label").alias("_label"))
    )


def labelled_sample(labels: DataFrame, label: str, key: str, rows_per_class: int) -> tuple[DataFrame, float]:
    """At most ``rows_per_class`` keys of each class (those with the smallest hashes), and the share of
    class 1 among all. Labels other than 0 and 1 and null keys are left out; a key with several labels
    takes the largest. The sample has a bounded number of rows and may be broadcast."""
    clean = labels_by_key(labels, label, key)
    counts = {r["_label"]: r["count"] for r in clean.groupBy("_label").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    picked = [
        clean.where(F.col("_label") == c).orderBy(F.xxhash64("_key"), "_key").limit(rows_per_class) for c in (0, 1)
    ]
    return picked[0].unionByName(picked[1]), share
