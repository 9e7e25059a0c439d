"""Joins that keep one very frequent key from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is split when it holds more than one in MAX_HOT_KEYS of all rows and more than HOT_ROWS rows.
# Fewer than MAX_HOT_KEYS keys can meet the first condition, so the table of hot keys has a fixed
# size bound and may be broadcast.
MAX_HOT_KEYS = 20_000
HOT_ROWS = 1_000_000
MAX_PARTS = 100_000


def hot_keys(
    big: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, max_hot_keys: int = MAX_HOT_KEYS
) -> DataFrame:
    """Keys of ``big`` to split, with the number of parts each is split into. One column-pruned,
    map-side combined count."""
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    return (
        counts.filter(F.col("_n") > hot_rows)
        .join(F.broadcast(total), F.col("_n") * max_hot_keys > F.col("_total"))
        .select(*keys, F.least(F.ceil(F.col("_n") / hot_rows), F.lit(MAX_PARTS)).cast("int").alias("_parts"))
    )


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[Column],
    how: str = "inner",
    condition: Column | None = None,
    hot_rows: int = HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """``big`` joined with ``small`` on ``keys`` where single keys of ``big`` may be very frequent.

    Rows of a hot key get a part number from ``spread_by`` (a deterministic hash, so a retried task
    sends each row to the same place) and the rows of ``small`` with that key are repeated once per
    part. All other rows are in part 0. Every pair of equal keys still meets exactly once. ``how``
    may be any join type that keeps rows of ``big`` only: inner, left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} would repeat unmatched rows of the repeated side")
    hot = hot_keys(big, keys, hot_rows, max_hot_keys)
    part = F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int")
    )
    left = big.join(F.broadcast(hot), list(keys), "left").withColumn("_part", part).drop("_parts")
    right = (
        small.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
        .drop("_parts")
    )
    if condition is None:
        return left.join(right, [*keys, "_part"], how).drop("_part")
    left, right = left.alias("big"), right.alias("small")
    on = F.col("big._part") == F.col("small._part")
    for k in keys:
        on = on & (F.col(f"big.{k}") == F.col(f"small.{k}"))
    joined = left.join(right, on & condition, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop("_part")
    return joined.select("big.*", *[F.col(f"small.{c}") for c in right.columns if c not in (*keys, "_part")]).drop("_part")

