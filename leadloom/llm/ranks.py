"""Ranks over groups of any size: buckets that follow the order are counted, and rows are numbered
within their bucket only, so that no task has to sort a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Rows that a bucket of a group holds on average if one group has all rows.
ROWS_PER_BUCKET = 100_000
LEAST_BUCKETS = 512


def bucket_count(rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET))


def unit(*columns: Column) -> Column:
    """A hash of the columns as a whole number below 2^53 (held exactly by a double)."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 53) - 1))


def unit_bucket(value: Column, buckets: int) -> Column:
    """The bucket of a ``unit`` hash; buckets follow the order of the hashes."""
    return F.floor(value / F.lit(float(1 << 53)) * buckets).cast("int")


def ranked(df: DataFrame, groups: list[str], bucket: str, order: list[str]) -> DataFrame:
    """``df`` with ``_rank`` (from 0, in the order of ``bucket``, then ``order``) and ``_size`` (rows of
    the group). ``groups`` and ``bucket`` hold no nulls. The table of counts has at most one row for
    each group and bucket; with no groups it has one row for each bucket, which one task adds up."""
    counts = df.groupBy(*groups, bucket).agg(F.count(F.lit(1)).alias("_n"))
    all_before = W.partitionBy(*groups).orderBy(bucket).rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = counts.select(
        *groups,
        bucket,
        (F.sum("_n").over(all_before) - F.col("_n")).alias("_before"),
        F.sum("_n").over(W.partitionBy(*groups)).alias("_size"),
    )
    within = W.partitionBy(*groups, bucket).orderBy(*order)
    return (
        df.join(counts, [*groups, bucket])
        .withColumn("_rank", F.col("_before") + F.row_number().over(within) - 1)
        .drop("_before")
    )
