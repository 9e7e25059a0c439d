"""Connected components of a graph given by its links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.session import written


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step. Neighbourhoods are never gathered: a node's smallest neighbour
    is a combined minimum, and links meet it by a join, so a node of any degree is spread over tasks."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("_m"))
    small = large.join(least, "a").where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return small.unionByName(least.select("a", F.col("_m").alias("b"))).distinct()


def _is_done(links: DataFrame) -> bool:
    """Whether every node leads to one other only, and that one leads nowhere."""
    n = links.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("a").alias("a")).first()
    if n["n"] != n["a"]:
        return False
    inner = links.select(F.col("b").alias("_b")).distinct()
    return inner.join(links.select("a"), F.col("_b") == F.col("a"), "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) for every node of ``links`` but the smallest
    ones themselves. ``links``: columns ``a`` and ``b`` of whole numbers, in either order; links of a node
    with itself and nulls are left out."""
    now = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = None
    while not _is_done(now):
        now = written(_stars(now), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
