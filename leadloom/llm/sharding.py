"""Shards that each hold the mixture of the whole: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.ranks import bucket_count, ranked, unit, unit_bucket
from leadloom.session import written

SEED = 20_240_229


def interleave(
    docs: DataFrame, shards: int, seed: int = SEED, stratum: str = "source", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the key, ``size`` (UTF-8 bytes of the text and 1), ``text_crc32``,
    ``stratum``, ``shard`` (0 to shards - 1) and ``slot`` (place in the shard, gapless from 0).

    Rows are shuffled within each stratum by a seeded hash and ranked. A row's fraction is its rank
    less an offset of its stratum (a hash in (0, 1), which spreads strata of a single row), over
    the stratum's rows. All rows in the order of fractions are cut into shards whose
    counts differ by one at most, so each shard holds each stratum in proportion.

    Nulls: a null text has no bytes and the checksum of the empty text; the rows with a null stratum
    are a stratum; null keys are rows like others. Repeated rows are all placed. Ties go by
    stratum, hash, key and checksum. An empty table gives no rows. Only the named columns are read.
    Both ranks are computed by buckets, so a stratum may hold any share of the rows.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    thin = written(
        docs.select(
            F.col(key).alias("_key"),
            (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum"),
            F.col(stratum).isNull().alias("_none"),
        ).withColumn("_hash", unit(F.lit(seed), F.col("_key"), F.col("text_crc32"), F.col("size"))),
        "interleave",
    )
    rows = thin.count()
    buckets = bucket_count(rows)
    strata = ["_none", "_stratum"]
    order = ["_hash", "_key", "text_crc32", "size"]
    by_stratum = ranked(thin.withColumn("_at", unit_bucket(F.col("_hash"), buckets)), strata, "_at", order)
    offset = (unit(F.lit(seed), F.lit("offset"), *map(F.col, strata)) + 0.5) / float(1 << 53)
    spread = (
        by_stratum.withColumn("_share", (F.col("_rank") + 1 - offset) / F.col("_size"))
        .withColumn("_at", F.least(F.floor(F.col("_share") * buckets), F.lit(buckets - 1)).cast("int"))
        .drop("_rank", "_size")
    )
    placed = ranked(written(spread, "interleave"), [], "_at", ["_share", *strata, *order])
    first = F.expr(f"cast(_shard * _size as long) div {shards} + if((_shard * _size) % {shards} = 0, 0, 1)")
    return (
        placed.withColumn("_shard", F.expr(f"(_rank * {shards}) div _size"))
        .withColumn("_slot", F.col("_rank") - first)
        .select(
            F.col("_key").alias(key),
            "size",
            "text_crc32",
            F.when(~F.col("_none"), F.col("_stratum")).alias("stratum"),
            F.col("_shard").cast("int").alias("shard"),
            F.col("_slot").alias("slot"),
        )
    )


def op4_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleave(spark.read.parquet(f"{sf_dir}/documents.parquet"), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "stratum",
    )
