"""Session settings the library expects, and where it may cut lineage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "leadloom") -> SparkSession:
    """A session for tests and the bench; on a cluster use the session the cluster provides."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # prefer a hash join where every partition of the smaller side fits
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediates: that of ``spark.checkpoint.dir``, else that of
    ``spark.leadloom.scratch``, else a folder in the session's warehouse. Executors and driver must
    all reach it, so a path on a single machine's disk is refused where the master is not local."""
    conf = spark.conf
    named = conf.get("spark.checkpoint.dir", None) or conf.get("spark.leadloom.scratch", None)
    if named:
        return named.rstrip("/")
    root = conf.get("spark.sql.warehouse.dir").rstrip("/")
    if root.startswith(("file:", "/")) and not conf.get("spark.master", "local").startswith("local"):
        raise ValueError(
            f"intermediates would go to {root}, which executors may not share: "
            "name a shared folder in spark.checkpoint.dir or spark.leadloom.scratch"
        )
    return f"{root}/leadloom-scratch"


#: Codec of the library's Parquet files: long texts take about half of what the session's default leaves.
CODEC = "zstd"
#: Thin rows (a key or two) up to this many are broadcast; more are joined by shuffling.
BROADCAST_ROWS = 500_000


#: Has Spark delete the shuffle files of an execution as it ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Executions that begin within delete their shuffle files as they end, which would else stay until the driver happens to collect its
    garbage. For executions whose result goes to storage or to the driver, so that nothing reads their shuffles again."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back: cuts the lineage, survives the loss of
    executors, and later readers still prune columns and push filters. The shuffles that made it are freed."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)


def few(keys: DataFrame) -> bool:
    """Whether thin ``keys`` (read from storage) may be broadcast, by a count of their rows."""
    return keys.count() <= BROADCAST_ROWS


def measured_joins(spark: SparkSession) -> None:
    """Lets joins of this session broadcast a side only when its measured size is under the session's limit. Estimates go by the size of
    compressed files: long or repeated texts come out at ten times theirs and more in the driver, which collects what is broadcast.
    Sides that are small by their nature are marked where they are joined. Results do not depend on it."""
    limit, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    now = spark.conf.get(limit)
    if now != "-1":
        if spark.conf.get(measured, None) is None:
            spark.conf.set(measured, now)
        spark.conf.set(limit, "-1")


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """``df``, repartitioned by ``keys`` only where it comes in fewer partitions than the session has
    cores, so that costly expressions do not run in a handful of tasks. Large inputs have more
    partitions than that and are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
