"""A corpus from raw documents to packed sequences, in five stages.

Each stage works on all documents that the one before it kept; its result is written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadloom.llm import decontamination, minhash, packing, quality, toxicity
from leadloom.llm.worker import small_batches
from leadloom.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking accepts. It learns from all labelled documents.
    Rows are judged each by its own text: null and empty texts as the empty one, equal texts alike, also under a repeated or null key. Without labels of
    both classes all stay; an empty table stays empty. Extra columns pass through."""
    small_batches(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not take for toxic; it learns as the first stage does.
    Odd rows, labels and tables are taken as there."""
    small_batches(spark)
    machine = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.remove_toxic(docs, machine)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id.
    Texts without words are like nothing and stay, as rows without a key do; equal rows of one key leave one; differing texts under one key are judged each by itself.
    An empty table stays empty; extra columns pass through."""
    small_batches(spark)
    return minhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whether as a copy or as a paraphrase.
    Removal goes by row; null and empty texts and rows without a key stay. An empty table on either side changes nothing; extra columns pass through."""
    small_batches(spark)
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens.
    A null or empty text is its end mark alone; repeated rows and null keys are packed each; an empty table gives no rows; extra columns are not read."""
    small_batches(spark)
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: The stages learn models and merge near-duplicates, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
