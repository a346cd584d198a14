"""From raw documents to packed training sequences, one operator after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapwise.llm import decontaminate, language, minhash, packing, pii
from gapwise.llm.folds import remainder
from gapwise.llm.words import small_batches
from gapwise.runtime import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear."""
    small_batches(spark)
    return language.accepted(docs, language.learn(docs.where(remainder(3) != 1)))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    small_batches(spark)
    return minhash.deduplicated(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    small_batches(spark)
    return pii.masked(docs, pii.learn(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of the tokenised documents."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", deduplicate),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: Compression sizes, the trained field and the tokenizer have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the ``documents`` table; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, _ = materialize(docs, name)
    return docs
