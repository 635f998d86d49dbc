"""A corpus pipeline of five stages over ``documents``, each a call of one operator of ``bourse.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bourse.llm.common import table
from bourse.llm.decontam import clean_documents
from bourse.llm.mixing import mixed_documents
from bourse.llm.quality import kept_documents
from bourse.llm.simhash import one_per_group
from bourse.llm.wavelet import token_table, tokenizer_file
from bourse.session import scratch_path, shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id."""
    shared_dir(spark)
    return one_per_group(docs, k=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    shared_dir(spark)
    return clean_documents(docs, table(spark, sf_dir, "benchmark"), window=10)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that source, language and topic meet their target shares."""
    shared_dir(spark)
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept texts as token ids in wavelet-matrix shards; what the files hold, per document."""
    shared_dir(spark)
    return token_table(docs, tokenizer_file("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

# No SQL: suffix arrays, SimHash components and wavelet files are not expressible; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
