"""Corpus pipeline: classify, deduplicate, decontaminate, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet to the shared folder and read back as the next one's docs.
All but the last return the columns of ``documents``.

Every stage takes all rows its predecessor kept.  Null and empty texts count as
texts without words; rows of repeated or null ids are rows like any other;
columns beyond ``doc_id`` and ``text`` are carried along (and dropped by the
last stage); an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pointtally.llm import decontaminate, jaccard, packing, quality
from pointtally.llm.common import stored


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps: neither of low quality nor toxic.

    Each row is judged by its own whole text; a text without words is judged by
    the scorer's intercept and shape features alone; log odds of exactly 0 go.
    """
    return quality.keep_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates (five-word shingles, similarity 0.8).

    The row of the smallest id stays (one of them, where rows are repeated); a
    row without an id only where its group has no other.  Texts without words
    are in no group and stay.
    """
    return jaccard.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    A document goes when a twentieth of its words or more are hit; exactly a
    twentieth goes too.  Texts without words stay.
    """
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of the permitted lengths, in tokens.

    A null or empty text is one piece, its end id; pieces of equal length are
    placed by ascending id, rows without an id last; very long texts are cut
    into full sequences and a rest.
    """
    import public_tokenizers

    return packing.pack(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("classify", classify),
    ("deduplicate", deduplicate),
    ("remove_benchmark", remove_benchmark),
    ("pack", pack),
]

# The classifier is trained and the packing is greedy: neither is expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
