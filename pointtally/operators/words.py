"""Word counting over documents (one document = one line).

Input is the token table of :func:`pointtally.sources.document_tokens`:
``(doc_id, line_no, word)``.  All three word-count forms give the same
result; they differ in how the first round is keyed, which matters only for
how work spreads, and Spark's partial aggregation already pre-combines each
task's tokens before the shuffle (a word that is a third of all tokens costs
one row per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointtally.functions.hashing import stable_bucket
from pointtally.functions.tokens import line_count


def document_count(lines: DataFrame) -> DataFrame:
    """Number of documents (lines), ``(document_count BIGINT)``."""
    return lines.agg(F.count(F.lit(1)).alias("document_count"))


def text_document_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same over multi-line texts, without making a row per line; null texts have no lines."""
    return docs.agg(F.coalesce(F.sum(line_count(F.col(text))), F.lit(0)).cast("bigint").alias("document_count"))


def word_count(tokens: DataFrame) -> DataFrame:
    """``(word, n)``: occurrences of each word, one shuffle."""
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def with_salt(lines: DataFrame, k: int) -> DataFrame:
    """Lines with their ``salt``: a hash of ``(doc_id, line_no)`` into ``k`` buckets, made once per line."""
    if k <= 0:
        raise ValueError(f"number of salt buckets must be positive, got {k}")
    return lines.withColumn("salt", stable_bucket(k, "doc_id", "line_no"))


def word_count_salted(tokens: DataFrame, k: int) -> DataFrame:
    """Two rounds: count per ``(salt, word)``, then sum per word.

    The salt is that of the token's line (:func:`with_salt`, made before the
    lines were split into tokens; added here where it is missing), so all
    copies of a word in one document share a salt, as the reference's per-
    document map does, and a retried task picks the same salt.
    """
    if k <= 0:
        raise ValueError(f"number of salt buckets must be positive, got {k}")
    salted = tokens if "salt" in tokens.columns else with_salt(tokens, k)
    partial = salted.groupBy("salt", "word").agg(F.count(F.lit(1)).alias("n"))
    return partial.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def word_count_partitioned(tokens: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Two rounds: count per ``(physical partition, word)``, then sum per word.

    The first round is the partial aggregate of the task that reads the
    partition: one row per partition and word, without an exchange.  With
    ``num_partitions`` the tokens are dealt to that many partitions first; it
    is cheaper to deal the documents before they are split
    (:func:`pointtally.sources.deal`).
    """
    words = tokens.select("word")
    if num_partitions is not None:
        if num_partitions <= 0:
            raise ValueError(f"number of partitions must be positive, got {num_partitions}")
        words = words.repartition(num_partitions)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def distinct_words(counts: DataFrame) -> DataFrame:
    """Number of distinct words, ``(distinct_words BIGINT)``, from a word-count result."""
    return counts.agg(F.count(F.lit(1)).alias("distinct_words"))


def avg_word_length(counts: DataFrame) -> DataFrame:
    """Average length of the *distinct* words, integer division, ``(avg_word_length BIGINT)``.

    Unweighted by occurrences, truncated like Java's ``int / long``; null when
    there are no words.  ``length`` counts code points (Java counts UTF-16
    units; they differ only for characters outside the BMP).
    """
    agg = counts.agg(
        F.sum(F.length("word").cast("bigint")).alias("total"),
        F.count(F.lit(1)).alias("words"),
    )
    return agg.select(
        F.when(F.col("words") > 0, F.expr("total div words")).cast("bigint").alias("avg_word_length")
    )
