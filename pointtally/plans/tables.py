"""Loading the driver's parquet tables into the operators' input shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointtally.runtime import spread
from pointtally.sources.text import deal, document_lines, document_tokens, points_from_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as labelled pairs: ``event_id`` is the index, ``event_type`` the class."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("class"))


def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` rendered as the reference's ``"<index> <class>"`` text lines."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.concat_ws(" ", F.col("event_id").cast("string"), F.col("event_type")).alias("value"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` split into lines (one reference document per line), small inputs spread over the slots."""
    return document_lines(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def dealt_tokens(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Tokens of ``documents`` dealt to ``k`` partitions before they are split."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return document_tokens(document_lines(deal(docs, "doc_id", k)))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tokens(lines(spark, sf_dir))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as points ``(id, v ARRAY<DOUBLE>)``."""
    return points_from_table(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def part_point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` rendered as ``"<size>,<price>"`` point lines, keyed by ``p_partkey``."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.concat_ws(",", F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")).alias("value"),
    )


def part_point_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` rendered as free text holding two whitespace-separated point tokens per row."""
    p = table(spark, sf_dir, "part")
    size, price = F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")
    value = F.concat(F.lit(" "), size, F.lit(","), price, F.lit("\t "), price, F.lit(","), size, F.lit("\n"))
    return p.select("p_partkey", value.alias("value"))
