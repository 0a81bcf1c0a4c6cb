"""Text sources and parsers.

The reference reads plain text with ``textFile`` and parses each line in a
lambda; here a scan is ``spark.read.text`` and every parse is a column
expression, so parsing runs inside the scan's codegen stage.

Identity: the reference identifies a point by its position in a list.  Text
rows get an explicit 0-based ``id`` in scan order from :func:`with_row_index`
(the DataFrame form of ``RDD.zipWithIndex``), computed once per scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointtally.functions.distance import vector_size_stats
from pointtally.functions.ranges import with_start
from pointtally.functions.tokens import java_space_split, split_lines, strict_int
from pointtally.runtime import fits_broadcast

# The token separator of java.util.Scanner (any Java whitespace).
SCANNER_DELIMITER = r"\p{javaWhitespace}+"

_PID = "__pt_pid"
_MID = "__pt_mid"


def with_row_index(df: DataFrame, name: str = "id") -> DataFrame:
    """Add a dense 0-based BIGINT ``name`` in scan order.

    One small job counts rows per partition (one row per partition reaches the
    driver), the prefix sums become a small table of offsets, and each row's
    index is ``offset[partition] + position in partition``.  Nothing is
    collected per row and no single task sees all rows.  The scan order of
    ``df`` must be deterministic (a file scan is).
    """
    spark = df.sparkSession
    tagged = df.withColumn(_PID, F.spark_partition_id()).withColumn(_MID, F.monotonically_increasing_id())
    counts = sorted(
        (r[0], r[1]) for r in tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("c")).collect()
    )
    offsets, running = [], 0
    for pid, c in counts:
        offsets.append((pid, running))
        running += c
    if not offsets:
        return df.withColumn(name, F.lit(None).cast("bigint")).limit(0)
    off = spark.createDataFrame(offsets, f"{_PID} int, __pt_off bigint")
    first_in_part = F.shiftleft(F.col(_PID).cast("bigint"), 33)
    if not fits_broadcast(spark, len(offsets), 24):
        off = off.hint("shuffle_hash")
    else:
        off = F.broadcast(off)
    return (
        tagged.join(off, _PID)
        .withColumn(name, F.col("__pt_off") + (F.col(_MID) - first_in_part))
        .drop(_PID, _MID, "__pt_off")
    )


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``textFile``: one row per line, ``(id BIGINT, value STRING)``, id = line index."""
    lines = spark.read.text(path)
    return with_row_index(lines).select("id", "value")


# ---------------------------------------------------------------- labelled pairs


def parse_pairs(lines: DataFrame, value: str = "value") -> DataFrame:
    """``"<int> <class>"`` lines → ``(id BIGINT, class STRING)``.

    Split on a single space with Java's rules; token 0 must be an integer and
    token 1 must exist, otherwise the job fails; further tokens are ignored.
    """
    toks = java_space_split(F.col(value))
    first = F.get(toks, 0)
    second = F.get(toks, 1)
    return lines.select(
        strict_int(first, "pair index").alias("id"),
        F.when(second.isNotNull(), second)
        .otherwise(F.raise_error(F.concat(F.lit("pair line without class: "), F.col(value))))
        .alias("class"),
    )


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Labelled-pair text file → ``(id, class)``."""
    return parse_pairs(spark.read.text(path))


# ---------------------------------------------------------------- documents


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per line → ``(doc_id BIGINT, text STRING)``."""
    return read_text_lines(spark, path).select(F.col("id").alias("doc_id"), F.col("value").alias("text"))


def deal(df: DataFrame, id_col: str, num_partitions: int) -> DataFrame:
    """``repartition(K)``: row ``id`` goes to partition ``pmod(id, K)``, a null id to the first."""
    if num_partitions <= 0:
        raise ValueError(f"number of partitions must be positive, got {num_partitions}")
    at = F.coalesce(F.pmod(F.col(id_col), F.lit(num_partitions)), F.lit(0))
    return df.repartitionById(num_partitions, at.cast("int"))


def write_lines(lines: DataFrame, folder: str, line: str = "line") -> str:
    """Write a text column as text files, one row per line; returns the path of the new folder."""
    path = f"{folder.rstrip('/')}/lines-{uuid.uuid4().hex}"
    lines.select(F.col(line).alias("value")).write.text(path)
    return path


def document_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Table rows whose text holds line breaks → one row per line.

    A document of the reference is a *line*; the result is
    ``(doc_id, line_no, line)`` with ``line_no`` 0-based within the row.
    """
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.posexplode(split_lines(F.col(text))).alias("line_no", "line"),
    ).withColumn("line_no", F.col("line_no").cast("bigint"))


def document_tokens(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines → one row per token (``word``), keeping the other columns."""
    others = [c for c in lines.columns if c != line]
    return lines.select(*others, F.explode(java_space_split(F.col(line))).alias("word"))


# ---------------------------------------------------------------- points


def parse_point_line(value: Column) -> Column:
    """``"x,y,..."`` → ``ARRAY<DOUBLE>``, like ``Vectors.dense(line.split(","))``.

    Trailing empty fields are dropped (Java's split), a line of commas only is
    the empty vector, and an empty field elsewhere or a bad number fails the
    job (ANSI cast) or, with ANSI off, becomes null and is caught by
    :func:`validate_points`.
    """
    stripped = F.regexp_replace(value, ",+$", "")
    fields = (
        F.when((stripped == F.lit("")) & (value != F.lit("")), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, ","))
    )
    return F.transform(fields, lambda t: t.cast("double"))


def parse_points(lines: DataFrame, id_col: str = "id", value: str = "value") -> DataFrame:
    """Lines with an id → ``(id BIGINT, v ARRAY<DOUBLE>)`` (one point per line)."""
    return lines.select(F.col(id_col).cast("bigint").alias("id"), parse_point_line(F.col(value)).alias("v"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """One point per line, id = 0-based line index."""
    return parse_points(read_text_lines(spark, path))


def scan_point_tokens(lines: DataFrame, value: str = "value", order_by: str | None = None) -> DataFrame:
    """Whitespace-separated point tokens anywhere in the text → ``(id, v)``.

    This is the reference's ``Scanner``-based CSV reader: tokens are split on
    any Java whitespace (newlines included), empty tokens do not exist, and
    each token is a comma-separated point.  ``id`` is the token's 0-based
    position in the order of the integer column ``order_by`` (default: scan
    order), then in the row.  With ``order_by`` each row's first position comes
    from running token counts; no token is sorted and nothing is cached.
    """
    toks = F.filter(F.split(F.col(value), SCANNER_DELIMITER), lambda t: t != F.lit(""))
    if order_by is None:
        one = lines.select(F.explode(toks).alias("__pt_tok"))
        return with_row_index(one, "id").select("id", parse_point_line(F.col("__pt_tok")).alias("v"))
    rows = lines.select(order_by, toks.alias("__pt_toks")).filter(F.size("__pt_toks") > 0)
    started = with_start(rows, "__pt_start", F.col(order_by), [order_by], F.size("__pt_toks"))
    return started.select("__pt_start", F.posexplode("__pt_toks").alias("__pt_pos", "__pt_tok")).select(
        (F.col("__pt_start") + F.col("__pt_pos")).alias("id"), parse_point_line(F.col("__pt_tok")).alias("v")
    )


def read_point_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file whitespace-token point scan of a text file."""
    return scan_point_tokens(spark.read.text(path))


def points_from_table(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """A table with an id and a numeric array → ``(id BIGINT, v ARRAY<DOUBLE>)``.

    The cast to double happens before any arithmetic (``embeddings`` stores
    ``ARRAY<FLOAT>``).
    """
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))


def validate_points(points: DataFrame, v: str = "v", shape: tuple[int, int] | None = None) -> tuple[int, int]:
    """One aggregate pass: ``(n, dim)``; raise on mixed dimension, null or NaN.

    ``shape`` is a result an earlier step already established for these very
    rows (e.g. centers chosen by an operator); it is returned as is.
    """
    if shape is not None:
        return shape
    row = points.agg(*vector_size_stats(v)).first()
    n = int(row["n"])
    if n == 0:
        return 0, 0
    if row["n_bad"]:
        raise ValueError(f"{row['n_bad']} point(s) have a null or NaN coordinate")
    if row["min_dim"] != row["max_dim"]:
        raise ValueError(f"points of mixed dimension: {row['min_dim']} to {row['max_dim']}")
    return n, int(row["min_dim"])
