"""Class counting over labelled pairs ``(id BIGINT, class STRING)``.

The reference counts classes in two MapReduce rounds, first within groups
(``id % K`` or a physical partition) and then across them.  Spark's hash
aggregate already combines map-side, so a hot class (even one holding a third
of all rows) collapses to one partial row per task before any shuffle; the
two-round forms are kept because they are operators of their own (their
partial counts and partition sizes are results too).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _check_groups(k: int) -> None:
    if k <= 0:
        raise ValueError(f"number of groups must be positive, got {k}")


def pair_count(pairs: DataFrame) -> DataFrame:
    """Number of labelled pairs, ``(pair_count BIGINT)``."""
    return pairs.agg(F.count(F.lit(1)).alias("pair_count"))


def class_count(pairs: DataFrame) -> DataFrame:
    """``(class, n)`` for every class, ascending by class."""
    return class_totals(pairs).orderBy("class")


def class_totals(pairs: DataFrame) -> DataFrame:
    """``(class, n)`` for every class, in no order."""
    return pairs.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def class_partial_counts(pairs: DataFrame, k: int) -> DataFrame:
    """Round 1 with deterministic groups: ``(part, class, n)``, ``part = id % k``.

    ``%`` keeps the dividend's sign, as Java does, so a negative id lands in a
    negative group.
    """
    _check_groups(k)
    return pairs.groupBy((F.col("id") % F.lit(k)).cast("bigint").alias("part"), "class").agg(
        F.count(F.lit(1)).alias("n")
    )


def class_count_rounds(pairs: DataFrame, k: int) -> DataFrame:
    """Both rounds: partial counts per ``id % k`` group, then their sum per class."""
    return (
        class_partial_counts(pairs, k)
        .groupBy("class")
        .agg(F.sum("n").cast("bigint").alias("n"))
        .orderBy("class")
    )


def _physical(pairs: DataFrame, num_partitions: int | None) -> DataFrame:
    """Rows tagged with the physical partition they live in.

    With ``num_partitions`` the rows are placed first, row ``id`` in partition
    ``pmod(id, num_partitions)``: the caller's number, whatever the cluster.
    """
    if num_partitions is not None:
        _check_groups(num_partitions)
        pairs = pairs.repartitionById(num_partitions, F.pmod(F.col("id"), F.lit(num_partitions)).cast("int"))
    return pairs.withColumn("part", F.spark_partition_id().cast("bigint"))


def class_partition_counts(pairs: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Round 1 by physical partition: ``(part, class, n)`` per non-empty partition."""
    return _physical(pairs, num_partitions).groupBy("part", "class").agg(F.count(F.lit(1)).alias("n"))


def class_count_by_partition(pairs: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Class counts computed from per-partition partial counts (same result as :func:`class_count`)."""
    return (
        class_partition_counts(pairs, num_partitions)
        .groupBy("class")
        .agg(F.sum("n").cast("bigint").alias("n"))
        .orderBy("class")
    )


def max_partition_size(pairs: DataFrame, k: int) -> DataFrame:
    """Largest ``id % k`` group, ``(max_partition_size BIGINT)``; 0 for no rows."""
    _check_groups(k)
    sizes = pairs.groupBy((F.col("id") % F.lit(k)).alias("part")).agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.coalesce(F.max("size"), F.lit(0)).cast("bigint").alias("max_partition_size"))


def max_partition_size_physical(pairs: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Largest physical partition, ``(max_partition_size BIGINT)``; 0 for no rows.

    With ``num_partitions`` rows are placed by :func:`_physical`.  Partition
    sizes come from one partial aggregate per task; only one row per partition
    is shuffled.
    """
    sizes = _physical(pairs, num_partitions).groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.coalesce(F.max("size"), F.lit(0)).cast("bigint").alias("max_partition_size"))


def most_frequent_class(counts: DataFrame) -> DataFrame:
    """``(class, n)`` of the largest count; ties go to the smallest class.

    Takes the output of any class-count operator.  With no classes at all the
    answer is ``("", -1)``, the reference's starting value: that row is unioned
    in and always loses to a real count, so no driver-side check is needed.
    The top-1 is a TakeOrderedAndProject: one row per task is kept.
    """
    spark = counts.sparkSession
    default = spark.createDataFrame([("", -1)], "class string, n bigint")
    return (
        counts.select("class", F.col("n").cast("bigint").alias("n"))
        .unionByName(default)
        .orderBy(F.desc("n"), F.asc("class"))
        .limit(1)
    )
