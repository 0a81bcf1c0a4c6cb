"""The registered queries: one per operator of the inventory, over the driver's tables.

Every query reads whole tables (no id subsets, prefixes or row caps) and
returns a DataFrame whose column names match :mod:`pointtally.plans.oracle`.
Distances are rounded to :data:`DIGITS` places on both sides, since the
summation order of a distributed sum is not fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointtally import operators as O
from pointtally.plans import tables as T
from pointtally.runtime import scratch_dir
from pointtally.sources.text import (
    document_tokens,
    parse_pairs,
    parse_points,
    read_text_lines,
    scan_point_tokens,
    write_lines,
)

# Fixed parameters of the registered queries.
SEED = 42
K_GROUPS = 8  # K of the class / word counts
K_POINTS = 5  # k of the point operators
L_GROUPS = 4  # L of the coreset
DIGITS = 6

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(F.col(c), DIGITS).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ counting


def q_pair_parse(spark, d):
    return parse_pairs(T.pair_lines(spark, d))


def q_pair_count(spark, d):
    return O.pair_count(T.labelled_pairs(spark, d))


def q_class_count(spark, d):
    return O.class_count(T.labelled_pairs(spark, d))


def q_class_partial_counts(spark, d):
    return O.class_partial_counts(T.labelled_pairs(spark, d), K_GROUPS)


def q_class_count_rounds(spark, d):
    return O.class_count_rounds(T.labelled_pairs(spark, d), K_GROUPS)


def q_class_count_by_partition(spark, d):
    # The result does not depend on K, so the counts run over the scan's own
    # partitions and no shuffle of the input is made.
    return O.class_count_by_partition(T.labelled_pairs(spark, d))


def q_most_frequent_class(spark, d):
    return O.most_frequent_class(O.class_totals(T.labelled_pairs(spark, d)))


def q_max_partition_size(spark, d):
    return O.max_partition_size(T.labelled_pairs(spark, d), K_GROUPS)


def q_max_partition_size_physical(spark, d):
    return O.max_partition_size_physical(T.labelled_pairs(spark, d), K_GROUPS)


# ------------------------------------------------------------------ text

def q_lines_scan(spark, d):
    """The lines of ``documents``, written as text to the shared folder and scanned back."""
    path = write_lines(T.lines(spark, d), scratch_dir(spark))
    return read_text_lines(spark, path).groupBy(F.col("value").alias("line")).agg(F.count("id").alias("n"))


# ------------------------------------------------------------------ words


def q_document_count(spark, d):
    return O.text_document_count(T.table(spark, d, "documents"))


def q_word_count(spark, d):
    return O.word_count(T.tokens(spark, d))


def q_word_count_salted(spark, d):
    return O.word_count_salted(document_tokens(O.with_salt(T.lines(spark, d), K_GROUPS)), K_GROUPS)


def q_word_count_partitioned(spark, d):
    # Documents are dealt to the partitions, as the reference does at read time; their tokens are not moved again.
    return O.word_count_partitioned(T.dealt_tokens(spark, d, K_GROUPS))


def q_distinct_words(spark, d):
    return O.distinct_words(O.word_count(T.tokens(spark, d)))


def q_avg_word_length(spark, d):
    return O.avg_word_length(O.word_count(T.tokens(spark, d)))


# ------------------------------------------------------------------ point sources


def _coords(points: DataFrame) -> DataFrame:
    return points.select(
        "id",
        F.get("v", 0).alias("x0"),
        F.get("v", 1).alias("x1"),
        F.size("v").cast("bigint").alias("dim"),
    )


def q_points_parse(spark, d):
    return _coords(parse_points(T.part_point_lines(spark, d)))


def q_points_scan(spark, d):
    return _coords(scan_point_tokens(T.part_point_text(spark, d), order_by="p_partkey"))


def q_point_count(spark, d):
    return T.points(spark, d).agg(F.count(F.lit(1)).alias("point_count"))


# ------------------------------------------------------------------ diameter


def q_exact_diameter(spark, d):
    return _round(O.exact_diameter(T.points(spark, d)), "diameter")


def q_avg_pairwise_distance(spark, d):
    return _round(O.avg_pairwise_distance(T.points(spark, d)), "avg_distance")


def q_sample_points(spark, d):
    return O.sample_points(T.points(spark, d), K_POINTS, SEED).select("pos", "id")


def q_two_approx_diameter(spark, d):
    return _round(O.two_approx_diameter(T.points(spark, d), K_POINTS, SEED), "diameter")


# ------------------------------------------------------------------ centers


def q_kcenter_centers(spark, d):
    return O.farthest_first(T.points(spark, d), K_POINTS, seed=SEED).select("pos", "id")


def q_kcenter_diameter(spark, d):
    centers, shape = O.farthest_first(T.points(spark, d), K_POINTS, seed=SEED, with_shape=True)
    return _round(O.exact_diameter(centers.select("id", "v"), shape=shape), "diameter")


def q_nearest_center_distance(spark, d):
    pts = T.points(spark, d)
    centers, (_, dim) = O.farthest_first(pts, K_POINTS, seed=SEED, with_shape=True)
    return _round(O.nearest_center_distance(pts, centers.select("id", "v"), dim=dim), "dist")


def q_coreset(spark, d):
    return O.coreset(T.points(spark, d), K_POINTS, L_GROUPS, seed=SEED).select("part", "pos", "id")


# ------------------------------------------------------------------ diversity


def q_greedy_matching(spark, d):
    return O.greedy_matching(T.points(spark, d), K_POINTS).select("pos", "id")


def q_diversity_points(spark, d):
    chosen, _ = O.diversity_maximization(T.points(spark, d), K_POINTS, L_GROUPS, seed=SEED)
    return chosen.select("pos", "id")


def q_diversity_value(spark, d):
    _, value = O.diversity_maximization(T.points(spark, d), K_POINTS, L_GROUPS, seed=SEED)
    return _round(value.select(F.col("avg_distance").alias("diversity_value")), "diversity_value")


QUERIES: dict[str, Query] = {
    "pair_parse": q_pair_parse,
    "pair_count": q_pair_count,
    "class_count": q_class_count,
    "class_partial_counts": q_class_partial_counts,
    "class_count_rounds": q_class_count_rounds,
    "class_count_by_partition": q_class_count_by_partition,
    "most_frequent_class": q_most_frequent_class,
    "max_partition_size": q_max_partition_size,
    "max_partition_size_physical": q_max_partition_size_physical,
    "lines_scan": q_lines_scan,
    "document_count": q_document_count,
    "word_count": q_word_count,
    "word_count_salted": q_word_count_salted,
    "word_count_partitioned": q_word_count_partitioned,
    "distinct_words": q_distinct_words,
    "avg_word_length": q_avg_word_length,
    "points_parse": q_points_parse,
    "points_scan": q_points_scan,
    "point_count": q_point_count,
    "exact_diameter": q_exact_diameter,
    "avg_pairwise_distance": q_avg_pairwise_distance,
    "sample_points": q_sample_points,
    "two_approx_diameter": q_two_approx_diameter,
    "kcenter_centers": q_kcenter_centers,
    "kcenter_diameter": q_kcenter_diameter,
    "nearest_center_distance": q_nearest_center_distance,
    "coreset": q_coreset,
    "greedy_matching": q_greedy_matching,
    "diversity_points": q_diversity_points,
    "diversity_value": q_diversity_value,
}
