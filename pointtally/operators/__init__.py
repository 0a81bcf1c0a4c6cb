"""Operators: every one takes DataFrames and plain parameters and returns a DataFrame."""

from pointtally.operators.centers import farthest_first, nearest_center_distance
from pointtally.operators.counting import (
    class_count,
    class_count_by_partition,
    class_count_rounds,
    class_partial_counts,
    class_partition_counts,
    class_totals,
    max_partition_size,
    max_partition_size_physical,
    most_frequent_class,
    pair_count,
)
from pointtally.operators.diameter import (
    avg_pairwise_distance,
    exact_diameter,
    sample_points,
    two_approx_diameter,
)
from pointtally.operators.diversity import coreset, diversity_maximization, greedy_matching
from pointtally.operators.pairs import pair_groups, pair_summary
from pointtally.operators.words import (
    avg_word_length,
    distinct_words,
    document_count,
    text_document_count,
    word_count,
    word_count_partitioned,
    with_salt,
    word_count_salted,
)

__all__ = [
    "avg_pairwise_distance",
    "avg_word_length",
    "class_count",
    "class_count_by_partition",
    "class_count_rounds",
    "class_partial_counts",
    "class_totals",
    "class_partition_counts",
    "coreset",
    "distinct_words",
    "diversity_maximization",
    "document_count",
    "exact_diameter",
    "farthest_first",
    "greedy_matching",
    "max_partition_size",
    "max_partition_size_physical",
    "most_frequent_class",
    "nearest_center_distance",
    "pair_count",
    "pair_groups",
    "pair_summary",
    "sample_points",
    "text_document_count",
    "two_approx_diameter",
    "word_count",
    "word_count_partitioned",
    "with_salt",
    "word_count_salted",
]
