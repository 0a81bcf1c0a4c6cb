"""Class counting: invented pairs counted in plain Python, equivalences, edges."""

from __future__ import annotations

from collections import Counter

import pytest

from pointtally import operators as O
from pointtally.sources import read_pairs

# Invented pairs, one per line, no final newline: three hues in unequal numbers.
HUES = ["amber" if i % 7 == 3 else "teal" if i % 3 else "plum" for i in range(23)]
EXAMPLE = "\n".join(f"{i} {c}" for i, c in enumerate(HUES))
EXPECTED = sorted(Counter(HUES).items())


@pytest.fixture()
def example(spark, text_file):
    return read_pairs(spark, text_file(EXAMPLE))


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "id bigint, class string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_example_counts(example):
    assert rows(O.pair_count(example)) == [(23,)]
    assert rows(O.class_count(example)) == EXPECTED
    assert rows(O.most_frequent_class(O.class_count(example))) == [("teal", Counter(HUES)["teal"])]
    assert rows(O.max_partition_size(example, 8)) == [(3,)]


@pytest.mark.parametrize("k", [1, 3, 8, 1000])
def test_two_round_forms_equal_plain_count(example, k):
    assert rows(O.class_count_rounds(example, k)) == EXPECTED
    assert rows(O.class_count_by_partition(example, k)) == EXPECTED


def test_partial_counts_sum_per_group(example):
    partial = rows(O.class_partial_counts(example, 8))
    assert sum(n for _, _, n in partial) == 23
    assert {p for p, _, _ in partial} <= set(range(8))


def test_physical_partition_size(spark, example):
    for k in (1, 3, 8):
        want = max(Counter(i % k for i in range(23)).values())
        assert rows(O.max_partition_size_physical(example, k)) == [(want,)]
    # The caller's K holds whatever the number of input partitions or cores.
    for parts in (1, 5):
        pairs = spark.range(10000).selectExpr("id - 5000 AS id", "'x' AS class").repartition(parts)
        assert rows(O.max_partition_size_physical(pairs, 8)) == [(1250,)]


def test_most_frequent_class_does_not_sort_all_classes(example):
    plan = O.most_frequent_class(O.class_totals(example))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_empty_input(spark):
    empty = _pairs(spark, [])
    assert rows(O.class_count(empty)) == []
    assert rows(O.max_partition_size(empty, 8)) == [(0,)]
    assert rows(O.max_partition_size_physical(empty, 8)) == [(0,)]
    assert rows(O.most_frequent_class(O.class_count(empty))) == [("", -1)]


def test_ties_go_to_smallest_class(spark):
    pairs = _pairs(spark, [(0, "a"), (1, "b"), (2, "b"), (3, "a")])
    assert rows(O.most_frequent_class(O.class_count(pairs))) == [("a", 2)]


def test_negative_ids_keep_java_sign(spark):
    pairs = _pairs(spark, [(-3, "x"), (5, "x")])
    assert sorted(p for p, _, _ in rows(O.class_partial_counts(pairs, 8))) == [-3, 5]


def test_marker_named_class_is_an_ordinary_class(spark):
    pairs = _pairs(spark, [(0, "largest"), (1, "largest"), (2, "a")])
    assert rows(O.class_count_by_partition(pairs, 2)) == [("a", 1), ("largest", 2)]
    assert rows(O.most_frequent_class(O.class_count(pairs))) == [("largest", 2)]


def test_hot_class_is_combined_map_side(spark):
    # One class holds a third of all rows: the plan must aggregate partially
    # before the exchange, so the hot key never reaches one task as raw rows.
    pairs = spark.range(30000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 97) END AS class")
    plan = O.class_count(pairs)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    got = dict(rows(O.class_count(pairs)))
    assert got["hot"] == 10000 and sum(got.values()) == 30000


def test_invalid_group_count(example):
    with pytest.raises(ValueError):
        O.class_partial_counts(example, 0)
