"""Parsers and scans: Java split semantics, strict ints, point parsing, row index."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from pointtally.functions import java_space_split
from pointtally.functions import ranges as R
from pointtally.functions.ranges import range_bucket, with_start
from pointtally.operators import text_document_count
from pointtally.sources import (
    document_lines,
    document_tokens,
    parse_pairs,
    parse_point_line,
    read_point_tokens,
    read_points,
    read_text_lines,
    scan_point_tokens,
    validate_points,
    with_row_index,
)

FAILS = (PySparkException, Py4JJavaError)


def _tokens(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(java_space_split(F.col("text"))).collect()]


def test_java_split_edge_cases(spark):
    # Java "".split(" ") == [""], "   " -> [], "a  b " -> [a, "", b], " a" -> ["", a]
    assert _tokens(spark, ["", "   ", "a  b ", " a"]) == [[""], [], ["a", "", "b"], ["", "a"]]


def test_java_split_keeps_tabs_in_tokens(spark):
    assert _tokens(spark, ["a\tb c"]) == [["a\tb", "c"]]


def test_parse_pairs_good_and_extra_tokens(spark):
    lines = spark.createDataFrame([("0 amber extra",), ("-3 teal",), ("7  plum",)], "value string")
    got = [tuple(r) for r in parse_pairs(lines).collect()]
    assert got == [(0, "amber"), (-3, "teal"), (7, "")]


@pytest.mark.parametrize("bad", ["x amber", "7", "7 ", " 7 amber", "7\t amber", "1.5 A"])
def test_parse_pairs_rejects(spark, bad):
    lines = spark.createDataFrame([(bad,)], "value string")
    with pytest.raises(FAILS):
        parse_pairs(lines).collect()


def test_read_text_lines_index(spark, text_file):
    path = text_file("a\nb\n\nc")
    got = [tuple(r) for r in read_text_lines(spark, path).orderBy("id").collect()]
    assert got == [(0, "a"), (1, "b"), (2, ""), (3, "c")]


def test_with_row_index_dense_over_many_partitions(spark):
    df = spark.range(0, 1000, 1, numPartitions=7).select((F.col("id") * 3).alias("x"))
    got = with_row_index(df, "rid").select("rid", "x").collect()
    assert sorted(r["rid"] for r in got) == list(range(1000))
    assert all(r["x"] == 3 * r["rid"] for r in got)


def test_with_start_sums_in_key_order(spark):
    df = spark.range(0, 500, 1, numPartitions=5).select(((F.col("id") * 7) % 500).alias("x"))
    got = with_start(df, "at", F.col("x"), ["x"], F.col("x") % 3, ranges=9).collect()
    want, total = {}, 0
    for x in range(500):
        want[x] = total
        total += x % 3
    assert {r["x"]: r["at"] for r in got} == want
    assert with_start(df.limit(0), "at", F.col("x"), ["x"]).count() == 0


def test_ranges_follow_dense_keys(spark, monkeypatch):
    monkeypatch.setattr(R, "LEAST_RANGE", 1)
    keys = [1_700_000_000_000 + k for k in range(3000)] + [-(2**63), -7, -7, 0, 2**63 - 1] + [42] * 400 + [None, None]
    df = spark.createDataFrame([(k,) for k in keys], "x bigint").repartition(4)
    keyed = df.select(F.col("x").alias("__pt_key"), F.lit(1).cast("bigint").alias("__pt_w"))
    totals = R.range_totals(keyed, 20)
    assert sum(w for _, w in totals) == len(keys) and totals[0] == (None, 2)
    lows = [low for low, _ in totals[1:]]
    assert lows == sorted(lows) and lows[0] == -(2**63)
    assert max(w for low, w in totals if low != 42) <= 4 * len(keys) / 20  # one key cannot be cut
    got = with_start(df, "at", F.col("x"), ["x"], ranges=20).collect()
    assert sorted(r["at"] for r in got) == list(range(len(keys)))
    order = sorted(got, key=lambda r: r["at"])
    assert [r["x"] for r in order] == sorted(keys, key=lambda k: (k is not None, k))


def test_key_steps_rise_with_keys(spark):
    keys = sorted({s * (2**e + d) for e in range(62) for d in (-1, 0, 1) for s in (-1, 1)} | {2**63 - 1, -(2**63)})
    df = spark.createDataFrame([(k,) for k in keys], "x bigint")
    rows = df.select("x", R.key_step(F.col("x")).alias("s")).orderBy("x").collect()
    steps = [r["s"] for r in rows]
    assert steps == sorted(steps) and all(r["s"] == r["x"] for r in rows if abs(r["x"]) < R.STEPS)


def test_range_bucket(spark):
    bounds = [3, 5, 8, 13, 21, 34, 55]
    got = spark.range(-2, 60).select("id", range_bucket(F.col("id"), bounds).alias("b")).collect()
    assert all(r["b"] == sum(b <= r["id"] for b in bounds) for r in got)


@pytest.mark.parametrize("breaks", ["\n", "\r\n", "\r"])
def test_lines_are_those_of_a_text_scan(spark, tmp_path, breaks):
    for k, text in enumerate(["a b", "a b\n", "\n", "\n\n", "", "a\n\nb \n", " \n x"]):
        text = text.replace("\n", breaks)
        path = tmp_path / f"t{k}.txt"
        path.write_bytes(text.encode())
        want = sorted(r["value"] for r in spark.read.text(str(path)).collect())
        docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
        assert sorted(r["line"] for r in document_lines(docs).collect()) == want
        assert text_document_count(docs).first()[0] == len(want)


def test_scan_in_key_order_leaves_no_cache(spark):
    rows = [(3, " 1,2\t3,4\n"), (1, "5,6"), (2, " \n"), (7, "7,8 9,10  11,12")]
    df = spark.createDataFrame(rows, "k bigint, value string").repartition(3)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    got = [(r["id"], r["v"]) for r in scan_point_tokens(df, order_by="k").orderBy("id").collect()]
    assert got == [(i, [float(2 * j + 1), float(2 * j + 2)]) for i, j in enumerate([2, 0, 1, 3, 4, 5])]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_document_lines_and_tokens(spark):
    docs = spark.createDataFrame([(1, "a b\nc  d\r\ne"), (2, "")], "doc_id bigint, text string")
    lines = document_lines(docs)
    assert [tuple(r) for r in lines.orderBy("doc_id", "line_no").collect()] == [
        (1, 0, "a b"),
        (1, 1, "c  d"),
        (1, 2, "e"),
    ]
    words = sorted(r["word"] for r in document_tokens(lines).collect())
    assert words == ["", "a", "b", "c", "d", "e"]


def _parse(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return [r[0] for r in df.select(parse_point_line(F.col("value"))).collect()]


def test_point_line_parse(spark):
    assert _parse(spark, ["1.5,2", "3,4,", " 5 , 6", "7"]) == [[1.5, 2.0], [3.0, 4.0], [5.0, 6.0], [7.0]]


@pytest.mark.parametrize("bad", ["", "1,,2", ",1", "a,b"])
def test_point_line_parse_rejects(spark, bad):
    with pytest.raises(FAILS):
        _parse(spark, [bad])


def test_point_token_scan(spark, text_file):
    path = text_file("1.5,2  3,4\n\n\t5,6 \n")
    got = [(r["id"], r["v"]) for r in read_point_tokens(spark, path).orderBy("id").collect()]
    assert got == [(0, [1.5, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])]


def test_read_points_ids_are_line_numbers(spark, text_file):
    path = text_file("0,0\n1,1\n2,2\n")
    got = [(r["id"], r["v"]) for r in read_points(spark, path).orderBy("id").collect()]
    assert got == [(0, [0.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0])]


def test_validate_points(spark):
    ok = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "id bigint, v array<double>")
    assert validate_points(ok) == (2, 2)
    mixed = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0])], "id bigint, v array<double>")
    with pytest.raises(ValueError, match="mixed dimension"):
        validate_points(mixed)
    nan = spark.createDataFrame([(0, [1.0, float("nan")])], "id bigint, v array<double>")
    with pytest.raises(ValueError, match="NaN"):
        validate_points(nan)
    empty = spark.createDataFrame([], "id bigint, v array<double>")
    assert validate_points(empty) == (0, 0)
