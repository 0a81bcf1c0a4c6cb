"""Randomized checks against plain-Python brute force (small inputs, many shapes)."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pointtally import operators as O
from pointtally.functions import java_space_split
from pointtally.operators import centers as C

from brute import dist, farthest_first, greedy, sqd
from conftest import points_df

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def java_split(text: str) -> list[str]:
    """``String.split(" ")``: trailing empty tokens dropped, ``""`` -> ``[""]``."""
    if text == "":
        return [""]
    parts = text.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


# Coordinates on a coarse grid so that duplicate points and tied distances occur.
coords = st.lists(st.integers(min_value=-3, max_value=3), min_size=2, max_size=2)
point_sets = st.lists(coords, min_size=6, max_size=24)


@SETTINGS
@given(st.lists(st.text(alphabet="ab ", max_size=8), min_size=1, max_size=10))
def test_tokenizer_matches_java_split(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(java_space_split(F.col("text"))).collect()]
    assert got == [java_split(t) for t in texts]


@SETTINGS
@given(point_sets, st.integers(min_value=1, max_value=6))
def test_farthest_first_matches_brute_force(spark, pts, k):
    k = min(k, len(pts))
    points = {i * 3 + 1: [float(x) for x in p] for i, p in enumerate(pts)}
    df = points_df(spark, list(points.values()), ids=list(points))
    got = [r["id"] for r in O.farthest_first(df, k).orderBy("pos").collect()]
    assert got == farthest_first(points, k)


@SETTINGS
@given(point_sets, st.integers(min_value=1, max_value=7))
def test_greedy_matching_matches_brute_force(spark, pts, k):
    points = {i: [float(x) for x in p] for i, p in enumerate(pts)}
    df = points_df(spark, list(points.values()), ids=list(points))
    want = greedy(points, k)
    got = [r["id"] for r in O.greedy_matching(df, k).orderBy("pos").collect()]
    assert got == want


@SETTINGS
@given(point_sets, st.integers(min_value=1, max_value=9))
def test_pair_summary_matches_brute_force(spark, pts, blocks):
    points = {i: [float(x) for x in p] for i, p in enumerate(pts)}
    df = points_df(spark, list(points.values()), ids=list(points))
    got = O.pair_summary(df, len(points), 2, blocks=blocks).first()
    pairs = [(sqd(points[a], points[b]), a, b) for a in points for b in points if a < b]
    best = min(pairs, key=lambda t: (-t[0], t[1], t[2]))
    assert (got["d2"], got["i"], got["j"]) == best
    assert got["n_pairs"] == len(pairs)
    assert math.isclose(got["sum_d"], sum(math.sqrt(t[0]) for t in pairs), rel_tol=1e-12, abs_tol=1e-12)


def test_many_groups_use_broadcast_variable(spark, monkeypatch):
    pts = [[float((i * 7) % 13), float((i * 5) % 11)] for i in range(60)]
    df = points_df(spark, pts)
    want = sorted(map(tuple, O.coreset(df, 4, 6).select("part", "pos", "id").collect()))
    monkeypatch.setattr(C, "CLOSURE_BYTES", 0)
    got = sorted(map(tuple, O.coreset(df, 4, 6).select("part", "pos", "id").collect()))
    assert got == want


def test_many_small_groups_match_brute_force(spark):
    coords = [[float((i * 37) % 17), float((i * 11) % 7)] for i in range(200)]
    df = points_df(spark, coords)
    got = {}
    for r in O.coreset(df, 3, 50).collect():
        got.setdefault(r["part"], []).append((r["pos"], r["id"]))
    for g in range(50):
        members = {i: coords[i] for i in range(200) if i % 50 == g}
        assert [i for _, i in sorted(got[g])] == farthest_first(members, 3)


def scanner_points(text: str) -> list[list[float]]:
    """``Scanner.next()`` tokens (any whitespace) each split on ``,`` into doubles."""
    out = []
    for tok in text.split():
        fields = tok.split(",")
        while fields and fields[-1] == "":
            fields.pop()
        out.append([float(f) for f in fields])
    return out


point_token = st.lists(st.integers(min_value=-9, max_value=9), min_size=2, max_size=2).map(
    lambda xy: f"{xy[0]},{xy[1]}.5"
)
separator = st.sampled_from([" ", "  ", "\t", "\n", " \n\t", "\r\n"])


@SETTINGS
@given(st.lists(st.tuples(point_token, separator), min_size=1, max_size=12), separator)
def test_token_scan_matches_scanner(spark, tmp_path_factory, items, lead):
    from pointtally.sources import read_point_tokens

    text = lead + "".join(tok + sep for tok, sep in items)
    path = tmp_path_factory.mktemp("scan") / "points.txt"
    path.write_text(text, encoding="utf-8", newline="")
    got = [r["v"] for r in read_point_tokens(spark, str(path)).orderBy("id").collect()]
    assert got == scanner_points(text)


pair_line = st.one_of(
    st.tuples(st.integers(min_value=-50, max_value=50), st.sampled_from(["a", "bb", "c d", " e", ""])).map(
        lambda t: f"{t[0]} {t[1]}"
    ),
)


@SETTINGS
@given(st.lists(pair_line, min_size=1, max_size=10))
def test_pair_parse_matches_java(spark, lines):
    from pointtally.sources import parse_pairs

    def java(line):
        toks = java_split(line)
        if len(toks) < 2:
            return None
        return int(toks[0]), toks[1]

    want = [java(line) for line in lines]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    if any(w is None for w in want):
        try:
            parse_pairs(df).collect()
        except Exception:
            return
        raise AssertionError("expected the parse to fail")
    assert [tuple(r) for r in parse_pairs(df).collect()] == want


def test_nearest_distance_with_broadcast_payload(spark, monkeypatch):
    coords = [[float((i * 7) % 13), float((i * 5) % 11)] for i in range(80)]
    df = points_df(spark, coords)
    centers = O.farthest_first(df, 6).select("id", "v")
    want = sorted(map(tuple, O.nearest_center_distance(df, centers).collect()))
    monkeypatch.setattr(C, "CLOSURE_BYTES", 0)
    got = sorted(map(tuple, O.nearest_center_distance(df, centers).collect()))
    assert got == want
    ids = [r["id"] for r in centers.collect()]
    brute = {i: min(dist(coords[i], coords[c]) for c in ids) for i in range(80)}
    assert all(abs(d - brute[i]) == 0.0 for i, d in got)
