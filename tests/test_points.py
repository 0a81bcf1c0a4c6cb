"""Point-set operators against plain-Python brute force: generated points, bounds, edges, NaN rule."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pointtally import operators as O
from pointtally.operators import centers as C
from pointtally.operators import diameter as D
from pointtally.operators import diversity as V
from pointtally.operators import pairs as P
from pointtally.plans import tables as T
from pointtally.sources import read_point_tokens, read_points

from brute import average, diameter, dist, farthest_first, greedy, sample, sqd
from conftest import SF, points_df


def generated(n: int, dim: int, seed: int) -> list[list[float]]:
    """Seeded points on a grid fine enough for few ties, in three clusters."""
    rng = random.Random(seed)
    return [[rng.choice((0, 40, 90)) + rng.randrange(1000) / 64 for _ in range(dim)] for _ in range(n)]


COORDS = generated(700, 2, 7)


@pytest.fixture(scope="module")
def pts2d(spark):
    pts = points_df(spark, COORDS).repartition(5).cache()
    yield pts
    pts.unpersist()


def one(df):
    return df.first()[0]


def ids(df):
    return [r["id"] for r in df.orderBy("pos").collect()]


def test_csv_reads_agree(spark, text_file):
    path = text_file("\n".join(f"{x},{y}" for x, y in COORDS))
    lines, scanned = read_points(spark, path), read_point_tokens(spark, path)
    assert lines.count() == len(COORDS)
    assert scanned.exceptAll(lines).count() == 0 and lines.exceptAll(scanned).count() == 0


@pytest.mark.parametrize("prune,blocks", [(False, None), (True, None), (False, 5), (True, 3)])
def test_exact_diameter(pts2d, prune, blocks):
    assert one(O.exact_diameter(pts2d, prune=prune, blocks=blocks)) == diameter(COORDS)


@pytest.mark.parametrize("blocks", [None, 1, 4])
def test_average(pts2d, blocks):
    assert one(O.avg_pairwise_distance(pts2d, blocks=blocks)) == pytest.approx(average(COORDS), abs=1e-10)


def test_sample_and_two_approx(pts2d, monkeypatch):
    want = sample(range(len(COORDS)), 9)
    assert ids(O.sample_points(pts2d, 9)) == want
    far = max(dist(p, COORDS[s]) for p in COORDS for s in want)
    assert one(O.two_approx_diameter(pts2d, 9)) == far
    monkeypatch.setattr(D, "SAMPLE_TASK_ROWS", 0)  # by rank over ranges
    assert ids(O.sample_points(pts2d, 9)) == want


def test_two_approx_in_parts(spark, pts2d):
    want = one(O.two_approx_diameter(pts2d, 9))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200b")
        assert one(O.two_approx_diameter(pts2d, 9)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_kcenter_and_nearest(pts2d):
    points = dict(enumerate(COORDS))
    centers = O.farthest_first(pts2d, 6)
    want = farthest_first(points, 6)
    assert ids(centers) == want
    got = dict(map(tuple, O.nearest_center_distance(pts2d, centers.select("id", "v")).collect()))
    assert got == {i: min(dist(p, COORDS[c]) for c in want) for i, p in points.items()}


def test_coreset_and_diversity(pts2d):
    points = dict(enumerate(COORDS))
    core = []
    for g in range(4):
        core += farthest_first({i: p for i, p in points.items() if i % 4 == g}, 5)
    assert sorted(r["id"] for r in O.coreset(pts2d, 5, 4).collect()) == sorted(core)
    want = greedy({i: points[i] for i in core}, 5)
    chosen, value = O.diversity_maximization(pts2d, 5, 4)
    assert ids(chosen) == want
    assert one(value) == pytest.approx(average([points[i] for i in want]), abs=1e-10)


def test_bounds_on_embeddings(spark):
    pts = T.points(spark, f"{SF}/sf0.001").cache()
    d = one(O.exact_diameter(pts))
    assert one(O.exact_diameter(pts, prune=True)) == d
    for k in (1, 3):
        assert d / 2 - 1e-12 <= one(O.two_approx_diameter(pts, k)) <= d + 1e-12
    centers = O.farthest_first(pts, 5).select("id", "v")
    assert d / 2 - 1e-12 <= one(O.exact_diameter(centers)) <= d + 1e-12
    pts.unpersist()


@pytest.mark.parametrize("k", [4, 5, 9])
def test_greedy_matching(pts2d, k):
    assert ids(O.greedy_matching(pts2d, k)) == greedy(dict(enumerate(COORDS)), k)


# ------------------------------------------------------------------ rounds, groups


def test_many_rounds(spark, pts2d, monkeypatch):
    want = farthest_first(dict(enumerate(COORDS)), 11)
    assert ids(O.farthest_first(pts2d, 11)) == want
    monkeypatch.setattr(C, "MATERIALIZE_EVERY", 2)
    assert ids(O.farthest_first(pts2d, 11)) == want
    assert ids(O.farthest_first(pts2d, 11, storage_level=None)) == want


def test_no_state_is_written_after_the_last_center(spark, pts2d, monkeypatch):
    calls = []
    real = C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, name="": calls.append(name) or real(df, name))
    O.farthest_first(pts2d, C.MATERIALIZE_EVERY)
    O.farthest_first(pts2d, 3 * C.MATERIALIZE_EVERY, storage_level=None)
    assert calls == []
    O.farthest_first(pts2d, C.MATERIALIZE_EVERY + 2)
    assert calls == ["farthest"]


def test_nothing_stays_cached(spark, pts2d):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    O.farthest_first(pts2d, 4)
    O.coreset(pts2d, 3, 4).collect()
    O.exact_diameter(pts2d, prune=True).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("groups", [3, 60])
def test_driver_and_joined_centers_agree(spark, groups):
    coords = generated(240, 3, 11)
    pts = points_df(spark, coords, ids=range(-120, 120)).repartition(4)
    part = F.pmod(F.col("id"), F.lit(groups))
    points = {i - 120: c for i, c in enumerate(coords)}
    want = set()
    for g in range(groups):
        members = {i: p for i, p in points.items() if i % groups == g}
        want |= {(g, pos, i) for pos, i in enumerate(farthest_first(members, 3))}
    for driver_groups in (1000, 1):
        got = O.farthest_first(pts, 3, part=part, strict=False, driver_groups=driver_groups)
        assert {(r["part"], r["pos"], r["id"]) for r in got.collect()} == want


def test_negative_ids_make_exactly_the_groups(spark):
    pts = points_df(spark, generated(80, 2, 3), ids=range(-40, 40))
    assert {r["part"] for r in O.coreset(pts, 2, 4).collect()} == {0, 1, 2, 3}


def test_more_groups_than_any_cap(spark):
    pts = spark.range(3000).selectExpr("id", "array(double(id), 1.0D) AS v")
    got = O.farthest_first(pts, 2, part=F.col("id"), strict=False)
    assert got.count() == 3000


# ------------------------------------------------------------------ non-finite distances

INF = float("inf")


def infinite_sets(n):
    base = generated(n, 2, 5)
    one_inf = [list(p) for p in base]
    one_inf[3][0] = INF
    two_inf = [list(p) for p in one_inf]
    two_inf[7][0] = INF
    opposite = [list(p) for p in one_inf]
    opposite[7][0] = -INF
    return [one_inf, two_inf, opposite]


@pytest.mark.parametrize("n", [10, 300])
@pytest.mark.parametrize("which", [0, 1, 2])
def test_nan_distances_are_never_the_farthest(spark, n, which):
    coords = infinite_sets(n)[which]
    pts = points_df(spark, coords).repartition(3).cache()
    points = dict(enumerate(coords))
    for prune in (False, True):
        assert one(O.exact_diameter(pts, prune=prune)) == diameter(coords) == INF
    drawn = sample(points, 4)
    far = max((d for p in coords for s in drawn if not math.isnan(d := dist(p, coords[s]))), default=-1.0)
    assert one(O.two_approx_diameter(pts, 4)) == far
    avg, want = one(O.avg_pairwise_distance(pts)), average(coords)
    assert (math.isnan(avg) and math.isnan(want)) or avg == want
    assert ids(O.greedy_matching(pts, 5)) == greedy(points, 5)
    for storage in (None, C.StorageLevel.MEMORY_AND_DISK):
        got = O.farthest_first(pts, 4, strict=False, storage_level=storage)
        assert ids(got) == farthest_first(points, 4)
    assert ids(O.farthest_first(pts, 4, strict=False, driver_groups=0)) == farthest_first(points, 4)
    pts.unpersist()


def test_all_distances_nan(spark):
    pts = points_df(spark, [[INF], [INF], [INF]])
    assert one(O.exact_diameter(pts)) == one(O.exact_diameter(pts, prune=True)) == -1.0
    assert one(O.two_approx_diameter(pts, 2)) == -1.0
    assert ids(O.greedy_matching(pts, 2)) == [0, 1]
    with pytest.raises(ValueError):
        O.farthest_first(pts, 2)


# ------------------------------------------------------------------ edges


def test_zero_and_one_point(spark):
    for pts in (points_df(spark, []), points_df(spark, [[1.0, 2.0]])):
        assert one(O.exact_diameter(pts)) == -1.0
        assert math.isnan(one(O.avg_pairwise_distance(pts)))


def test_all_points_equal(spark):
    pts = points_df(spark, [[1.0, 1.0]] * 6)
    assert one(O.exact_diameter(pts)) == 0.0
    assert ids(O.greedy_matching(pts, 5)) == [0, 1, 2, 3, 4]
    assert len(ids(O.farthest_first(pts, 5))) == 5


def test_fewer_points_than_k(spark):
    pts = points_df(spark, [[0.0], [1.0], [3.0]], ids=[5, 2, 9])
    assert ids(O.greedy_matching(pts, 5)) == [2, 5, 9]
    with pytest.raises(ValueError):
        O.farthest_first(pts, 5)
    with pytest.raises(ValueError):
        O.two_approx_diameter(pts, 5)
    assert one(O.two_approx_diameter(pts, 0)) == -1.0


def test_small_group_keeps_all_points(spark):
    pts = points_df(spark, [[float(i), 0.0] for i in range(12)], ids=list(range(10)) + [100, 104])
    core = O.coreset(pts, 5, 1, part=F.when(F.col("id") >= 100, 1).otherwise(0))
    assert sorted(r["id"] for r in core.filter(F.col("part") == 1).collect()) == [100, 104]
    assert core.filter(F.col("part") == 0).count() == 5


def test_no_centers(spark):
    pts = points_df(spark, [[0.0], [1.0]])
    got = O.nearest_center_distance(pts, points_df(spark, [])).collect()
    assert [r["dist"] for r in got] == [None, None]


def test_nearest_center_in_blocks(spark):
    coords = generated(90, 2, 9)
    pts, centers = points_df(spark, coords), points_df(spark, coords[:30])
    want = sorted(map(tuple, O.nearest_center_distance(pts, centers).collect()))
    old, closure = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), C.CLOSURE_BYTES
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
        C.CLOSURE_BYTES = 0
        assert sorted(map(tuple, O.nearest_center_distance(pts, centers).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        C.CLOSURE_BYTES = closure


def test_mixed_dimension_and_nan_rejected(spark):
    with pytest.raises(ValueError):
        O.exact_diameter(points_df(spark, [[0.0, 1.0], [1.0]]))
    with pytest.raises(ValueError):
        O.farthest_first(points_df(spark, [[0.0, 1.0], [1.0]]), 1)
    with pytest.raises(ValueError):
        O.farthest_first(points_df(spark, [[0.0, float("nan")], [1.0, 1.0]]), 1)


@pytest.mark.parametrize("dim", [1, 3, 64, 300])
def test_any_dimension(spark, dim):
    coords = generated(12, dim, dim)
    pts = points_df(spark, coords)
    assert one(O.exact_diameter(pts)) == one(O.exact_diameter(pts, blocks=3)) == diameter(coords)
    assert ids(O.farthest_first(pts, 4)) == farthest_first(dict(enumerate(coords)), 4)


def test_pair_kernel_tiles_ties_and_empty_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "TILE_ROWS", 3)
    monkeypatch.setattr(P, "TILE_COLS", 4)
    # duplicates create tied farthest pairs; 7 blocks for 6 points leaves some empty
    coords = [[0.0, 0.0], [3.0, 4.0], [0.0, 0.0], [3.0, 4.0], [1.0, 1.0], [3.0, 4.0]]
    for blocks in (1, 2, 7):
        got = O.pair_summary(points_df(spark, coords, ids=range(10, 16)), 6, 2, blocks=blocks).first()
        assert (got["d2"], got["i"], got["j"], got["n_pairs"]) == (25.0, 10, 11, 15)
    many = generated(50, 2, 1)
    got = O.pair_summary(points_df(spark, many), 50, 2, blocks=3).first()
    want = min((-sqd(many[a], many[b]), a, b) for a in range(50) for b in range(a + 1, 50))
    assert (-got["d2"], got["i"], got["j"], got["n_pairs"]) == (*want, 50 * 49 // 2)


@pytest.mark.parametrize("kind", ["unit", "copies", "tight", "equal", "far off"])
@pytest.mark.parametrize("diag", [False, True])
def test_sum_of_distances_by_product(monkeypatch, kind, diag):
    monkeypatch.setattr(P, "PRODUCT_ROWS", 32)
    monkeypatch.setattr(P, "PRODUCT_COLS", 48)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(130, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "copies":
        x[rng.random(130) < 0.2] = x[0]
    elif kind == "tight":
        x[5:] = x[5] + 1e-9 * x[5:]
    elif kind == "equal":
        x[:] = x[0]
    elif kind == "far off":
        x = 1e4 + 1e-3 * x
    plain, real = [], P._exact_tile
    monkeypatch.setattr(P, "_exact_tile", lambda *a: plain.append(1) or real(*a))
    a, b = (x, x) if diag else (x[:70], x[70:])
    i, j = np.triu_indices(130, 1) if diag else (np.repeat(np.arange(70), 60), np.tile(np.arange(60), 70))
    d2 = np.zeros(len(i))
    for k in range(16):
        d2 += (a[i, k] - b[j, k]) ** 2
    got = P._block_pair(np.arange(len(a)), a.T.copy(), np.arange(len(b)) + (0 if diag else 500), b.T.copy(), diag, True)
    assert got[0] == d2.max() and got[4] == len(d2)
    assert got[3] == pytest.approx(np.sqrt(d2).sum(), rel=1e-12)
    if kind == "unit":
        assert not plain  # distances come from matrix products, not one dimension at a time


# ------------------------------------------------------------------ branch and bound, lists, skips


def test_diameter_search_skips_block_pairs(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 3)) * 20
    coords = np.concatenate([c + rng.normal(size=(60, 3)) * 0.2 for c in centers]).tolist()
    best, seen = D.diameter_search(points_df(spark, coords), len(coords), 3, pivots=24, block=20)
    assert best == diameter(coords)
    assert seen["computed"] < seen["block_pairs"] / 4 and seen["survivors"] < len(coords) / 2


@pytest.mark.parametrize("kind", ["sphere", "line", "grid", "infinite", "pair"])
def test_diameter_search_is_exact(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    if kind == "sphere":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    elif kind == "line":
        x[:, 1:] = 0
    elif kind == "grid":
        x = rng.integers(0, 3, (300, 4)).astype(float)
    elif kind == "infinite":
        x[7, 2] = np.inf
    elif kind == "pair":
        x = x[:2]
    best, _ = D.diameter_search(points_df(spark, x.tolist()), len(x), 4, pivots=16, block=40)
    assert best == diameter(x.tolist())


@pytest.mark.parametrize("kind", ["sphere", "clusters"])
def test_diameter_search_copies_a_point_once_per_pack(spark, monkeypatch, kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 16))
    if kind == "sphere":  # bounds leave nearly all block pairs in question
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    else:
        x[:, 0] += 40 * rng.integers(0, 3, 600)
    copied, real = [], D.side_copies
    monkeypatch.setattr(D, "PARTITIONS_PER_SLOT", 1)
    monkeypatch.setattr(D, "side_copies", lambda *a: copied.append((df := real(*a)).count()) or df)
    best, seen = D.diameter_search(points_df(spark, x.tolist()), len(x), 16, pivots=64, block=150)
    assert best == diameter(x.tolist())
    assert copied and max(copied) <= 4 * len(x) and len(copied) <= 2
    if kind == "sphere":
        assert seen["computed"] > 1000  # many more block pairs than packs make


def test_packs_are_about_equal():
    sizes = {b: 1 + 37 * b % 29 for b in range(80)}
    got = D.packed(sizes, 7)
    totals = [sum(sizes[b] for b in sizes if got[b] == p) for p in range(7)]
    assert set(got) == set(sizes) and max(totals) - min(totals) <= max(sizes.values())


def test_pair_bounds_hold():
    rng = np.random.default_rng(8)
    pivots = rng.normal(size=(6, 3))
    blocks = [rng.normal(size=(20, 3)) + 3 * k for k in range(5)]
    reach = np.array([np.linalg.norm(b[:, None] - pivots[None], axis=2).max(axis=0) for b in blocks])
    bounds = D.pair_bounds(reach, np.array([b.min(axis=0) for b in blocks]), np.array([b.max(axis=0) for b in blocks]))
    for i, a in enumerate(blocks):
        for j, b in enumerate(blocks):
            assert np.linalg.norm(a[:, None] - b[None], axis=2).max() <= bounds[i, j]


def plain_pairs(ida, a, idb, b, diag):
    out = []
    for r in range(len(ida)):
        for c in range(r + 1 if diag else 0, len(idb)):
            out.append((-sqd(a[:, r], b[:, c]), *sorted((int(ida[r]), int(idb[c])))))
    return sorted(x for x in out if not math.isnan(x[0]))


@pytest.mark.parametrize("kind", range(5))
def test_product_filter_changes_no_bit(kind, monkeypatch):
    monkeypatch.setattr(P, "PRODUCT_ROWS", 16)
    monkeypatch.setattr(P, "PRODUCT_COLS", 32)
    rng = np.random.default_rng(kind)
    for dim in (1, 3, 17):
        make = lambda n: rng.integers(-2, 3, (dim, n)) * 1.0 if kind == 0 else rng.normal(size=(dim, n)) * (1e-4, 1e150, 1.0, 1.0)[kind - 1] + (kind == 3) * 1e7
        a, b = make(50), make(70)
        if kind == 4:
            a[0, 3], b[0, 5] = np.inf, np.inf
        ida, idb = np.arange(50) * 2, np.arange(70) * 2 + 1
        with np.errstate(all="ignore"):
            for sides in ((ida, a, idb, b, False), (ida, a, ida, a, True)):
                want = plain_pairs(*sides)
                d2, i, j, _, n = P._block_pair(*sides, False)
                assert (-d2, i, j) == want[0] and n == (50 * 70 if not sides[4] else 50 * 49 // 2)
                for m in (1, 7, 10_000):
                    d, i, j, complete = P._block_pair_list(*sides, m)
                    positive = [x for x in want if x[0] < 0]
                    assert list(zip((-d).tolist(), i.tolist(), j.tolist())) == positive[:m]
                    assert not complete or m >= len(positive)


@pytest.mark.parametrize("stored", [False, True])
def test_lists_serve_several_rounds(spark, stored, monkeypatch):
    jobs = []
    again = V._Lists.again
    monkeypatch.setattr(V._Lists, "again", lambda self, *a: jobs.append(1) or again(self, *a))
    if stored:
        monkeypatch.setattr(V, "fits_broadcast", lambda *a: False)
    coords = generated(120, 3, 21)
    pts = points_df(spark, coords)
    want = greedy(dict(enumerate(coords)), 30)
    assert ids(O.greedy_matching(pts, 30)) == want
    assert len(jobs) < 14  # 15 rounds
    monkeypatch.setattr(V, "LIST_PAIRS", 2)
    assert ids(O.greedy_matching(pts, 30)) == want and jobs
    flat = points_df(spark, [[1.0], [1.0], [2.0], [1.0], [1.0], [1.0]])
    assert ids(O.greedy_matching(flat, 5)) == greedy({i: [2.0 if i == 2 else 1.0] for i in range(6)}, 5)


def test_far_centers_are_not_computed():
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(8, 2)) * 100
    x = np.concatenate([m + rng.normal(size=(200, 2)) for m in middles])
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(len(x))), pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(np.zeros(len(x), np.int64)),
            pa.array(np.full(len(x), np.inf)), pa.array(np.full(len(x), -1, np.int32)), pa.array(np.zeros(len(x), bool)),
        ],
        names=C.STATE_COLUMNS,
    )
    rounds, earlier, plain = [], {}, np.full(len(x), np.inf)
    order = [200 * k for k in range(8)] + [200 * k + 7 for k in range(8)]
    for pos, i in enumerate(order):
        rounds.append(C._packed([(0, i, x[i].tolist())], pos, 2, earlier))
        earlier.setdefault(0, []).append(x[i].tolist())
        plain = np.minimum(plain, np.sqrt(((x - x[i]) ** 2).sum(axis=1)))
    _, _, md, near, taken, computed = C._apply(batch, rounds, 2)
    assert (md == plain).all() and taken.sum() == 16
    assert (near == np.array([np.linalg.norm(x - x[i], axis=1) for i in order]).argmin(axis=0)).all()
    assert computed < 0.5 * len(x) * len(order)
