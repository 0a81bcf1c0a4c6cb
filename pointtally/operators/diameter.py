"""Maximum and average pairwise distance, and seeded point sampling.

* :func:`exact_diameter` -- max over all unordered pairs (the block kernel).
  For large sets it is a branch and bound (:func:`diameter_search`): points are
  dealt to the nearest of some pivots, every block knows how far it reaches
  from each pivot and its bounding box, and block pairs are computed in
  descending order of the bound these give until it falls below the longest
  distance found.
* :func:`two_approx_diameter` -- max distance between every point and ``k``
  sampled points: the sample travels with the tasks, one pass, no join.
* :func:`avg_pairwise_distance` -- mean over all unordered pairs.

A NaN distance is never the largest on any path; an average over one is NaN.
"""

from __future__ import annotations

import heapq
import math
import sys

import numpy as np
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import pointtally.functions.arrow as arrow_fns
from pointtally.functions.hashing import seeded_order_key
from pointtally.functions.ranges import with_start
from pointtally.operators.pairs import PARTITIONS_PER_SLOT, _block_pair, block_rows, block_side, grouped_fn, kernel_blocks, pair_summary, side_copies
from pointtally.runtime import broadcast_budget, fits_broadcast, materialize, parallelism, point_bytes
from pointtally.sources.text import validate_points

# Task functions defined here travel by value (executors need no copy of the package).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRUNE_CENTERS = 8
# Pivots of the branch and bound, within the broadcast budget.
PIVOTS = 64
# Exact pruning is tried from this many points on (its O(k n) passes are then
# negligible against the O(n^2) pair phase); the result is the same either way.
PRUNE_MIN_POINTS = 100_000
# Relative slack for floating-point error in the triangle inequality.
PRUNE_SLACK = 1e-9
# Sample sizes up to which one task holds the sample while it is ordered.
SAMPLE_TASK_ROWS = 100_000


def _one_value(spark, name: str, value: float) -> DataFrame:
    return spark.createDataFrame([(float(value),)], f"{name} double")


def sample_points(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``k`` points without replacement, seeded: ``(pos, id, v)`` in draw order.

    The draw order is ``md5('<seed>:<id>')`` (ties on id).  Every task keeps
    its own top ``k`` and those are merged; a sample too large for one task is
    taken by rank over ranges of the key instead.
    """
    if k < 0:
        raise ValueError(f"sample size must be non-negative, got {k}")
    keyed = points.select("id", "v", seeded_order_key(seed).alias("h"))
    if k <= SAMPLE_TASK_ROWS:
        # One ordered partition: the position in it is the draw order.
        top = keyed.orderBy("h", "id").limit(k)
        return top.select(F.monotonically_increasing_id().alias("pos"), "id", "v")
    rank = F.conv(F.substring("h", 1, 15), 16, 10).cast("bigint")
    return with_start(keyed, "pos", rank, ["h", "id"]).filter(F.col("pos") < k).select("pos", "id", "v")


def _max_d2(points: DataFrame, n: int, dim: int, blocks: int | None) -> DataFrame:
    return pair_summary(points, n, dim, blocks, with_sum=False).select("d2")


def exact_diameter(
    points: DataFrame,
    prune: bool | None = None,
    shape: tuple[int, int] | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """``(diameter DOUBLE)``: the largest pairwise distance, ``-1`` where there is none.

    There is none below two points, or where every distance is NaN.  ``prune``
    forces the exact triangle-inequality pruning on or off (default: on from
    ``PRUNE_MIN_POINTS`` points); see :func:`diameter_search`.
    """
    spark = points.sparkSession
    n, dim = validate_points(points, shape=shape)
    if n < 2:
        return _one_value(spark, "diameter", -1.0)
    if prune is None:
        prune = n >= PRUNE_MIN_POINTS
    if prune:
        return _one_value(spark, "diameter", diameter_search(points, n, dim)[0])
    return _max_d2(points, n, dim, blocks).select(F.coalesce(F.sqrt("d2"), F.lit(-1.0)).alias("diameter"))


def _reach_fn(pivots: np.ndarray, dim: int):
    """Task function: per block (nearest pivot) of the task's points, their number, the largest squared
    distance to every pivot and the bounding box.

    A NaN distance counts as infinite, so that its point excludes nothing.
    """

    def run(batches):
        import pyarrow as pa

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = arrow_fns.column_matrix(batch.column("v"), dim)
            d2 = arrow_fns.sqdists(x, pivots)
            d2 = np.where(np.isnan(d2), np.inf, d2)
            held = _merged_reach(held, d2.argmin(axis=1), np.ones(len(x), np.int64), d2, x, x)
        if held is not None:
            yield _reach_batch(pa, held)

    return run


def _merged_reach(held, blocks, counts, far, low, high):
    """Block statistics joined with further rows of them, one row per block."""
    rows = (blocks, counts, far, low, high)
    if held is not None:
        rows = tuple(np.concatenate(x) for x in zip(held, rows))
    order = np.argsort(rows[0], kind="stable")
    blocks = rows[0][order]
    first = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
    how = (np.add, np.maximum, np.minimum, np.maximum)
    return blocks[first], *(f.reduceat(x[order], first, axis=0) for f, x in zip(how, rows[1:]))


def _reach_batch(pa, held):
    blocks, counts, *wide = held
    arrays = [pa.array(blocks.astype(np.int64)), pa.array(counts)] + [pa.array(list(x), pa.list_(pa.float64())) for x in wide]
    return pa.RecordBatch.from_arrays(arrays, names=["b", "n", "far", "low", "high"])


REACH_SCHEMA = "b bigint, n bigint, far array<double>, low array<double>, high array<double>"


def _merge_reach_fn(n_pivots: int, dim: int):
    """Task function: the statistics of each block among the task's rows, merged."""

    def run(batches):
        import pyarrow as pa

        held = None
        for batch in batches:
            if batch.num_rows:
                wide = [arrow_fns.column_matrix(batch.column(c), k) for c, k in (("far", n_pivots), ("low", dim), ("high", dim))]
                held = _merged_reach(held, batch.column("b").to_numpy(), batch.column("n").to_numpy(), *wide)
        if held is not None:
            yield _reach_batch(pa, held)

    return run


def pair_bounds(reach: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Upper bound of the distance between a point of block ``i`` and one of block ``j``, ``(blocks, blocks)``.

    By the triangle inequality over every pivot (``reach[i, p]``: the farthest
    that block ``i`` lies from pivot ``p``), and by the bounding boxes.
    """
    nb = len(reach)
    out = np.empty((nb, nb))
    with np.errstate(invalid="ignore", over="ignore"):
        for i in range(nb):
            around = (reach[i] + reach).min(axis=1)
            span = np.maximum(np.abs(high[i] - low), np.abs(high - low[i]))
            box = np.sqrt((span * span).sum(axis=1))
            out[i] = np.fmin(around, np.where(np.isnan(box), np.inf, box))
    return out * (1.0 + PRUNE_SLACK)


def _survivors_fn(pivots: np.ndarray, reach: np.ndarray, alive: np.ndarray, lower: float, dim: int):
    """Task function: ``(id, v, k)`` of the points that may lie on a pair longer than ``lower``.

    ``alive[i, j]`` tells the block pairs still in question; a point of block
    ``i`` stays if the triangle inequality allows a partner in some such ``j``.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            d2 = arrow_fns.sqdists(arrow_fns.column_matrix(batch.column("v"), dim), pivots)
            d2 = np.where(np.isnan(d2), np.inf, d2)
            block = d2.argmin(axis=1)
            d = np.sqrt(d2)
            stays = np.zeros(len(d), bool)
            for j in range(len(reach)):
                rows = np.flatnonzero(alive[block, j] & ~stays)
                if len(rows):
                    stays[rows] = (d[rows] + reach[j]).min(axis=1) * (1.0 + PRUNE_SLACK) >= lower
            keep = pa.array(stays)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").filter(keep), batch.column("v").filter(keep), pa.array(block[stays].astype(np.int64))],
                names=["id", "v", "k"],
            )

    return run


SEARCH_SCHEMA = "d2 double, computed bigint"


def _search_fn(dim: int, bounds: np.ndarray, pivot_of: np.ndarray, pack_of: np.ndarray, turn: float, near: bool, lower: float):
    """Task function over rows ``(ki, kj, b, id, v)`` sorted by ``(ki, kj, b)``, where ``ki`` and ``kj`` are packs of
    blocks: ``SEARCH_SCHEMA`` rows, the largest squared distance above ``lower`` and the block pairs computed.

    Block pairs whose bound is at least ``turn`` (with ``near``: below it) are
    taken farthest bound first, until it does not exceed the longest distance found.
    """

    def solve(ki, kj, table):
        ids, blk = table.column("id").to_numpy(), table.column("b").to_numpy()
        vecs = arrow_fns.column_matrix(table.column("v"), dim)
        sides = {int(b): block_side(ids, vecs, np.flatnonzero(blk == b)) for b in np.unique(blk)}
        todo = []
        for a in sides:
            for b in sides:
                bound = float(bounds[pivot_of[a], pivot_of[b]])
                here = (pack_of[a], pack_of[b]) == (ki, kj) and (ki != kj or a <= b)
                if here and near == (bound < turn):
                    todo.append((-bound, a, b))
        best, found, computed = lower, None, 0
        for bound, a, b in sorted(todo):
            if -bound <= math.sqrt(max(best, 0.0)):
                break
            d2 = _block_pair(*sides[a], *sides[b], a == b, False, best)[0]
            computed += 1
            if d2 is not None:
                found = d2 if found is None else max(found, d2)
                best = max(best, d2)
        return found, computed

    def out(pa, rows):
        d2, computed = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(d2, pa.float64()), pa.array(computed, pa.int64())], names=["d2", "computed"])

    return grouped_fn(solve, out)


def packed(sizes: dict[int, int], packs: int) -> dict[int, int]:
    """A pack for every block, such that the packs are about equally large (the largest block goes to the least pack first)."""
    heap = [(0, p) for p in range(packs)]
    out = {}
    for b in sorted(sizes, key=lambda b: (-sizes[b], b)):
        total, p = heapq.heappop(heap)
        out[b] = p
        heapq.heappush(heap, (total + sizes[b], p))
    return out


def diameter_search(
    points: DataFrame, n: int, dim: int, pivots: int = PIVOTS, block: int | None = None
) -> tuple[float, dict[str, int]]:
    """The diameter (``-1`` where every distance is NaN), and counts: points that could matter
    (``survivors``), block pairs there are and were ``computed``.

    Pivots are some farthest-first centers, whose distances to all points give
    a first lower bound, and a seeded sample.  One pass gathers the blocks'
    statistics, a second keeps the points that can matter; what reaches the
    driver is a row per pivot.  Blocks are put into as few packs as the plain
    block kernel has blocks (at most ``block`` points on average); a larger
    block is cut by a hash of the id.  A task gets the points of a pair of packs
    once, for all block pairs between them: however many blocks there are, a
    point is copied once per pack at most.  Block pairs are computed in two
    rounds, those of the farthest bounds first, which raises the lower bound
    for the others.  The answer is exact: a pair is left out only where its
    bound, with ``PRUNE_SLACK`` for rounding, does not exceed a distance found.
    """
    from pointtally.operators.centers import farthest_first

    spark = points.sparkSession
    pts = points.select(F.col("id").cast("bigint").alias("id"), F.col("v").cast("array<double>").alias("v"))
    pts = pts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit = max(PRUNE_CENTERS, max(broadcast_budget(spark), 1 << 20) // (2 * point_bytes(dim)))
        wanted = max(2, min(pivots, fit, n))
        far = farthest_first(pts, min(PRUNE_CENTERS, wanted), strict=False, storage_level=None).select("id", "v")
        drawn = sample_points(pts, wanted).select("id", "v").collect()
        rows = {r["id"]: list(r["v"]) for r in [*far.collect(), *drawn]}
        centers = np.asarray([rows[i] for i in sorted(rows)], np.float64).reshape(len(rows), dim)
        parts = max(1, min(len(rows), parallelism(spark)))
        stats = (
            pts.mapInArrow(_reach_fn(centers, dim), REACH_SCHEMA)
            .repartition(parts, "b")
            .mapInArrow(_merge_reach_fn(len(rows), dim), REACH_SCHEMA)
            .collect()
        )
        stats.sort(key=lambda r: r["b"])
        known = [r["b"] for r in stats]
        far2 = np.asarray([list(r["far"]) for r in stats]).reshape(len(stats), len(rows))
        low, high = (np.asarray([list(r[c]) for r in stats]).reshape(len(stats), dim) for c in ("low", "high"))
        reach = np.full((len(rows), len(rows)), -np.inf)
        reach[known] = np.sqrt(far2)
        # The farthest point of a pivot is a real pair; NaN distances were made infinite and prove nothing.
        real = far2[np.isfinite(far2)]
        lower = float(real.max()) if len(real) else -1.0
        bounds = np.full((len(rows), len(rows)), -np.inf)
        bounds[np.ix_(known, known)] = pair_bounds(reach[known], low, high)
        alive = bounds > math.sqrt(max(lower, 0.0))
        stays = _survivors_fn(centers, reach, alive, math.sqrt(max(lower, 0.0)), dim)
        kept = materialize(pts.mapInArrow(stays, "id bigint, v array<double>, k bigint"), "survivors")
    finally:
        pts.unpersist()
    sizes = {r["k"]: r["count"] for r in kept.groupBy("k").count().collect()}
    left = sum(sizes.values())
    packs = max(1, kernel_blocks(spark, left, dim), -(-left // (block or block_rows(dim))))
    per_block = -(-left // packs) or block or block_rows(dim)
    cuts = {k: -(-m // per_block) for k, m in sizes.items()}
    starts, total = {}, 0
    for k in sorted(cuts):
        starts[k], total = total, total + cuts[k]
    pack = packed({starts[k] + i: sizes[k] // cuts[k] for k in cuts for i in range(cuts[k])}, packs)
    pivot_of = np.repeat(sorted(cuts), [cuts[k] for k in sorted(cuts)]).astype(np.int64)
    pack_of = np.asarray([pack[b] for b in range(total)], np.int64)
    todo = [
        (float(bounds[a, b]), starts[a] + i, starts[b] + j)
        for a in sorted(cuts)
        for b in sorted(cuts)
        if a <= b and alive[a, b]
        for i in range(cuts[a])
        for j in range(i if a == b else 0, cuts[b])
    ]
    todo.sort(key=lambda t: (-t[0], t[1], t[2]))
    done, best = 0, lower
    if todo:
        first = F.create_map(*[F.lit(x) for k in sorted(cuts) for x in (k, starts[k])])
        many = F.create_map(*[F.lit(x) for k in sorted(cuts) for x in (k, cuts[k])])
        block_of = F.element_at(first, F.col("k")) + F.pmod(F.xxhash64("id"), F.element_at(many, F.col("k")))
        placed = kept.select("id", "v", block_of.cast("bigint").alias("b"))
        # Block pairs of equal bounds are in the same round.
        turn = todo[min(len(todo), PARTITIONS_PER_SLOT * parallelism(spark)) - 1][0]
        for near in (False, True):
            now = [t for t in todo if near == (t[0] < turn) and not t[0] <= math.sqrt(max(best, 0.0))]
            if not now:
                continue
            needs = {(*sorted((pack[a], pack[b])), x) for _, a, b in now for x in (a, b)}
            slots = {key: s for s, key in enumerate(sorted({need[:2] for need in needs}))}
            sides = spark.createDataFrame(
                [(*need[:2], slots[need[:2]], need[2]) for need in sorted(needs)], "ki bigint, kj bigint, slot bigint, kb bigint"
            )
            if fits_broadcast(spark, len(needs), 40):
                sides = F.broadcast(sides)
            got = (
                side_copies(placed, sides, min(len(slots), PARTITIONS_PER_SLOT * parallelism(spark)))
                .mapInArrow(_search_fn(dim, bounds, pivot_of, pack_of, turn, near, best), SEARCH_SCHEMA)
                .agg(F.max("d2").alias("d2"), F.sum("computed").alias("computed"))
                .first()
            )
            best = best if got["d2"] is None else max(best, got["d2"])
            done += got["computed"] or 0
    blocks = sum(-(-r["n"] // per_block) for r in stats)
    counts = {"survivors": left, "block_pairs": blocks * (blocks + 1) // 2, "computed": done}
    return (math.sqrt(best) if best >= 0 else -1.0), counts


def _far_fn(sample, dim: int):
    """Task function: validation counts and the largest squared distance to any sampled point."""

    def run(batches):
        import pyarrow as pa

        centers = sample.value if hasattr(sample, "value") else sample
        total = None
        for batch in batches:
            n, lo, hi, bad = arrow_fns.vector_stats(batch.column("v"))
            if n == 0:
                continue
            far = -np.inf
            if not bad and lo == hi == dim:
                far = float(arrow_fns.max_sqdist(arrow_fns.column_matrix(batch.column("v"), dim), centers).max())
            row = (n, lo, hi, bad, far)
            total = row if total is None else (
                total[0] + n, min(total[1], lo), max(total[2], hi), total[3] + bad, max(total[4], far)
            )
        if total is not None:
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(total, types)], names=["n", "lo", "hi", "bad", "far"]
            )

    return run


def two_approx_diameter(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``(diameter DOUBLE)``: max distance between any point and ``k`` sampled points.

    Lies in ``[D/2, D]``; ``-1`` for ``k = 0`` or where every distance is NaN;
    ``k`` larger than the set fails.  The seeded sample travels to the tasks in
    parts that fit the broadcast budget; each part is one ``mapInArrow`` pass
    that also validates the points.
    """
    spark = points.sparkSession
    if k < 0:
        raise ValueError(f"sample size must be non-negative, got {k}")
    if k == 0:
        return _one_value(spark, "diameter", -1.0)
    pts = points.select("id", F.col("v").cast("array<double>").alias("v"))
    dim = len((pts.select("v").first() or [[]])[0] or [])
    per_part = max(1, broadcast_budget(spark) // point_bytes(dim))
    drawn = sample_points(pts, k, seed)
    if k > per_part:
        drawn = materialize(drawn, "sample")
    best, seen = -math.inf, 0
    for start in range(0, k, per_part):
        rows = (drawn if k <= per_part else drawn.filter(F.col("pos").between(start, start + per_part - 1))).collect()
        seen += len(rows)
        if not rows or len(rows) < min(per_part, k - start):
            raise ValueError(f"cannot sample {k} points from {seen}")
        dims = {len(r["v"] or []) for r in rows}
        if dims != {dim}:
            raise ValueError(f"points of mixed dimension: {min(dims | {dim})} to {max(dims | {dim})}")
        sample = np.asarray([list(r["v"]) for r in rows], dtype=np.float64).reshape(len(rows), dim)
        shared = spark.sparkContext.broadcast(sample)
        try:
            stats = (
                pts.mapInArrow(_far_fn(shared, dim), "n bigint, lo bigint, hi bigint, bad bigint, far double")
                .agg(
                    F.sum("n").alias("n"),
                    F.min("lo").alias("min_dim"),
                    F.max("hi").alias("max_dim"),
                    F.sum("bad").alias("n_bad"),
                    F.max("far").alias("far"),
                )
                .first()
            )
        finally:
            shared.destroy()
        _check_stats(stats)
        best = max(best, stats["far"])
    return _one_value(spark, "diameter", math.sqrt(best) if best >= 0 else -1.0)


def _check_stats(row) -> None:
    if row["n"] and row["n_bad"]:
        raise ValueError(f"{row['n_bad']} point(s) have a null or NaN coordinate")
    if row["n"] and row["min_dim"] != row["max_dim"]:
        raise ValueError(f"points of mixed dimension: {row['min_dim']} to {row['max_dim']}")


def avg_pairwise_distance(
    points: DataFrame, shape: tuple[int, int] | None = None, blocks: int | None = None
) -> DataFrame:
    """``(avg_distance DOUBLE)``: mean distance over unordered pairs; NaN below two points."""
    spark = points.sparkSession
    n, dim = validate_points(points, shape=shape)
    if n < 2:
        return _one_value(spark, "avg_distance", float("nan"))
    return pair_summary(points, n, dim, blocks).select(
        F.coalesce(F.col("sum_d") / F.col("n_pairs"), F.lit(float("nan"))).alias("avg_distance")
    )


__all__ = [
    "sample_points",
    "exact_diameter",
    "two_approx_diameter",
    "avg_pairwise_distance",
]
