"""All unordered point pairs (the reference's ``for i, for j > i`` loops), reduced in blocks.

No pair ever exists as a Spark row.  Points are hashed into ``B`` blocks; a
point of block ``b`` is copied to the block pairs ``(min(b, o), max(b, o))``
for every ``o``, Spark shuffles the copies, and numpy reduces each block pair
to one row: its farthest pair, its number of pairs and, on request, the sum of
their distances.  Ids are unique, so no block is hot.

One rule holds on every path: a distance that is NaN (two infinite coordinates
of one sign) is never the farthest, and makes a sum of distances NaN.
"""

from __future__ import annotations

import math
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import pointtally.functions.arrow as arrow_fns
from pointtally.functions.hashing import stable_bucket
from pointtally.runtime import parallelism

# Task functions defined here travel by value (executors need no copy of the package).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Coordinate bytes per block: a block pair's working set is about four times
# this.  Each point is shuffled B = n / (rows per block) times, so blocks are as
# large as memory allows.
KERNEL_BLOCK_BYTES = 64 << 20
# Rows and columns of a tile of the distance matrix (the working arrays stay in cache).
TILE_ROWS, TILE_COLS = 64, 4096
PRODUCT_ROWS, PRODUCT_COLS = 256, 2048
# A sum of distances takes squared distances from the product form only where they exceed its margin by this
# factor (a relative error of 2^-31 of the distance at most).
CLOSE = 2.0**30
# Share of close pairs from which a whole tile is computed in the plain order, and dimensions below which all are.
CLOSE_SHARE, SUM_DIM = 1 / 8, 8
# Pairs whose distances are computed one by one in a run.
PAIR_RUN = 65_536
# Blocks smaller than this cost more in tasks than they gain, with and without sums of distances.
MIN_BLOCK_ROWS, MIN_PRODUCT_ROWS = 1024, 4096
# Partitions of the block pairs, per task slot.
PARTITIONS_PER_SLOT = 8

GROUP_SCHEMA = "ki bigint, kj bigint, d2 double, i bigint, j bigint, sum_d double, n_pairs bigint"


def _exact_tile(at, bt, rows, cols, out, tmp):
    """Squared distances of a tile, summed one dimension at a time from zero."""
    out.fill(0.0)
    for k in range(at.shape[0]):
        np.subtract.outer(at[k, rows], bt[k, cols], out=tmp)
        np.multiply(tmp, tmp, out=tmp)
        out += tmp
    return out


def _exact_pairs(at, bt, rows, cols):
    """Squared distances of the pairs ``(rows[k], cols[k])``, in the same order of summation."""
    out = np.empty(len(rows))
    for lo in range(0, len(rows), PAIR_RUN):
        r, c = rows[lo : lo + PAIR_RUN], cols[lo : lo + PAIR_RUN]
        acc = np.zeros(len(r))
        for k in range(at.shape[0]):
            diff = at[k, r] - bt[k, c]
            acc += diff * diff
        out[lo : lo + PAIR_RUN] = acc
    return out


def _first_best(best, vals, ida, idb):
    """``best`` or the largest of ``vals``, ``(-d2, i, j)``: ties go to the smallest ids, NaN is no candidate."""
    known = ~np.isnan(vals)
    if not known.any():
        return best
    top = float(vals[known].max())
    if best is not None and top < -best[0]:
        return best
    hit = np.flatnonzero(vals == top)
    pi, pj = np.minimum(ida[hit], idb[hit]), np.maximum(ida[hit], idb[hit])
    first = np.lexsort((pj, pi))[0]
    cand = (-top, int(pi[first]), int(pj[first]))
    return cand if best is None or cand < best else best


def rounding_margin(dim: int, size: float) -> float:
    """How far ``|a|^2 + |b|^2 - 2ab`` and the plain sum of squared differences lie apart at most.

    ``size`` bounds ``|a|^2 + |b|^2``.  With unit roundoff ``u`` and ``g(n) =
    nu / (1 - nu)``: each norm is off by ``g(dim)`` of itself, the sum of the
    ``dim`` products and both norms by ``g(dim + 2)`` of ``2 size``, in any
    order of summation; the plain sum is off by ``g(dim + 2)`` of a value of
    ``2 size`` at most.  Together below ``(5 dim + 10) u size``; what is left
    covers the rounding of ``size`` itself, and underflow is below the last term.
    """
    return (4 * dim + 12) * np.finfo(np.float64).eps * size + 4 * dim * np.finfo(np.float64).tiny


def _block_pair(ida, at, idb, bt, diag: bool, with_sum: bool, least: float = -1.0):
    """``(d2, i, j, sum, pairs)`` over all pairs of two blocks (``(dim, n)`` coordinates).

    With ``diag`` both are the same block in id order, of which the upper
    triangle is taken.  Squared distances are summed one dimension at a time
    from zero, the order of ``Vectors.sqdist``; ties go to the smallest
    ``(i, j)``; ``d2`` is None where every distance is NaN, or below ``least``.

    A tile is first judged by a matrix product (the norms are two further
    coordinates of it): entries whose product form, allowing for
    :func:`rounding_margin`, lies below the best so far are left out, the
    others are computed in the plain order.  The farthest pair is the same to
    the last bit.  The sum takes the product form of all pairs but the close
    ones, whose distance it would not give to nine digits: they are computed in
    the plain order, and so are tiles with many of them, vectors of few
    dimensions and blocks with an infinite coordinate or a size near overflow.
    """
    best, total, count = None, 0.0, 0
    na, nb = len(ida), len(idb)
    dim = at.shape[0]
    floor = least
    by_product = False
    if na and nb and dim >= (SUM_DIM if with_sum else 1):
        with np.errstate(over="ignore", invalid="ignore"):
            norm_a, norm_b = np.einsum("kn,kn->n", at, at), np.einsum("kn,kn->n", bt, bt)
        by_product = bool(norm_a.max() + norm_b.max() < 1e300)  # false for NaN and infinity
    height, width = (PRODUCT_ROWS, PRODUCT_COLS) if by_product else (TILE_ROWS, TILE_COLS)
    acc, tmp = np.empty((height, width)), None
    if by_product:
        wide_a = np.concatenate([-2.0 * at, norm_a[None], np.ones((1, na))]).T
        wide_b = np.concatenate([bt, np.ones((1, nb)), norm_b[None]])
    for r0 in range(0, na, height):
        m = min(height, na - r0)
        for c0 in range(r0 if diag else 0, nb, width):
            w = min(width, nb - c0)
            rows, cols = slice(r0, r0 + m), slice(c0, c0 + w)
            valid = None
            if diag and c0 < r0 + m:  # the tile crosses the diagonal
                valid = np.arange(c0, c0 + w)[None, :] > np.arange(r0, r0 + m)[:, None]
            n = m * w if valid is None else int(valid.sum())
            if not n:
                continue
            count += n
            plain, near = not by_product, None
            if by_product:
                margin = rounding_margin(dim, float(norm_a[rows].max()) + float(norm_b[cols].max()))
                g = np.matmul(wide_a[rows], wide_b[:, cols], out=acc[:m, :w] if w == width else None)
                if with_sum and (valid is not None or float(g.min()) < CLOSE * margin):
                    near = g < CLOSE * margin if valid is None else valid & (g < CLOSE * margin)
                    plain = np.count_nonzero(near) > CLOSE_SHARE * n
            if plain:
                tmp = np.empty_like(acc) if tmp is None else tmp
                dd = _exact_tile(at, bt, rows, cols, acc[:m, :w], tmp[:m, :w])
                if with_sum:
                    total += float(np.sqrt(dd if valid is None else dd[valid]).sum())
                # The largest of the tile and its ties; NaN compares as false.
                known = ~np.isnan(dd) if valid is None else valid & ~np.isnan(dd)
                top = dd.max(where=known, initial=-1.0)
                if top < max(floor, 0.0):
                    continue
                i, j = np.nonzero(known & (dd == top))
                vals = dd[i, j]
            else:
                if valid is not None:
                    g[~valid] = -np.inf
                top = float(g.max())
                floor = max(floor, top - margin)
                i, j = np.nonzero(g >= floor - margin) if top + margin >= floor else ((), ())
                vals = _exact_pairs(at, bt, r0 + i, c0 + j) if len(i) else None
                if with_sum:
                    if near is not None:
                        ni, nj = np.nonzero(near)
                        g[ni, nj] = _exact_pairs(at, bt, r0 + ni, c0 + nj)
                    total += float(np.sqrt(g if valid is None else g[valid]).sum())
                if vals is None:
                    continue
            best = _first_best(best, vals, ida[r0 + i], idb[c0 + j])
            if best is not None:
                floor = max(floor, -best[0])
    d2, i, j = (None, None, None) if best is None else (-best[0], best[1], best[2])
    return d2, i, j, total, count


def grouped_fn(solve, out):
    """Task function over rows sorted by ``(ki, kj)``: ``solve(ki, kj, their table)`` is a row, ``out(pyarrow, rows)`` a record batch."""

    def run(batches):
        import pyarrow as pa

        key, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            ki, kj = batch.column("ki").to_numpy(), batch.column("kj").to_numpy()
            cuts = np.flatnonzero((ki[1:] != ki[:-1]) | (kj[1:] != kj[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                here = (int(ki[a]), int(kj[a]))
                if here != key:
                    if parts:
                        yield out(pa, [solve(*key, pa.Table.from_batches(parts))])
                    key, parts = here, []
                parts.append(batch.slice(a, b - a))
        if parts:
            yield out(pa, [solve(*key, pa.Table.from_batches(parts))])

    return run


def block_side(ids: np.ndarray, vecs: np.ndarray, rows: np.ndarray):
    """Ids and coordinates ``(dim, n)`` of some rows, in id order."""
    rows = rows[np.argsort(ids[rows], kind="stable")]
    return ids[rows], arrow_fns.columns_of(vecs[rows])


def _pairs_fn(dim: int, reduce, out):
    """Task function over rows ``(ki, kj, b, id, v)`` sorted by ``(ki, kj, b)``.

    ``reduce(ids, coordinates, ids, coordinates, same block)`` solves a block
    pair, ``out(pyarrow, rows)`` makes a record batch of ``(ki, kj, *result)``.
    """

    def solve(ki, kj, table):
        ids, blk = table.column("id").to_numpy(), table.column("b").to_numpy()
        vecs = arrow_fns.column_matrix(table.column("v"), dim)
        sides = [x for k in (ki, kj) for x in block_side(ids, vecs, np.flatnonzero(blk == k))]
        return (ki, kj, *reduce(*sides, ki == kj))

    return grouped_fn(solve, out)


def kernel_fn(dim: int, with_sum: bool, least: float = -1.0):
    """Task function over rows ``(ki, kj, b, id, v)`` sorted by ``(ki, kj, b)``: ``GROUP_SCHEMA`` rows."""

    def out(pa, rows):
        names = [c.split()[0] for c in GROUP_SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

    return _pairs_fn(dim, lambda *sides: _block_pair(*sides, with_sum, least), out)


LIST_SCHEMA = "ki bigint, kj bigint, d2 array<double>, i array<bigint>, j array<bigint>, complete boolean"


def _block_pair_list(ida, at, idb, bt, diag: bool, m: int):
    """The first ``m`` pairs of two blocks by ``(-d2, i, j)``, as three arrays, and whether there are no more.

    Pairs at distance 0 or NaN are no candidates.  A tile is judged by the
    product form as in :func:`_block_pair`, against the ``m``-th best so far.
    """
    held = (np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
    floor, complete = 0.0, True
    with np.errstate(over="ignore", invalid="ignore"):
        norm_a, norm_b = np.einsum("kn,kn->n", at, at), np.einsum("kn,kn->n", bt, bt)
        finite = bool((norm_a.max(initial=0.0) + norm_b.max(initial=0.0)) < 1e300)
    for r0 in range(0, len(ida), PRODUCT_ROWS):
        rows = slice(r0, min(r0 + PRODUCT_ROWS, len(ida)))
        for c0 in range(r0 if diag else 0, len(idb), PRODUCT_COLS):
            cols = slice(c0, min(c0 + PRODUCT_COLS, len(idb)))
            shape = (rows.stop - r0, cols.stop - c0)
            valid = np.ones(shape, bool)
            if diag and c0 < rows.stop:
                valid = np.arange(c0, cols.stop)[None, :] > np.arange(r0, rows.stop)[:, None]
            if finite:
                margin = rounding_margin(at.shape[0], float(norm_a[rows].max()) + float(norm_b[cols].max()))
                g = norm_a[rows][:, None] + norm_b[cols][None, :] - 2.0 * (at[:, rows].T @ bt[:, cols])
                g[~valid] = -np.inf
                if g.size > m:
                    least = float(np.partition(g.reshape(-1), g.size - m)[g.size - m])
                    floor = max(floor, least - margin)
                hit = valid & (g >= floor - margin)
            else:
                hit = valid
            i, j = np.nonzero(hit)
            vals = _exact_pairs(at, bt, r0 + i, c0 + j)
            complete = complete and len(i) == int(valid.sum())
            use = vals > 0  # false for NaN
            complete = complete and len(held[0]) + int(use.sum()) <= m
            pi, pj = ida[r0 + i[use]], idb[c0 + j[use]]
            held = tuple(
                np.concatenate(x) for x in zip(held, (vals[use], np.minimum(pi, pj), np.maximum(pi, pj)))
            )
            order = np.lexsort((held[2], held[1], -held[0]))[:m]
            held = tuple(x[order] for x in held)
            if len(order) == m:
                floor = max(floor, float(held[0][-1]))
    return (*held, complete)


def list_fn(dim: int, m: int):
    """Task function over rows ``(ki, kj, b, id, v)`` sorted by ``(ki, kj, b)``: ``LIST_SCHEMA`` rows."""

    def out(pa, solved):
        ki, kj, d2, i, j, complete = zip(*solved)
        types = (pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
        arrays = [pa.array(ki, pa.int64()), pa.array(kj, pa.int64())]
        arrays += [pa.array([x.tolist() for x in c], t) for c, t in zip((d2, i, j), types)] + [pa.array(complete, pa.bool_())]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in LIST_SCHEMA.split(", ")])

    return _pairs_fn(dim, lambda *sides: _block_pair_list(*sides, m), out)


def block_rows(dim: int) -> int:
    """Points per block at most: ``KERNEL_BLOCK_BYTES`` of coordinates."""
    return max(1, KERNEL_BLOCK_BYTES // (8 * max(dim, 1)))


def kernel_blocks(spark, n: int, dim: int, with_sum: bool = False) -> int:
    """Blocks for ``n`` points: as few as memory allows, but several block pairs per task slot."""
    by_tasks = math.ceil(math.sqrt(PARTITIONS_PER_SLOT * parallelism(spark)))
    least = MIN_BLOCK_ROWS if with_sum else MIN_PRODUCT_ROWS
    return max(1, min(by_tasks, math.ceil(n / least)), math.ceil(n / block_rows(dim)))


def kernel_partitions(spark, nb: int) -> int:
    """Partitions of ``nb (nb + 1) / 2`` block pairs: a bounded multiple of the slots."""
    return max(1, min(nb * (nb + 1) // 2, PARTITIONS_PER_SLOT * parallelism(spark)))


def pair_groups(
    points: DataFrame,
    n: int,
    dim: int,
    blocks: int | None = None,
    with_sum: bool = True,
) -> DataFrame:
    """One row per block pair: ``(ki, kj, d2, i, j, sum_d, n_pairs)``.

    ``d2, i, j`` is the farthest pair (ties: smallest ``(i, j)``; null where
    every distance is NaN), ``sum_d`` the sum of distances (0 unless
    ``with_sum``).
    """
    nb = blocks or kernel_blocks(points.sparkSession, n, dim, with_sum)
    return every_pair(hashed_blocks(points, nb), nb).mapInArrow(kernel_fn(dim, with_sum), GROUP_SCHEMA)


def every_pair(placed: DataFrame, nb: int) -> DataFrame:
    """Copies of the points ``(id, v, b)`` for all pairs of ``nb`` blocks."""
    others = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(nb - 1).cast("bigint")))
    copies = placed.select("id", "v", "b", others.alias("o")).select(
        "id", "v", "b", F.least("b", "o").alias("ki"), F.greatest("b", "o").alias("kj")
    )
    code = F.col("ki") * F.lit(nb) - F.expr("ki * (ki - 1) div 2") + F.col("kj") - F.col("ki")  # 0, 1, 2, ... row by row
    return block_pairs(copies, code, kernel_partitions(placed.sparkSession, nb))


def hashed_blocks(points: DataFrame, nb: int) -> DataFrame:
    """``(id, v, b)``: the points with their block, by a hash of the id."""
    return points.select(F.col("id").cast("bigint").alias("id"), "v", stable_bucket(nb, "id").alias("b"))


def block_pairs(copies: DataFrame, code: Column, parts: int) -> DataFrame:
    """Copies ``(id, v, b, ki, kj)`` with every block pair in one of ``parts`` partitions, dealt by ``code`` in turn."""
    return copies.repartitionById(parts, F.pmod(code, F.lit(parts)).cast("int")).sortWithinPartitions("ki", "kj", "b")


def chosen_pairs(placed: DataFrame, keys: DataFrame, parts: int) -> DataFrame:
    """Copies of the points ``(id, v, b)`` for the block pairs ``keys (ki, kj, slot)`` only.

    The keys are joined to the points' blocks before any copy is made.
    """
    sides = keys.select("ki", "kj", "slot", F.explode(F.array_distinct(F.array("ki", "kj"))).alias("kb"))
    return side_copies(placed, sides, parts)


def side_copies(placed: DataFrame, sides: DataFrame, parts: int) -> DataFrame:
    """A copy of the points ``(id, v, b)`` of block ``kb`` for every row ``(ki, kj, slot, kb)`` of ``sides``."""
    copies = placed.join(sides, F.col("b") == F.col("kb")).select("id", "v", "b", "ki", "kj", "slot")
    return block_pairs(copies, F.col("slot"), parts).drop("slot")


def best_pair() -> Column:
    """Aggregate: ``struct(-d2, i, j)`` of the farthest pair over group rows."""
    return F.min(F.when(F.col("d2").isNotNull(), F.struct((-F.col("d2")).alias("nd2"), "i", "j")))


def pair_summary(
    points: DataFrame, n: int, dim: int, blocks: int | None = None, with_sum: bool = True
) -> DataFrame:
    """One row over all unordered pairs: ``(d2, i, j, sum_d, n_pairs)``, see :func:`pair_groups`."""
    partial = pair_groups(points, n, dim, blocks, with_sum)
    return partial.agg(
        best_pair().alias("best"),
        F.sum("sum_d").alias("sum_d"),
        F.coalesce(F.sum("n_pairs"), F.lit(0)).cast("bigint").alias("n_pairs"),
    ).select(
        (-F.col("best.nd2")).alias("d2"),
        F.col("best.i").alias("i"),
        F.col("best.j").alias("j"),
        "sum_d",
        "n_pairs",
    )
