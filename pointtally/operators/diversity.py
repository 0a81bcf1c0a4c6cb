"""Diversity maximization: coreset, greedy matching, and their composition.

:func:`greedy_matching` is the sequential remote-clique 2-approximation of the
reference re-aimed at DataFrames: each of the ``k // 2`` rounds takes the
farthest pair whose ends are both unused (squared distances, as the reference
compares them; ties to the first ``(i, j)``), and for odd ``k`` the smallest
unused id is added.  The first pairs of every block pair are listed in one
job; rounds are taken from the lists, and lists are renewed only where they end
too early.  The chosen ids (at most ``k``) and the first pairs in order reach
the driver, the latter ``TOP_PAIRS`` at a time.

:func:`diversity_maximization` is the reference's two-round MapReduce: the
per-group farthest-first coreset (``k`` centers of each of ``L`` groups), then
greedy matching on the coreset, then the average distance of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointtally.functions.ranges import with_start
from pointtally.operators.centers import farthest_first
from pointtally.operators.diameter import avg_pairwise_distance
from pointtally.operators.pairs import (
    LIST_SCHEMA,
    chosen_pairs,
    every_pair,
    hashed_blocks,
    kernel_blocks,
    kernel_partitions,
    list_fn,
)
from pointtally.runtime import fits_broadcast, materialize
from pointtally.sources.text import validate_points

RESULT_SCHEMA = "pos bigint, id bigint"

# Pairs listed per block pair, and read by the driver at a time.
LIST_PAIRS = 64
TOP_PAIRS = 4096


def _positions(points: DataFrame, order: list[int]) -> DataFrame:
    spark = points.sparkSession
    pos = spark.createDataFrame([(p, i) for p, i in enumerate(order)], RESULT_SCHEMA)
    return points.join(pos.withColumnRenamed("id", "p_id"), F.col("id") == F.col("p_id")).select("pos", "id", "v")


def _without(points: DataFrame, used: list[int], *columns: str) -> DataFrame:
    """Rows none of whose ``columns`` holds a used id."""
    if not used:
        return points
    gone = points.sparkSession.createDataFrame([(i,) for i in used], "u_id bigint")
    for c in columns:
        points = points.join(gone, F.col(c) == F.col("u_id"), "left_anti")
    return points


def greedy_matching(points: DataFrame, k: int, shape: tuple[int, int] | None = None) -> DataFrame:
    """``k`` points chosen by greedy farthest-pair matching: ``(pos, id, v)``.

    With ``k >= n`` every point is returned (in id order).  Where no remaining
    pair has a distance above 0 (all are 0 or NaN) the first two remaining ids
    are taken (the reference would repeat a point there).
    """
    if k < 0:
        raise ValueError(f"k must be non-negative, got {k}")
    n, dim = validate_points(points, shape=shape)
    if k >= n:
        return with_start(points, "pos", F.col("id"), ["id"]).select("pos", "id", "v")
    used = _greedy_pairs(points, n, dim, k // 2) if k >= 2 else []
    if k % 2:
        used.append(int(_without(points, used, "id").agg(F.min("id")).first()[0]))
    return _positions(points, used)


class _Lists:
    """The first pairs of every block pair, on the driver.

    A pair is ``(-d2, i, j)``; a list that is not complete says nothing about
    pairs after its last.
    """

    def __init__(self, points: DataFrame, nb: int, dim: int, m: int):
        self.placed, self.nb, self.fn = hashed_blocks(points, nb), nb, list_fn(dim, m)
        self.spark = points.sparkSession
        self.jobs = 1
        self.load(every_pair(self.placed, nb).mapInArrow(self.fn, LIST_SCHEMA))

    def again(self, used: set[int], keys: DataFrame) -> DataFrame:
        """The lists of some block pairs without used points."""
        self.jobs += 1
        parts = kernel_partitions(self.spark, self.nb)
        return chosen_pairs(_without(self.placed, sorted(used), "id"), keys, parts).mapInArrow(self.fn, LIST_SCHEMA)

    def load(self, found: DataFrame) -> None:
        self.lists = {}
        self.put(found)

    def put(self, found: DataFrame) -> None:
        for r in found.collect():
            pairs = list(zip([-d for d in r["d2"]], r["i"], r["j"]))
            self.lists[(r["ki"], r["kj"])] = (pairs, r["complete"])

    def certain(self, used: set[int]) -> list[tuple]:
        """Unused pairs in order, up to the end of the first list that may go on."""
        end = min((p[-1] for p, complete in self.lists.values() if p and not complete), default=None)
        free = (x for p, _ in self.lists.values() for x in p if x[1] not in used and x[2] not in used)
        return sorted(x for x in free if end is None or x <= end)[:TOP_PAIRS]

    def refresh(self, used: set[int]) -> bool:
        """Renew the lists that end before the first unused pair; whether there were any."""
        free = (x for p, _ in self.lists.values() for x in p if x[1] not in used and x[2] not in used)
        first = min(free, default=None)
        stale = [k for k, (p, complete) in self.lists.items() if p and not complete and (first is None or p[-1] < first)]
        if not stale:
            return False
        rows = [(*k, s) for s, k in enumerate(stale)]
        # A block pair without free points makes no row: its list is then empty and complete.
        self.lists.update({k: ([], True) for k in stale})
        self.put(self.again(used, self.spark.createDataFrame(rows, "ki bigint, kj bigint, slot bigint")))
        return True

    def close(self) -> None:
        pass


class _StoredLists(_Lists):
    """The same lists as a stored table, where they are too many for the driver."""

    def load(self, found: DataFrame) -> None:
        entries = F.transform(F.arrays_zip("d2", "i", "j"), lambda x: F.struct((-x["d2"]).alias("nd2"), x["i"].alias("i"), x["j"].alias("j")))
        self.table = materialize(found.select("ki", "kj", entries.alias("pairs"), "complete"), "lists")

    def _open(self) -> DataFrame:
        last = F.element_at("pairs", -1)
        return self.table.filter(~F.col("complete") & (F.size("pairs") > 0)).select("ki", "kj", last.alias("last"))

    def _free(self, used: set[int]) -> DataFrame:
        pairs = self.table.select(F.explode("pairs").alias("p")).select("p", "p.i", "p.j")
        return _without(pairs, sorted(used), "i", "j")

    def certain(self, used: set[int]) -> list[tuple]:
        end = self._open().agg(F.min("last").alias("e")).select("e.*").first()
        free = self._free(used)
        if end["nd2"] is not None:
            free = free.filter(F.col("p") <= F.struct(*[F.lit(end[c]).alias(c) for c in ("nd2", "i", "j")]))
        return [tuple(r["p"]) for r in free.orderBy("p").limit(TOP_PAIRS).collect()]

    def refresh(self, used: set[int]) -> bool:
        first = self._free(used).agg(F.min("p").alias("p")).select("p.*").first()
        stale = self._open()
        if first["nd2"] is not None:
            stale = stale.filter(F.col("last") < F.struct(*[F.lit(first[c]).alias(c) for c in ("nd2", "i", "j")]))
        stale = materialize(stale.select("ki", "kj", F.monotonically_increasing_id().alias("slot")), "stale")
        if stale.isEmpty():
            return False
        old = self.table
        rest = old.join(stale.select("ki", "kj"), ["ki", "kj"], "left_anti")
        self.load(self.again(used, stale))
        both = materialize(rest.unionByName(self.table), "lists")
        old.unpersist()
        self.table.unpersist()
        self.table = both
        return True

    def close(self) -> None:
        self.table.unpersist()


def _greedy_pairs(points: DataFrame, n: int, dim: int, rounds: int) -> list[int]:
    """Greedy rounds over lists of the first pairs of every block pair.

    Once a pair is chosen, the pairs that touch it are out; the others keep
    their order.  So the lists serve as many rounds as they reach: every pair
    up to the end of the first list that may go on is known.  Only where that
    is used up are lists renewed, and only those that end before the first
    unused pair.
    """
    spark = points.sparkSession
    nb = kernel_blocks(spark, n, dim)
    few = fits_broadcast(spark, nb * (nb + 1) // 2 * LIST_PAIRS, 24)
    lists = (_Lists if few else _StoredLists)(points, nb, dim, LIST_PAIRS)
    used: list[int] = []
    try:
        while len(used) < 2 * rounds:
            gone = set(used)
            certain = lists.certain(gone)
            for _, i, j in certain:
                if len(used) < 2 * rounds and i not in gone and j not in gone:
                    used += [int(i), int(j)]
                    gone |= {i, j}
            if len(used) < 2 * rounds and not certain and not lists.refresh(gone):
                break
    finally:
        lists.close()
    if len(used) < 2 * rounds:  # nothing but pairs at distance 0 or NaN
        rest = _without(points.select("id"), used, "id").orderBy("id").limit(2 * rounds - len(used)).collect()
        used += [int(r["id"]) for r in rest]
    return used


def coreset(
    points: DataFrame,
    k: int,
    groups: int,
    part: Column | None = None,
    seed: int = 42,
    with_shape: bool = False,
):
    """Round 1: ``k`` farthest-first centers of each group, ``(part, pos, id, v)``.

    Groups default to ``pmod(id, groups)``: exactly ``groups`` of them, whatever
    the sign of the ids.  A group with fewer than ``k`` points contributes all
    of them; an empty group contributes nothing.
    """
    if groups <= 0:
        raise ValueError(f"number of groups must be positive, got {groups}")
    most = groups if part is None else None
    if part is None:
        part = F.pmod(F.col("id"), F.lit(groups))
    return farthest_first(points, k, part=part, seed=seed, strict=False, with_shape=with_shape, most_groups=most)


def diversity_maximization(
    points: DataFrame, k: int, groups: int, part: Column | None = None, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Both rounds: ``(chosen (pos, id, v), value (avg_distance))``.

    Round 1 runs over all points (one round per center); round 2 and the value
    only ever touch the ``k * groups`` coreset points.
    """
    core, (m, dim) = coreset(points, k, groups, part, seed, with_shape=True)
    chosen = greedy_matching(core.select("id", "v"), k, shape=(m, dim))
    value = avg_pairwise_distance(chosen.select("id", "v"), shape=(min(k, m), dim))
    return chosen, value
