"""Farthest-first traversal (k-center) over a whole point set or per group.

The reference loads a partition into a list and runs the traversal in one
thread.  Here all groups advance together, one round per center:

* each point carries ``md``, its distance to the nearest center of its own
  group so far, ``near``, which one that is, and ``taken`` (already a center);
* a round maps every record batch through numpy (``mapInArrow``): ``md`` is
  brought up to date with the centers chosen since the state was last written,
  and the task's farthest free point of each group (ties: smallest id) is kept
  with its vector -- one row per task and group, however many batches;
* a center farther than ``2 md`` from the point's nearest one cannot lower
  ``md`` (triangle inequality), so such points, and batches of such points,
  are not computed;
* Spark reduces those rows per group, so a round is one pass over the points.

Where the groups are few their centers travel to the tasks from the driver
(size-checked) and no group is gathered anywhere.  Where they are many the
centers stay a DataFrame that is joined to the points, and nothing is
collected; the points of a large group are spread over salts, to each of which
its center is sent, so a group of half the points fills no task.  Both give the
same result.

Rules of the reference on every path: the first center sets ``md``, later ones
lower it only where their distance is smaller; a NaN distance is never smaller
and never the farthest.

The first center of a group is its point with the smallest
``md5('<seed>:<id>')``: seeded, the same on a task retry, and reproducible in
SQL.  It comes from the first job, which also validates the points.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import pointtally.functions.arrow as arrow_fns
from pointtally.functions.hashing import seeded_order_key
from pointtally.runtime import broadcast_budget, fits_broadcast, materialize, point_bytes
from pointtally.sources.text import validate_points

# The task-side helpers travel by value, so executors need no copy of this
# package on their path.
cloudpickle.register_pickle_by_value(arrow_fns)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rounds after which the state of a cached traversal is written anew.
MATERIALIZE_EVERY = 8

# Groups up to which centers go through the driver, if their size fits the
# broadcast budget too; beyond it they stay a DataFrame.
DRIVER_GROUPS = 1_000

# Rows of a group that share a salt, about, where centers are joined to the points.
SALT_ROWS = 100_000

# Relative slack for rounding in the triangle inequality.
SKIP_SLACK = 1e-9

# Pending centers larger than this (bytes) go out as a broadcast variable
# instead of inside every task's closure.
CLOSURE_BYTES = 1 << 20

CENTERS_SCHEMA = "part bigint, pos bigint, id bigint, v array<double>"
STATE_SCHEMA = "id bigint, v array<double>, part bigint, md double, near int, taken boolean"
STATE_COLUMNS = ["id", "v", "part", "md", "near", "taken"]
WINNER_SCHEMA = "part bigint, nmd double, id bigint, v array<double>"
FIRSTS_SCHEMA = "part bigint, n bigint, lo bigint, hi bigint, bad bigint, h string, id bigint, v array<double>"


def _lower(md: np.ndarray, d: np.ndarray, first: bool) -> np.ndarray:
    """``md`` after a center at distances ``d``: the first one's sets it, others lower it."""
    return d if first else np.where(d < md, d, md)


def _apply(batch, payload, dim):
    """``(ids, part, md, near, taken, distances computed)`` of a record batch with the pending rounds applied.

    ``payload`` is a list of rounds ``(first, pos, parts, ids, cols, gaps)``:
    one center per group, groups ascending, coordinates ``(dim, groups)``, and
    the distances ``(groups, pos)`` to the group's earlier centers.
    """
    rounds = payload.value if hasattr(payload, "value") else payload
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    part = batch.column("part").to_numpy(zero_copy_only=False)
    md = batch.column("md").to_numpy(zero_copy_only=False)
    near = batch.column("near").to_numpy(zero_copy_only=False)
    taken = batch.column("taken").to_numpy(zero_copy_only=False)
    cols, computed = None, 0
    for first, pos, parts, cids, centers, gaps in rounds:
        at = np.searchsorted(parts, part)
        at[at == len(parts)] = 0
        own = parts[at] == part
        taken = taken | (own & (cids[at] == ids))
        need = own
        if not first:
            gap = gaps[at, near]
            need = own & ~(np.isfinite(gap) & (gap * (1.0 - SKIP_SLACK) >= 2.0 * md))
        rows = np.flatnonzero(need)
        if not len(rows):
            continue
        if cols is None:
            cols = arrow_fns.columns_of(arrow_fns.column_matrix(batch.column("v"), dim))
        computed += len(rows)
        some = len(rows) < len(ids)
        chosen = centers[:, 0] if len(parts) == 1 else centers[:, at[rows] if some else at]
        d = np.sqrt(arrow_fns.sqdist_to(cols[:, rows] if some else cols, chosen))
        md, near = md.copy(), near.copy()
        if first:
            md[rows], near[rows] = d, 0
        else:
            less = d < md[rows]
            md[rows[less]], near[rows[less]] = d[less], pos
    return ids, part, md, near, taken, computed


def _winners_fn(payload, dim):
    """Task function: the farthest free point of each group among the task's rows, with its vector."""

    def run(batches):
        import pyarrow as pa

        best = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        vectors = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids, part, md, _, taken, _ = _apply(batch, payload, dim)
            free = np.flatnonzero(~taken & ~np.isnan(md))
            here = arrow_fns.first_per_group(part[free], -md[free], ids[free])
            free = free[here]
            rows = [np.concatenate(x) for x in zip(best, (part[free], -md[free], ids[free]))]
            first = arrow_fns.first_per_group(rows[0], rows[1], rows[2])
            best = tuple(x[first] for x in rows)
            own = batch.column("v").take(pa.array(free))
            both = own if vectors is None else pa.concat_arrays([vectors, own])
            vectors = both.take(pa.array(first))
        if len(best[0]):
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in best), vectors], names=["part", "nmd", "id", "v"])

    return run


def _rows_fn(payload, dim):
    """Task function: every row with ``md``, ``near`` and ``taken`` brought up to date."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            _, _, md, near, taken, _ = _apply(batch, payload, dim)
            kept = [batch.column(c) for c in ("id", "v", "part")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(md), pa.array(near, pa.int32()), pa.array(taken)], names=STATE_COLUMNS)

    return run


def _joined_rows_fn(dim: int, first: bool):
    """Task function over state rows joined with their group's newest center ``(c_id, c_v)``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            has = np.asarray(batch.column("c_id").is_valid())
            md = batch.column("md").to_numpy(zero_copy_only=False)
            taken = batch.column("taken").to_numpy(zero_copy_only=False)
            if has.any():
                rows = pa.array(has)
                x = arrow_fns.columns_of(arrow_fns.column_matrix(batch.column("v").filter(rows), dim))
                c = arrow_fns.columns_of(arrow_fns.column_matrix(batch.column("c_v").filter(rows), dim))
                md, taken = md.copy(), taken.copy()
                md[has] = _lower(md[has], np.sqrt(arrow_fns.sqdist_to(x, c)), first)
                same = batch.column("id").filter(rows).to_numpy() == batch.column("c_id").filter(rows).to_numpy()
                taken[has] |= same
            names = ["id", "v", "part", "near", "salt"]
            arrays = [*(batch.column(c) for c in names), pa.array(md), pa.array(taken)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "md", "taken"]).select([*STATE_COLUMNS, "salt"])

    return run


def _farthest(state: DataFrame, payload, dim: int) -> DataFrame:
    """``(part, id, v)``: the farthest free point of every group, one partial row per task and group."""
    partial = state.mapInArrow(_winners_fn(payload, dim), WINNER_SCHEMA)
    best = partial.groupBy("part").agg(F.min(F.struct("nmd", "id", "v")).alias("b"))
    return best.select("part", F.col("b.id").alias("id"), F.col("b.v").alias("v"))


def _firsts_fn():
    """Task function: per group of the task's rows, validation counts and the
    point with the smallest ``(h, id)``."""

    def run(batches):
        import pyarrow as pa

        keys = [np.zeros(0, np.int64)] + [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)]
        stats = np.zeros((0, 4), np.int64)  # n, lo, hi, bad
        vectors = None
        for batch in batches:
            m = batch.num_rows
            if m == 0:
                continue
            v = batch.column("v")
            lens = v.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = v.flatten()
            wrong = np.isnan(flat.to_numpy(zero_copy_only=False)).astype(np.int64)  # null coordinates read as NaN
            run_sum = np.concatenate([[0], np.cumsum(wrong)])
            ends = np.cumsum(lens)
            bad = run_sum[ends] - run_sum[ends - lens] + np.asarray(v.is_null()).astype(np.int64)
            h = np.frombuffer(bytes.fromhex("".join(batch.column("h").to_pylist())), ">u8").reshape(m, 2)
            part = batch.column("part").to_numpy(zero_copy_only=False)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            keys = [np.concatenate(x) for x in zip(keys, (part, h[:, 0].astype(np.uint64), h[:, 1].astype(np.uint64), ids))]
            stats = np.concatenate([stats, np.column_stack([np.ones(m, np.int64), lens, lens, bad])])
            order = np.lexsort(tuple(reversed(keys)))
            keys, stats = [k[order] for k in keys], stats[order]
            both = v if vectors is None else pa.concat_arrays([vectors, v])
            at = np.flatnonzero(np.append(True, keys[0][1:] != keys[0][:-1]))
            stats = np.column_stack(
                [f.reduceat(stats[:, c], at) for c, f in enumerate((np.add, np.minimum, np.maximum, np.add))]
            )
            keys = [k[at] for k in keys]
            vectors = both.take(pa.array(order[at]))
        if len(keys[0]):
            hexes = [f"{a:016x}{b:016x}" for a, b in zip(keys[1].tolist(), keys[2].tolist())]
            cols = [pa.array(keys[0]), *(pa.array(stats[:, c]) for c in range(4)), pa.array(hexes), pa.array(keys[3])]
            names = ["part", "n", "lo", "hi", "bad", "h", "id", "v"]
            yield pa.RecordBatch.from_arrays([*cols, vectors], names=names)

    return run


def _firsts(base: DataFrame, seed: int) -> DataFrame:
    """Per group: validation counts and its first center ``(id, v)``."""
    keyed = base.select("id", "v", "part", seeded_order_key(seed).alias("h"))
    return (
        keyed.mapInArrow(_firsts_fn(), FIRSTS_SCHEMA)
        .groupBy("part")
        .agg(
            F.sum("n").alias("n"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.sum("bad").alias("bad"),
            F.min(F.struct("h", "id", "v")).alias("c"),
        )
        .select("part", "n", "lo", "hi", "bad", F.col("c.id").alias("id"), F.col("c.v").alias("v"))
    )


def _checked(n: int, lo: int, hi: int, bad: int) -> int:
    if bad:
        raise ValueError(f"{bad} null or NaN coordinate(s) or null point(s)")
    if n and lo != hi:
        raise ValueError(f"points of mixed dimension: {lo} to {hi}")
    return int(lo or 0)


def _state_base(points: DataFrame, part: Column | None) -> DataFrame:
    return points.select(
        "id",
        F.col("v").cast("array<double>").alias("v"),
        (F.lit(0) if part is None else part).cast("bigint").alias("part"),
        F.lit(float("inf")).alias("md"),
        F.lit(-1).alias("near"),
        F.lit(False).alias("taken"),
    )


def _packed(rows: Sequence, pos: int, dim: int, earlier: dict | None = None):
    """A round's centers ``(part, id, v)`` as a payload entry; ``earlier`` has the ``pos`` centers of each group so far."""
    rows = sorted(rows, key=lambda r: r[0])
    centers = np.asarray([r[2] for r in rows], np.float64).reshape(len(rows), dim)
    gaps = np.full((len(rows), max(pos, 1)), np.nan)
    with np.errstate(invalid="ignore", over="ignore"):
        for g, r in enumerate(rows):
            if earlier and pos:
                gaps[g] = np.sqrt(arrow_fns.sqdists(centers[g : g + 1], np.asarray(earlier[r[0]], np.float64).reshape(pos, dim)))[0]
    return (
        pos == 0,
        pos,
        np.asarray([r[0] for r in rows], np.int64),
        np.asarray([r[1] for r in rows], np.int64),
        np.ascontiguousarray(centers.T),
        gaps,
    )


class _Payload:
    """Pending rounds for the tasks: inside the closure, or as a broadcast variable that is released."""

    def __init__(self, spark, rounds: list):
        self.shared = None
        self.rounds = rounds
        if sum(c.nbytes + gaps.nbytes for *_, c, gaps in rounds) > CLOSURE_BYTES:
            self.shared = spark.sparkContext.broadcast(rounds)

    def __enter__(self):
        return self.rounds if self.shared is None else self.shared

    def __exit__(self, *exc):
        if self.shared is not None:
            self.shared.destroy()


def _few_groups(base: DataFrame, k: int, firsts: list, dim: int, cached: bool) -> list[tuple]:
    """``(part, pos, id, v)`` of all centers; they travel from the driver to the tasks."""
    spark = base.sparkSession
    state, owned, pending = base, None, []
    chosen, earlier = [], {}

    def add(rows, pos):
        got = [(int(r["part"]), int(r["id"]), list(r["v"])) for r in rows]
        pending.append(_packed(got, pos, dim, earlier))
        chosen.extend((p, pos, i, v) for p, i, v in got)
        for p, _, v in got:
            earlier.setdefault(p, []).append(v)

    try:
        add(firsts, 0)
        for pos in range(1, k):
            if cached and len(pending) >= MATERIALIZE_EVERY:
                with _Payload(spark, pending) as payload:
                    fresh = materialize(state.mapInArrow(_rows_fn(payload, dim), STATE_SCHEMA), "farthest")
                if owned is not None:
                    owned.unpersist()
                state = owned = fresh
                pending.clear()
            with _Payload(spark, pending) as payload:
                rows = _farthest(state, payload, dim).collect()
            if not rows:
                break
            add(rows, pos)
        return chosen
    finally:
        if owned is not None:
            owned.unpersist()


def _salted(base: DataFrame, firsts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The state with its ``salt``, and ``(part, salts)`` of every group.

    Only groups above ``SALT_ROWS`` rows (at most rows / ``SALT_ROWS`` of them)
    have several salts; their number is looked up in a broadcast table if that
    fits the budget, and otherwise is one for all, by the largest group.
    """
    spark = base.sparkSession
    salts = F.ceil(F.col("n") / F.lit(SALT_ROWS)).cast("int")
    large = firsts.filter(F.col("n") > SALT_ROWS).select(F.col("part").alias("g_part"), salts.alias("g_salts"))
    if fits_broadcast(spark, large.count(), 16):
        sized = base.join(F.broadcast(large), F.col("part") == F.col("g_part"), "left")
        many = F.coalesce(F.col("g_salts"), F.lit(1))
        counts = firsts.select("part", F.greatest(salts, F.lit(1)).alias("salts"))
    else:
        sized, many = base, F.lit(-(-most // SALT_ROWS))
        counts = firsts.select("part", many.alias("salts"))
    state = sized.withColumn("salt", F.pmod(F.xxhash64("id"), many).cast("int"))
    return state.select(*STATE_COLUMNS, "salt"), counts


def _with_newest(state: DataFrame, newest: DataFrame, salts: DataFrame) -> DataFrame:
    """The state's rows with their group's newest center ``(c_id, c_v)``, by group and salt."""
    centers = (
        newest.join(salts.withColumnRenamed("part", "g_part"), F.col("part") == F.col("g_part"))
        .withColumn("c_salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .select(F.col("part").alias("c_part"), "c_salt", F.col("id").alias("c_id"), F.col("v").alias("c_v"))
    )
    same = (F.col("part") == F.col("c_part")) & (F.col("salt") == F.col("c_salt"))
    return state.join(centers, same, "left").drop("c_part", "c_salt")


def _many_groups(base: DataFrame, k: int, firsts: DataFrame, dim: int, most: int) -> DataFrame:
    """``CENTERS_SCHEMA`` rows; the centers stay a DataFrame and are joined to the points by group and salt.

    A round shuffles the points once by ``(part, salt)`` and writes them back;
    the tasks that read them then hold few groups each.
    """
    state, salts = _salted(base, firsts, most)
    newest = firsts.select("part", "id", "v")
    out = None
    for pos in range(k):
        rows = newest.select("part", F.lit(pos).cast("bigint").alias("pos"), "id", "v")
        out = rows if out is None else out.unionAll(rows)
        if pos == k - 1:
            break
        joined = _with_newest(state, newest, salts)
        state = materialize(joined.mapInArrow(_joined_rows_fn(dim, pos == 0), STATE_SCHEMA + ", salt int"), "farthest")
        newest = materialize(_farthest(state, [], dim), "centers")
    return out


def farthest_first(
    points: DataFrame,
    k: int,
    part: Column | None = None,
    seed: int = 42,
    strict: bool | None = None,
    with_shape: bool = False,
    storage_level: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    driver_groups: int = DRIVER_GROUPS,
    most_groups: int | None = None,
):
    """Farthest-first traversal: ``k`` centers per group, in order of choice.

    ``points`` is ``(id, v)``.  Without ``part`` the whole set is one group
    (the reference's k-center); with ``part`` (a column over the points, e.g.
    ``pmod(id, L)``) every group gets its own ``k`` centers (the coreset
    round).  ``strict`` (default: whole set only) raises when a group has fewer
    than ``k`` points to choose; otherwise such a group returns all of them.
    ``most_groups`` is a known bound of the number of groups.

    Returns ``(part, pos, id, v)``; with ``with_shape`` also ``(number of
    centers, dim)``.

    Jobs: one that validates and picks the first centers (and fills the
    cache), then a round per further center.  ``storage_level`` caches the
    points for those passes; ``None`` re-reads the source every round instead,
    for inputs beyond cluster memory: with few groups nothing is cached then.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    if strict is None:
        strict = part is None
    spark = points.sparkSession
    base = _state_base(points, part)
    if storage_level is not None:
        base = base.persist(storage_level)
    firsts = found = _firsts(base, seed)
    if (1 if part is None else most_groups or driver_groups + 1) > driver_groups:
        found.persist(StorageLevel.MEMORY_AND_DISK)  # so that many groups are not counted twice
    try:
        rows = firsts.limit(driver_groups + 1).collect()
        few = len(rows) <= driver_groups
        if not few:
            firsts = materialize(firsts, "firsts")
            totals = (F.sum("n"), F.min("lo"), F.max("hi"), F.sum("bad"), F.min("n"), F.max("n"), F.count(F.lit(1)))
            n, lo, hi, bad, least, most, groups = firsts.agg(*totals).first()
        else:
            groups = len(rows)
            n = sum(r["n"] for r in rows)
            lo, hi = min((r["lo"] for r in rows), default=0), max((r["hi"] for r in rows), default=0)
            bad, least = sum(r["bad"] for r in rows), min((r["n"] for r in rows), default=0)
            most = max((r["n"] for r in rows), default=0)
        dim = _checked(n, lo, hi, bad)
        if strict and k > least:
            raise ValueError(f"cannot choose {k} centers from {least} points")
        pending = k if storage_level is None else min(k, MATERIALIZE_EVERY)
        few = few and groups * point_bytes(dim) * pending <= max(broadcast_budget(spark), CLOSURE_BYTES)
        if few:
            chosen = _few_groups(base, k, rows, dim, storage_level is not None) if rows else []
            chosen.sort(key=lambda t: (t[0], t[1]))
            count = len(chosen)
            out = spark.createDataFrame(chosen, CENTERS_SCHEMA)
        else:
            out = _many_groups(base, k, firsts, dim, most)
            count = out.count() if strict or with_shape else None
        if strict and count < k * groups:
            raise ValueError(f"a group has fewer than {k} points to choose")
    finally:
        found.unpersist()
        if storage_level is not None:
            base.unpersist()
    return (out, (count, dim)) if with_shape else out


def nearest_center_distance(points: DataFrame, centers: DataFrame, dim: int | None = None) -> DataFrame:
    """``(id, dist)``: each point's distance to its nearest center, null without centers.

    Centers travel to the tasks in blocks that fit the broadcast budget; one
    block is one pass over the points without a shuffle, and between blocks the
    distances so far are written.  A NaN distance is never the nearest; where
    all are NaN the result is NaN.  ``dim`` skips the validation pass when the
    caller already validated the points.
    """
    spark = points.sparkSession
    n, dim = (1, dim) if dim is not None else validate_points(points)
    per_block = max(1, max(broadcast_budget(spark), CLOSURE_BYTES) // point_bytes(dim))
    total = centers.count()
    blocks = -(-total // per_block)
    centers = centers.select("id", F.col("v").cast("array<double>").alias("v"))
    state = _state_base(points, None)
    if blocks > 1:
        centers = materialize(centers.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(2 * blocks))), "centers")
        blocks *= 2  # hashed blocks vary in size
    for b in range(blocks):
        rows = (centers if blocks == 1 else centers.filter(F.col("block") == b)).select("id", "v").collect()
        if n and rows and len(rows[0]["v"]) != dim:
            raise ValueError("centers and points differ in dimension")
        packed = [np.asarray(r["v"], np.float64) for r in rows]
        state = state.mapInArrow(_nearest_fn(packed, dim), STATE_SCHEMA)
        if b < blocks - 1:
            state = materialize(state, "nearest")
    dist = F.when(F.lit(total) == 0, F.lit(None).cast("double")).otherwise(
        F.when(F.col("taken") | (F.col("md") < float("inf")), F.col("md")).otherwise(F.lit(float("nan")))
    )
    return state.select("id", dist.alias("dist"))


def _nearest_fn(centers, dim):
    """Task function: ``md`` lowered by the centers; ``taken`` marks rows with any distance that is not NaN."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            md = batch.column("md").to_numpy(zero_copy_only=False)
            known = batch.column("taken").to_numpy(zero_copy_only=False)
            if batch.num_rows:
                cols = arrow_fns.columns_of(arrow_fns.column_matrix(batch.column("v"), dim))
                for center in centers:
                    d = np.sqrt(arrow_fns.sqdist_to(cols, center))
                    md = np.where(d < md, d, md)
                    known = known | ~np.isnan(d)
            kept = [batch.column(c) for c in ("id", "v", "part")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(md), batch.column("near"), pa.array(known)], names=STATE_COLUMNS)

    return run
