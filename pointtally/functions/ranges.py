"""Ranges of a numeric key, and running totals over a global order."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _array(values: Sequence[int]) -> str:
    return f"array({','.join(f'{int(v)}L' for v in values)})" if values else "cast(array() as array<bigint>)"


def range_bucket(col: Column, bounds: Sequence[int]) -> Column:
    """How many of the ascending ``bounds`` are at most ``col`` (null: null).

    Two levels of about ``sqrt(len(bounds))`` comparisons each.
    """
    bounds = list(bounds)
    if not bounds:
        return F.when(col.isNotNull(), F.lit(0))
    step = max(1, math.isqrt(len(bounds)))
    slices = [[]] + [bounds[i + 1 : i + step] for i in range(0, len(bounds), step)]
    c = F.size(F.filter(F.expr(_array(bounds[::step])), lambda b: b <= col))
    fine = F.size(F.filter(F.element_at(F.expr(f"array({','.join(map(_array, slices))})"), c + 1), lambda b: b <= col))
    return F.when(col.isNotNull(), F.greatest(c - 1, F.lit(0)) * step + F.least(c, F.lit(1)) + fine)


# Weight below which a range is not cut further.
LEAST_RANGE = 10_000
# Steps of an octave that totals are kept for, and times that a dense range is looked at again.
STEPS, LOOKS = 256, 8


def key_step(col: Column) -> Column:
    """Lower end of the step of a BIGINT: itself below ``STEPS``, one of ``STEPS`` equal steps of its octave above; mirrored below 0."""
    size = F.when(col < 0, -(col + 1)).otherwise(col)
    shift = F.greatest(F.length(F.bin(size)) - F.lit(STEPS.bit_length()), F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)
    return F.when(col < 0, -low - 1).otherwise(low)


def _step_totals(keyed: DataFrame, base: int) -> list[tuple[int, int, int]]:
    """``(lowest key, highest key, weight)`` of every step of ``__pt_key - base`` (at most 127 ``STEPS``), null keys first."""
    step = key_step(F.col("__pt_key") - F.lit(base))
    rows = keyed.groupBy(step.alias("s")).agg(F.min("__pt_key"), F.max("__pt_key"), F.sum("__pt_w"))
    return sorted(((r[1], r[2], r[3]) for r in rows.collect()), key=lambda r: (r[0] is not None, r[0]))


def range_totals(keyed: DataFrame, ranges: int) -> list[tuple[int | None, int]]:
    """``(first key, total weight)`` of up to about ``ranges`` ranges of ``__pt_key``, ascending, from one scan; null keys are one of their own.

    Totals of fixed steps are merged into ranges.  Only where one step holds
    far more than its share, and more than one key, are its rows read again,
    by steps from its lowest key.
    """
    steps = _step_totals(keyed, 0)
    out = [(None, w) for low, _, w in steps if low is None]
    steps = [s for s in steps if s[0] is not None]
    total = sum(w for *_, w in steps)
    share = max(total / ranges, min(LEAST_RANGE, total))
    for _ in range(LOOKS):
        dense = [s for s in steps if s[2] > 4 * share and s[0] < s[1]]
        if not dense:
            break
        for low, high, w in dense:
            steps.remove((low, high, w))
            # From the middle, mirrored steps are fine on both sides.
            middle = low + (high - low + 1) // 2
            steps += _step_totals(keyed.filter(F.col("__pt_key").between(low, high)), middle)
        steps.sort()
    for low, _, w in steps:
        if out and out[-1][0] is not None and out[-1][1] + w <= share:
            out[-1] = (out[-1][0], out[-1][1] + w)
        else:
            out.append((low, w))
    return out


def with_start(
    df: DataFrame, name: str, key: Column, order_by: Sequence[str], weight: Column | None = None, ranges: int = 64
) -> DataFrame:
    """Add ``name``: the total ``weight`` (default 1) of all rows before, in ``order_by`` order.

    ``key`` is a BIGINT that rises with that order; rows without one come
    first.  One scan of keys and weights finds about ``ranges`` ranges and
    their totals, of which a row each reaches the driver; a window sums within
    each range.  Nothing is sorted as a whole or cached.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    keyed = df.withColumn("__pt_key", key.cast("bigint")).withColumn("__pt_w", weight)
    totals = range_totals(keyed.select("__pt_key", "__pt_w"), ranges)
    bounds = [low for low, _ in totals if low is not None]
    before, running = [], 0
    for b, (_, total) in enumerate(totals, 1 - (len(totals) - len(bounds))):
        before += [F.lit(b), F.lit(running).cast("bigint")]
        running += total
    placed = keyed.withColumn("__pt_b", F.coalesce(range_bucket(F.col("__pt_key"), bounds), F.lit(0)))
    inside = F.sum("__pt_w").over(
        Window.partitionBy("__pt_b").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(inside, F.lit(0))
    if before:
        start = F.coalesce(F.element_at(F.create_map(*before), F.col("__pt_b")), F.lit(0)) + start
    return placed.withColumn(name, start).drop("__pt_key", "__pt_w", "__pt_b")
