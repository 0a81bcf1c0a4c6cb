"""Point validation as Spark column expressions.

Distances run in numpy over Arrow batches (:mod:`pointtally.functions.arrow`):
Spark evaluates array arithmetic element by element at several microseconds
per 64-d distance.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_size_stats(v: Column | str = "v") -> list[Column]:
    """Aggregates that validate a point column in one pass.

    Returns ``n``, ``min_dim``, ``max_dim`` and ``n_bad`` (rows whose vector is
    null or holds a null or NaN coordinate).
    """
    col = F.col(v) if isinstance(v, str) else v
    # arrays_overlap(v, [NaN]) is true for a NaN (Spark treats NaN = NaN),
    # null when v holds a null element, false otherwise -- one codegen'd
    # scan, several times cheaper than exists(v, x -> ...).
    bad = col.isNull() | F.coalesce(F.arrays_overlap(col, F.array(F.lit(float("nan")))), F.lit(True))
    return [
        F.count(F.lit(1)).alias("n"),
        F.min(F.size(col)).alias("min_dim"),
        F.max(F.size(col)).alias("max_dim"),
        F.sum(F.when(bad, 1).otherwise(0)).alias("n_bad"),
    ]
