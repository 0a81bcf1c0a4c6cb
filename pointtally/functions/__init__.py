"""Column-expression helpers shared by the operators.

Column helpers return ``pyspark.sql.Column`` objects built from built-in
functions; :mod:`pointtally.functions.arrow` holds the numpy helpers that run
on Arrow record batches inside Spark tasks.
"""

from pointtally.functions.distance import vector_size_stats
from pointtally.functions.hashing import seeded_order_key, stable_bucket
from pointtally.functions.tokens import (
    java_space_split,
    split_lines,
    strict_int,
)

__all__ = [
    "vector_size_stats",
    "seeded_order_key",
    "stable_bucket",
    "java_space_split",
    "split_lines",
    "strict_int",
]
