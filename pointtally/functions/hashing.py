"""Deterministic, retry-safe pseudo-randomness keyed on row identity.

The reference draws from ``java.util.Random``; a re-executed Spark task must
make the same choice, so randomness here is a hash of ``(seed, id)`` and never
depends on row order, partition layout or ``rand()``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_order_key(seed: int, id_col: Column | str = "id") -> Column:
    """``md5('<seed>:<id>')`` as hex text.

    Ordering by this key (ties on ``id``) is a seeded uniform permutation.  The
    same text comes out of DuckDB's ``md5('42:' || id)``, which is what makes
    the sampling operators checkable against SQL.
    """
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), idc.cast("string")))


def stable_bucket(n: int, *cols: Column | str) -> Column:
    """``pmod(xxhash64(cols), n)``: a deterministic bucket in ``[0, n)``."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("bigint")
