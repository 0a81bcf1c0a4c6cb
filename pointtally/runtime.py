"""Session-derived knobs: broadcast budget, lineage cutting, parallelism.

Nothing here creates a session or sets cluster paths.  The checkpoint folder
is whatever the cluster configured (``spark.checkpoint.dir`` /
``SparkContext.setCheckpointDir``); only tests and the bench set one, and only
when it is unset.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024

# Bytes of a point row beyond its coordinates (UnsafeRow header, id, array header).
POINT_ROW_OVERHEAD = 48


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def parse_bytes(text: str) -> int:
    """A size as Spark writes it (``10485760``, ``100MB``, ``1g``, ``-1``) in bytes."""
    found = re.fullmatch(r"\s*(-?[0-9]+)\s*([kmgtp]?)(i?b)?\s*", str(text).lower())
    if not found:
        raise ValueError(f"not a size in bytes: {text!r}")
    return int(found[1]) * _UNITS[found[2]]


def broadcast_budget(spark: SparkSession) -> int:
    """Largest build side (bytes) we broadcast: the session's auto-broadcast threshold, 0 where it is off."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(DEFAULT_BROADCAST_BYTES))
    return max(parse_bytes(raw), 0)


def point_bytes(dim: int) -> int:
    """Estimated size in bytes of one ``(id, v ARRAY<DOUBLE>)`` row."""
    return POINT_ROW_OVERHEAD + 8 * max(dim, 0)


def fits_broadcast(spark: SparkSession, rows: int, row_bytes: int) -> bool:
    """True when ``rows`` rows of ``row_bytes`` stay under the broadcast budget."""
    return rows * row_bytes <= broadcast_budget(spark)


def parallelism(spark: SparkSession) -> int:
    """Number of task slots: enough partitions to keep every core busy."""
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # no classic SparkContext (e.g. a Connect session)
        return max(1, int(spark.conf.get("spark.default.parallelism", "8")))


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The reliable checkpoint folder the cluster names, if any."""
    try:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            return jdir.get()
    except Exception:  # no classic SparkContext
        pass
    return spark.conf.get("spark.checkpoint.dir", None) or None


def scratch_dir(spark: SparkSession) -> str:
    """The folder for written state that all executors share.

    Only a session in one process, with neither setting, gets a folder of its
    own (tests); on a cluster a missing folder is an error.
    """
    folder = checkpoint_dir(spark)
    if folder is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pointtally-"))
        folder = checkpoint_dir(spark)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str = "state") -> DataFrame:
    """Run ``df`` once and cut its lineage.

    With a checkpoint folder (``spark.checkpoint.dir`` on a cluster) the rows
    are written there as Parquet and read back, so a lost executor costs a
    re-read.  Where none is configured they are cached, and a lost block is
    rebuilt from the lineage, which every operator here keeps deterministic.
    """
    folder = checkpoint_dir(df.sparkSession)
    if folder is not None:
        path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


# Input up to this size (bytes) is spread by a shuffle where its scan has too few splits.
SPREAD_BYTES = 256 << 20


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Deal a small input to all slots before CPU-heavy work.

    A small input (one file, one row group) is one task, and tokenizing it
    would run single-threaded; one cheap shuffle spreads it.  Inputs above
    ``SPREAD_BYTES`` (the plan's size estimate), and those with splits enough,
    are left alone: nothing large is ever shuffled for this.
    """
    target = min_partitions or parallelism(df.sparkSession)
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        have = df.rdd.getNumPartitions()
    except Exception:  # no classic session: leave the plan alone
        return df
    return df.repartition(target) if have < target and size <= SPREAD_BYTES else df
