"""Shared helpers: the cluster's shared folder, cut points, range buckets, files."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

from pointtally.runtime import scratch_dir

def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, else its checkpoint folder.

    Where neither is set, a session in one process (tests) gets a folder of its
    own; on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else scratch_dir(spark)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage with replicated storage: a lost executor costs a re-read.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def trimmed(run):
    """Task function ``run``, after which the worker's freed memory goes back to the system.

    Python workers outlive their tasks; what their allocators keep would add up
    over the stages of a pipeline.
    """

    def wrapped(batches):
        import ctypes
        import gc

        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return wrapped


def open_fs(uri: str):
    """``(file system, path)`` of a URI or plain path, usable inside tasks."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def partitions_for(spark: SparkSession, total_bytes: int, target_bytes: int, most: int = 100_000) -> int:
    """Partition count that gives about ``target_bytes`` each, at least one per slot."""
    slots = max(1, spark.sparkContext.defaultParallelism)
    return max(slots, min(most, math.ceil((total_bytes or 0) / target_bytes)))


def byte_slices(sizes, limit: int):
    """Cut rows into runs of at most about ``limit`` bytes: ``(start, end)`` pairs."""
    start, held = 0, 0
    for i, s in enumerate(sizes):
        if held and held + s > limit:
            yield start, i
            start, held = i, 0
        held += s
    if start < len(sizes):
        yield start, len(sizes)


def text_runs(column, limit: int):
    """Runs of an Arrow text column of at most about ``limit`` bytes: ``(start, end, texts)``, null as empty."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for lo, hi in byte_slices(sizes, limit):
        yield lo, hi, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
