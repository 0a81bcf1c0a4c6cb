"""Document fingerprints: quartile bucket digests of hashed byte triplets.

A sliding window of five UTF-8 bytes (four zero bytes stand before the text)
gives six byte triplets per position; each is hashed by three byte tables into
one of 128 buckets and counted.  The digest holds one checksum byte, one byte
for the length on a logarithmic scale, one byte for the ratios of the bucket
counts' quartiles, and two bits per bucket: the quartile its count lies in.
Two digests compare by a difference score, bounded by ``BOUND`` and turned
into a likeness between 0 and 1.

The neighbour comparison needs each document beside the next one in descending
``doc_id`` order.  Documents go to ranges of ``doc_id`` (percentiles over all
ids) with one shuffle; every range also gets the first document of the next,
and the last gets the very first, so each task walks its own sorted rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointtally.functions.ranges import range_bucket
from pointtally.llm.common import byte_slices, partitions_for

BUCKETS = 128
BOUND = 400
RANGE_BYTES = 32 << 20
CHUNK_BYTES = 1 << 20
# Triplets of a window: the newest byte and two of the four before it.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4), (1, 4), (3, 4))
DIGEST_BYTES = 3 + BUCKETS // 4


def _tables() -> np.ndarray:
    """Byte tables ``[triplet, place, byte] -> 0..127``, derived from SHA-256."""
    raw = b"".join(
        hashlib.sha256(f"{t}:{p}:{blk}".encode()).digest()
        for t in range(len(TRIPLETS))
        for p in range(3)
        for blk in range(8)
    )
    return (np.frombuffer(raw, np.uint8) % BUCKETS).reshape(len(TRIPLETS), 3, 256)


def digests(texts: list[bytes]) -> np.ndarray:
    """``(n, DIGEST_BYTES)`` digests of byte strings; equal strings, equal digests."""
    n = len(texts)
    out = np.zeros((n, DIGEST_BYTES), np.uint8)
    tables = _tables()
    for lo, hi in byte_slices([len(t) + 4 for t in texts], CHUNK_BYTES):
        if hi - lo == 1 and len(texts[lo]) > CHUNK_BYTES:
            counts = _long_counts(texts[lo], tables)
        else:
            counts = _bucket_counts(texts[lo:hi], tables)
        out[lo:hi] = _digest_rows(counts, texts[lo:hi])
    return out


def _long_counts(text: bytes, tables: np.ndarray) -> np.ndarray:
    """Bucket counts of one long text, by segments that each see the four bytes before them."""
    counts = np.zeros((1, BUCKETS), np.int64)
    for at in range(0, len(text), CHUNK_BYTES):
        lead = text[max(at - 4, 0) : at]
        window = np.frombuffer(b"\0" * (4 - len(lead)) + lead + text[at : at + CHUNK_BYTES], np.uint8)
        counts[0] += _window_counts(window, np.arange(4, len(window)), np.zeros(len(window) - 4, np.int64), 1, tables)
    return counts


def _window_counts(buf: np.ndarray, pos: np.ndarray, base: np.ndarray, n: int, tables: np.ndarray) -> np.ndarray:
    """Counts of the triplets that end at ``pos``, in the ``BUCKETS`` buckets from ``base`` on."""
    counts = np.zeros(n * BUCKETS, np.int64)
    back = [buf[pos - k] for k in range(5)]
    for t, (i, j) in enumerate(TRIPLETS):
        h = tables[t, 0][back[0]] ^ tables[t, 1][back[i]] ^ tables[t, 2][back[j]]
        counts += np.bincount(base + h, minlength=n * BUCKETS)
    return counts


def _bucket_counts(texts: list[bytes], tables: np.ndarray) -> np.ndarray:
    n = len(texts)
    pad = b"\0\0\0\0"
    buf = np.frombuffer(pad + pad.join(texts), np.uint8)
    lens = np.array([len(t) for t in texts], np.int64)
    starts = 4 + np.concatenate([[0], np.cumsum(lens + 4)[:-1]])
    doc = np.repeat(np.arange(n, dtype=np.int64), lens)
    pos = np.arange(len(doc), dtype=np.int64) + (starts - np.concatenate([[0], np.cumsum(lens)[:-1]]))[doc]
    return _window_counts(buf, pos, doc * BUCKETS, n, tables).reshape(n, BUCKETS)


def _digest_rows(counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
    n = len(texts)
    lens = np.array([len(t) for t in texts], np.int64)
    order = np.sort(counts, axis=1)
    q = order[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (counts > q[:, :1]).astype(np.uint8) + (counts > q[:, 1:2]) + (counts > q[:, 2:])
    c = code.reshape(n, BUCKETS // 4, 4)
    body = c[:, :, 0] | c[:, :, 1] << 2 | c[:, :, 2] << 4 | c[:, :, 3] << 6
    top = np.maximum(q[:, 2], 1)
    ratios = (q[:, 0] * 100 // top % 16) << 4 | (q[:, 1] * 100 // top % 16)
    length = np.minimum(np.round(np.log(np.maximum(lens, 1)) / math.log(1.1)), 255)
    check = np.array([hashlib.blake2b(t, digest_size=1).digest()[0] for t in texts], np.uint8)
    return np.column_stack([check, length.astype(np.uint8), ratios.astype(np.uint8), body])


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Difference scores of digest rows, unbounded: 0 for equal digests."""
    x, y = a.astype(np.int64), b.astype(np.int64)
    score = (x[:, 0] != y[:, 0]).astype(np.int64)
    ld = np.abs(x[:, 1] - y[:, 1])
    score += np.where(ld <= 1, ld, 12 * ld)
    for shift in (0, 4):
        d = np.abs((x[:, 2] >> shift & 15) - (y[:, 2] >> shift & 15))
        d = np.minimum(d, 16 - d)
        score += np.where(d <= 1, d, 12 * (d - 1))
    for shift in (0, 2, 4, 6):
        d = np.abs((x[:, 3:] >> shift & 3) - (y[:, 3:] >> shift & 3))
        score += np.where(d == 3, 6, d).sum(axis=1)
    return score


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``1 - min(difference, BOUND) / BOUND``: 1 for equal digests, 0 at the bound."""
    return 1.0 - np.minimum(difference(a, b), BOUND) / BOUND


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _neighbours_fn():
    """Task function over rows ``(halo, doc_id, text)``, each range in order and
    followed by the first document of the next range."""

    def rows(held, pa):
        docs = held[:-1]
        texts = [t for _, t in held]
        edited = [t[: len(t) - len(t) // 2] + nxt[: len(t) // 2] for t, nxt in zip(texts, texts[1:])]
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        raw_edited = [t.encode("utf-8", "surrogatepass") for t in edited]
        own, other = digests(raw), digests(raw_edited)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in docs], pa.int64()),
                pa.array([len(t) for _, t in docs], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in raw_edited], pa.string()),
                pa.array([d.tobytes().hex() for d in own[:-1]], pa.string()),
                pa.array([d.tobytes().hex() for d in other], pa.string()),
                pa.array(likeness(own[:-1], other), pa.float64()),
                pa.array(likeness(own[:-1], own[1:]), pa.float64()),
            ],
            names=[c.split()[0] for c in SCHEMA.split(", ")],
        )

    def run(batches):
        import pyarrow as pa

        held, size = [], 0
        for batch in batches:
            for halo, i, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                held.append((i, text))
                size += len(text)
                if halo:
                    if len(held) > 1:
                        yield rows(held, pa)
                    held, size = [], 0
                elif size > 2 * CHUNK_BYTES and len(held) > 1:
                    yield rows(held, pa)
                    held, size = held[-1:], len(text)

    return run


def fingerprints(documents: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Digests of every whole text and of its edited text, with their likeness.

    Returns ``(doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next)``, one row per row of
    ``documents`` (``doc_id``, ``text``; other columns are ignored).  The
    edited text has its last ``floor(n_chars / 2)`` code points replaced by as
    many first ones (or all) of the next document in descending ``doc_id``
    order; after the last comes the first, so a lone document follows itself.
    Rows of equal ``doc_id`` are ordered by descending text, null ids come
    last, a null text counts as empty, an empty table gives no rows.  A long
    text is hashed in segments; a task streams its range in windows of a few
    megabytes, so a range of any size (ranges are ``range_bytes`` on average up
    to 100,000 of them) needs no more memory than its longest text.
    """
    spark = documents.sparkSession
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not size["n"]:
        return spark.createDataFrame([], SCHEMA)
    parts = partitions_for(spark, size["b"], range_bytes)
    cuts = [i / parts for i in range(1, parts)]
    bounds = (docs.agg(F.percentile_approx("doc_id", cuts, 100 * parts).alias("c")).first()["c"] or []) if cuts else []
    # Ranges in descending order; null ids form the last one.
    bounds = sorted(set(bounds))
    last = len(bounds) + 1
    ranged = docs.withColumn(
        "bucket", F.coalesce(F.lit(len(bounds)) - range_bucket(F.col("doc_id"), bounds), F.lit(last)).cast("int")
    )
    # The first document of every range: its largest id, then its largest text.
    tops = sorted(
        (r["bucket"], r["top"]) for r in ranged.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()
    )
    before = {b: tops[k - 1][0] for k, (b, _) in enumerate(tops)}  # the first range's is the last one
    heads_of = spark.createDataFrame([(top, before[b]) for b, top in tops], "top bigint, prev int")
    heads = (
        ranged.join(F.broadcast(heads_of), F.col("doc_id").eqNullSafe(F.col("top")))
        .groupBy("doc_id", "prev")
        .agg(F.max("text").alias("text"))
    )
    rows = (
        ranged.select("bucket", F.lit(0).alias("halo"), "doc_id", "text")
        .unionAll(heads.select(F.col("prev").alias("bucket"), F.lit(1).alias("halo"), "doc_id", "text"))
        .repartitionById(last + 1, "bucket")
        .sortWithinPartitions("bucket", "halo", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    )
    return rows.select("halo", "doc_id", "text").mapInArrow(_neighbours_fn(), SCHEMA)
