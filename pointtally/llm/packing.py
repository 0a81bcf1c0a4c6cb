"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each at a cost.  Documents longer than
the largest are cut into full sequences and a rest; the rests and the shorter
documents are placed in descending length, each into the open bin with the
least room that still holds it.  Where none does, a bin is opened at the
permitted length of least cost per token it can be expected to hold: the item
plus what the items still to come can fill.  At the end every bin shrinks to
the smallest permitted length that holds its contents.

Items are dealt round-robin to shards of bounded size that are packed on their
own (only ids and lengths travel), so no key can make a shard large.

Lengths are tokens: :func:`token_lengths` encodes every whole text in one pass
and passes on ids and lengths only.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointtally.llm.common import text_runs, trimmed
from pointtally.llm.token_files import BATCH_BYTES, worker_encoder

# Permitted lengths and their costs: the tokens computed, and a fixed part per sequence.
CAPACITIES = (512, 1024, 2048, 4096)
SEQUENCE_COST = 32
SHARD_ITEMS = 50_000

SCHEMA = (
    "doc_id bigint, piece bigint, start bigint, length bigint, shard bigint, bin bigint, capacity bigint, offset bigint"
)


def default_costs(capacities=CAPACITIES) -> dict[int, float]:
    return {int(c): float(c + SEQUENCE_COST) for c in capacities}


def _lengths_fn(tokenizer: str):
    def run(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            for lo, hi, texts in text_runs(batch.column(1), BATCH_BYTES):
                lengths = pa.array(encoder.lengths(texts) + 1, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lengths], ["doc_id", "length"])

    return trimmed(run)


def token_lengths(documents: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, length)`` of every row: the ids of its whole text and one end id.

    One pass, no shuffle.  A null text has the end id only.  ``tokenizer`` is
    the path of a tokenizers file, present on every executor.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_lengths_fn(tokenizer), "doc_id bigint, length bigint")


def best_fit(lengths: np.ndarray, costs: dict[int, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bin, offset, capacity)`` of every item; ``lengths`` descend and none exceeds the largest capacity.

    Open bins are kept by their free room: a bit mask of the rooms that occur
    finds the smallest that fits in one step.
    """
    caps = sorted(costs)
    n = len(lengths)
    bin_of, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # Tokens of items i.. that are at most s long: lengths descend, so those are a suffix.
    suffix = np.concatenate([np.cumsum(lengths[::-1])[::-1], [0]]).astype(np.int64)
    rising = -np.asarray(lengths)
    rooms: dict[int, list[int]] = {}
    mask = 0
    size, used = [], []
    full = -1  # a bin without room, for items without length
    for i, length in enumerate(map(int, lengths)):
        above = mask >> length
        if length == 0 and full >= 0:
            b, room = full, 0
        elif above:
            room = (above & -above).bit_length() - 1 + length
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            best = None
            for c in caps:
                if c < length:
                    continue
                first = max(i + 1, int(np.searchsorted(rising, -(c - length)))) if c > length else n
                fill = min(c - length, int(suffix[first]))
                price = costs[c] / max(1, length + fill)
                if best is None or price < best[0]:
                    best = (price, c)
            b, room = len(size), best[1]
            size.append(room)
            used.append(0)
        bin_of[i], offset[i] = b, used[b]
        used[b] += length
        room -= length
        if room:
            rooms.setdefault(room, []).append(b)
            mask |= 1 << room
        else:
            full = b
    shrunk = np.array(caps, np.int64)[np.searchsorted(caps, used)] if used else np.zeros(0, np.int64)
    return bin_of, offset, shrunk[bin_of] if n else shrunk


def pack_items(ids, lengths, costs: dict[int, float]) -> dict[str, np.ndarray]:
    """Pieces of the items and their places, as columns of ``SCHEMA`` without ``shard``."""
    top = max(costs)
    ids, lengths = np.asarray(ids, np.int64), np.asarray(lengths, np.int64)
    full = (np.maximum(lengths, 1) - 1) // top  # a rest of at least one token stays (or the whole of an empty item)
    row = np.concatenate([np.repeat(np.arange(len(ids)), full), np.arange(len(ids))])
    piece = np.concatenate([np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full), full]).astype(np.int64)
    length = np.concatenate([np.full(int(full.sum()), top, np.int64), lengths - full * top])
    start = piece * top
    order = np.lexsort((start, row, -length))
    row, piece, start, length = row[order], piece[order], start[order], length[order]
    bins, offset, capacity = best_fit(length, costs)
    return {
        "row": row, "piece": piece, "start": start, "length": length, "bin": bins, "capacity": capacity, "offset": offset,
    }


def _pack_fn(costs: dict[int, float]):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        order = table.sort_by([("length", "descending"), ("doc_id", "ascending")])
        got = pack_items(np.zeros(len(order)), order.column("length").to_numpy(), costs)
        ids = order.column("doc_id").combine_chunks().take(pa.array(got["row"]))
        shard = pa.array(np.full(len(ids), TaskContext.get().partitionId(), np.int64))
        cols = [ids, *(pa.array(got[c]) for c in ("piece", "start", "length"))]
        cols += [shard, *(pa.array(got[c]) for c in ("bin", "capacity", "offset"))]
        out = pa.Table.from_arrays(cols, names=[c.split()[0] for c in SCHEMA.split(", ")])
        yield from out.to_batches(max_chunksize=10_000)

    return trimmed(run)


def pack(
    documents: DataFrame,
    length: Column | None = None,
    costs: dict[int, float] | None = None,
    shard_items: int = SHARD_ITEMS,
    tokenizer: str | None = None,
) -> DataFrame:
    """Place every document: ``SCHEMA`` rows, one per piece, ``start`` and ``length`` in tokens of the document.

    A bin is ``(shard, bin)`` with its final ``capacity``; a piece stands at
    ``offset`` in it.  Either ``tokenizer`` is given, and lengths are
    :func:`token_lengths`, or ``length``, a column over ``documents``; null and
    negative lengths count as 0, and a document of length 0 is one piece of
    length 0.  Repeated rows and null ids are placed like any other row; ties
    go by ``doc_id``; other columns are ignored; an empty table gives no rows;
    a text of any length is encoded whole and cut into full sequences and a rest.
    """
    costs = {int(c): float(v) for c, v in (costs or default_costs()).items()}
    if not costs or min(costs) < 1:
        raise ValueError("capacities must be positive")
    if (length is None) == (tokenizer is None):
        raise ValueError("either a length or a tokenizer")
    shards = max(1, math.ceil(documents.count() / shard_items))
    if tokenizer is not None:
        documents, length = token_lengths(documents, tokenizer), F.col("length")
    items = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.greatest(F.coalesce(length.cast("bigint"), F.lit(0)), F.lit(0)).alias("length"),
    )
    return items.repartition(shards).mapInArrow(_pack_fn(costs), SCHEMA)
