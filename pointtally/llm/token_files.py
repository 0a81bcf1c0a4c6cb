"""Token-ID files: documents encoded, and stored as patched frame-of-reference blocks.

File format (little-endian)::

    "TOKP" version u32, block size u32                        file header
    per block: minimum u32, width u8, n_values u32, n_exceptions u32,
               packed values, exception positions u32[], exception values u32[]
    index: block start offsets u64[]                          one per block
    n_blocks u64, index offset u64, n_values u64, "TOKE"      footer

A block holds up to ``BLOCK`` ids.  Their minimum is subtracted; the width is
that of a percentile of the differences, wider differences are stored whole in
the exception list (their packed bits are zero).  The index gives every block's
start, so any run of ids is read without the blocks before it.

Documents are dealt to ranges of ``doc_id``, each range is one file, and the
first range's file comes first, so the ids of all files in order are the ids
of all documents in ascending ``doc_id`` order.
"""

from __future__ import annotations

import io
import re
import struct
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pointtally.functions.ranges import range_bucket
from pointtally.llm.common import fresh_path, open_fs, partitions_for, stored, trimmed

MAGIC, END_MAGIC, VERSION = b"TOKP", b"TOKE", 1
HEADER, BLOCK_HEAD, FOOTER = "<4sII", "<IBII", "<QQQ4s"

BLOCK = 4096
PERCENTILE = 99.0
RANGE_BYTES = 32 << 20
END_ID = 0
# Cached chunks and their ids, per Python worker; a longer chunk is not kept.
CACHE_BYTES = 32 << 20
LONGEST_CHUNK = 64
# New chunks are encoded in runs, texts in batches of about this size.
RUN_BYTES, BATCH_BYTES = 64 << 10, 4 << 20


# ------------------------------------------------------------------ blocks


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """``values`` (below ``2**width``) as a little-endian bit stream of ``width`` bits each."""
    if width == 0 or len(values) == 0:
        return b""
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    raw = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4)
    bits = np.unpackbits(raw, axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, width: int) -> np.ndarray:
    if width == 0 or n == 0:
        return np.zeros(n, np.uint32)
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * width).reshape(n, width)
    full = np.zeros((n, 32), np.uint8)
    full[:, :width] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(-1).astype(np.uint32)


def packed_bytes(n: int, width: int) -> int:
    return (n * width + 7) // 8


def encode_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block: minimum subtracted, percentile width, wider values as exceptions."""
    low = int(ids.min())
    diff = (ids - np.uint32(low)).astype(np.uint32)
    rank = max(0, -(-len(diff) * percentile // 100) - 1)
    width = int(np.partition(diff, int(rank))[int(rank)]).bit_length()
    out = np.flatnonzero(diff >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    kept = diff.copy()
    kept[out] = 0
    return (
        struct.pack(BLOCK_HEAD, low, width, len(diff), len(out))
        + pack_bits(kept, width)
        + out.astype("<u4").tobytes()
        + diff[out].astype("<u4").tobytes()
    )


def decode_block(data: bytes) -> np.ndarray:
    low, width, n, n_out = struct.unpack_from(BLOCK_HEAD, data)
    at = struct.calcsize(BLOCK_HEAD)
    size = packed_bytes(n, width)
    diff = unpack_bits(data[at : at + size], n, width)
    at += size
    diff[np.frombuffer(data, "<u4", n_out, at)] = np.frombuffer(data, "<u4", n_out, at + 4 * n_out)
    return diff + np.uint32(low)


class FileWriter:
    """Streams ids into one file; blocks are written as they fill."""

    def __init__(self, out, block: int = BLOCK, percentile: float = PERCENTILE):
        self.out, self.block, self.percentile = out, block, percentile
        self.starts: list[int] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.n = 0
        self.at = struct.calcsize(HEADER)
        out.write(struct.pack(HEADER, MAGIC, VERSION, block))

    def append(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(np.uint32, copy=False))
        self.n_held += len(ids)
        self.n += len(ids)
        if self.n_held >= 64 * self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        end = len(ids) if last else len(ids) // self.block * self.block
        for k in range(0, end, self.block):
            data = encode_block(ids[k : min(k + self.block, end)], self.percentile)
            self.starts.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.held, self.n_held = [ids[end:]], len(ids) - end

    def close(self) -> int:
        self._flush(True)
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(struct.pack(FOOTER, len(self.starts), self.at, self.n, END_MAGIC))
        self.out.close()
        return self.at + 8 * len(self.starts) + struct.calcsize(FOOTER)


class FileReader:
    """Reads runs of ids through the block index of a seekable file."""

    def __init__(self, f):
        self.f = f
        f.seek(0, io.SEEK_END)
        end = f.tell()
        f.seek(end - struct.calcsize(FOOTER))
        n_blocks, index_at, self.n, magic = struct.unpack(FOOTER, f.read(struct.calcsize(FOOTER)))
        f.seek(0)
        head = struct.unpack(HEADER, f.read(struct.calcsize(HEADER)))
        if magic != END_MAGIC or head[:2] != (MAGIC, VERSION):
            raise ValueError("not a token file")
        self.block = head[2]
        f.seek(index_at)
        self.starts = np.append(np.frombuffer(f.read(8 * n_blocks), "<u8"), np.uint64(index_at)).astype(np.int64)
        self.cached = (-1, np.zeros(0, np.uint32))

    def _load(self, k: int) -> np.ndarray:
        if self.cached[0] != k:
            self.f.seek(int(self.starts[k]))
            self.cached = (k, decode_block(self.f.read(int(self.starts[k + 1] - self.starts[k]))))
        return self.cached[1]

    def read(self, start: int, n: int) -> np.ndarray:
        """Ids ``start .. start + n`` of the file."""
        parts = []
        while n > 0:
            k, off = divmod(start, self.block)
            got = self._load(k)[off : off + n]
            parts.append(got)
            start, n = start + len(got), n - len(got)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


# ------------------------------------------------------------------ encoding

# Byte-level pieces never join a word with the white space that follows it, nor
# a letter or digit with the mark after it.  So the ids of a chunk (white space
# and the word after it; the points and commas that end a word) do not depend
# on its neighbours, and the ids of joined chunks are those of the chunks.
# Texts with any other white space are encoded whole.
_OTHER_SPACE = re.compile(r"[^\S \n]")
_SPLIT, _BREAK = b"\xff", 10  # no byte of UTF-8; the line break set between chunks without white space of their own


def splits_at_words(tokenizer: dict) -> bool:
    """Whether a tokenizer file's ids of a text are those of its chunks: byte-level pre-tokenizing, and nothing around it."""
    pre = tokenizer.get("pre_tokenizer") or {}
    model = tokenizer.get("model") or {}
    return (
        pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
        and tokenizer.get("normalizer") is None
        and (tokenizer.get("post_processor") or {"type": "ByteLevel"})["type"] == "ByteLevel"
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "unk_token"))
    )


def chunk_edges(buf: np.ndarray) -> np.ndarray:
    """Starts of the chunks of texts that each end with ``_SPLIT`` (a chunk of its own)."""
    space, split = (buf == 0x20) | (buf == 0x0A), buf == _SPLIT[0]
    mark = (buf == ord(".")) | (buf == ord(","))
    edge = np.zeros(len(buf) + 1, bool)
    edge[0] = True
    edge[1:-1] = (space[1:] & ~space[:-1]) | split[1:] | split[:-1]
    runs = np.flatnonzero(np.diff(mark.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    first, after = runs[0::2], runs[1::2]
    ends_word = _ALNUM[buf[first - 1]] & (first > 0) & (space | split)[np.minimum(after, len(buf) - 1)]
    edge[first[ends_word]] = True
    return np.flatnonzero(edge[:-1])


_ALNUM = np.array([chr(b).isalnum() and b < 0x80 for b in range(256)])


def _gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of runs ``start .. start + count``, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


class _Kept:
    """Chunks and their ids, appended to; arrays double as they grow."""

    def __init__(self):
        self.words: list = []
        self.n = self.n_ids = self.word_bytes = 0
        self.lens, self.offs = np.zeros(1024, np.int32), np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)

    @property
    def nbytes(self) -> int:
        return self.word_bytes + self.lens.nbytes + self.offs.nbytes + self.ids.nbytes

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        if n <= len(a):
            return a
        out = np.zeros(max(n, 2 * len(a)), a.dtype)
        out[: len(a)] = a
        return out

    def add(self, words, lens: np.ndarray, ids: np.ndarray) -> None:
        if not len(words):
            return
        n, m = self.n + len(words), self.n_ids + len(ids)
        self.lens, self.offs, self.ids = self._room(self.lens, n), self._room(self.offs, n), self._room(self.ids, m)
        self.lens[self.n : n] = lens
        self.offs[self.n : n] = self.n_ids + np.cumsum(lens) - lens
        self.ids[self.n_ids : m] = ids
        self.n, self.n_ids = n, m
        self.words.append(words)
        self.word_bytes += words.nbytes

    def find(self, words) -> np.ndarray:
        """Index of every word, -1 where unknown."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not self.n:
            return np.full(len(words), -1, np.int64)
        known = pa.chunked_array(self.words)
        return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


class Encoder:
    """Ids of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    Texts are cut into chunks; the ids of chunks seen before come from a cache,
    the distinct new ones are joined and encoded in one go, and the ids' byte
    lengths tell which are whose.  The cache holds two generations of
    ``cache_bytes / 2`` each: a full one becomes the old one, and chunks found
    in the old one move to the new, so what is not met again is forgotten.
    Chunks above ``LONGEST_CHUNK`` bytes are never kept.  Where the tokenizer
    is of another kind (see :func:`splits_at_words`) every text is encoded whole.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        import json

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.by_chunk = splits_at_words(json.load(f))
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        vocabulary = self.tok.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)  # a byte-level token has a character per byte
        self.limit = cache_bytes // 2
        self.young, self.old = _Kept(), _Kept()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, words) -> tuple[np.ndarray, np.ndarray]:
        """``(number of ids of each chunk, ids)`` of distinct new chunks, by the tokenizer."""
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)
        size = np.diff(offsets)
        lead, last = data[offsets[:-1]], data[offsets[1:] - 1]
        blank = (last == 0x20) | (last == 0x0A)  # white space that ends a text: only right on its own
        lens = np.zeros(len(words), np.int64)
        parts: dict[int, np.ndarray] = {k: self._whole(words[k].as_py().decode()) for k in np.flatnonzero(blank).tolist()}
        rows = np.flatnonzero(~blank)
        apart = (lead[rows] != 0x20) & (lead[rows] != 0x0A)
        # Every chunk without white space of its own follows a line break.
        ends = np.cumsum(size[rows] + apart)
        joined = np.full(int(ends[-1]) if len(rows) else 0, _BREAK, np.uint8)
        joined[_gather(ends - size[rows], size[rows])] = data[_gather(offsets[rows], size[rows])]
        ids = np.zeros(0, np.uint32)
        if len(rows):
            cuts = [0, *(np.flatnonzero(np.diff(ends // RUN_BYTES)) + 1).tolist(), len(rows)]
            marks = [0, *ends[np.array(cuts[1:]) - 1].tolist()]
            runs = [joined[a:b].tobytes().decode() for a, b in zip(marks, marks[1:])]
            got = self.tok.encode_batch_fast(runs, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in got])
            upto = np.concatenate([[0], np.cumsum(self.width[ids])])
            first, end = np.searchsorted(upto, ends - size[rows]), np.searchsorted(upto, ends)
            if (upto[first] != ends - size[rows]).any() or (upto[np.minimum(end, len(ids))] != ends).any():
                raise ValueError("the tokenizer joins chunks")
            lens[rows] = end - first
            ids = ids[_gather(first, end - first)]
        if parts:
            for k, x in parts.items():
                lens[k] = len(x)
            at = np.cumsum(lens) - lens
            whole = np.zeros(int(lens.sum()), np.uint32)
            whole[_gather(at[rows], lens[rows])] = ids
            for k, x in parts.items():
                whole[at[k] : at[k] + len(x)] = x
            ids = whole
        return lens, ids

    def _distinct(self, words) -> tuple[np.ndarray, np.ndarray]:
        """``(number of ids of each chunk, ids)`` of distinct chunks, known or new."""
        import pyarrow as pa
        import pyarrow.compute as pc

        short = np.asarray(pc.less_equal(pc.binary_length(words), LONGEST_CHUNK))
        young = self.young.find(words)
        old = np.where(young < 0, self.old.find(words), -1)
        split = np.asarray(pc.equal(words, _SPLIT))
        new = np.flatnonzero((young < 0) & (old < 0) & ~split)
        lens = np.zeros(len(words), np.int64)
        new_lens, new_ids = self._learn(words.take(pa.array(new))) if len(new) else (np.zeros(0, np.int64), np.zeros(0, np.uint32))
        at_young, at_old = np.flatnonzero(young >= 0), np.flatnonzero(old >= 0)
        lens[at_young], lens[at_old], lens[new] = self.young.lens[young[at_young]], self.old.lens[old[at_old]], new_lens
        start = np.cumsum(lens) - lens
        ids = np.empty(int(lens.sum()), np.uint32)
        for kept, where, index in ((self.young, at_young, young[at_young]), (self.old, at_old, old[at_old])):
            ids[_gather(start[where], lens[where])] = kept.ids[_gather(kept.offs[index], lens[where])]
        ids[_gather(start[new], lens[new])] = new_ids
        fresh = np.flatnonzero((young < 0) & short & ~split)
        self.young.add(words.take(pa.array(fresh)), lens[fresh], ids[_gather(start[fresh], lens[fresh])])
        if self.young.nbytes > self.limit:
            self.old, self.young = self.young, _Kept()
        return lens, ids

    def _coded(self, texts: list[str]):
        """Whole texts' ids by index; of the others the chunk codes, their number per text, and the chunks' ids."""
        import pyarrow as pa

        whole, raw = {}, []
        for k, t in enumerate(texts):
            if not self.by_chunk or _OTHER_SPACE.search(t) or self.added.search(t):
                whole[k] = t
                raw.append(b"")
            else:
                raw.append(t.encode())
        buf = np.frombuffer(_SPLIT.join(raw) + _SPLIT, np.uint8)
        edges = chunk_edges(buf)
        offsets = np.append(edges, len(buf)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(edges), [None, pa.py_buffer(offsets), pa.py_buffer(buf)])
        coded = chunks.dictionary_encode()
        codes = coded.indices.to_numpy()
        ends = np.flatnonzero(buf[edges] == _SPLIT[0]) + 1
        return whole, codes, ends, *self._distinct(coded.dictionary)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all texts, number of ids of each)``."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        whole, codes, ends, lens, flat = self._coded(texts)
        n = lens[codes]
        ids = flat[_gather((np.cumsum(lens) - lens)[codes], n)]
        at = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], ends])]
        if not whole:
            return ids, np.diff(at)
        parts = [self._whole(whole[k]) if k in whole else ids[at[k] : at[k + 1]] for k in range(len(texts))]
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text, as :meth:`encode` counts them."""
        if not texts:
            return np.zeros(0, np.int64)
        whole, codes, ends, lens, _ = self._coded(texts)
        per = np.diff(np.concatenate([[0], np.cumsum(lens[codes])])[np.concatenate([[0], ends])])
        for k, t in whole.items():
            per[k] = len(self._whole(t))
        return per


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept between its tasks (its cache is bounded)."""
    import sys
    import types

    kept = sys.modules.setdefault("_llm_worker_kept", types.ModuleType("_llm_worker_kept"))
    encoders = kept.__dict__.setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def _write_fn(folder: str, tokenizer: str, block: int, percentile: float, end_id: int, batch_chars: int):
    def run(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        fs, root = open_fs(folder)
        encoder = worker_encoder(tokenizer)
        writer, bucket, name = None, None, ""

        def begin():
            nonlocal writer, name
            name = f"tokens-{bucket:06d}-{uuid.uuid4().hex}.tokp"
            fs.create_dir(root, recursive=True)
            writer = FileWriter(fs.open_output_stream(f"{root}/{name}", compression=None), block, percentile)

        def put(ids_, texts):
            ids, lens = encoder.encode(texts)
            at = np.concatenate([[0], np.cumsum(lens)])
            starts = writer.n + at[:-1] + np.arange(len(texts))
            writer.append(np.insert(ids, at[1:], end_id))
            return pa.RecordBatch.from_pydict(
                {
                    "file": pa.array([f"{folder}/{name}"] * len(texts)),
                    "bucket": pa.array([bucket] * len(texts), pa.int32()),
                    "doc_id": pa.array(ids_, pa.int64()),
                    "file_start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(lens + 1, pa.int64()),
                }
            )

        for batch in batches:
            held, texts, size = [], [], 0
            for b, i, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if b != bucket or size > batch_chars:
                    if texts:
                        yield put(held, texts)
                    held, texts, size = [], [], 0
                    if b != bucket:
                        if writer is not None:
                            writer.close()
                        bucket = b
                        begin()
                held.append(i)
                texts.append(text)
                size += len(text)
            if texts:
                yield put(held, texts)
        if writer is not None:
            writer.close()

    return trimmed(run)


INDEX_SCHEMA = "file string, bucket int, doc_id bigint, file_start bigint, n_tokens bigint"


def write_tokens(
    documents: DataFrame,
    tokenizer: str,
    end_id: int = END_ID,
    block: int = BLOCK,
    percentile: float = PERCENTILE,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write token files.

    Returns the stored index ``(file, bucket, doc_id, file_start, n_tokens)``:
    the file, its rank, and where in it a document's ids stand.  ``documents``
    needs ``doc_id`` and ``text``; other columns are ignored.  A null text
    counts as empty (its only id is the end id); rows of equal ``doc_id`` are
    ordered by text, null ids come first; an empty table writes no file.
    ``tokenizer`` is the path of a tokenizers file, present on every executor.
    Ranges are ``range_bytes`` on average, up to 100,000 of them; tasks stream
    theirs, so a larger range or a very long text costs time and, for the text,
    memory in proportion to it alone.
    """
    spark = documents.sparkSession
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    parts = partitions_for(spark, size, range_bytes)
    cuts = [i / parts for i in range(1, parts)]
    bounds = (docs.agg(F.percentile_approx("doc_id", cuts, 100 * parts).alias("c")).first()["c"] or []) if cuts else []
    bounds = sorted(set(bounds))
    rows = (
        docs.select(F.coalesce(range_bucket(F.col("doc_id"), bounds) + 1, F.lit(0)).cast("int").alias("b"), "*")
        .repartitionById(len(bounds) + 2, "b")
        .sortWithinPartitions("b", F.col("doc_id").asc_nulls_first(), "text")
    )
    folder = fresh_path(spark, "tokens")
    run = _write_fn(folder, tokenizer, block, percentile, end_id, BATCH_BYTES)
    return stored(rows.mapInArrow(run, INDEX_SCHEMA), "token-index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: the ids of all documents before, over all files.

    Only one total per file is summed in order; documents add their offset in
    the file.
    """
    totals = index.groupBy("bucket").agg(F.sum("n_tokens").alias("total"))
    before = totals.select(
        F.col("bucket").alias("t_bucket"),
        F.coalesce(
            F.sum("total").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
    )
    return index.join(before, index.bucket == before.t_bucket).select(
        *index.columns, (F.col("before") + F.col("file_start")).alias("start")
    )


def _read_fn(with_ids: bool):
    def run(batches):
        import zlib

        import pyarrow as pa

        reader, current = None, None
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(5)]
            crcs, ids_out = [], []
            for file, _, file_start, n, _ in zip(*cols):
                if file != current:
                    fs, path = open_fs(file)
                    reader, current = FileReader(fs.open_input_file(path)), file
                ids = reader.read(file_start, n)
                crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                if with_ids:
                    ids_out.append(ids.astype(np.int64))
            data = {
                "doc_id": pa.array(cols[1], pa.int64()),
                "start": pa.array(cols[4], pa.int64()),
                "n_tokens": pa.array(cols[3], pa.int64()),
                "ids_crc32": pa.array(crcs, pa.int64()),
            }
            if with_ids:
                data["ids"] = pa.array(ids_out, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(data)

    return trimmed(run)


def read_tokens(index: DataFrame, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` of every document, read from the files.

    Each file is read by one task, block after block through its index.
    """
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    rows = (
        with_starts(index)
        .select("file", "doc_id", "file_start", "n_tokens", "start", "bucket")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "file_start")
        .drop("bucket")
    )
    return rows.mapInArrow(_read_fn(with_ids), schema + (", ids array<bigint>" if with_ids else ""))
