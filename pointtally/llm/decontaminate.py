"""Benchmark decontamination with an FM-index per training shard.

A benchmark item's windows are its runs of ``WINDOW`` consecutive words (an
item of fewer words is one window).  The documents a task reads form shards of
bounded size.  All words of a shard become one sequence over the shard's own
vocabulary, each document ended by a separator of its own; the index knows
nothing of the benchmark.  Over it stand a suffix array, its Burrows-Wheeler
transform as a wavelet matrix, and the positions of every ``SAMPLE``-th suffix
and of each document's start.  All windows whose words the shard holds search
backwards together through the wavelet ranks; the occurrences are located by
walking to the next sampled position, and the spans of a document are merged.

The windows of a small benchmark travel with the tasks.  One above
``PART_BYTES`` is written to the shared folder in parts of about that size,
and every shard is searched for one part after the other.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointtally.llm.common import byte_slices, fresh_path, open_fs, text_runs, trimmed
from pointtally.llm.words import NON_ALNUM, WordHasher, mix

WINDOW = 13
SAMPLE = 8
SHARD_WORDS = 1 << 18
SHARD_DOCS = 100_000
CHUNK_BYTES = 2 << 20
LOCATE_ROWS = 1 << 20
# Text a task holds while it filters whole rows.
HELD_BYTES = 32 << 20
# Benchmark text whose windows travel with the tasks; a larger one is read in parts of this size.
PART_BYTES = 2 << 20


class Windows:
    """The distinct windows of benchmark items, as rows of word hashes, and the items that hold them."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        hasher = WordHasher(NON_ALNUM)
        buf, starts, ends, first = hasher.split([(t or "").encode("utf-8", "surrogatepass") for _, t in items])
        words = hasher.hashes(buf, starts, ends)
        size = np.diff(first)
        count = np.where(size > 0, np.maximum(size - window + 1, 1), 0)
        owner = np.repeat(np.arange(len(items)), count)
        at = first[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        lengths = np.minimum(size[owner], window)
        places = at[:, None] + np.arange(window)
        rows = np.where(np.arange(window) < lengths[:, None], words[np.minimum(places, max(len(words) - 1, 0))], 0) if len(words) else np.zeros((0, window), np.uint64)
        # Equal windows meet under one key; rows are compared word by word, so a shared key merges nothing else.
        key = lengths.astype(np.uint64)
        for c in range(window):
            key = mix(key ^ rows[:, c])
        order = np.argsort(key, kind="stable")
        rows, lengths, owner = rows[order], lengths[order], owner[order]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1) | (lengths[1:] != lengths[:-1])
        number = np.cumsum(fresh) - 1
        self.lengths = lengths[fresh]
        self.words, places = np.unique(rows[fresh], return_inverse=True)  # also the padding
        self.places = places.reshape(len(self.lengths), window)
        self.pad = np.arange(window) >= self.lengths[:, None]
        pairs = np.unique(number * max(len(items), 1) + owner)
        held, holder = np.divmod(pairs, max(len(items), 1))
        self.owners = holder
        self.owner_at = np.searchsorted(held, np.arange(len(self.lengths) + 1))
        self.names = ["" if item is None else str(item) for item, _ in items]

    def items(self, k: int) -> list[str]:
        """Names of the items that hold window ``k``."""
        return [self.names[i] for i in self.owners[self.owner_at[k] : self.owner_at[k + 1]].tolist()]

    def symbols(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(window numbers, symbols)`` of the windows all of whose words a sorted vocabulary holds; symbols from 1."""
        if not len(vocabulary) or not len(self.lengths):
            return np.zeros(0, np.int64), np.zeros((0, self.places.shape[1]), np.int64)
        at = np.minimum(np.searchsorted(vocabulary, self.words), len(vocabulary) - 1)
        symbol = np.where(vocabulary[at] == self.words, at + 1, 0)[self.places]
        known = np.flatnonzero(((symbol > 0) | self.pad).all(axis=1))
        return known, np.where(self.pad, 0, symbol)[known]


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix tripling; zeros are separators that differ, the earlier the smaller.

    A rank is the first row of the suffixes that share a prefix; only suffixes
    whose prefix is not unique yet are sorted again.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    zeros = symbols == 0
    rank = symbols.astype(np.int64) + int(zeros.sum())
    rank[zeros] = np.arange(int(zeros.sum()))
    order, todo, group = np.empty(n, np.int64), np.arange(n), np.zeros(n, np.int64)
    step, whole = 1, True
    while len(todo):
        follow = [np.where(todo + k * step < n, rank[np.minimum(todo + k * step, n - 1)] + 1, 0) for k in (1, 2)]
        limit = int(rank.max()) + 2
        if limit**3 < 1 << 63:
            key = (rank[todo] * limit + follow[0]) * limit + follow[1]
            by = np.argsort(key, kind="stable")
            key = key[by]
            differs = key[1:] != key[:-1]
        else:
            by = np.lexsort((follow[1], follow[0], rank[todo]))
            parts = [x[by] for x in (rank[todo], *follow)]
            differs = np.any([x[1:] != x[:-1] for x in parts], axis=0)
        todo = todo[by]
        # Rows of the suffixes: those of their old group, in the new order.
        old = np.zeros(len(todo), np.int64) if whole else group[by]
        first = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        rows = old + np.arange(len(todo)) - np.repeat(first, np.diff(np.append(first, len(todo))))
        order[rows] = todo
        start = np.flatnonzero(np.append(True, differs))
        sizes = np.diff(np.append(start, len(todo)))
        fresh = np.repeat(rows[start], sizes)
        if whole:
            rank = np.empty(n, np.int64)
        rank[todo] = fresh
        again = np.repeat(sizes > 1, sizes)
        todo, group = todo[again], fresh[again]
        step, whole = 3 * step, False
    return order


class WaveletMatrix:
    """Ranks and access over a symbol sequence, vectorised over queries."""

    def __init__(self, seq: np.ndarray):
        self.bits = max(1, int(seq.max(initial=0)).bit_length())
        self.zeros, self.rank0 = [], []
        cur = seq
        for level in range(self.bits - 1, -1, -1):
            bit = (cur >> level) & 1
            before = np.zeros(len(cur) + 1, np.int32)
            np.cumsum(1 - bit, out=before[1:])
            self.rank0.append(before)
            self.zeros.append(int(before[-1]))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])

    def rank(self, symbols: np.ndarray, *positions: np.ndarray) -> list[np.ndarray]:
        """For each position array: how often ``symbols[i]`` occurs before ``position[i]``."""
        start = np.zeros(len(symbols), np.int64)
        at = [p.astype(np.int64) for p in positions]
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one = (symbols >> level) & 1 == 1
            before, zeros = self.rank0[k], self.zeros[k]
            start = np.where(one, zeros + start - before[start], before[start])
            at = [np.where(one, zeros + p - before[p], before[p]) for p in at]
        return [p - start for p in at]

    def access(self, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols at ``positions`` and their ranks there."""
        at = positions.astype(np.int64)
        start = np.zeros(len(at), np.int64)
        symbols = np.zeros(len(at), np.int64)
        for k in range(self.bits):
            before, zeros = self.rank0[k], self.zeros[k]
            one = before[at + 1] == before[at]
            symbols = symbols << 1 | one
            start = np.where(one, zeros + start - before[start], before[start])
            at = np.where(one, zeros + at - before[at], before[at])
        return symbols, at - start


class FmIndex:
    """FM-index of a word sequence in which zeros end runs."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        n = len(symbols)
        order = suffix_array(symbols)
        self.wavelet = WaveletMatrix(symbols[order - 1])  # row of position 0 wraps to the last separator
        counts = np.bincount(symbols, minlength=int(symbols.max(initial=0)) + 2)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        run_start = np.ones(n, bool)
        run_start[1:] = symbols[:-1] == 0
        self.sampled = (run_start | (np.arange(n) % sample == 0))[order]
        self.slot = np.cumsum(self.sampled) - 1
        self.positions = order[self.sampled]

    def search(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(pattern, first row, end row)`` of the patterns that occur, by backward search."""
        top = len(self.before) - 3  # the largest symbol of the sequence: the wavelet matrix has no bits for others
        which = np.arange(len(lengths))
        last = symbols[which, lengths - 1]
        which = which[last <= top]
        last = symbols[which, lengths[which] - 1]
        lo, hi = self.before[last], self.before[last + 1]
        done: list[tuple] = []
        left = lengths[which] - 1
        while len(which):
            alive = lo < hi
            which, lo, hi, left = which[alive], lo[alive], hi[alive], left[alive]
            ended = left == 0
            done.append((which[ended], lo[ended], hi[ended]))
            which, lo, hi, left = which[~ended], lo[~ended], hi[~ended], left[~ended] - 1
            if not len(which):
                break
            c = symbols[which, left]
            known = c <= top
            which, lo, hi, left, c = which[known], lo[known], hi[known], left[known], c[known]
            r_lo, r_hi = self.wavelet.rank(c, lo, hi)
            lo, hi = self.before[c] + r_lo, self.before[c] + r_hi
        if not done:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate([d[k] for d in done]) for k in range(3))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Sequence positions of suffix rows, through the sampled ones."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.sampled[rows])
        while len(todo):
            symbol, rank = self.wavelet.access(rows[todo])
            rows[todo] = self.before[symbol] + rank
            steps[todo] += 1
            todo = todo[~self.sampled[rows[todo]]]
        return self.positions[self.slot[rows]] + steps


class Shard:
    """Documents gathered until the shard is full; then indexed and searched."""

    def __init__(self, parts):
        self.parts = parts
        self.hasher = WordHasher(NON_ALNUM)
        self.clear()

    def clear(self) -> None:
        self.ids: list = []
        self.n_words: list[np.ndarray] = []
        self.words: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: list, texts: list[bytes]) -> None:
        buf, starts, ends, first = self.hasher.split(texts)
        self.words.append(self.hasher.hashes(buf, starts, ends))
        self.n_words.append(np.diff(first))
        self.ids += ids
        self.size += len(starts)

    def full(self) -> bool:
        return self.size >= SHARD_WORDS or len(self.ids) >= SHARD_DOCS

    def results(self):
        """Per document ``(n_words, n_hit, items, spans)``; spans are merged word ranges."""
        n = len(self.ids)
        n_words = np.concatenate(self.n_words) if self.n_words else np.zeros(0, np.int64)
        items: dict[int, set] = {}
        spans: dict[int, list] = {}
        if not self.size:
            return n_words, np.zeros(n, np.int64), items, spans
        vocabulary, codes = np.unique(np.concatenate(self.words), return_inverse=True)
        self.words = []
        ends = np.cumsum(n_words)
        symbols = np.insert(codes + 1, ends, 0)
        doc = np.repeat(np.arange(n), n_words + 1)
        word = np.arange(len(symbols)) - np.repeat(ends - n_words + np.arange(n), n_words + 1)
        index, cover = None, np.zeros(len(symbols) + 1, np.int64)
        for windows in self.parts():
            number, patterns = windows.symbols(vocabulary)
            if not len(number):
                continue
            index = index or FmIndex(symbols)
            which, lo, hi = index.search(patterns, windows.lengths[number])
            number = number[which]
            count = hi - lo
            for a, b in byte_slices(count.tolist(), LOCATE_ROWS):
                c = count[a:b]
                rows = np.repeat(lo[a:b] - (np.cumsum(c) - c), c) + np.arange(c.sum())
                pattern = np.repeat(number[a:b], c)
                at = index.locate(rows)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + windows.lengths[pattern], -1)
                pairs = np.unique(doc[at] * len(windows.lengths) + pattern)
                for d, p in zip(*(x.tolist() for x in np.divmod(pairs, len(windows.lengths)))):
                    items.setdefault(d, set()).update(windows.items(p))
        hit = np.cumsum(cover[:-1]) > 0
        n_hit = np.bincount(doc[hit], minlength=n)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).view(np.int8)))
        for s, e in zip(edge[0::2].tolist(), edge[1::2].tolist()):
            spans.setdefault(int(doc[s]), []).append((int(word[s]), int(word[e - 1]) + 1))
        return n_words, n_hit, items, spans


SCHEMA = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "spans array<struct<start: bigint, end: bigint>>"
)


def _find_fn(parts):
    def run(batches):
        import pyarrow as pa

        shard = Shard(parts)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

        def flush():
            n_words, n_hit, items, spans = shard.results()
            n = len(shard.ids)
            joined = [",".join(sorted(items.get(d, ()))) for d in range(n)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(shard.ids, pa.int64()),
                    "n_words": pa.array(n_words, pa.int64()),
                    "n_hit": pa.array(n_hit, pa.int64()),
                    "n_items": pa.array([len(items.get(d, ())) for d in range(n)], pa.int64()),
                    "items_sha256": pa.array([hashlib.sha256(j.encode()).hexdigest() for j in joined], pa.string()),
                    "contaminated": pa.array((n_hit > 0) & (20 * n_hit >= n_words)),
                    "spans": pa.array([[{"start": s, "end": e} for s, e in spans.get(d, ())] for d in range(n)], span),
                }
            )
            shard.clear()

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, texts in text_runs(batch.column(1), CHUNK_BYTES):
                shard.add(ids[lo:hi], [t.encode("utf-8", "surrogatepass") for t in texts])
                if shard.full():
                    yield from flush()
        if shard.ids:
            yield from flush()

    return trimmed(run)


def _clean_fn(parts, text_at: int, held_bytes: int):
    """Task function: the rows of its batches, all columns, that are not contaminated."""

    def run(batches):
        import pyarrow as pa

        shard = Shard(parts)
        held, size = [], 0

        def flush():
            n_words, n_hit, _, _ = shard.results()
            clean = (n_hit == 0) | (20 * n_hit < n_words)
            shard.clear()
            at = 0
            for part in held:
                yield part.filter(pa.array(clean[at : at + part.num_rows]))
                at += part.num_rows

        for batch in batches:
            for lo, hi, texts in text_runs(batch.column(text_at), CHUNK_BYTES):
                shard.add([None] * (hi - lo), [t.encode("utf-8", "surrogatepass") for t in texts])
                held.append(batch.slice(lo, hi - lo))
                size += sum(map(len, texts))
                if shard.full() or size > held_bytes:
                    yield from flush()
                    held, size = [], 0
        yield from flush()

    return trimmed(run)


def _parts(benchmark: DataFrame, window: int):
    """A function, for tasks, that yields the benchmark's :class:`Windows`: one, or one per written part."""
    spark = benchmark.sparkSession
    texts = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= PART_BYTES:
        windows = spark.sparkContext.broadcast(Windows([tuple(r) for r in texts.collect()], window))
        return lambda: [windows.value]
    folder = fresh_path(spark, "benchmark")
    texts.repartition(-(-size // PART_BYTES)).write.parquet(folder)

    def read():
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        fs, root = open_fs(folder)
        for info in sorted(fs.get_file_info(pafs.FileSelector(root)), key=lambda f: f.path):
            if info.base_name.endswith(".parquet"):
                table = pq.read_table(info.path, filesystem=fs)
                yield Windows(list(zip(*(table.column(c).to_pylist() for c in ("item_id", "text")))), window)

    return read


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents``, with all their columns, that :func:`find_contamination` does not flag.

    Null and empty texts stay, as do repeated rows and rows without an id; an
    empty benchmark removes nothing, an empty table gives no rows.  A text of
    any length is judged whole, as a shard of its own if it fills one.
    """
    run = _clean_fn(_parts(benchmark, window), documents.columns.index("text"), HELD_BYTES)
    return documents.mapInArrow(run, documents.schema)


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``SCHEMA`` rows, one per row of ``documents``: hit words, items found and merged word spans.

    ``documents`` needs ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and
    ``text``; other columns are ignored.  Null and empty texts have no words;
    repeated rows give equal rows; a null ``doc_id`` stays and a null
    ``item_id`` counts as an item with an empty name; rows of equal ``item_id``
    are one item; an empty benchmark hits nothing; an empty table gives no
    rows.  A document is contaminated when a twentieth of its words or more
    are hit.
    """
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    return docs.mapInArrow(_find_fn(_parts(benchmark, window)), SCHEMA)


ORACLE = f"""
WITH RECURSIVE
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS m, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS i FROM bw WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM win),
dg AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, ms WHERE len(w) >= m)),
occ AS (SELECT doc_id, item_id, dg.m, i FROM dg JOIN win ON dg.m = win.m AND dg.g = win.g),
hits AS (SELECT doc_id, count(*) AS n_hit FROM (
           SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, m, i FROM occ)) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
        FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""
