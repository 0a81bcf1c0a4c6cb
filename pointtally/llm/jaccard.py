"""N-gram Jaccard join: exact set-similarity links and their components.

A document's set is its distinct word shingles, as 64-bit hashes.  Two sets
link when ``100 * |A & B| >= 80 * |A | B|``; no link is missed and none is
approximate.

1.  One pass makes each document's set size and set digest, and adds every
    shingle to a count table of fixed size (``2^SKETCH_BITS`` counters).  Equal
    digests are one class; only classes are compared.
2.  A linked pair shares at least one of the ``n - ceil(0.8 n) + 1`` rarest
    shingles of either set (rarest by the count table, ties by hash: any order
    would be right, this one makes few candidates).  Those shingles go, packed
    in blocks, to buckets; a bucket's inverted lists are cut where sizes differ
    too much to link.  Lists that the count table shows to be long are dealt to
    several buckets.
3.  A class joins the cluster of the smallest class it shares a list with.
    Clusters are the cells of the search: a cell holds the sets of its cluster,
    and of the classes of smaller clusters that share a list with it.  Large
    cells are cut into blocks and searched pair of blocks by pair of blocks.
4.  Histograms of the sets (an upper bound of any overlap) tell which classes of
    a cell may link at all; only those send their sets.  In a cell runs the
    T-occurrence search by DivideSkip: the query's shorter
    inverted lists are merged, candidates that reach the overlap less the
    number of long lists go on, and the long lists are probed by binary search
    until a candidate is lost or reaches the required overlap.
5.  Cells return, per linked class, its links and a star edge to the smallest
    class of its part; the components of those edges come from min-label
    rounds on DataFrames.

Only the count table, a bit map of candidate ids (both of fixed size) and
totals reach the driver.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pointtally.llm.common import partitions_for, stored, text_runs, trimmed
from pointtally.llm.words import SPACES, WordHasher, mix
from pointtally.runtime import fits_broadcast

WORDS = 5
NUM, DEN = 80, 100

SKETCH_BITS = 21
SKETCH_CHUNK = 1 << 16
FILTER_BITS = 23
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
LIST_BLOCK = 4096
CELL_CLASSES = 1024
CELL_SHINGLES = 1 << 20
# Rows of one class that meet in a task.
CLASS_ROWS = 50_000
# DivideSkip: the weight of merging against probing when lists are divided.
MU = 0.01

_Q = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(64)]


# ------------------------------------------------------------------ sets


def shingle_sets(hasher: WordHasher, texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; shorter texts are one shingle, wordless ones none."""
    buf, starts, ends, first = hasher.split(texts)
    h = hasher.hashes(buf, starts, ends)
    n = len(h) - words + 1
    if n > 0:
        total = np.zeros(n, np.uint64)
        for k in range(words):
            total += h[k : k + n] * np.uint64(_Q[k])
        shingles = mix(total)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(shingles[a : b - words + 1]))
        elif b > a:
            part = sum(int(v) * _Q[k] for k, v in enumerate(h[a:b].tolist())) + (b - a)
            out.append(mix(np.array([part & 0xFFFFFFFFFFFFFFFF], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_digests(sets: list[np.ndarray], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set, independent of order; 0 for empty sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    out = []
    for k in (1, 2):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(flat ^ np.uint64(_Q[k + 2 * seed])))])
        ends = np.cumsum(sizes)
        total = run[ends] - run[ends - sizes]
        out.append(np.where(sizes > 0, mix(total + sizes.astype(np.uint64)), np.uint64(0)))
    return out[0], out[1]


def prefix_size(n, num: int = NUM, den: int = DEN):
    """How many of the rarest shingles a set must offer so that every linked set shares one."""
    return n - (num * n + den - 1) // den + 1


def _batches_of_sets(batches, words):
    """``(ids, sets)`` of the rows of Arrow batches, in runs of bounded bytes."""
    hasher = WordHasher(SPACES)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for lo, hi, texts in text_runs(batch.column(1), CHUNK_BYTES):
            yield ids[lo:hi], shingle_sets(hasher, [t.encode("utf-8", "surrogatepass") for t in texts], words)


def histogram(shingles: np.ndarray) -> bytes | None:
    """Counts of a set's shingles by their leading bits, about four to a bucket, one byte each.

    Two sets share at most the sum of their buckets' minima.  None where a
    count does not fit a byte (such a set is never left out by its histogram).
    """
    bits = max(4, (len(shingles) // 4).bit_length())
    counts = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


SUMMARY_SCHEMA = "doc_id bigint, n bigint, cls bigint, check bigint, hist binary, chunk int, counts binary"


def _summary_fn(words: int, seed: int, bits: int):
    """Task function: per document set size and digests; at the end the task's count table."""

    def run(batches):
        import pyarrow as pa

        table = np.zeros(1 << bits, np.uint32)
        mask = np.uint64((1 << bits) - 1)
        for ids, sets in _batches_of_sets(batches, words):
            d1, d2 = set_digests(sets, seed)
            flat = np.concatenate(sets)
            table += np.bincount((flat & mask).astype(np.int64), minlength=1 << bits).astype(np.uint32)
            n = len(ids)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "cls": pa.array(d1.view(np.int64)),
                    "check": pa.array(d2.view(np.int64)),
                    "hist": pa.array([histogram(s) if len(s) else None for s in sets], pa.binary()),
                    "chunk": pa.nulls(n, pa.int32()),
                    "counts": pa.nulls(n, pa.binary()),
                }
            )
        parts = [(k, table[a : a + SKETCH_CHUNK]) for k, a in enumerate(range(0, len(table), SKETCH_CHUNK))]
        parts = [(k, zlib.compress(p.tobytes(), 1)) for k, p in parts if p.any()]
        m = len(parts)
        yield pa.RecordBatch.from_pydict(
            {
                **{c: pa.nulls(m, pa.int64()) for c in ("doc_id", "n", "cls", "check")},
                "hist": pa.nulls(m, pa.binary()),
                "chunk": pa.array([k for k, _ in parts], pa.int32()),
                "counts": pa.array([p for _, p in parts], pa.binary()),
            }
        )

    return trimmed(run)


def _sum_tables(batches):
    """Task function: the sum of the count tables' chunks it gets."""
    import pyarrow as pa

    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(zlib.decompress(data), np.uint32).astype(np.int64)
            total[chunk] = total[chunk] + part if chunk in total else part
    yield pa.RecordBatch.from_pydict(
        {
            "chunk": pa.array(list(total), pa.int32()),
            "counts": pa.array([v.tobytes() for v in total.values()], pa.binary()),
        }
    )


def _count_table(summary: DataFrame, bits: int) -> np.ndarray:
    rows = (
        summary.filter("chunk is not null")
        .select("chunk", "counts")
        .repartition((1 << bits) // SKETCH_CHUNK, "chunk")
        .mapInArrow(_sum_tables, "chunk int, counts binary")
        .collect()
    )
    table = np.zeros(1 << bits, np.int64)
    for r in rows:
        table[r["chunk"] * SKETCH_CHUNK : (r["chunk"] + 1) * SKETCH_CHUNK] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(table, np.iinfo(np.uint32).max).astype(np.uint32)


# ------------------------------------------------------------------ inverted lists


def _postings_fn(words, seed, bits, table, buckets, num, den):
    """Task function: the rarest shingles of every set, packed per bucket.

    A block holds ``tokens u64 | list block u32 | row u32`` of its postings and
    ``class u64 | size u32`` of the rows they point to.
    """

    def run(batches):
        import pyarrow as pa

        counts_of = table.value
        mask = np.uint64((1 << bits) - 1)
        seen: set[int] = set()
        for _, sets in _batches_of_sets(batches, words):
            cls, _ = set_digests(sets, seed)
            toks, rows = [], []
            for k, s in enumerate(sets):
                key = int(cls[k])
                if not len(s) or key in seen:  # exact copies: once per task
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(key)
                p = prefix_size(len(s), num, den)
                count = counts_of[(s & mask).astype(np.int64)]
                if p < len(s):
                    part = np.flatnonzero(count <= np.partition(count, p - 1)[p - 1])
                    part = part[np.argsort(count[part], kind="stable")][:p]  # ties: the smaller hash first
                else:
                    part = slice(None)
                toks.append(s[part])
                rows.append(np.full(p, k, np.int64))
            if not toks:
                continue
            tok, row = np.concatenate(toks), np.concatenate(rows)
            sizes = np.array([len(s) for s in sets], np.uint32)
            split = counts_of[(tok & mask).astype(np.int64)] // LIST_BLOCK + 1
            block = (mix(cls[row]) % split.astype(np.uint64)).astype(np.uint32)
            bucket = (mix(tok + block.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            tok, row, block, bucket, split = tok[order], row[order], block[order], bucket[order], split[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            out_b, out_d = [], []
            for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
                used, inv = np.unique(row[a:b], return_inverse=True)
                whole = split[a:b] == 1
                out_b.append(int(bucket[a]))
                out_d.append(
                    len(used).to_bytes(4, "little")
                    + cls[used].tobytes()
                    + sizes[used].tobytes()
                    + tok[a:b].tobytes()
                    + np.where(whole, 0, block[a:b] + 1).astype(np.uint32).tobytes()
                    + inv.astype(np.uint32).tobytes()
                )
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array(out_b, pa.int32()), "data": pa.array(out_d, pa.binary())}
            )

    return trimmed(run)


def _unpack(data: bytes):
    used = int.from_bytes(data[:4], "little")
    at = 4
    cls = np.frombuffer(data, np.uint64, used, at)
    at += 8 * used
    size = np.frombuffer(data, np.uint32, used, at)
    at += 4 * used
    m = (len(data) - at) // 16
    tok = np.frombuffer(data, np.uint64, m, at)
    block = np.frombuffer(data, np.uint32, m, at + 8 * m)
    row = np.frombuffer(data, np.uint32, m, at + 12 * m)
    return tok, block, cls[row], size[row].astype(np.int64)


def segments(tok, block, cls, size, num: int = NUM, den: int = DEN):
    """Inverted lists of two classes or more, cut where neighbours in size cannot link.

    Returns ``(list id, class, leader)`` rows, each distinct membership once;
    the parts of a split list keep their single members, as those may link
    with another part's, and share the list's id.
    """
    order = np.lexsort((cls, size, block, tok))
    tok, block, cls, size = tok[order], block[order], cls[order], size[order]
    if not len(tok):
        return tuple(np.zeros(0, np.uint64) for _ in range(3))
    same_list = (tok[1:] == tok[:-1]) & (block[1:] == block[:-1])
    fresh = np.append(True, ~(same_list & (cls[1:] == cls[:-1])))  # a class repeated by several tasks
    tok, block, cls, size = tok[fresh], block[fresh], cls[fresh], size[fresh]
    same_list = (tok[1:] == tok[:-1]) & (block[1:] == block[:-1])
    start = np.flatnonzero(np.append(True, ~(same_list & (size[1:] * num <= size[:-1] * den))))
    count = np.diff(np.append(start, len(tok)))
    split = block[start] > 0
    keep = (count > 1) | split
    leader = np.minimum.reduceat(cls, start)
    members = np.add.reduceat(mix(cls), start) + count.astype(np.uint64)
    # A part of a split list is told apart by its list alone, to meet the other parts.
    list_key = mix(tok[start])
    ident = np.where(split, list_key, members)
    what = np.where(split, members ^ list_key, members)
    first = np.zeros(len(start), bool)
    first[np.unique(what, return_index=True)[1]] = True
    keep &= first
    at = np.repeat(keep, count)
    return np.repeat(ident, count)[at], cls[at], np.repeat(leader, count)[at]


def _lists_fn(num, den):
    def run(batches):
        import pyarrow as pa

        parts = [_unpack(d) for batch in batches for d in batch.column(1).to_pylist()]
        if not parts:
            return
        ident, cls, leader = segments(*(np.concatenate([p[k] for p in parts]) for k in range(4)), num, den)
        for a in range(0, len(ident), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[a : a + 100_000].view(np.int64)) for x in (ident, cls, leader)],
                names=["list_id", "cls", "leader"],
            )

    return trimmed(run)


# ------------------------------------------------------------------ cells


def required_overlap(a, b, num: int = NUM, den: int = DEN):
    """Smallest ``|A & B|`` at which sets of sizes ``a`` and ``b`` link."""
    return -(-num * (a + b) // (num + den))


class Cell:
    """Inverted lists of a block of sets, searched by DivideSkip."""

    def __init__(self, sets: list[np.ndarray], num: int = NUM, den: int = DEN):
        self.num, self.den = num, den
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.by_size = np.argsort(self.sizes, kind="stable")  # members are numbered by size
        self.sizes = self.sizes[self.by_size]
        flat = np.concatenate([sets[i] for i in self.by_size])
        member = np.repeat(np.arange(len(sets), dtype=np.int64), self.sizes)
        order = np.argsort(flat, kind="stable")
        flat, self.members = flat[order], member[order]
        self.start = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        self.tokens = flat[self.start]
        self.start = np.append(self.start, len(flat))
        # List number and member in one ascending key: a list's part in a range of members is two probes.
        self.keys = np.repeat(np.arange(len(self.tokens), dtype=np.int64), np.diff(self.start)) * len(sets) + self.members

    def search(self, query: np.ndarray, after: int = -1) -> np.ndarray:
        """Members (positions in ``sizes``) beyond ``after`` that link with ``query``."""
        n, m = len(query), len(self.sizes)
        low = max(after + 1, int(np.searchsorted(self.sizes, -(-self.num * n // self.den))))
        high = int(np.searchsorted(self.sizes, self.den * n // self.num, side="right"))
        none = np.zeros(0, np.int64)
        if low >= high:
            return none
        need = int(required_overlap(n, self.sizes[low], self.num, self.den))
        at = np.searchsorted(self.tokens, query)
        at[at == len(self.tokens)] = 0
        at = at[self.tokens[at] == query]
        begin = np.searchsorted(self.keys, at * m + low)
        end = np.searchsorted(self.keys, at * m + high)
        length = end - begin
        filled = length > 0
        begin, end, length = begin[filled], end[filled], length[filled]
        if len(length) < need:
            return none
        order = np.argsort(length, kind="stable")
        begin, end, length = begin[order], end[order], length[order]
        # The longest lists are only probed: about T / (mu log M + 1) of them.
        n_long = min(need - 1, int(need / (MU * np.log2(max(2, int(length[-1]))) + 1)))
        if length[-1] * 4 <= self.MERGE_ALL:
            n_long = 0  # lists this short are cheaper merged than probed one by one
        n_short = len(length) - n_long
        # Merge the short lists; equal members stand together, their number is the count.
        size = length[:n_short]
        take = np.repeat(begin[:n_short] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        merged = np.sort(self.members[take])
        edge = np.flatnonzero(np.append(True, merged[1:] != merged[:-1]))
        found, count = merged[edge], np.diff(np.append(edge, len(merged)))
        want = required_overlap(n, self.sizes[found], self.num, self.den)
        alive = count + n_long >= want
        found, count, want = found[alive], count[alive], want[alive]
        for k in range(n_short, len(length)):
            if not len(found):
                return none
            run = self.members[begin[k] : end[k]]
            probe = np.searchsorted(run, found)
            probe[probe == len(run)] = 0
            count = count + (run[probe] == found)
            alive = count + (len(length) - 1 - k) >= want
            if not alive.all():
                found, count, want = found[alive], count[alive], want[alive]
        return found[count >= want]

    # Lists up to a quarter of this are merged whole.
    MERGE_ALL = 64


def search_cell(sets, mult, asks, within: bool, num: int = NUM, den: int = DEN):
    """Links of a cell: ``(links per row, root per row)``.

    Rows that do not ask are indexed; those that ask (probes, or the second
    block's members) are searched in the index, and with ``within`` the indexed
    ones among themselves.  ``links`` adds up the documents of the linked
    classes, equal roots are linked rows.
    """
    n = len(sets)
    links = np.zeros(n, np.int64)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def link(i, others):
        links[i] += int(mult[others].sum())
        links[others] += mult[i]
        for j in others.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)

    indexed = np.flatnonzero(~asks)
    if not len(indexed):
        return links, parent
    cell = Cell([sets[i] for i in indexed], num, den)
    rows = indexed[cell.by_size]
    if within:
        for k, i in enumerate(rows.tolist()):
            got = cell.search(sets[i], k)
            if len(got):
                link(i, rows[got])
    for i in np.flatnonzero(asks).tolist():
        got = cell.search(sets[i])
        if len(got):
            link(i, rows[got])
    return links, [root(i) for i in range(n)]


SEAT_SCHEMA = "x bigint, i int, j int, p int, cls bigint, mult bigint, asks int, rep bigint"


def may_link(sizes, hists, asks, within: bool, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Which rows of a cell may link with one they are compared with, by sizes and histograms.

    Rows are compared as in :func:`search_cell`.  A pair stays unless the sum
    of its bucket minima, at the coarser of its two resolutions, is below the
    required overlap; no linked pair is lost.
    """
    n = len(sizes)
    alive = np.zeros(n, bool)
    if any(h is None for h in hists):
        return np.ones(n, bool)
    rows = np.flatnonzero(~asks)
    rows = rows[np.argsort(sizes[rows], kind="stable")]
    by_size = sizes[rows]
    widths = np.array([len(hists[i]) for i in rows], np.int64)
    levels = {}  # members of one resolution: their places in size order, their histograms, those folded once
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        h = np.frombuffer(b"".join(hists[i] for i in rows[at]), np.uint8).reshape(len(at), w)
        levels[int(w)] = (at, h, h[:, 0::2].astype(np.uint16) + h[:, 1::2])
    place = {int(i): k for k, i in enumerate(rows)}
    for i in ([*rows.tolist()] if within else []) + np.flatnonzero(asks).tolist():
        size = int(sizes[i])
        own = np.frombuffer(hists[i], np.uint8)
        folded = own[0::2].astype(np.uint16) + own[1::2]
        after = place[i] + 1 if not asks[i] else 0
        low = max(after, int(np.searchsorted(by_size, -(-num * size // den))))
        high = int(np.searchsorted(by_size, den * size // num, side="right"))
        for w in (len(own) // 2, len(own), 2 * len(own)):
            if w not in levels:
                continue
            at, h, half = levels[w]
            a, b = np.searchsorted(at, (low, high))
            if a >= b:
                continue
            ours, theirs = (folded, h[a:b]) if w < len(own) else (own, h[a:b] if w == len(own) else half[a:b])
            most = np.minimum(theirs, ours).sum(axis=1, dtype=np.int64)
            hit = most >= required_overlap(size, by_size[at[a:b]], num, den)
            if hit.any():
                alive[i] = True
                alive[rows[at[a:b][hit]]] = True
    return alive


def _alive_fn(num, den):
    """Task function over seats with ``(n, hist)``, sorted by cell: the seats that may link in their cell."""

    def run(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in SEAT_SCHEMA.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

        def solve(rows):
            rows = list({r[4]: r for r in rows}.values())  # a class may come from several rows of one id
            _, i, j, p = rows[0][:4]
            asks = np.array([r[6] for r in rows]) == 1
            alive = may_link(
                np.array([r[8] for r in rows], np.int64), [r[9] for r in rows], asks, i == j and p == 0, num, den
            )
            return [r[:8] for r, a in zip(rows, alive) if a]

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names
            )

        cell, rows, found = None, [], []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[:4] != cell:
                    if rows:
                        found += solve(rows)
                        if len(found) > 10_000:
                            yield out(found)
                            found = []
                    cell, rows = r[:4], []
                rows.append(r)
        if rows:
            found += solve(rows)
        if found:
            yield out(found)

    return trimmed(run)


CELL_SCHEMA = "cls bigint, root bigint, links bigint"


def _cells_fn(num, den):
    """Task function over rows ``(x, i, j, p, cls, mult, asks, shingles)`` sorted by cell."""

    def solve(rows):
        first: dict = {}
        for r in rows:
            first.setdefault(r[4], r)  # a class may come from several tasks
        rows = list(first.values())
        _, i, j, p = rows[0][:4]
        asks = np.array([r[6] for r in rows]) == 1
        links, parent = search_cell(
            [r[7] for r in rows], np.array([r[5] for r in rows], np.int64), asks, i == j and p == 0, num, den
        )
        return [(r[4], rows[p][4], int(n)) for r, n, p in zip(rows, links, parent) if n]

    def run(batches):
        import pyarrow as pa

        def out(found):
            return pa.RecordBatch.from_pydict(
                {
                    "cls": pa.array([f[0] for f in found], pa.int64()),
                    "root": pa.array([f[1] for f in found], pa.int64()),
                    "links": pa.array([f[2] for f in found], pa.int64()),
                }
            )

        cell, rows, found = None, [], []
        for batch in batches:
            flat = batch.column(7).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(batch.column(7).value_lengths().to_numpy(zero_copy_only=False))
            cols = [batch.column(k).to_pylist() for k in range(7)]
            for k, (x, i, j, p, cls, mult, asks) in enumerate(zip(*cols)):
                if (x, i, j, p) != cell:
                    if rows:
                        found += solve(rows)
                        if len(found) > 10_000:
                            yield out(found)
                            found = []
                    cell, rows = (x, i, j, p), []
                rows.append((x, i, j, p, cls, mult, asks, flat[(ends[k - 1] if k else 0) : ends[k]]))
        if rows:
            found += solve(rows)
        yield out(found)

    return trimmed(run)


def _sets_fn(words, seed, bitmap, bits):
    """Task function: classes and sets of the documents whose id passes the bit map."""

    def run(batches):
        import pyarrow as pa

        allowed = bitmap.value
        seen: set[int] = set()

        def chosen():
            for batch in batches:
                h = batch.column(2).to_numpy() & ((1 << bits) - 1)
                hit = (allowed[h >> 3] >> (h & 7)) & 1 == 1
                if hit.any():
                    yield batch.filter(pa.array(hit))

        for ids, sets in _batches_of_sets(chosen(), words):
            cls, _ = set_digests(sets, seed)
            rows = []
            for k, s in enumerate(sets):
                key = (ids[k], int(cls[k]))
                if len(s) and key not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(key)
                    rows.append(k)
            if rows:
                flat = np.concatenate([sets[k] for k in rows]).view(np.int64)
                offsets = np.concatenate([[0], np.cumsum([len(sets[k]) for k in rows])]).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "s_id": pa.array([ids[k] for k in rows], pa.int64()),
                        "s_cls": pa.array(cls[rows].view(np.int64)),
                        "shingles": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    }
                )

    return trimmed(run)


# ------------------------------------------------------------------ components


def components(edges: DataFrame) -> DataFrame:
    """``(v, comp)``: the smallest vertex of each vertex's component, for edges ``(u, v)``.

    Alternating star rounds: every vertex's neighbours are joined to the
    smallest among them.  Each round is an aggregation and a join; nothing is
    gathered by vertex.  Rounds end when the edges no longer change.
    """
    cur = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges"
    )

    def state(df):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()

    before = state(cur)
    while before["n"]:
        # Large star: larger neighbours of u go to the smallest of u and its neighbours.
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: smaller neighbours of u, and u, go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        joined = large.join(low, F.col("u") == F.col("w"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select(F.col("w").alias("u"), F.col("m").alias("v")))
        cur = stored(small.filter("u <> v").distinct(), "edges")
        after = state(cur)
        if after == before:
            break
        before = after
    return cur.select(F.col("u").alias("v"), F.col("v").alias("comp")).unionAll(
        cur.select("v", F.col("v").alias("comp")).distinct()
    )


# ------------------------------------------------------------------ the join


def jaccard_components(
    documents: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN, sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)``, one row per row of ``documents``.

    ``n_links`` counts the other documents a document links with (copies
    included), ``component_id`` is the smallest ``doc_id`` reachable by links.
    ``documents`` needs ``doc_id`` and ``text``; other columns are ignored.  A
    null or wordless text has an empty set, links with nothing and is its own
    component; repeated rows are documents of their own that link with each
    other; a null ``doc_id`` takes part, and is the component's id only where
    all its ids are null; an empty table gives no rows.
    """
    return _classified(documents, words, num, den, sketch_bits)[0].select(
        "doc_id", "n_shingles", "component_id", "n_links"
    )


def _classified(
    documents: DataFrame, words: int, num: int, den: int, sketch_bits: int = SKETCH_BITS
) -> tuple[DataFrame, int]:
    """Rows of :func:`jaccard_components` with ``cls`` and ``first``, and the seed of the classes.

    ``first`` marks the rows of one class and one id in every component: the
    smallest id, of the classes that hold it the smallest; null ids come last.
    """
    spark = documents.sparkSession
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    for seed in range(8):
        summary = stored(docs.mapInArrow(_summary_fn(words, seed, sketch_bits), SUMMARY_SCHEMA), "sets")
        own = summary.filter("chunk is null").select("doc_id", "n", "cls", "check", "hist")
        classes = stored(
            own.filter("n > 0")
            .groupBy("cls")
            .agg(
                F.min("doc_id").alias("rep"),
                F.count(F.lit(1)).alias("mult"),
                F.min("n").alias("n"),
                ((F.min("check") != F.max("check")) | (F.min("n") != F.max("n"))).alias("clash"),
            ),
            "classes",
        )
        totals = classes.agg(F.max("clash").alias("clash"), F.sum("n").alias("n")).first()
        if not totals["clash"]:
            break  # else two different sets share a class id: digest anew with other constants
    else:
        raise RuntimeError("different sets share a class id under every seed")
    table = spark.sparkContext.broadcast(_count_table(summary, sketch_bits))
    buckets = partitions_for(spark, (totals["n"] or 0) * (den - num) // den * 20, BUCKET_BYTES)
    packed = docs.mapInArrow(
        _postings_fn(words, seed, sketch_bits, table, buckets, num, den), "bucket int, data binary"
    )
    lists = stored(
        packed.repartitionById(buckets, "bucket").mapInArrow(
            _lists_fn(num, den), "list_id bigint, cls bigint, leader bigint"
        ),
        "lists",
    )
    cluster_of = lists.groupBy("cls").agg(F.min("leader").alias("x"))
    members = stored(
        cluster_of.join(classes.drop("clash"), "cls").select("cls", "x", "rep", "mult", "n"), "clusters"
    )
    # Clusters that meet in a list: the smaller probes the larger one's cell.
    sizes = members.groupBy("x").agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("s"))
    met = cluster_pairs(
        lists.join(members.select(F.col("cls").alias("m_cls"), "x"), F.col("cls") == F.col("m_cls")).select("list_id", "x"), sizes
    )
    guests = met.join(members, F.col("guest") == F.col("x")).select("home", "cls", "rep", "mult", "n")
    probes = guests.groupBy("home").agg(F.count(F.lit(1)).alias("pg"), F.sum("n").alias("ps"))
    plan = (
        sizes.join(probes, F.col("x") == F.col("home"), "left")
        .select(
            F.col("x").alias("px"),
            F.greatest(F.ceil(F.col("g") / CELL_CLASSES), F.ceil(F.col("s") / CELL_SHINGLES)).cast("int").alias("nb"),
            F.coalesce(
                F.greatest(F.ceil(F.col("pg") / CELL_CLASSES), F.ceil(F.col("ps") / CELL_SHINGLES)), F.lit(1)
            ).cast("int").alias("np"),
            (F.col("g") > 1).alias("pairs"),
            F.col("home").isNotNull().alias("probed"),
        )
        .filter("pairs or probed")
    )
    at = members.join(plan, F.col("x") == F.col("px")).withColumn(
        "b", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int")
    )
    keep = ["x", "i", "j", "p", "cls", "mult", "asks", "rep"]
    same = at.select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o")).select(
        "x",
        F.least("b", "o").alias("i"),
        F.greatest("b", "o").alias("j"),
        F.lit(0).alias("p"),
        "cls",
        "mult",
        (F.col("b") > F.col("o")).cast("int").alias("asks"),
        "rep",
    )
    more = at.filter("np > 1").select("*", F.explode(F.sequence(F.lit(1), F.col("np") - 1)).alias("p")).select(
        "x", F.col("b").alias("i"), F.col("b").alias("j"), "p", "cls", "mult", F.lit(0).alias("asks"), "rep"
    )
    come = (
        guests.join(plan, F.col("home") == F.col("px"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("i"))
        .select(
            F.col("home").alias("x"),
            "i",
            F.col("i").alias("j"),
            F.pmod(F.xxhash64("cls"), F.col("np")).cast("int").alias("p"),
            "cls",
            "mult",
            F.lit(1).alias("asks"),
            "rep",
        )
    )
    seats = same.select(keep).unionAll(more.select(keep)).unionAll(come.select(keep))
    # Sets are many bytes; histograms tell, without loss, which classes need not send theirs.
    hists = own.filter("n > 0").select(
        F.col("doc_id").alias("h_id"), F.col("cls").alias("h_cls"), F.col("n").alias("h_n"), "hist"
    )
    cell = ["x", "i", "j", "p"]
    held = (
        seats.join(hists, F.col("rep").eqNullSafe(F.col("h_id")) & (F.col("cls") == F.col("h_cls")))
        .select(*keep, "h_n", "hist")
        .repartition(partitions_for(spark, totals["n"] or 0, BUCKET_BYTES), *cell)
        .sortWithinPartitions(*cell)
    )
    seats = stored(held.mapInArrow(_alive_fn(num, den), SEAT_SCHEMA), "seats")
    # A bit map of the ids that are needed, of fixed size, spares the other documents their way through the join.
    mask = (1 << FILTER_BITS) - 1
    bit = F.xxhash64("rep").bitwiseAND(F.lit(mask)) + 1  # buckets count from 1
    words_ = (
        seats.select("rep")
        .groupBy(F.bitmap_bucket_number(bit).alias("k"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    bitmap = np.zeros((1 << FILTER_BITS) // 8 + 8192, np.uint8)
    for r in words_:  # bucket k holds the bits from (k - 1) * 32768 + 1 on
        part = np.frombuffer(r["bits"], np.uint8)
        bitmap[(r["k"] - 1) * 4096 : (r["k"] - 1) * 4096 + len(part)] |= part
    shipped = spark.sparkContext.broadcast(bitmap)
    sets = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(
        _sets_fn(words, seed, shipped, FILTER_BITS), "s_id bigint, s_cls bigint, shingles array<bigint>"
    )
    cells = (
        seats.join(sets, F.col("rep").eqNullSafe(F.col("s_id")) & (F.col("cls") == F.col("s_cls")))
        .select("x", "i", "j", "p", "cls", "mult", "asks", "shingles")
        .repartition(partitions_for(spark, 2 * (totals["n"] or 0), BUCKET_BYTES), *cell)
        .sortWithinPartitions(*cell)
    )
    found = stored(cells.mapInArrow(_cells_fn(num, den), CELL_SCHEMA), "links")
    comps = components(found.select(F.col("cls").alias("u"), F.col("root").alias("v")))
    degree = found.groupBy("cls").agg(F.sum("links").alias("links"))
    classes_in = classes.join(comps.withColumnRenamed("v", "c_v"), F.col("cls") == F.col("c_v"), "left").select(
        "cls", "rep", "mult", F.coalesce("comp", "cls").alias("comp")
    )
    smallest = classes_in.groupBy("comp").agg(
        F.min("rep").alias("component"), F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "cls")).alias("least")
    )
    result = (
        classes_in.join(smallest, "comp")
        .join(degree.withColumnRenamed("cls", "d_cls"), F.col("cls") == F.col("d_cls"), "left")
        .select(
            F.col("cls").alias("r_cls"),
            "component",
            "rep",
            (F.col("cls") == F.col("least.cls")).alias("wins"),
            (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    told = ["doc_id", "n", "cls"]
    worded, wordless = own.filter("n > 0").select(told), own.filter("n = 0").select(told)
    by_class = _salted_join(worded, result, classes)
    alone = [F.lit(None).cast(f.dataType).alias(f.name) for f in result.schema.fields]
    rows = by_class.unionByName(wordless.select(*told, *alone)).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        "cls",
        (F.col("wins") & F.col("doc_id").eqNullSafe(F.col("rep"))).alias("first"),
    )
    return rows, seed


def cluster_pairs(seen: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(home, guest)``: clusters that meet in a list, from ``(list_id, x)`` and ``(x, g, s)``; the guest is the smaller.

    Lists that hold the same clusters (the shingles of one template) count
    once, and a list's pairs are made one home at a time.
    """
    return (
        seen.distinct()
        .join(sizes.select("x", "g"), "x")
        .groupBy("list_id")
        .agg(F.array_sort(F.collect_list(F.struct("g", "x"))).alias("xs"))
        .filter(F.size("xs") > 1)
        .select("xs")
        .distinct()
        .select("xs", F.posexplode("xs").alias("at", "a"))
        .filter("at > 0")
        .select(F.col("a.x").alias("home"), F.explode(F.slice("xs", F.lit(1), F.col("at"))).alias("q"))
        .select("home", F.col("q.x").alias("guest"))
        .distinct()
    )


def _salted_join(worded: DataFrame, result: DataFrame, classes: DataFrame) -> DataFrame:
    """Every row of a set with its class's ``result`` row; the rows of a class with many copies are spread over salts.

    Classes above ``CLASS_ROWS`` rows are at most rows / ``CLASS_ROWS``; where
    even those are too many to be broadcast the plain join is left to split
    its skewed partitions.
    """
    many = classes.filter(F.col("mult") > CLASS_ROWS).select(
        F.col("cls").alias("m_cls"), F.ceil(F.col("mult") / CLASS_ROWS).cast("int").alias("salts")
    )
    n = many.count()
    if not n or not fits_broadcast(worded.sparkSession, n, 16):
        return worded.join(result, F.col("cls") == F.col("r_cls"))
    salts = F.coalesce("salts", F.lit(1))
    tagged = worded.join(F.broadcast(many), F.col("cls") == F.col("m_cls"), "left")
    tagged = tagged.withColumn("salt", F.pmod(F.monotonically_increasing_id(), salts).cast("int")).drop("m_cls", "salts")
    copied = result.join(F.broadcast(many), F.col("r_cls") == F.col("m_cls"), "left")
    copied = copied.withColumn("r_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("m_cls", "salts")
    return tagged.join(copied, (F.col("cls") == F.col("r_cls")) & (F.col("salt") == F.col("r_salt"))).drop("salt", "r_salt")


def _class_fn(words: int, seed: int, text_at: int):
    """Task function: the rows of its batches, all columns, with size and class of their sets."""

    def run(batches):
        import pyarrow as pa

        hasher = WordHasher(SPACES)
        for batch in batches:
            for lo, hi, texts in text_runs(batch.column(text_at), CHUNK_BYTES):
                sets = shingle_sets(hasher, [t.encode("utf-8", "surrogatepass") for t in texts], words)
                more = [pa.array([len(s) for s in sets], pa.int64()), pa.array(set_digests(sets, seed)[0].view(np.int64))]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, "__n", "__cls"])

    return trimmed(run)


def keep_one(documents: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """The rows of ``documents``, with all their columns, less all but one of every component.

    A row of the component's smallest id stays; a row without an id only where
    the component has no other.  Rows of one id with different texts are judged
    each by its own component.  A text without words stays.
    """
    rows, seed = _classified(documents, words, num, den)
    ids = stored(
        rows.groupBy(F.col("doc_id").alias("__id"))
        .agg(F.max((F.col("n_shingles") > 0) & ~F.col("first")).alias("__gone"), F.count(F.lit(1)).alias("__rows"))
        .filter("__id is null or __gone or __rows > 1"),
        "not-kept",
    )
    # An id that stands for one row decides on it; rows of other ids are told apart by their classes.
    listed = ids.filter("__id is not null").select("__id")
    out = documents.join(listed, documents["doc_id"] == F.col("__id"), "left_anti")
    unclear = ids.filter("__id is null or __rows > 1").select("__id")
    if unclear.isEmpty():
        return out
    out = out.filter(F.col("doc_id").isNotNull())
    again = documents.join(unclear, documents["doc_id"] == F.col("__id"), "left_semi").unionAll(
        documents.filter(F.col("doc_id").isNull())
    )
    schema = StructType([*documents.schema.fields, StructField("__n", LongType()), StructField("__cls", LongType())])
    told = again.mapInArrow(_class_fn(words, seed, documents.columns.index("text")), schema)
    first = rows.filter("n_shingles > 0 and first").select(F.col("doc_id").alias("__first"), F.col("cls").alias("__c")).distinct()
    chosen = (
        told.filter("__n > 0")
        .dropDuplicates(["doc_id", "__cls"])
        .join(first, (F.col("__cls") == F.col("__c")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("__first")), "left_semi")
    )
    return out.unionAll(told.filter("__n = 0").unionAll(chosen).select(documents.columns))


ORACLE = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT row, array_to_string(w[i:i + {WORDS - 1}], ' ') AS s
  FROM (SELECT row, w, unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT row, count(*) AS n FROM sets GROUP BY row
), common AS (
  SELECT a.row AS u, b.row AS v, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.row <> b.row GROUP BY ALL
), links AS (
  SELECT u, v FROM common JOIN sizes x ON x.row = u JOIN sizes y ON y.row = v
  WHERE {DEN} * c >= {NUM} * (x.n + y.n - c)
), reached AS (
  SELECT row AS u, row AS v FROM docs UNION SELECT r.u, l.v FROM reached r JOIN links l ON l.u = r.v
), components AS (
  SELECT u, min(doc_id) AS component_id FROM reached JOIN docs ON row = v GROUP BY u
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM docs LEFT JOIN sizes USING (row) JOIN components c ON c.u = docs.row
  LEFT JOIN (SELECT u, count(*) AS n_links FROM links GROUP BY u) l ON l.u = docs.row
"""
