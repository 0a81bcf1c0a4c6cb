"""Phrase collocation mining with weighted acyclic automata.

Counts of one- to three-word phrases live in count transducers: automata whose
arcs carry a word and the number of occurrences of the phrase that ends there
(:class:`Transducer`).  Equal states are shared, so the many phrases seen once
cost little more than their words.

1. Each task counts the phrases of a shard of the texts, sorts them and builds
   a transducer from them run by run: one per *prefix range*, a range of first
   words crossed with a range of second words, so that no first word, however
   frequent, makes a range large.
2. The transducers of one prefix range are united and their weights summed.
   Phrases below the least count are then dropped: no part of a candidate can
   be rarer than the candidate.
3. Every range asks for the parts of its candidates: a weighted acceptor goes
   to each range that owns some of them and is composed with its transducer.
   The acceptor's own weights tell the owner of a two-word phrase how often
   three-word candidates that end with it occur.
4. Ranges score their candidates with the answers.

Words are kept as bytes throughout and all counts are integers, so results are
exact.  Words are distributed over ranges by CRC-32, which affects balance only.
"""

from __future__ import annotations

import math
import struct
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointtally.llm.common import stored, trimmed
from pointtally.runtime import parallelism

# Characters between words, and between pieces no phrase crosses.
SPACES = b"\x20\x09"
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"

MIN_COUNT = 10
TOP = 2000
UNKNOWN = "und"
SHARD_WORDS = 2_000_000
RUN_BYTES = 4 << 20
RANGE_BYTES = 2 << 20
# Prefix ranges a shard is split into at most; more are reached in further rounds.
FAN = 2048
# Ranges are read one by one, so a partition's size does not decide the memory of its task.
PARTITION_BYTES, MOST_PARTITIONS = 16 << 20, 100_000
# Phrases that are united at once.
UNION_PHRASES = 1_000_000
RANK_SALTS = 64

_LOWER = bytes(b + 32 if 0x41 <= b < 0x5B else b for b in range(256))


# ------------------------------------------------------------------ arrays


def sum_by(codes: np.ndarray, weights: np.ndarray, how=np.add) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``codes``, ascending, and the sum (or ``how``) of the weights of each."""
    if not len(codes):
        return codes, weights
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], how.reduceat(weights[order], first)


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions ``start .. start + count`` of all spans, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def dump(arrays: list[np.ndarray]) -> bytes:
    import zstandard

    head = struct.pack("<I", len(arrays)) + b"".join(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)) for a in arrays)
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays), 1)


def load(data: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.decompress(data)
    (n,) = struct.unpack_from("<I", raw)
    at, out = 4 + 10 * n, []
    for k in range(n):
        kind, size = struct.unpack_from("<2sQ", raw, 4 + 10 * k)
        dtype = np.dtype("<" + kind.decode())
        out.append(np.frombuffer(raw, dtype, size, at))
        at += size * dtype.itemsize
    return out


def words_to_arrays(words) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow binary array as ``(lengths, bytes)``."""
    _, at, data = words.buffers()
    offsets = np.frombuffer(at, np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return np.diff(offsets).astype(np.uint32), data[offsets[0] : offsets[-1]]


def arrays_to_words(lengths: np.ndarray, data: np.ndarray):
    import pyarrow as pa

    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers)


def word_places(words) -> np.ndarray:
    """CRC-32 of every word: its place among the prefix ranges."""
    return np.fromiter(map(zlib.crc32, words.to_pylist()), np.uint64, len(words))


# ------------------------------------------------------------------ transducers


@dataclass
class Phrases:
    """Phrases in order, words as indexes of ``words``: one, two and three long.

    A two-word phrase names its first word by index ``b0`` of the one-word
    phrases, a three-word phrase its first two by index ``t0`` of the two-word
    phrases.  A one-word phrase that is only a prefix here has weight 0.
    """

    langs: list[str]
    words: object  # sorted Arrow large_binary array
    ul: np.ndarray
    uw: np.ndarray
    uf: np.ndarray
    b0: np.ndarray
    bw: np.ndarray
    bf: np.ndarray
    t0: np.ndarray
    tw: np.ndarray
    tf: np.ndarray

    def __len__(self) -> int:
        return len(self.uw) + len(self.bw) + len(self.tw)


def _signatures(starts: np.ndarray, counts: np.ndarray, arcs: tuple) -> np.ndarray:
    """A 64-bit sum per state over a mixture of its arcs; equal states have equal ones."""
    mixed = np.zeros(len(arcs[0]), np.uint64)
    for a in arcs:
        mixed = (mixed ^ a.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return run[starts + counts] - run[starts] + counts.astype(np.uint64)


def _register(starts: np.ndarray, counts: np.ndarray, *arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share equal states: ``(state of each segment, representative segment of each state)``.

    States are grouped by a signature of their arcs, and compared arc by arc
    with the first of the group; one that differs stays a state of its own.
    """
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, group = np.unique(_signatures(starts, counts, arcs), return_index=True, return_inverse=True)
    rep = first[group]
    same = counts == counts[rep]
    rows = np.flatnonzero(same & (counts > 0))
    own, other = spans(starts[rows], counts[rows]), spans(starts[rep[rows]], counts[rows])
    differs = np.zeros(len(own), bool)
    for a in arcs:
        differs |= a[own] != a[other]
    wrong = np.zeros(n, bool)
    if len(rows):
        ends = np.cumsum(counts[rows])
        wrong[rows] = np.add.reduceat(differs.astype(np.int64), ends - counts[rows]) > 0
    rep = np.where(same & ~wrong, rep, np.arange(n))
    kept, state = np.unique(rep, return_inverse=True)
    return state, kept


def _segments(parents: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First child and number of children of each of ``n`` parents (ascending ``parents``)."""
    counts = np.bincount(parents, minlength=n).astype(np.int64) if n else np.zeros(0, np.int64)
    return np.cumsum(counts) - counts, counts


class Transducer:
    """A count transducer of sorted phrases, built state by state from the ends."""

    @staticmethod
    def build(p: Phrases) -> bytes:
        t_start, t_count = _segments(p.t0, len(p.bw))
        state3, kept3 = _register(t_start, t_count, p.tw, p.tf)
        b_start, b_count = _segments(p.b0, len(p.uw))
        state2, kept2 = _register(b_start, b_count, p.bw, p.bf, state3)
        arcs3 = spans(t_start[kept3], t_count[kept3])
        arcs2 = spans(b_start[kept2], b_count[kept2])
        u4, u8 = np.uint32, np.uint64
        lengths, data = words_to_arrays(p.words)
        lang_bytes = [x.encode() for x in p.langs]
        return dump(
            [
                np.array([len(x) for x in lang_bytes], u4), np.frombuffer(b"".join(lang_bytes), np.uint8), lengths, data,
                p.ul.astype(u4), p.uw.astype(u4), p.uf.astype(u8), state2.astype(u4),
                b_count[kept2].astype(u4), p.bw[arcs2].astype(u4), p.bf[arcs2].astype(u8), state3[arcs2].astype(u4),
                t_count[kept3].astype(u4), p.tw[arcs3].astype(u4), p.tf[arcs3].astype(u8),
            ]
        )

    @staticmethod
    def expand(data: bytes) -> Phrases:
        """All paths of a transducer, in order."""
        ll, lb, wl, wb, ul, uw, uf, s2, c2, bw, bf, s3, c3, tw, tf = load(data)
        ends = np.cumsum(ll)
        langs = [lb[e - n : e].tobytes().decode() for e, n in zip(ends.tolist(), ll.tolist())]
        i8 = lambda a: a.astype(np.int64)
        c2, c3, s2, s3 = map(i8, (c2, c3, s2, s3))
        first2, first3 = np.cumsum(c2) - c2, np.cumsum(c3) - c3
        at2 = spans(first2[s2], c2[s2])
        b0 = np.repeat(np.arange(len(uw)), c2[s2])
        s3 = s3[at2]
        at3 = spans(first3[s3], c3[s3])
        t0 = np.repeat(np.arange(len(at2)), c3[s3])
        return Phrases(
            langs, arrays_to_words(wl, wb), i8(ul), i8(uw), i8(uf), b0, i8(bw[at2]), i8(bf[at2]), t0, i8(tw[at3]), i8(tf[at3])
        )


def _packed(langs, words, ul, uw, uf, b0, bw, bf, t0, tw, tf) -> Phrases:
    """The phrases with only the languages and words they use, in the same order."""
    import pyarrow as pa

    used_l, ul = np.unique(ul, return_inverse=True)
    used, all_w = np.unique(np.concatenate([uw, bw, tw]), return_inverse=True)
    cut = [len(uw), len(uw) + len(bw)]
    uw, bw, tw = all_w[: cut[0]], all_w[cut[0] : cut[1]], all_w[cut[1] :]
    return Phrases([langs[k] for k in used_l.tolist()], words.take(pa.array(used)), ul, uw, uf, b0, bw, bf, t0, tw, tf)


def united(parts: list[Phrases], least: int = 1) -> Phrases:
    """The union of transducers' phrases, weights summed; phrases below ``least`` are dropped."""
    import pyarrow as pa
    import pyarrow.compute as pc

    langs = sorted({x for p in parts for x in p.langs}, key=str.encode)
    lang_of = {x: k for k, x in enumerate(langs)}
    coded = pa.concat_arrays([p.words for p in parts]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    words = coded.dictionary.take(pa.array(order))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes = rank[coded.indices.to_numpy()]
    w, at = np.int64(max(len(words), 1)), 0
    u_code, u_f, b_code, b_f, t_keys = [], [], [], [], []
    for p in parts:
        own = codes[at : at + len(p.words)]
        at += len(p.words)
        lang = np.array([lang_of[x] for x in p.langs], np.int64)
        u = lang[p.ul] * w + own[p.uw]
        u_code.append(u)
        u_f.append(p.uf)
        b_code.append((u[p.b0], own[p.bw]))
        b_f.append(p.bf)
        t_keys.append((u[p.b0][p.t0], own[p.bw][p.t0], own[p.tw], p.tf))
    uc, uf = sum_by(np.concatenate(u_code), np.concatenate(u_f))
    bc, bf = sum_by(
        np.searchsorted(uc, np.concatenate([x for x, _ in b_code])) * w + np.concatenate([x for _, x in b_code]),
        np.concatenate(b_f),
    )
    t1, t2, t3, tf = (np.concatenate(x) for x in zip(*t_keys))
    tc, tf = sum_by(np.searchsorted(bc, np.searchsorted(uc, t1) * w + t2) * w + t3, tf)
    if least > 1:
        keep = tf >= least
        tc, tf = tc[keep], tf[keep]
        keep = bf >= least
        moved = np.cumsum(keep) - 1  # a prefix is at least as frequent as what follows it
        tc = moved[tc // w] * w + tc % w
        bc, bf = bc[keep], bf[keep]
        keep = (uf >= least) | np.isin(np.arange(len(uc)), bc // w)
        moved = np.cumsum(keep) - 1
        bc = moved[bc // w] * w + bc % w
        uc, uf = uc[keep], uf[keep]
    return _packed(langs, words, uc // w, uc % w, uf, bc // w, bc % w, bf, tc // w, tc % w, tf)


# ------------------------------------------------------------------ shards


class Shard:
    """Words of texts, with their languages and whether they begin a piece."""

    def __init__(self):
        self.kind = np.zeros(256, np.uint8)
        self.kind[list(SPACES)] = 1
        self.kind[list(BREAKS)] = 2
        self.clear()

    def clear(self) -> None:
        self.words, self.first, self.lang, self.n = [], [], [], 0
        self.langs: dict[str, int] = {}

    def add(self, langs: list[str], texts: list[bytes]) -> None:
        """Texts of a run; one longer than a run is read in parts that end between words."""
        run_l, run_t, size = [], [], 0
        for lang, text in zip(langs, texts):
            if len(text) > RUN_BYTES:
                self._add_long(lang, text)
            else:
                run_l.append(lang)
                run_t.append(text)
                size += len(text) + 1
        if run_t:
            at = np.cumsum([0] + [len(t) + 1 for t in run_t])
            starts = self._read(b"\n".join(run_t) + b"\n", True)
            codes = np.array([self.langs.setdefault(x, len(self.langs)) for x in run_l], np.int64)
            self.lang.append(codes[np.searchsorted(at, starts, side="right") - 1])

    def _add_long(self, lang: str, text: bytes) -> None:
        code = self.langs.setdefault(lang, len(self.langs))
        at, fresh = 0, True
        while at < len(text):
            end = min(at + RUN_BYTES, len(text))
            if end < len(text):
                gaps = np.flatnonzero(self.kind[np.frombuffer(text, np.uint8, end - at, at)])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:
                    more = [k for k in (text.find(bytes([b]), end) for b in SPACES + BREAKS) if k >= 0]
                    end = min(more, default=len(text) - 1) + 1
            part = text[at:end]
            starts = self._read(part, fresh)
            self.lang.append(np.full(len(starts), code, np.int64))
            kinds = self.kind[np.frombuffer(part, np.uint8)]
            words = np.flatnonzero(kinds == 0)
            tail = kinds[words[-1] + 1 :] if len(words) else kinds
            fresh = bool((tail == 2).any()) or (fresh and not len(words))
            at = end

    def _read(self, text: bytes, fresh: bool) -> np.ndarray:
        """Add the words of ``text``; ``fresh``: its first word begins a piece.  Returns where words start."""
        import pyarrow as pa

        text = text.translate(_LOWER)
        buf = np.frombuffer(text, np.uint8)
        kind = self.kind[buf]
        inside = kind == 0
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        starts, ends = edge[0::2], edge[1::2]
        breaks = np.cumsum(kind == 2, dtype=np.int32)
        first = np.empty(len(starts), bool)
        if len(starts):
            first[1:] = breaks[starts[1:]] != breaks[ends[:-1] - 1]
            first[0] = fresh or bool(breaks[starts[0]])
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(buf[inside])]
        self.words.append(pa.Array.from_buffers(pa.large_binary(), len(starts), buffers))
        self.first.append(first)
        self.n += len(starts)
        return starts

    def phrases(self) -> Phrases:
        """All phrases of the shard with their counts."""
        import pyarrow as pa
        import pyarrow.compute as pc

        coded = pa.concat_arrays(self.words).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        words = coded.dictionary.take(pa.array(order))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        langs = sorted(self.langs, key=str.encode)
        lang_rank = np.empty(len(langs), np.int64)
        for k, x in enumerate(langs):
            lang_rank[self.langs[x]] = k
        w = np.int64(max(len(words), 1))
        lang = lang_rank[np.concatenate(self.lang)]
        first = np.concatenate(self.first)
        uc, u, uf = np.unique(lang * w + rank[coded.indices.to_numpy()], return_inverse=True, return_counts=True)
        uw = uc % w
        m = np.int64(max(len(uc), 1))
        follows = np.flatnonzero(~first[1:])  # the word after stands in the same piece
        bc, b, bf = np.unique(u[follows] * m + u[follows + 1], return_inverse=True, return_counts=True)
        twice = np.flatnonzero(np.diff(follows) == 1)
        tc, tf = np.unique(b[twice] * m + u[follows[twice] + 2], return_counts=True)
        return Phrases(langs, words, uc // w, uw, uf, bc // m, uw[bc % m], bf, tc // m, uw[tc % m], tf)


@dataclass(frozen=True)
class Ranges:
    """Prefix ranges: ``first`` ranges of first words times ``second`` ranges of second words."""

    first: int
    second: int

    def of_word(self, places: np.ndarray) -> np.ndarray:
        return (places * np.uint64(self.first) >> np.uint64(32)).astype(np.int64) * self.second

    def of_pair(self, places1: np.ndarray, places2: np.ndarray) -> np.ndarray:
        return self.of_word(places1) + (places2 * np.uint64(self.second) >> np.uint64(32)).astype(np.int64)


def range_rounds(wanted: int) -> list[Ranges]:
    """Ranges of every round: each divides those of the round before, by ``FAN`` at most; the last are ``wanted`` or more."""
    rounds = [math.isqrt(max(wanted - 1, 0)) + 1]  # ranges of first words, and as many of second words
    step = math.isqrt(FAN)
    while rounds[0] > step:
        coarse = -(-rounds[0] // step)
        rounds.insert(0, coarse)
    for k in range(1, len(rounds)):
        rounds[k] = rounds[k - 1] * -(-rounds[k] // rounds[k - 1])
    return [Ranges(n, n) for n in rounds]


def split_phrases(p: Phrases, ranges: Ranges):
    """``(range, phrases)`` of every prefix range that holds any."""
    places = word_places(p.words)
    u_at = ranges.of_word(places[p.uw])
    b_at = ranges.of_pair(places[p.uw[p.b0]], places[p.bw])
    t_at = b_at[p.t0]
    runs = []
    for at in (u_at, b_at, t_at):
        order = np.argsort(at, kind="stable")
        runs.append((order, at[order]))
    for r in np.unique(np.concatenate([u_at, b_at])).tolist():
        u, b, t = (o[np.searchsorted(s, r) : np.searchsorted(s, r, side="right")] for o, s in runs)
        # First words of this range's pairs that are counted in another range: weight 0 here.
        roots = np.unique(np.concatenate([u, p.b0[b]]))
        uf = np.where(u_at[roots] == r, p.uf[roots], 0)
        yield (
            r,
            _packed(
                p.langs, p.words, p.ul[roots], p.uw[roots], uf, np.searchsorted(roots, p.b0[b]), p.bw[b], p.bf[b],
                np.searchsorted(b, p.t0[t]), p.tw[t], p.tf[t],
            ),
        )


SHARD_SCHEMA = "place bigint, data binary"


def _shard_fn(ranges: Ranges, shard_words: int):
    def run(batches):
        import pyarrow as pa

        shard = Shard()

        def flush():
            if shard.n:
                phrases = shard.phrases()
                shard.clear()
                for r, part in split_phrases(phrases, ranges):
                    arrays = [pa.array([r], pa.int64()), pa.array([Transducer.build(part)], pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["place", "data"])

        for batch in batches:
            sizes = batch.column(1).cast(pa.large_binary())
            at = 0
            while at < batch.num_rows:
                end, size = at, 0
                while end < batch.num_rows and size < RUN_BYTES:
                    size += len(sizes[end].as_py())
                    end += 1
                shard.add(batch.column(0).slice(at, end - at).to_pylist(), sizes.slice(at, end - at).to_pylist())
                at = end
                if shard.n >= shard_words:
                    yield from flush()
        yield from flush()

    return trimmed(run)


# ------------------------------------------------------------------ union


def _by_place(batches, *columns):
    """Rows of a sorted stream, as tuples."""
    for batch in batches:
        cols = [batch.column(c) for c in columns]
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in cols)


TOTAL_SCHEMA = "place bigint, data binary, lang string, n bigint"


def _pieces_fn(finer: Ranges):
    """Task function over transducers sorted by place: unions of some of them at a time, cut by ``finer`` ranges."""

    def run(batches):
        import pyarrow as pa

        place, held, size = None, [], 0

        def out():
            for where, phrases in split_phrases(united(held), finer):
                arrays = [pa.array([where], pa.int64()), pa.array([Transducer.build(phrases)], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["place", "data"])

        for here, data in _by_place(batches, "place", "data"):
            if held and (here != place or size > UNION_PHRASES):
                yield from out()
                held, size = [], 0
            place = here
            held.append(Transducer.expand(data))
            size += len(held[-1])
        if held:
            yield from out()

    return trimmed(run)


def _union_fn(least: int):
    """Task function over transducers sorted by place: one per place, and the words of each language (without a place)."""

    def run(batches):
        import pyarrow as pa

        place, held, size = None, [], 0
        words: dict[str, int] = {}

        def row(*values):
            types = (pa.int64(), pa.binary(), pa.string(), pa.int64())
            names = [c.split()[0] for c in TOTAL_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

        for here, data in _by_place(batches, "place", "data"):
            if held and here != place:
                yield row(place, Transducer.build(united(held, least)), None, None)
                held, size = [], 0
            place = here
            p = Transducer.expand(data)
            for lang, n in zip(p.langs, sum_by(p.ul, p.uf)[1].tolist()):
                words[lang] = words.get(lang, 0) + n
            held.append(p)
            size += len(p)
            if size > UNION_PHRASES and len(held) > 1:
                held = [united(held)]
                size = len(held[0])
        if held:
            yield row(place, Transducer.build(united(held, least)), None, None)
        for lang, n in words.items():
            yield row(None, None, lang, n)

    return trimmed(run)


# ------------------------------------------------------------------ parts


class Parts:
    """The parts whose counts the candidates of a range need, by owning range."""

    def __init__(self, p: Phrases, ranges: Ranges):
        self.p = p
        w = np.int64(max(len(p.words), 1))
        places = word_places(p.words)
        lang = p.ul[p.b0]
        first, last3 = lang * w + p.uw[p.b0], lang[p.t0] * w + p.tw
        second = lang * w + p.bw
        wanted = np.concatenate([first, second, last3])
        self.words, at = np.unique(wanted, return_inverse=True)
        self.first, self.second, self.last3 = np.split(at, [len(first), len(first) + len(second)])
        # Last two words of the three-word phrases, with their largest count.
        key = np.searchsorted(self.words, second[p.t0]) * w + p.tw
        self.pairs, self.longest = sum_by(key, p.tf, np.maximum)
        self.last_pair = np.searchsorted(self.pairs, key)
        self.w = w
        pair_first = self.words[self.pairs // w]
        self.word_at = ranges.of_word(places[self.words % w])
        self.pair_at = ranges.of_pair(places[pair_first % w], places[self.pairs % w])
        self.word_order = np.argsort(self.word_at, kind="stable")
        self.pair_order = np.argsort(self.pair_at, kind="stable")
        self.word_sorted, self.pair_sorted = self.word_at[self.word_order], self.pair_at[self.pair_order]

    def owners(self) -> list[int]:
        return np.unique(np.concatenate([self.word_at, self.pair_at])).tolist()

    def of(self, owner: int) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the words and pairs that ``owner`` counts, in order."""
        cut = lambda order, at: order[np.searchsorted(at, owner) : np.searchsorted(at, owner, side="right")]
        return cut(self.word_order, self.word_sorted), cut(self.pair_order, self.pair_sorted)

    def acceptor(self, owner: int) -> bytes:
        """The parts asked of ``owner``: words (weight 1), and pairs weighted with :attr:`longest`."""
        words, pairs = self.of(owner)
        pair_first = self.words[self.pairs[pairs] // self.w]
        roots, at = np.unique(np.concatenate([self.words[words], pair_first]), return_inverse=True)
        asked = np.zeros(len(roots), np.int64)
        asked[at[: len(words)]] = 1
        none = np.zeros(0, np.int64)
        p = self.p
        return Transducer.build(
            _packed(
                p.langs, p.words, roots // self.w, roots % self.w, asked, at[len(words) :], self.pairs[pairs] % self.w,
                self.longest[pairs], none, none, none,
            )
        )


class Owner:
    """A range's transducer, composed with the acceptors that ask it."""

    def __init__(self, data: bytes):
        self.p = Transducer.expand(data)
        self.w = np.int64(max(len(self.p.words), 1))
        self.roots = self.p.ul * self.w + self.p.uw
        self.pairs = self.p.b0 * self.w + self.p.bw
        # Largest count of a three-word candidate that ends with each pair.
        self.longest = np.zeros(len(self.pairs), np.int64)

    def answer(self, asked: bytes) -> bytes:
        """Counts of the words and pairs an acceptor asks for, in its order."""
        import pyarrow.compute as pc

        q = Transducer.expand(asked)
        known = {x: k for k, x in enumerate(self.p.langs)}
        lang = np.array([known.get(x, -1) for x in q.langs], np.int64)
        word = pc.fill_null(pc.index_in(q.words, value_set=self.p.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        root = lang[q.ul] * self.w + word[q.uw]
        at = np.minimum(np.searchsorted(self.roots, root), max(len(self.roots) - 1, 0))
        pair = at[q.b0] * self.w + word[q.bw]
        at2 = np.minimum(np.searchsorted(self.pairs, pair), max(len(self.pairs) - 1, 0))
        if (self.roots[at] != root).any() or (lang < 0).any() or (word < 0).any() or (self.pairs[at2] != pair).any():
            raise ValueError("a part of a candidate is missing from its range")
        np.maximum.at(self.longest, at2, q.bf)
        return dump([self.p.uf[at][q.uf > 0].astype(np.uint64), self.p.bf[at2].astype(np.uint64)])


LINK_SCHEMA = "place bigint, kind int, other bigint, data binary"


def _links(rows):
    import pyarrow as pa

    types = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    names = [c.split()[0] for c in LINK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)


def _ask_fn(ranges: Ranges):
    """Task function over transducers: an acceptor to every range that owns parts (kind 1)."""

    def run(batches):
        for place, data in _by_place(batches, "place", "data"):
            p = Transducer.expand(data)
            if len(p.bw):
                parts = Parts(p, ranges)
                for owner in parts.owners():
                    yield _links([(owner, 1, place, parts.acceptor(owner))])

    return trimmed(run)


def _answer_fn():
    """Task function over ``(place, kind, other, data)``, transducer first: answers to the askers (kind 1),
    and to the range itself how often longer candidates end with its pairs (kind 2)."""

    def run(batches):
        owner, place = None, None
        for here, kind, other, data in _by_place(batches, "place", "kind", "other", "data"):
            if here != place:
                if owner is not None and len(owner.pairs):
                    yield _links([(place, 2, place, dump([owner.longest.astype(np.uint64)]))])
                owner, place = None, here
            if kind == 0:
                owner = Owner(data)
            else:
                yield _links([(other, 1, here, owner.answer(data))])
        if owner is not None and len(owner.pairs):
            yield _links([(place, 2, place, dump([owner.longest.astype(np.uint64)]))])

    return trimmed(run)


# ------------------------------------------------------------------ scores


class Scorer:
    """Collects a range's answers, then scores its candidates."""

    def __init__(self, data: bytes, ranges: Ranges):
        self.p = Transducer.expand(data)
        self.parts = Parts(self.p, ranges)
        self.word_f = np.zeros(len(self.parts.words), np.int64)
        self.pair_f = np.zeros(len(self.parts.pairs), np.int64)
        self.longest = np.zeros(len(self.p.bw), np.int64)

    def take(self, kind: int, other: int, data: bytes) -> None:
        if kind == 2:
            (ending,) = load(data)
            self.longest = np.maximum(self.longest, ending.astype(np.int64))
            return
        words, pairs = self.parts.of(other)
        self.word_f[words], self.pair_f[pairs] = (a.astype(np.int64) for a in load(data))

    def rows(self, share: int):
        """``(lang, phrase, a, l, r, score)`` of the candidates no longer one covers."""
        p, q = self.p, self.parts
        np.maximum.at(self.longest, p.t0, p.tf)
        words = [w.decode() for w in p.words.to_pylist()]
        lang = p.ul[p.b0]

        def score(a: int, l: int, r: int) -> int:
            return 1_000_000 * a * a // (l * r)

        kept = np.flatnonzero(100 * self.longest < share * p.bf)
        l2, r2 = self.word_f[q.first], self.word_f[q.second]
        for k in kept.tolist():
            a, l, r = int(p.bf[k]), int(l2[k]), int(r2[k])
            yield p.langs[lang[k]], f"{words[p.uw[p.b0[k]]]} {words[p.bw[k]]}", a, l, r, score(a, l, r)
        for k, b in enumerate(p.t0.tolist()):
            a = int(p.tf[k])
            cuts = [
                (int(l2[b]), int(self.pair_f[q.last_pair[k]])),
                (int(p.bf[b]), int(self.word_f[q.last3[k]])),
            ]
            s, (l, r) = min(((score(a, *c), c) for c in cuts), key=lambda x: x[0])
            phrase = f"{words[p.uw[p.b0[b]]]} {words[p.bw[b]]} {words[p.tw[k]]}"
            yield p.langs[lang[b]], phrase, a, l, r, s


SCORE_SCHEMA = "lang string, phrase string, a bigint, l bigint, r bigint, score bigint"


def _score_fn(ranges: Ranges, share: int, top: int | None):
    """Task function over ``(place, kind, other, data)``: scored candidates, a task's ``top`` per language."""

    def run(batches):
        import pyarrow as pa

        best: dict[str, list] = {}

        def order(row):
            return -row[5], -row[2], row[1].encode()

        def out(rows):
            types = [pa.string(), pa.string(), *[pa.int64()] * 4]
            names = [c.split()[0] for c in SCORE_SCHEMA.split(", ")]
            for k in range(0, len(rows), 10_000):
                cols = zip(*rows[k : k + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)

        def close(scorer):
            if scorer is None:
                return
            if top is None:
                yield from out(list(scorer.rows(share)))
                return
            for row in scorer.rows(share):
                held = best.setdefault(row[0], [])
                held.append(row)
                if len(held) >= 4 * top + 10_000:
                    best[row[0]] = sorted(held, key=order)[:top]

        scorer, place = None, None
        for here, kind, other, data in _by_place(batches, "place", "kind", "other", "data"):
            if here != place:
                yield from close(scorer)
                scorer, place = None, here
            if kind == 0:
                scorer = Scorer(data, ranges)
            else:
                scorer.take(kind, other, data)
        yield from close(scorer)
        for held in best.values():
            yield from out(sorted(held, key=order)[:top])

    return trimmed(run)


def collocations(
    documents: DataFrame,
    top: int | None = TOP,
    least: int = MIN_COUNT,
    share: int = 50,
    shard_words: int = SHARD_WORDS,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of each language.

    ``documents`` needs ``lang`` and ``text``; other columns are ignored.  Null
    languages count as ``und`` (together with texts so marked), null and empty
    texts have no words, every row counts, also repeated ones; an empty table
    gives no rows.  A text of any length is read whole, in runs.  Phrases of
    two and three words with ``least`` occurrences are candidates; one that
    stands in a longer candidate with ``share`` per cent of its occurrences is
    dropped.  Ties in score go to the more frequent phrase, then by bytes.
    With ``top=None`` all candidates are returned, without a rank.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = range_rounds(max(4, math.ceil(size / range_bytes)))
    ranges = rounds[-1]
    parts = max(parallelism(spark), min(MOST_PARTITIONS, math.ceil(size / PARTITION_BYTES)))
    def dealt(df: DataFrame, *order: str) -> DataFrame:
        return df.repartition(parts, "place").sortWithinPartitions("place", *order)

    pieces = texts.mapInArrow(_shard_fn(rounds[0], shard_words), SHARD_SCHEMA)
    for finer in rounds[1:]:
        pieces = stored(dealt(pieces).mapInArrow(_pieces_fn(finer), SHARD_SCHEMA), "phrase-pieces")
    sums = stored(dealt(pieces).mapInArrow(_union_fn(least), TOTAL_SCHEMA), "phrase-totals")
    totals = sums.filter("place IS NOT NULL").select("place", "data")
    own = totals.select("place", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("other"), "data")
    asked = totals.mapInArrow(_ask_fn(ranges), LINK_SCHEMA)
    answers = dealt(own.unionAll(asked), "kind", "other").mapInArrow(_answer_fn(), LINK_SCHEMA)
    answers = stored(answers, "phrase-answers")
    scored = dealt(own.unionAll(answers), "kind", "other").mapInArrow(_score_fn(ranges, share, top), SCORE_SCHEMA)
    n = sums.filter("place IS NULL").groupBy(F.col("lang").alias("n_lang")).agg(F.sum("n").alias("n"))
    if top is None:
        ranked = scored.withColumn("rank", F.lit(None).cast("bigint"))
    else:
        by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        # Tasks return their first ones; those are narrowed in parts before a language meets in one place.
        salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS))).orderBy(*by)
        few = scored.withColumn("k", F.row_number().over(salted)).filter(F.col("k") <= top).drop("k")
        whole = Window.partitionBy("lang").orderBy(*by)
        ranked = few.withColumn("rank", F.row_number().over(whole).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.join(n, F.col("lang") == F.col("n_lang")).select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("n").cast("bigint").alias("n"), "score"
    )


ORACLE = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS row,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL
), pieces AS (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
  FROM texts
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM pieces, (SELECT unnest([1, 2, 3]) AS k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.w, cut,
    array_to_string(c.w[1:cut], ' ') AS head, array_to_string(c.w[cut + 1:], ' ') AS rest
  FROM candidates c, (SELECT unnest([1, 2]) AS cut) WHERE cut < c.k
), scores AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.w, h.f AS l, r.f AS r, cut,
    (1000000::HUGEINT * c.a * c.a) // (h.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN grams h ON h.lang = c.lang AND h.phrase = c.head
    JOIN grams r ON r.lang = c.lang AND r.phrase = c.rest
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE k = 3) GROUP BY lang, phrase
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank
  FROM scores s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
  WHERE 100 * coalesce(g.most, 0) < 50 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
