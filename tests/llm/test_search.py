"""Jaccard join, decontamination, fingerprints: against brute force on small fixtures."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from pointtally.llm import decontaminate as D
from pointtally.llm import fingerprints as FP
from pointtally.llm import jaccard as J
from pointtally.llm.words import NON_ALNUM, SPACES, WordHasher

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EDGE_TEXTS = ["", None, " \t\n", "one", "One", "one two", "É é", "a b c d e", "A\x0bB c\td e", "x" * 5000, "\0 a\x1fb"]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# ------------------------------------------------------------------ words


@pytest.mark.parametrize(
    "separators,pattern",
    [(SPACES, r"[^\x20\x09-\x0D]+"), (NON_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")],
    ids=["spaces", "non-alnum"],
)
def test_words_and_hashes(separators, pattern, monkeypatch):
    from pointtally.llm import words

    rng = random.Random(3)
    texts = [t or "" for t in EDGE_TEXTS] + [
        "".join(rng.choice("abÄé.,- \n\t|9Z") for _ in range(rng.randrange(200))) for _ in range(50)
    ]
    hashes: dict[str, set] = collections.defaultdict(set)
    for segment in (words.SEGMENT, 64):
        monkeypatch.setattr(words, "SEGMENT", segment)
        hasher = WordHasher(separators)
        buf, starts, ends, first = hasher.split([t.encode() for t in texts])
        h = hasher.hashes(buf, starts, ends)
        for k, t in enumerate(texts):
            want = re.findall(pattern, t.translate(LOWER))
            got = [bytes(buf[starts[i] : ends[i]]).decode() for i in range(first[k], first[k + 1])]
            assert [g.translate(LOWER) for g in got] == want
            if segment != 64:
                for w, i in zip(want, range(first[k], first[k + 1])):
                    hashes[w].add(int(h[i]))
    assert all(len(v) == 1 for v in hashes.values())
    assert len({next(iter(v)) for v in hashes.values()}) == len(hashes)


# ------------------------------------------------------------------ Jaccard join


def linked_components(docs):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent, degree = list(range(len(docs))), [0] * len(docs)

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                degree[a] += 1
                degree[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    smallest: dict = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            smallest[root(k)] = min(i, smallest.get(root(k), i))
    return sorted(
        ((i, len(sets[k]), smallest.get(root(k)), degree[k]) for k, (i, _) in enumerate(docs)), key=repr
    )


def near_copies(n, seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghijklm") * rng.randint(1, 2) for _ in range(rng.randint(1, 90))] for _ in range(15)]
    docs = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(["x1", "y2"])
        if rng.random() < 0.2:
            w += rng.choice(base)[:15]
        docs.append((rng.randrange(10**6), (" ".join(w)).upper() if rng.random() < 0.3 else "\n".join(w)))
    docs += [(-k, t) for k, t in enumerate(EDGE_TEXTS)]
    docs += [(None, "p q r s t u"), (7, "P q r s t u"), (9, "rep eat"), (9, "rep eat"), (None, "alone here")]
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_components(spark, small, monkeypatch):
    if small:
        monkeypatch.setattr(J, "CLASS_ROWS", 2)
    if small:  # many blocks, split lists, long lists probed
        monkeypatch.setattr(J, "CELL_CLASSES", 3)
        monkeypatch.setattr(J, "LIST_BLOCK", 4)
        monkeypatch.setattr(J.Cell, "MERGE_ALL", 0)
    docs = near_copies(160, 5)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS cls", "3 AS x")
    got = rows(J.jaccard_components(df.repartition(4)), "doc_id", "n_shingles", "component_id", "n_links")
    assert got == linked_components(docs)


def test_cluster_pairs_of_templates_are_few(spark):
    # a grid of heads and bodies: every head's shingles list one document of each body's cluster
    seen = spark.range(100 * 20 * 100).selectExpr("id div 100 AS list_id", "id % 100 AS x")
    sizes = spark.range(100).selectExpr("id AS x", "100 AS g", "1000 AS s")
    pairs = J.cluster_pairs(seen, sizes)
    assert pairs.count() == pairs.filter("guest < home").count() == 100 * 99 // 2
    made = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert made.index("slice") < made.index("collect_list")  # pairs come from distinct lists
    mixed = spark.createDataFrame([(1, 5), (1, 6), (1, 5), (2, 6), (2, 7), (3, 7), (3, 6), (4, 5)], "list_id long, x long")
    few = J.cluster_pairs(mixed, spark.createDataFrame([(5, 2, 0), (6, 1, 0), (7, 2, 0)], "x long, g long, s long"))
    assert sorted(map(tuple, few.collect())) == [(5, 6), (7, 6)]


def test_template_grid(spark):
    words = lambda kind, k: " ".join(f"{kind}{k}w{j}" for j in range(30))
    docs = [(h * 12 + b, words("h", h) + " " + words("b", b)) for h in range(12) for b in range(12)]
    docs += [(1000 + k, t) for k, t in docs[:5]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in J.jaccard_components(df).collect()}
    want = {i: (i % 1000, 1 if i % 1000 < 5 else 0) for i, _ in docs}
    assert got == want


def test_jaccard_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.jaccard_components(df).collect() == []


def test_keep_one(spark):
    long = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    docs = [(5, long, "p"), (3, long, "q"), (8, long + " zz", "r"), (4, "other text", "s"), (6, None, "t"), (4, "other text", "s")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert rows(J.keep_one(df), "doc_id", "lang") == [(3, "q"), (4, "s"), (6, "t")]


def test_keep_one_judges_rows(spark):
    long = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    own = "one two three four five six seven eight nine ten"
    docs = [
        (1, long, "stays"), (2, long, "gone"), (2, own, "stays"), (2, None, "stays"),  # one id, three texts
        (5, "n " + own + " x", "stays"), (5, "p p p p p p", "stays"), (5, "p p p p p p", "stays"),  # copies: one stays
        (7, long + " zz", "gone"), (8, "q q2 q3 q4 q5 q6 q7 q8 q9 q10 q11", "stays"), (8, "q q2 q3 q4 q5 q6 q7 q8 q9 q10 q11 q12", "stays"),
        (None, long, "gone"), (None, "m m2 m3 m4 m5 m6", "stays"), (None, "m m2 m3 m4 m5 m6", "stays"), (None, "lone words", "stays"),
        (None, None, "stays"), (None, "", "stays"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    kept = J.keep_one(df)
    got = rows(kept, "doc_id", "lang")
    want = [(1, "stays"), (2, "stays"), (2, "stays"), (5, "stays"), (5, "stays"), (8, "stays")] + [(None, "stays")] * 4
    assert got == sorted(want, key=repr) and kept.columns == df.columns
    assert J.jaccard_components(kept).filter("n_links > 0").count() == 0


def test_cell_search_matches_counting():
    rng = np.random.RandomState(0)
    pool = rng.randint(0, 2**62, 400).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, rng.randint(1, 60))) for _ in range(60)]
    sets += [np.unique(np.append(s[:-1], pool[k])) for k, s in enumerate(sets)]
    want = {
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if 100 * len(both := np.intersect1d(sets[a], sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - len(both))
    }
    cell = J.Cell(sets)
    for merge_all in (0, 64):
        J_merge, J.Cell.MERGE_ALL = J.Cell.MERGE_ALL, merge_all
        try:
            got = set()
            for k, i in enumerate(cell.by_size.tolist()):
                got |= {tuple(sorted((i, int(cell.by_size[j])), reverse=True)) for j in cell.search(sets[i], k)}
        finally:
            J.Cell.MERGE_ALL = J_merge
        assert got == want and len(want) > 20
    alive = J.may_link(
        np.array([len(s) for s in sets]), [J.histogram(s) for s in sets], np.zeros(len(sets), bool), True
    )
    assert all(alive[a] and alive[b] for a, b in want)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(300, 340)]
    edges += [(500, k) for k in range(501, 540)]
    parent = {v: v for e in edges for v in e}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    linked = {v for a, b in edges if a != b for v in (a, b)}
    got = dict(map(tuple, J.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {v: root(v) for v in linked}


# ------------------------------------------------------------------ decontamination


def contamination(docs, items, window=13):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    wins = []
    for item, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.append((item, w[k : k + window]))
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for item, g in wins:
            for k in range(len(w) - len(g) + 1):
                if w[k : k + len(g)] == g:
                    hit |= set(range(k, k + len(g)))
                    found.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        spans = [k for k in sorted(hit) if k - 1 not in hit]
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w), len(spans)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_contamination(spark, small, monkeypatch):
    if small:
        monkeypatch.setattr(D, "SHARD_WORDS", 40)
        monkeypatch.setattr(D, "CHUNK_BYTES", 200)
        monkeypatch.setattr(D, "LOCATE_ROWS", 3)
        monkeypatch.setattr(D, "SAMPLE", 1)
        monkeypatch.setattr(D, "PART_BYTES", 300)  # the benchmark is read in parts
    rng = random.Random(4)
    vocab = ["the", "Of", "größe", "x1", "and", "river", "été"]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 13, 20, 40])))) for k in range(12)]
    items += [(3, items[4][1]), (None, items[5][1] + " tail"), (77, None), (78, " .,; "), (10, "solo-word")]
    docs = []
    for k in range(120):
        parts = [rng.choice(vocab + ["filler%d" % rng.randrange(50)]) for _ in range(rng.randrange(60))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = (rng.choice(items)[1] or "").upper().split()
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(-k, t) for k, t in enumerate(EDGE_TEXTS)] + [(None, items[2][1]), (5, docs[5][1])]
    ddf = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "0 AS n_hit")
    bdf = spark.createDataFrame(items, "item_id long, text string")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "size(spans)"]
    got = sorted((tuple(r) for r in D.find_contamination(ddf.repartition(3), bdf).selectExpr(*names).collect()), key=repr)
    want = contamination(docs, items)
    assert got == want and sum(r[2] > 0 for r in want) > 30
    clean = collections.Counter((i, t) for (i, t) in docs if not contamination([(i, t)], items)[0][5])
    kept = D.clean_documents(ddf, bdf)
    assert kept.columns == ddf.columns
    assert collections.Counter((r["doc_id"], r["text"]) for r in kept.collect()) == clean


def test_contamination_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_contamination(docs, none).first()["n_hit"] == 0
    assert D.find_contamination(docs.limit(0), none).collect() == []


@pytest.mark.parametrize("kind", ["random", "copies", "one word", "separators"])
def test_suffix_array_is_sorted(kind):
    rng = np.random.RandomState(7)
    seq = rng.randint(0, 9, 400)
    if kind == "copies":
        seq = np.concatenate([np.append(seq[:50] % 8 + 1, 0)] * 9)
    elif kind == "one word":
        seq = np.append(np.ones(300, np.int64), 0)
    elif kind == "separators":
        seq = np.zeros(40, np.int64)
    zeros = np.cumsum(seq == 0)
    plain = [int(z) if s == 0 else int(s) + 1000 for s, z in zip(seq, zeros)]
    assert D.suffix_array(seq).tolist() == sorted(range(len(seq)), key=lambda i: plain[i:])


def test_the_index_holds_every_word(monkeypatch):
    held = []
    index = D.FmIndex
    monkeypatch.setattr(D, "FmIndex", lambda symbols: held.append(symbols) or index(symbols))
    windows = D.Windows([("a", "two words"), ("b", "not there"), ("c", "two words")])
    shard = D.Shard(lambda: [windows])
    shard.add([1, 2], [b"here are two words and others", b"two"])
    n_words, n_hit, items, spans = shard.results()
    assert len(held[0]) == 6 + 1 + 2 and len(set(held[0].tolist())) == 7
    assert n_words.tolist() == [6, 1] and n_hit.tolist() == [2, 0]
    assert items == {0: {"a", "c"}} and spans == {0: [(2, 4)]}


def test_suffix_array_and_ranks():
    rng = np.random.RandomState(1)
    seq = rng.randint(0, 6, 300)
    seq[-1] = 0
    index = D.FmIndex(seq, sample=5)
    wave = D.WaveletMatrix(seq)
    at = np.arange(300)
    symbol, rank = wave.access(at)
    assert (symbol == seq).all()
    assert (rank == [int((seq[:k] == seq[k]).sum()) for k in range(300)]).all()
    for length in (1, 2, 4):
        pats = rng.randint(1, 6, (40, length))
        which, lo, hi = index.search(pats, np.full(40, length))
        got = {int(p): sorted(index.locate(np.arange(a, b)).tolist()) for p, a, b in zip(which, lo, hi)}
        for k, p in enumerate(pats):
            want = [i for i in range(300 - length + 1) if (seq[i : i + length] == p).all()]
            assert got.get(k, []) == want


# ------------------------------------------------------------------ fingerprints


@pytest.mark.parametrize("seq, window", [([3, 7, 0], [8, 3]), ([3, 7, 0], [3, 8]), ([1, 3, 0, 3, 0], [4, 1]), ([1, 0], [2, 1])])
def test_windows_above_the_largest_symbol_of_a_shard(seq, window):
    index = D.FmIndex(np.array(seq))
    which, lo, hi = index.search(np.array([window, seq[:2]]), np.array([2, 1]))
    assert [index.locate(np.arange(a, b)).tolist() for w, a, b in zip(which, lo, hi) if w == 0] == []
    assert which.tolist() == [1] and int(hi[0] - lo[0]) == seq.count(seq[0])


def test_fingerprints(spark):
    rng = random.Random(6)
    docs = [(k * 3 - 60, "".join(rng.choice("abcdé \n") for _ in range(rng.randrange(400)))) for k in range(60)]
    docs += [(1000, None), (1001, ""), (1002, "x"), (1003, "é" * 9000), (1004, "same text here"), (1005, "same text here")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS bucket", "2 AS halo")
    order = sorted(((i, t or "") for i, t in docs), reverse=True)
    want = {}
    for k, (i, t) in enumerate(order):
        nxt, half = order[(k + 1) % len(order)][1], len(t) // 2
        edited = (t[: len(t) - half] + nxt[:half]).encode()
        own, other, follow = FP.digests([t.encode(), edited, nxt.encode()])
        want[i] = (
            len(t), hashlib.sha256(edited).hexdigest(), own.tobytes().hex(), other.tobytes().hex(),
            float(FP.likeness(own[None], other[None])[0]), float(FP.likeness(own[None], follow[None])[0]),
        )
    for size in (1 << 20, 500):
        got = {r[0]: tuple(r)[1:] for r in FP.fingerprints(df.repartition(3), range_bytes=size).collect()}
        assert got == want
    assert want[1004][2] == want[1005][2]
    assert all(0 <= v[4] <= 1 and 0 <= v[5] <= 1 for v in want.values())


def test_fingerprints_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert FP.fingerprints(empty).collect() == []
    alone = FP.fingerprints(spark.createDataFrame([(4, "lone text")], "doc_id long, text string")).first()
    assert alone["near_next"] == 1.0
    odd = [(None, "n1"), (None, "n2"), (5, "rep"), (5, "rep"), (5, "tie"), (9, "top document")]
    got = FP.fingerprints(spark.createDataFrame(odd, "doc_id long, text string"), range_bytes=4)
    assert sorted(str(r["doc_id"]) for r in got.collect()) == ["5", "5", "5", "9", "None", "None"]


def plain_digest(text: bytes) -> bytes:
    """The digest by its definition, byte by byte."""
    raw = [[b"".join(hashlib.sha256(f"{t}:{p}:{k}".encode()).digest() for k in range(8)) for p in range(3)] for t in range(6)]
    counts = [0] * 128
    padded = bytes(4) + text
    for at in range(4, len(padded)):
        for t, (i, j) in enumerate([(1, 2), (1, 3), (2, 3), (2, 4), (1, 4), (3, 4)]):
            a, b, c = padded[at], padded[at - i], padded[at - j]
            counts[(raw[t][0][a] % 128) ^ (raw[t][1][b] % 128) ^ (raw[t][2][c] % 128)] += 1
    q1, q2, q3 = (sorted(counts)[k] for k in (31, 63, 95))
    body = bytearray(32)
    for k, c in enumerate(counts):
        body[k // 4] |= ((c > q1) + (c > q2) + (c > q3)) << 2 * (k % 4)
    top = max(q3, 1)
    length = min(round(math.log(max(len(text), 1)) / math.log(1.1)), 255)
    ratios = (q1 * 100 // top % 16) << 4 | q2 * 100 // top % 16
    return bytes([hashlib.blake2b(text, digest_size=1).digest()[0], length, ratios]) + bytes(body)


def test_digests_by_definition(monkeypatch):
    rng = random.Random(12)
    texts = [b"", b"x", b"abc", b"\0\0\0\0\0", bytes(range(256)) * 3]
    texts += [bytes(rng.randrange(256) for _ in range(rng.randrange(900))) for _ in range(30)]
    want = [plain_digest(t) for t in texts]
    assert [d.tobytes() for d in FP.digests(texts)] == want
    monkeypatch.setattr(FP, "CHUNK_BYTES", 64)  # longer texts in segments
    assert [d.tobytes() for d in FP.digests(texts)] == want


def test_similar_texts_are_nearer():
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(900)) for _ in range(20)]
    near = [t[:700] + u[:200] for t, u in zip(texts, texts[1:])]
    a, b = FP.digests([t.encode() for t in texts]), FP.digests([t.encode() for t in near])
    assert (FP.likeness(a[:-1], b) > FP.likeness(a[:-1], a[1:])).mean() > 0.9
    assert (FP.likeness(a, a) == 1).all()
