"""Phrase collocations, adaptive thresholds and Merkle manifests: against brute force and on edges."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointtally.llm import collocations as C
from pointtally.llm import merkle as M
from pointtally.llm import thresholds as T

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------ collocations


def phrase_counts(docs):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    return f, n


def plain_collocations(docs, least, top=2000):
    f, n = phrase_counts(docs)
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            covered = [b for q, b in candidates.items() if len(q) > len(p) and p in (q[:-1], q[1:])]
            if any(100 * b >= 50 * a for b in covered):
                continue
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            scored.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def word_soup(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "é", "Éa", "x" * 40, "a-b", "7", "city", " z"]
    gaps = [" "] * 8 + ["\t", "  ", ", ", ".", "\n", "!?", "\x0b"]
    docs = [(None, None), ("en", ""), (None, " . \t"), ("", "one two"), ("en", "A a a a a. a")]
    for k in range(n):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(60)))
        docs.append((rng.choice([None, "en", "en", "fr", "und"]), text))
    return docs + docs[10:20]


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, small, monkeypatch):
    if small:  # several shards, unions in steps, long texts in parts
        monkeypatch.setattr(C, "RUN_BYTES", 64)
        monkeypatch.setattr(C, "UNION_PHRASES", 50)
        monkeypatch.setattr(C, "FAN", 9)
    docs = word_soup(150, 5)
    df = spark.createDataFrame([(k, *d) for k, d in enumerate(docs)], "doc_id long, lang string, text string")
    df = df.selectExpr("*", "'x' AS phrase", "1 AS place", "2 AS n").repartition(3)
    options = {"shard_words": 100, "range_bytes": 200} if small else {}
    got = C.collocations(df, least=3, **options)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(docs, 3)
    few = C.collocations(df, least=3, top=4, **options)
    assert sorted(tuple(r) for r in few.collect()) == plain_collocations(docs, 3, 4)


def test_range_rounds(monkeypatch):
    assert [r.first for r in C.range_rounds(4)] == [2] and len(C.range_rounds(C.FAN // 2)) == 1
    for wanted in (3, 3000, 10**7, 10**9):
        sides = [r.first for r in C.range_rounds(wanted)]
        assert sides[-1] ** 2 >= wanted and sides[0] ** 2 <= C.FAN
        assert all(b % a == 0 and (b // a) ** 2 <= C.FAN for a, b in zip(sides, sides[1:]))


def test_collocations_empty_and_all(spark):
    df = spark.createDataFrame([("en", "a b. a b")], "lang string, text string")
    assert C.collocations(df).collect() == [] == C.collocations(df.limit(0)).collect()
    rows = C.collocations(df, top=None, least=2).collect()
    assert [tuple(r) for r in rows] == [("en", None, "a b", 2, 2, 2, 4, 1_000_000)]


def test_transducers_share_states_and_expand():
    shard = C.Shard()
    shard.add(["en"] * 2, [b" ".join(b"w%d same end" % k for k in range(500)), b"b a. a b"])
    p = shard.phrases()
    assert p.uf.sum() == 1504
    data = C.Transducer.build(p)
    q = C.Transducer.expand(data)
    for name in ("ul", "uw", "uf", "b0", "bw", "bf", "t0", "tw", "tf"):
        assert getattr(p, name).tolist() == getattr(q, name).tolist(), name
    assert q.words.to_pylist() == sorted(q.words.to_pylist()) and q.langs == ["en"]
    states3 = len(C.load(data)[12])
    assert states3 < 0.7 * len(p.bw)  # "w17 same" and "w18 same" end in one state
    twice = C.united([p, q])
    assert twice.tf.tolist() == (2 * p.tf).tolist() and twice.uf.tolist() == (2 * p.uf).tolist()
    assert (C.united([p, q], 10).bf >= 10).all()


def test_states_with_one_signature_stay_apart(monkeypatch):
    starts, counts = np.array([0, 2, 4]), np.array([2, 2, 2])
    labels, weights = np.array([1, 2, 1, 2, 3, 4]), np.array([5, 6, 5, 6, 5, 6])
    state, kept = C._register(starts, counts, labels, weights)
    assert state.tolist() == [0, 0, 1] and kept.tolist() == [0, 2]
    monkeypatch.setattr(C, "_signatures", lambda starts, counts, arcs: np.zeros(len(starts), np.uint64))
    state, _ = C._register(starts, counts, labels, weights)
    assert state[0] == state[1] != state[2]


# ------------------------------------------------------------------ thresholds


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), len(lines)


def plain_verdicts(docs, least):
    counted = [(i, lang, source, *plain_counts(text)) for i, lang, source, text in docs]
    failed = [r[3] < 10 or 100 * r[7] > 20 * r[3] for r in counted]
    values = [
        None if bad else dict(zip(T.METRICS, (1000 * r[4] // r[3], 1000 * r[5] // r[3], 1000 * r[6] // r[8], 1000 * r[7] // r[3])))
        for r, bad in zip(counted, failed)
    ]

    def floor(v):
        shift = max(v.bit_length() - 6, 0)
        return v >> shift << shift

    def fences(group, metric):
        held = sorted(floor(v[metric]) for v in group)
        q1, q3 = (held[-(-len(held) * k // 4) - 1] for k in (1, 3))
        width = max(T.FENCE * (q3 - q1), T.METRICS[metric][0])
        return (q1 - width if T.METRICS[metric][1] else -1), q3 + width

    out = []
    for r, bad, v in zip(counted, failed, values):
        kept = not bad
        if kept:
            passed = [(x, y) for x, y, b in zip(counted, values, failed) if not b]
            groups = [[y for x, y in passed if x[1:3] == r[1:3]], [y for x, y in passed if x[1] == r[1]], [y for _, y in passed]]
            group = next((g for g in groups if len(g) >= least), groups[2])
            for metric in T.METRICS:
                low, high = fences(group, metric)
                kept = kept and low <= v[metric] <= high
        out.append((r[0], *r[3:8], bad, kept))
    return sorted(out, key=repr)


def rule_docs(seed):
    rng = random.Random(seed)
    docs = [(None, None, None, None), (1, "en", None, ""), (1, "en", "a", " \n\t"), (2, None, "a", "w " * 300)]
    long = " ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(20_000))
    docs.append((3, "en", "a", long))
    for k in range(160):
        words = [rng.choice(["alpha", "beta", "Gamma", "ünï", "d", "epsilon"]) for _ in range(rng.randrange(60))]
        if rng.random() < 0.3:
            words += ["#" * rng.randrange(9), "$%&|<>"] * rng.randrange(6)
        if rng.random() < 0.3:
            words += words[:7]
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "\x0b", " "]) for w in words)
        if rng.random() < 0.3:
            text += "\nsame line here" * rng.randrange(4)
        docs.append((k, rng.choice(["en", "en", None]), rng.choice(["a", "b", None]), text))
    return docs + docs[:6]


@pytest.mark.parametrize("broadcast", [True, False])
def test_thresholds(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(T, "fits_broadcast", lambda *a: False)
    docs = rule_docs(7)
    df = spark.createDataFrame(docs, "doc_id long, lang string, source string, text string")
    df = df.selectExpr("*", "1 AS n_words", "2 AS metric", "3 AS g").repartition(3)
    got = T.judge(df, least_docs=30).drop("limits_of")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_verdicts(docs, 30)
    assert T.judge(df.limit(0)).collect() == []


def test_thresholds_stay_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "en", "a", "x")], "doc_id long, lang string, source string, text string")
    plan = T.judge(df)._jdf.queryExecution().executedPlan().toString() + T.word_rules(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_sketch_buckets_and_merge(spark):
    rows = spark.range(0, 100_000, 7).select(F.col("id"), T.bucket(F.col("id")).alias("b")).collect()
    for r in rows:
        shift = max(r["id"].bit_length() - 6, 0)
        assert r["b"] == r["id"] >> shift << shift and 33 * (r["id"] - r["b"]) <= r["id"] + 32
    sketch = spark.createDataFrame(
        [("en", "a", "m", 1, 2), ("en", "b", "m", 1, 3), ("en", "b", "m", 4, 5)], "lang string, source string, metric string, value long, c long"
    )
    assert sorted(tuple(r) for r in T.merged(sketch, "lang").collect()) == [("en", "m", 1, 5), ("en", "m", 4, 5)]


# ------------------------------------------------------------------ Merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [sha(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        levels.append(nodes)
    return levels


def plain_manifest(docs):
    """``docs`` as rows (doc_id, source, lang, n_chars, text)."""
    groups = collections.defaultdict(list)
    for d in docs:
        changed = d
        if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0 and d[3] is not None:
            changed = (*d[:3], d[3] + 1, d[4])
        groups[d[2]].append((d[0] is not None, d[0] or 0, plain_leaf(d), plain_leaf(changed), d[0]))
    trees = {}
    for g, rows in groups.items():
        rows.sort(key=lambda r: r[:3])
        trees[g] = plain_tree([r[2] for r in rows])
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = plain_tree([trees[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for i, (_, _, leaf, changed, key) in enumerate(groups[g]):
            siblings, acc = [], changed
            for levels, at in ((trees[g], i), (top, place)):
                for nodes in levels[:-1]:
                    run = nodes[at // 2 * 2 : at // 2 * 2 + 2]
                    siblings += [x for k, x in enumerate(run) if k != at % 2]
                    run[at % 2] = acc
                    acc, at = sha(*run), at // 2
            root = top[-1][0]
            out.append((key, leaf, trees[g][-1][0], root, sha(*siblings), acc, acc == root))
    return sorted(out, key=repr)


DOC_SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def manifest_docs(n, seed):
    rng = random.Random(seed)
    docs = [(rng.randrange(10 * n), "s", rng.choice(["en", "en", "en", "fr", "é", "", None]), len(str(k)), f"text {k}") for k in range(n)]
    docs += [(None, None, None, None, None), (None, "", "en", 0, ""), (5, "s", "en", None, "é" * 5000), (-3, "s", "en", 2**63 - 1, "x")]
    return docs + docs[:5] + [docs[0]] * 3


@pytest.mark.parametrize("n,broadcast", [(0, True), (40, False), (300, True)])
def test_merkle(spark, n, broadcast, monkeypatch):
    monkeypatch.setattr(M, "PARTITION_ROWS", 50)
    if not broadcast:
        monkeypatch.setattr(M, "fits_broadcast", lambda *a: False)
    docs = manifest_docs(max(n, 1), 11)
    df = spark.createDataFrame(docs, DOC_SCHEMA).selectExpr("*", "'x' AS g", "1 AS pos", "2 AS h", "3 AS payload").repartition(4)
    got = sorted((tuple(r) for r in M.document_manifest(df).collect()), key=repr)
    assert got == plain_manifest(docs)
    assert {r[-1] for r in got} == ({True, False} if n else {r[-1] for r in plain_manifest(docs)})


def test_merkle_small_trees(spark):
    assert M.document_manifest(spark.createDataFrame([], DOC_SCHEMA)).collect() == []
    for docs in ([(2, "s", "en", 1, "a")], [(2, "s", "en", 1, "a"), (4, "s", None, 1, "b")]):
        got = M.document_manifest(spark.createDataFrame(docs, DOC_SCHEMA))
        assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_manifest(docs)


@pytest.mark.parametrize("step", [1, 3])
def test_only_every_few_levels_are_stored(spark, step):
    rows = spark.range(100).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    manifest = M.build_manifest(rows, F.lit("g"), F.col("k"), F.col("leaf"), step=step)
    sizes = [x.count() for x in manifest.levels]
    assert sizes == [-(-100 // 2 ** (step * k)) for k in range(len(sizes))] and sizes[-1] == 1
    got = M.proofs(manifest, step).select("key", M.fold(F.col("leaf"), F.col("proof")).alias("f"), "root")
    assert all(r["f"] == r["root"] for r in got.collect()) and got.count() == 100
    assert manifest.root == plain_tree([sha(str(k)) for k in range(100)])[-1][0]


def test_tree_heights():
    assert [M.height(n) for n in (0, 1, 2, 3, 4, 5, 8, 9)] == [0, 0, 1, 2, 2, 3, 3, 4]
    with pytest.raises(ValueError):
        M.build_manifest(None, None, None, None, step=0)
