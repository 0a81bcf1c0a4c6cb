"""Quality classifier: weak labels by expectation-maximisation, then a hashed linear scorer.

Two aspects are modelled alike, low quality and toxicity.  Heuristic labellers
vote on every document; known labels, where a table of them exists, are one
more labeller that abstains elsewhere.  The votes of all documents are counted
by pattern (at most ``2^labellers * 3`` rows), and expectation-maximisation on
those counts estimates each labeller's accuracy and a posterior per pattern.  A linear scorer over hashed features (words, word beginnings, shape
buckets) is fitted to the posteriors of a bounded sample of voted documents
(``SAMPLE_ROWS`` per class and aspect, chosen by a hash of the id) and scores
every document in one pass.
"""

from __future__ import annotations

import re
import warnings
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointtally.llm.common import stored, text_runs, trimmed
from pointtally.llm.words import NON_ALNUM, WordHasher, mix

# Insults that make toxicity labellers fire.
INSULTS = (
    "clown coward disgusting dumb filthy fool garbage idiot imbecile jerk liar loser moron pathetic retard scum stupid "
    "trash vermin worthless"
).split()

SAMPLE_ROWS = 4_000
FEATURE_BITS = 18
SHAPE_BINS = 10
UNKNOWN_WEIGHT = 0.1
# Lengths (bytes) of the word beginnings that are features, beside the whole word.
BEGINNINGS = (3, 4, 5, 6, 7)
CHUNK_BYTES = 1 << 20
# L1 strength of each aspect's scorer: low quality shows in few shape features, toxicity in many words.
# At least MIN_DOCUMENTS sampled documents must show a feature, so small samples are not learnt by heart.
L1 = (1e-3, 1e-4)
MIN_DOCUMENTS = 2.5
RUN_FEATURES = 500_000
# The scorer's fit ends when no weight moves by more than SETTLED; ending by rounds above UNSETTLED is warned of.
SETTLED, UNSETTLED = 1e-4, 0.05

# Labellers of each aspect, in the order of their vote bits.
QUALITY_LABELLERS = ("pipes", "symbols", "capitals", "shouts", "repeats", "variety", "lines")
TOXIC_LABELLERS = ("insults", "several", "dense", "addressed")
# Different insults that make several, their share of the words that is dense.
SEVERAL, DENSE = 3, 0.02
# Shares from which the quality labellers fire; "variety" fires below its share.
THRESHOLDS = {
    "pipes": 0.1, "symbols": 0.15, "capitals": 0.3, "shouts": 0.1, "repeats": 0.15, "variety": 0.3, "lines": 0.3,
}

_INSULTS = re.compile(rf"\b(?:{'|'.join(INSULTS)})\b")
# An insult at most two words after one that addresses the reader.
_ADDRESSED = re.compile(rf"\b(?:you|your|youre|you're)\b\W+(?:\w+\W+){{0,2}}?(?:{'|'.join(INSULTS)})\b")
_SYMBOLS = re.compile(r"([#$%&*@^~=+_<>])\1\1")


def shapes(text: str) -> dict[str, float]:
    """Shape measures of a text, each between 0 and 1."""
    parts = text.split()
    n = max(1, len(parts))
    lines = text.split("\n")
    return {
        "pipes": sum(p == "|" for p in parts) / n,
        "symbols": min(1.0, len(_SYMBOLS.findall(text)) / n),
        "capitals": sum(len(p) > 1 and p.isupper() for p in parts) / n,
        "shouts": sum(p.endswith("!!") for p in parts) / n,
        "repeats": sum(a == b for a, b in zip(parts, parts[1:])) / n,
        "variety": len(set(parts)) / n if len(parts) >= 20 else 1.0,
        "lines": 1 - len(set(lines)) / len(lines) if len(lines) > 2 else 0.0,
    }


def votes(text: str) -> tuple[int, int]:
    """Vote bits of the quality and of the toxicity labellers."""
    s = shapes(text)
    q = 0
    for k, name in enumerate(QUALITY_LABELLERS):
        fires = s[name] <= THRESHOLDS[name] if name == "variety" else s[name] >= THRESHOLDS[name]
        q |= fires << k
    low = text.lower()
    found = _INSULTS.findall(low) if any(w in low for w in INSULTS) else []
    dense = bool(found) and len(found) >= DENSE * len(text.split())
    addressed = bool(found) and _ADDRESSED.search(low) is not None
    return q, bool(found) | (len(set(found)) >= SEVERAL) << 1 | dense << 2 | addressed << 3


def _votes_fn():
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            got = [votes(t) for _, _, texts in text_runs(batch.column(1), CHUNK_BYTES) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "q": pa.array([g[0] for g in got], pa.int32()),
                    "t": pa.array([g[1] for g in got], pa.int32()),
                }
            )

    return trimmed(run)


# ------------------------------------------------------------------ weak labels


def fit_labellers(bits, known, counts, n_labellers: int, rounds: int = 2_000, trust: float = 0.98):
    """Expectation-maximisation over vote patterns.

    ``bits`` are the heuristics' votes (each fires for the class or abstains),
    ``known`` the known label's vote (-1 where it abstains), ``counts`` the
    documents of each pattern.  Estimated per heuristic: how often it fires in
    the class and outside it.  Only firing counts as evidence, so heuristics
    for different kinds of documents do not speak against each other.  The
    known label's accuracy has a prior at ``trust`` that weighs as much as all
    its votes; where it abstains a document counts ``UNKNOWN_WEIGHT`` for the rates.  Returns ``(posterior per pattern, rates (labellers, 2), known
    label's accuracy, class prior)``; a rate row is (outside, inside).
    """
    bits, known, counts = (np.asarray(x) for x in (bits, known, counts))
    fired = (bits[:, None] >> np.arange(n_labellers) & 1).astype(float)
    seen = known >= 0
    n_known = float((counts * seen).sum())
    weighed = counts * (seen if n_known else 1)
    heard = counts * np.where(seen | (n_known == 0), 1.0, UNKNOWN_WEIGHT)
    rates = np.tile((0.02, 0.3), (n_labellers, 1))
    right, prior = trust, 0.1
    post = np.zeros(len(counts))
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + fired @ np.log(rates[:, 1] / rates[:, 0])
        odds = odds + np.where(seen, np.where(known == 1, 1, -1) * np.log(right / (1 - right)), 0.0)
        fresh = 1 / (1 + np.exp(-odds.clip(-500, 500)))
        done = np.abs(fresh - post).max(initial=0.0) < 1e-9
        post = fresh
        if done:
            break
        for y, w in ((0, heard * (1 - post)), (1, heard * post)):
            rates[:, y] = (w @ fired + 2 * (0.02, 0.3)[y]) / (w.sum() + 2)
        rates = rates.clip(1e-6, 1 - 1e-6)
        agreed = (weighed * seen * np.where(known == 1, post, 1 - post)).sum()
        right = float(np.clip((agreed + trust * (n_known + 1)) / (2 * n_known + 1), 0.5, 1 - 1e-4))
        prior = float(np.clip(((weighed * post).sum() + 0.1) / (weighed.sum() + 1), 1e-3, 1 - 1e-3))
    else:
        warnings.warn(f"expectation-maximisation did not settle in {rounds} rounds", stacklevel=2)
    return post, rates, right, prior


# ------------------------------------------------------------------ scorer


def feature_rows(hasher: WordHasher, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, feature)`` of the distinct hashed features of texts, in text order.

    Features are words, word beginnings of ``BEGINNINGS`` bytes, buckets of the
    shape measures and the shapes that fire.
    """
    buf, starts, ends, first = hasher.split([t.encode("utf-8", "surrogatepass") for t in texts])
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(first))
    shift = np.uint64(64 - FEATURE_BITS)
    keys = [doc << FEATURE_BITS | (hasher.hashes(buf, starts, ends) >> shift).astype(np.int64)]
    for k in BEGINNINGS:
        longer = np.flatnonzero(ends - starts > k)
        h = hasher.hashes(buf, starts[longer], starts[longer] + k)
        keys.append(doc[longer] << FEATURE_BITS | (mix(h + np.uint64(k)) >> shift).astype(np.int64))
    mask = (1 << FEATURE_BITS) - 1
    own = []
    for i, t in enumerate(texts):
        for name, v in shapes(t).items():
            if name != "variety" and v >= THRESHOLDS[name]:
                own.append(i << FEATURE_BITS | zlib.crc32(f"f:{name}".encode()) & mask)
            own.append(
                i << FEATURE_BITS
                | zlib.crc32(f"s:{name}:{min(int(v * SHAPE_BINS), SHAPE_BINS - 1)}:{v > 0}".encode()) & mask
            )
    keys.append(np.array(own, np.int64))
    distinct = np.unique(np.concatenate(keys))
    return distinct >> FEATURE_BITS, distinct & mask


def _features_fn():
    def run(batches):
        import pyarrow as pa

        hasher = WordHasher(NON_ALNUM)
        for batch in batches:
            for lo, hi, texts in text_runs(batch.column(1), CHUNK_BYTES):
                doc, feature = feature_rows(hasher, texts)
                ends = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(lo, hi - lo),
                        "f": pa.ListArray.from_arrays(pa.array(ends), pa.array(feature.astype(np.int32))),
                    }
                )

    return trimmed(run)


def fit_scorer(indices, indptr, target, weight, rounds: int = 250, rate: float = 0.5, l1: float = 1e-3):
    """Logistic weights by proximal AdaGrad on presence features; the last one is the intercept.

    A feature's gradient is at most the weight of the documents that have it;
    where that does not exceed ``l1`` its weight never leaves zero, so those
    features are left out beforehand.
    """
    weight = weight / weight.sum()
    n = np.diff(indptr)
    reach = np.bincount(indices, weights=np.repeat(weight, n), minlength=1 << FEATURE_BITS)
    used = np.flatnonzero(reach > l1)
    number = np.full(1 << FEATURE_BITS, -1, np.int32)
    number[used] = np.arange(len(used))
    kept = number[indices] >= 0
    indices = number[indices[kept]]
    ends = np.concatenate([[0], np.cumsum(kept)])[indptr]
    dim = len(used)
    w, g2 = np.zeros(dim + 1), np.full(dim + 1, 1e-8)
    # Documents in runs of bounded size keep the working arrays small.
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], RUN_FEATURES)), len(target)))
    runs = [
        (a, b, indices[ends[a] : ends[b]], np.repeat(np.arange(b - a, dtype=np.int32), np.diff(ends[a : b + 1])))
        for a, b in zip(cuts[:-1], cuts[1:])
    ]
    for round_ in range(rounds):
        g = np.zeros(dim + 1)
        for a, b, features, rows in runs:
            z = np.bincount(rows, weights=w[features], minlength=b - a) + w[dim]
            err = weight[a:b] * (1 / (1 + np.exp(-z.clip(-500, 500))) - target[a:b])
            g[:dim] += np.bincount(features, weights=err[rows], minlength=dim)
            g[dim] += err.sum()
        g2 += g * g
        step = rate / np.sqrt(g2)
        before = w.copy()
        w -= step * g
        w[:dim] = np.sign(w[:dim]) * np.maximum(np.abs(w[:dim]) - step[:dim] * l1, 0)
        moved = float(np.abs(w - before).max(initial=0.0))
        if moved < SETTLED:
            break
    else:
        if moved > UNSETTLED:
            warnings.warn(f"the scorer still moved by {moved:.2g} in round {round_ + 1}", stacklevel=2)
    out = np.zeros((1 << FEATURE_BITS) + 1)
    out[used], out[-1] = w[:dim], w[dim]
    return out


def scores(hasher: WordHasher, weights: np.ndarray, column) -> np.ndarray:
    """``(n, 2)`` log odds of an Arrow column's texts being of low quality and toxic."""
    z = np.tile(weights[-1], (len(column), 1))
    for lo, hi, texts in text_runs(column, CHUNK_BYTES):
        doc, feature = feature_rows(hasher, texts)
        for aspect in (0, 1):
            z[lo:hi, aspect] += np.bincount(doc, weights=weights[feature, aspect], minlength=hi - lo)
    return z


def _score_fn(weights: np.ndarray):
    def run(batches):
        import pyarrow as pa

        hasher = WordHasher(NON_ALNUM)
        for batch in batches:
            z = scores(hasher, weights, batch.column(1))
            p = 1 / (1 + np.exp(-z.clip(-500, 500)))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "p_low": pa.array(p[:, 0], pa.float64()),
                    "p_toxic": pa.array(p[:, 1], pa.float64()),
                    "keep": pa.array((z < 0).all(axis=1)),
                }
            )

    return trimmed(run)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def _voted(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``(doc_id, q, t, low, toxic)`` of every row: vote bits, and known labels or -1."""
    if labels is None:
        labels = docs.sparkSession.createDataFrame([], "doc_id bigint, quality int, toxic int")
    known = labels.groupBy(F.col("doc_id").cast("bigint").alias("l_id")).agg(
        F.max(1 - F.col("quality").cast("int")).alias("low"), F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    voted = stored(docs.mapInArrow(_votes_fn(), "doc_id bigint, q int, t int"), "votes")
    return voted.join(known, voted.doc_id == known.l_id, "left").select(
        "doc_id",
        "q",
        "t",
        F.coalesce("low", F.lit(-1)).alias("low"),
        F.coalesce("toxic", F.lit(-1)).alias("toxic"),
    )


def labeller_report(documents: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """What the labellers do: ``(aspect, labeller, fired, known, right, rate_inside, rate_outside)``.

    ``fired`` counts the documents a labeller votes for, ``known`` those of
    them with a known label and ``right`` those whose label agrees; the rates
    are the estimates of expectation-maximisation, how often it fires in the
    class and outside it.
    """
    rows, out = _voted(_texts(documents), labels), []
    for aspect, bits, label, names in (("low", "q", "low", QUALITY_LABELLERS), ("toxic", "t", "toxic", TOXIC_LABELLERS)):
        patterns = rows.groupBy(bits, label).agg(F.count(F.lit(1)).alias("n")).collect()
        b, k, n = (np.array([p[c] for p in patterns], np.int64) for c in (bits, label, "n"))
        _, rates, _, _ = fit_labellers(b, k, n, len(names))
        for j, name in enumerate(names):
            fires = (b >> j & 1) == 1
            counts = [int(n[m].sum()) for m in (fires, fires & (k >= 0), fires & (k == 1))]
            out.append((aspect, name, *counts, float(rates[j, 1]), float(rates[j, 0])))
    schema = "aspect string, labeller string, fired bigint, known bigint, right bigint, rate_inside double, rate_outside double"
    return documents.sparkSession.createDataFrame(out, schema)


def fit(documents: DataFrame, labels: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Scorer weights ``(2^FEATURE_BITS + 1, 2)`` for low quality and toxicity.

    ``labels`` has ``doc_id``, ``quality`` (1: good) and ``toxic`` (1: toxic);
    where an id has several labels a bad one counts; null labels abstain.
    """
    docs = _texts(documents)
    rows = _voted(docs, labels)
    weights = np.zeros(((1 << FEATURE_BITS) + 1, 2))
    plans = []
    for aspect, (bits, label, names) in enumerate((("q", "low", QUALITY_LABELLERS), ("t", "toxic", TOXIC_LABELLERS))):
        patterns = rows.groupBy(bits, label).agg(F.count(F.lit(1)).alias("n")).collect()
        if not patterns:
            return weights
        b, k, n = (np.array([p[c] for p in patterns]) for c in (bits, label, "n"))
        post, *_ = fit_labellers(b, k, n, len(names))
        voted_on = [(int(x), int(y), float(p)) for x, y, p in zip(b, k, post) if y >= 0 or x]
        if not voted_on:
            weights[-1, aspect] = -10.0
            continue
        for want in (0, 1):
            chosen = [v for v in voted_on if (v[2] >= 0.5) == bool(want)]
            if not chosen:
                continue
            table = F.create_map(*[F.lit(x) for v in chosen for x in ((v[1] + 1) << 16 | v[0], v[2])])
            target = F.element_at(table, F.shiftleft(F.col(label) + 1, 16) + F.col(bits))
            picked = (
                rows.withColumn("y", target)
                .filter(F.col("y").isNotNull() & F.col("doc_id").isNotNull())
                .select(F.lit(aspect).alias("aspect"), "doc_id", "y")
                .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
                .limit(sample_rows)
            )
            plans.append(picked)
    if not plans:
        return weights
    sample = [r for p in plans for r in p.collect()]  # at most 4 * sample_rows
    if not sample:
        return weights
    ids = docs.sparkSession.createDataFrame(sorted({(r["doc_id"],) for r in sample}), "s_id bigint")
    got = (
        docs.join(F.broadcast(ids), docs.doc_id == ids.s_id)
        .select("doc_id", "text")
        .mapInArrow(_features_fn(), "doc_id bigint, f array<int>")
        .groupBy("doc_id")
        .agg(F.min("f").alias("f"))  # of several texts with one id always the same one
        .orderBy("doc_id")
        .toArrow()
    )
    row_of = {d: i for i, d in enumerate(got.column("doc_id").to_pylist())}
    held = got.column("f").combine_chunks()
    del got
    lens, flat = held.value_lengths().to_numpy(), held.flatten().to_numpy()
    at = np.concatenate([[0], np.cumsum(lens)])
    for aspect in (0, 1):
        own = {r["doc_id"]: r["y"] for r in reversed(sample) if r["aspect"] == aspect}
        own = sorted((row_of[d], y) for d, y in own.items() if d in row_of)
        if not own:
            continue
        rows_, y = np.array([r for r, _ in own]), np.array([v for _, v in own])
        indices = np.concatenate([flat[at[r] : at[r + 1]] for r in rows_])
        indptr = np.concatenate([[0], np.cumsum(lens[rows_])])
        weights[:, aspect] = fit_scorer(indices, indptr, y, np.ones(len(y)), l1=max(L1[aspect], MIN_DOCUMENTS / len(y)))
    return weights


SCHEMA = "doc_id bigint, p_low double, p_toxic double, keep boolean"


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """``SCHEMA`` rows: the scorer applied to every whole text; ``keep`` where both are below one half."""
    return _texts(documents).mapInArrow(_score_fn(weights.astype(np.float64)), SCHEMA)


def classify(documents: DataFrame, labels: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Fit on ``documents`` (and ``labels``) and score every row: ``SCHEMA``.

    ``documents`` needs ``doc_id`` and ``text``; other columns are ignored.  A
    null text counts as empty; repeated rows are scored alike, one row each; a
    null ``doc_id`` is scored but not sampled; an empty table gives no rows;
    without any vote everything is kept.
    """
    return score(documents, fit(documents, labels, sample_rows))


def _keep_fn(weights: np.ndarray, text_at: int):
    """Task function: the rows of its batches, all columns, whose text the scorer keeps."""

    def run(batches):
        import pyarrow as pa

        hasher = WordHasher(NON_ALNUM)
        for batch in batches:
            z = scores(hasher, weights, batch.column(text_at))
            yield batch.filter(pa.array((z < 0).all(axis=1)))

    return trimmed(run)


def keep_documents(documents: DataFrame, labels: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``documents``, with all their columns, that :func:`classify` keeps.

    Every row is judged by its own whole text, also repeated rows and rows
    without an id; null and empty texts are judged as empty; ties (log odds of
    exactly 0) go; an empty table gives no rows.
    """
    weights = fit(documents, labels, sample_rows)
    return documents.mapInArrow(_keep_fn(weights, documents.columns.index("text")), documents.schema)
