"""Merkle manifest of a dataset: checkpoint-and-recompute proofs.

Every row is a leaf.  The leaves of a group (a language), in key order, form a
binary tree; the groups' roots, in group order, form a tree of their own, whose
root stands for the whole dataset.  A node is the SHA-256 of its children's
hexadecimal digests; a last child without partner is hashed alone.

Only every ``STEP``-th level is persisted.  A proof (the siblings from a leaf
to the root) is extracted subtree by subtree: the up to ``2**STEP`` stored
nodes below one stored node are brought together, the interior levels between
are computed again, each node takes its siblings from them and its parent's
path behind, and the interior nodes are dropped.

Positions come from a range sort over ``(group, key, leaf)``: a group may hold
any share of the rows, a key any number of them.  Nothing larger than one
subtree meets in one place.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointtally.llm.common import stored
from pointtally.runtime import fits_broadcast, parallelism

STEP = 5
PARTITION_ROWS = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def node_hash(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n``."""
    return max(n - 1, 0).bit_length()


def interior(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of an aligned subtree, and ``levels`` levels above them."""
    out = [nodes]
    for _ in range(levels):
        nodes = [node_hash(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def sibling_steps(levels: list[list[str]], i: int) -> list[str]:
    """Steps of node ``i`` up the subtree: ``l`` or ``r`` with the sibling on that side, ``-`` without one."""
    out = []
    for nodes in levels[:-1]:
        other = i ^ 1
        out.append(("r" if other > i else "l") + nodes[other] if other < len(nodes) else "-")
        i >>= 1
    return out


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field ``-`` if null, else its length in bytes, ``:`` and its value."""

    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, fields)).cast("binary"), 256)


@dataclass
class Manifest:
    """The stored levels of the groups' trees and of the tree over their roots."""

    levels: list[DataFrame]  # (g, pos, n, h[, key, payload]), every STEP levels, leaves first
    top: list[DataFrame]
    root: str | None  # None for an empty table


def _positions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, their place in their group ``g`` by ``order``, and ``n``, its size."""
    spark = rows.sparkSession
    parts = max(parallelism(spark), math.ceil(rows.count() / PARTITION_ROWS))
    keys = ["g", *order, "m_tie"]
    placed = stored(
        rows.withColumn("m_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .drop("m_tie")
        .withColumn("m_part", F.spark_partition_id())
        .withColumn("m_row", F.monotonically_increasing_id()),
        "merkle-leaves",
    )
    before = Window.partitionBy("g").orderBy("m_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and partition it reaches into: groups + partitions at most.
    runs = stored(
        placed.groupBy("g", "m_part")
        .agg(F.count(F.lit(1)).alias("c"), F.min("m_row").alias("m_first"))
        .select(
            F.col("g").alias("m_g"),
            F.col("m_part").alias("m_p"),
            (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("m_first")).alias("m_shift"),
            F.sum("c").over(Window.partitionBy("g")).alias("n"),
        ),
        "merkle-runs",
    )
    side = F.broadcast(runs) if fits_broadcast(spark, runs.count(), 128) else runs
    return (
        placed.join(side, (F.col("g") == F.col("m_g")) & (F.col("m_part") == F.col("m_p")))
        .withColumn("pos", F.col("m_row") + F.col("m_shift"))
        .drop("m_g", "m_p", "m_part", "m_row", "m_first", "m_shift")
    )


def _subtrees(level: DataFrame, step: int, columns: Sequence[str] = ()) -> DataFrame:
    """The nodes of each aligned subtree of ``step`` levels, in one row: ``(g, up, n, nodes)``."""
    return level.groupBy("g", F.shiftright("pos", step).alias("up")).agg(
        F.max("n").alias("n"), F.collect_list(F.struct("pos", "h", *columns)).alias("nodes")
    )


def _raise_fn(base: int, step: int):
    """Task function: the top node of each subtree whose nodes stand on level ``base``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            tops = []
            for n, nodes in zip(batch.column("n").to_pylist(), batch.column("nodes").to_pylist()):
                nodes = [x["h"].hex() for x in sorted(nodes, key=lambda x: x["pos"])]
                (top,) = interior(nodes, max(0, min(step, height(n) - base)))[-1]
                tops.append(bytes.fromhex(top))
            yield pa.RecordBatch.from_arrays(
                [batch.column("g"), batch.column("up"), batch.column("n"), pa.array(tops, pa.binary())],
                names=["g", "pos", "n", "h"],
            )

    return run


def _build(leaves: DataFrame, step: int) -> list[DataFrame]:
    """The stored levels ``0, step, 2 * step, ...`` of all groups; the last holds one node per group."""
    levels = [leaves]
    tallest = height(leaves.agg(F.max("n")).first()[0] or 0)
    for base in range(0, tallest, step):
        up = _subtrees(levels[-1], step).mapInArrow(_raise_fn(base, step), "g string, pos bigint, n bigint, h binary")
        levels.append(stored(up, "merkle-level"))
    return levels


def build_manifest(
    rows: DataFrame,
    group: Column,
    key: Column,
    leaf: Column,
    payload: Column | None = None,
    step: int = STEP,
) -> Manifest:
    """The trees of ``rows``: a tree per ``group`` over leaves in ``key`` order, and one over the groups.

    ``leaf`` is a row's digest as hexadecimal text (see :func:`leaf_hash`);
    ``payload`` a text carried along to the proofs.  Null groups form a group
    of their own, before all others; null keys come first; rows of equal key
    are ordered by their leaf, so equal rows are interchangeable leaves.  An
    empty table has no root.  Other columns are ignored; a text of any length
    is one leaf and is read once.
    """
    if step < 1:
        raise ValueError(f"step must be positive, got {step}")
    g = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    flat = stored(
        rows.select(
            g.alias("g"),
            key.cast("bigint").alias("key"),
            F.unhex(leaf).alias("h"),
            (F.lit(None) if payload is None else payload).cast("string").alias("payload"),
        ),
        "merkle-rows",
    )
    levels = _build(_positions(flat, ["key", "h"]), step)
    roots = levels[-1].select(F.lit("").alias("g"), F.col("g").alias("key"), "h")
    top = _build(_positions(roots, ["key"]), step)
    row = top[-1].select("h").first()
    return Manifest(levels, top, row and bytes(row["h"]).hex())


def _extract_fn(base: int, step: int, columns: Sequence[str]):
    """Task function over subtrees with their top's path: the path of every node."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            schema = batch.schema
            carried = [f for f in schema.field("nodes").type.value_type if f.name in columns]
            cols = [batch.column(c).to_pylist() for c in ("g", "n", "nodes", "path", "subroot")]
            g_out, pos, h, paths, subroots, extra = [], [], [], [], [], [[] for _ in carried]
            for g, n, nodes, path, subroot in zip(*cols):
                nodes.sort(key=lambda x: x["pos"])
                levels = interior([x["h"].hex() for x in nodes], max(0, min(step, height(n) - base)))
                for i, x in enumerate(nodes):
                    steps = sibling_steps(levels, i)
                    paths.append(",".join([*steps, path] if path else steps))
                    pos.append(x["pos"])
                    h.append(x["h"])
                    for out, f in zip(extra, carried):
                        out.append(x[f.name])
                g_out += [g] * len(nodes)
                subroots += [subroot] * len(nodes)
            arrays = [pa.array(g_out, pa.string()), pa.array(pos, pa.int64()), pa.array(h, pa.binary())]
            arrays += [pa.array(paths, pa.string()), pa.array(subroots, pa.string())]
            arrays += [pa.array(x, f.type) for x, f in zip(extra, carried)]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["g", "pos", "h", "path", "subroot", *(f.name for f in carried)]
            )

    return run


def _paths(levels: list[DataFrame], tops: DataFrame, step: int, columns: Sequence[str]) -> DataFrame:
    """Paths ``(g, pos, h, path, subroot[, columns])`` of all leaves, from those of the tops ``(g, pos, path, subroot)``."""
    above = tops
    for k in range(max(len(levels) - 2, 0), -1, -1):
        carry = columns if k == 0 else ()
        types = {f.name: f.dataType.simpleString() for f in levels[k].schema}
        schema = "g string, pos bigint, h binary, path string, subroot string"
        schema += "".join(f", {c} {types[c]}" for c in carry)
        # A tree of one level only: its leaf is its top.
        below = _subtrees(levels[k], step if len(levels) > 1 else 0, carry)
        parents = above.select(F.col("g").alias("p_g"), F.col("pos").alias("p_pos"), "path", "subroot")
        joined = below.join(parents, (F.col("g") == F.col("p_g")) & (F.col("up") == F.col("p_pos")))
        above = joined.select("g", "n", "nodes", "path", "subroot").mapInArrow(
            _extract_fn(k * step, step, carry), schema
        )
    return above


def proofs(manifest: Manifest, step: int = STEP) -> DataFrame:
    """``(g, key, leaf, subroot, root, proof, payload)`` of every row.

    ``proof`` holds the steps from the leaf to the root, comma-joined: ``l`` or
    ``r`` and the sibling's digest on that side, ``-`` where a node has none.
    ``step`` is that of the manifest.
    """
    none = F.lit("").alias("path")
    over = manifest.top[-1].select("g", "pos", none, F.lit("").alias("subroot"))
    groups = _paths(manifest.top, over, step, ("key",))
    tops = groups.select(
        F.col("key").alias("g"), F.lit(0).cast("bigint").alias("pos"), "path", F.lower(F.hex("h")).alias("subroot")
    )
    rows = _paths(manifest.levels, tops, step, ("key", "payload"))
    return rows.select(
        "g",
        "key",
        F.lower(F.hex("h")).alias("leaf"),
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        F.col("path").alias("proof"),
        "payload",
    )


def fold(leaf: Column, proof: Column) -> Column:
    """The root that follows from ``leaf`` and the steps of ``proof``."""

    def up(acc: Column, step: Column) -> Column:
        sibling = F.substring(step, 2, 64)
        joined = F.when(step == "-", acc).when(step.startswith("l"), F.concat(sibling, acc))
        return F.sha2(joined.otherwise(F.concat(acc, sibling)).cast("binary"), 256)

    return F.when(proof == "", leaf).otherwise(F.aggregate(F.split(proof, ","), leaf, up))


def siblings_digest(proof: Column) -> Column:
    """Digest of the siblings of a proof, in order."""
    return F.sha2(F.translate(proof, "lr,-", "").cast("binary"), 256)


def document_manifest(documents: DataFrame) -> DataFrame:
    """Manifest, proofs and a tamper check of every document.

    Returns ``(doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified)``.  Where 7 divides the CRC-32 of the decimal ``doc_id``, the
    folded leaf is that of a row with ``n_chars + 1`` (a null stays), so
    verification must fail there.  A null ``doc_id`` is never tampered with.
    Rows are matched to their proofs by the payload that travels with the
    leaf, so repeated ids and repeated rows are rows like any other.
    """
    fields = [F.col(c) for c in FIELDS]
    changed = F.col("n_chars").cast("decimal(20,0)") + F.lit(1)
    tampered = [changed.cast("decimal(20,0)") if c == "n_chars" else F.col(c) for c in FIELDS]
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7) == 0
    manifest = build_manifest(
        documents, F.col("lang"), F.col("doc_id"), leaf_hash(fields), F.when(hit, leaf_hash(tampered))
    )
    folded = fold(F.coalesce("payload", "leaf"), F.col("proof"))
    return (
        proofs(manifest)
        .withColumn("folded_root", folded)
        .select(
            F.col("key").alias("doc_id"),
            "leaf",
            "subroot",
            "root",
            siblings_digest(F.col("proof")).alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


# CRC-32 bit by bit: 0xEDB88320 is its reflected polynomial.
ORACLE = """
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, n_chars, CAST(doc_id AS VARCHAR) AS ids,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
    coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS mid,
    coalesce(octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || (n_chars + 1), '-') AS changed,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail
  FROM documents
), leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256(head || mid || tail) AS leaf,
    CASE WHEN xor(list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(ids, ''),
          lambda d: [unicode(d)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda acc, b: xor(xor(acc, b) >> 1, CASE WHEN xor(acc, b) % 2 = 1 THEN 3988292384 ELSE 0 END)),
        4294967295) % 7 = 0
      THEN sha256(head || changed || tail) ELSE sha256(head || mid || tail) END AS used
  FROM rows
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY g) AS n
  FROM leaves
), tree AS (
  SELECT g, 0 AS lvl, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT g, lvl + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM tree WHERE n > 1 GROUP BY g, lvl, pos // 2
), subroots AS (
  SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS lvl, pos, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM top WHERE n > 1 GROUP BY lvl, pos // 2
), nodes AS (
  SELECT g, lvl, pos, n, h, 0 AS part FROM tree UNION ALL SELECT NULL, lvl, pos, n, h, 1 FROM top
), steps AS (
  SELECT p.doc_id, p.leaf, p.g, p.pos, 0 AS part, t.lvl,
    (p.pos >> t.lvl) % 2 AS odd, s.h AS sibling
  FROM placed p JOIN (SELECT DISTINCT g, lvl, n FROM tree WHERE n > 1) t ON t.g = p.g
  LEFT JOIN tree s ON s.g = p.g AND s.lvl = t.lvl AND s.pos = xor(p.pos >> t.lvl, 1)
  UNION ALL
  SELECT p.doc_id, p.leaf, p.g, p.pos, 1, t.lvl, (r.pos >> t.lvl) % 2, s.h
  FROM placed p JOIN subroots r ON r.g = p.g CROSS JOIN (SELECT DISTINCT lvl FROM top WHERE n > 1) t
  LEFT JOIN top s ON s.lvl = t.lvl AND s.pos = xor(r.pos >> t.lvl, 1)
), proof AS (
  SELECT g, pos, sha256(string_agg(coalesce(sibling, ''), '' ORDER BY part, lvl)) AS proof_sha256,
    list(CASE WHEN sibling IS NULL THEN '-' WHEN odd = 1 THEN 'l' || sibling ELSE 'r' || sibling END
      ORDER BY part, lvl) AS steps
  FROM steps GROUP BY g, pos
), result AS (
  SELECT p.doc_id, p.leaf, r.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root,
    coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
    coalesce(list_reduce(list_prepend(p.used, q.steps), lambda acc, s: CASE WHEN s = '-' THEN sha256(acc)
      WHEN s[1] = 'l' THEN sha256(s[2:] || acc) ELSE sha256(acc || s[2:]) END), p.used) AS folded_root
  FROM placed p JOIN subroots r ON r.g = p.g LEFT JOIN proof q ON q.g = p.g AND q.pos = p.pos
)
SELECT *, folded_root = root AS verified FROM result
"""
