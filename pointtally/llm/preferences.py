"""Preference formatting: one prompt, two masked completions per conversation pair.

The longest common turn prefix of the chosen and the rejected conversation is
rendered once as prompt; what follows in each is its completion, with the
character spans to train on (the assistants' texts with their end marker).
Spark functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Turn template: ``START role \n text END``.
START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def adjacent_pairs(conversations: DataFrame) -> DataFrame:
    """``(pair_id, chosen_id, rejected_id)``: ids ``2k`` and ``2k + 1`` make pair ``k``.

    The smaller id is the chosen one.  An id without its neighbour makes a pair
    whose rejected side is null.  Null ids make none.
    """
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("id")).filter("id is not null").distinct()
    return (
        ids.groupBy(F.floor(F.col("id") / 2).cast("bigint").alias("pair_id"))
        .agg(F.min("id").alias("chosen_id"), F.max("id").alias("other"))
        .select(
            "pair_id", "chosen_id", F.when(F.col("other") != F.col("chosen_id"), F.col("other")).alias("rejected_id")
        )
    )


def _render(turns: Column) -> Column:
    texts = F.transform(turns, lambda x: F.concat(F.lit(START), x["role"], F.lit(MIDDLE), x["text"], F.lit(END)))
    return F.array_join(texts, "")


def _spans(turns: Column) -> Column:
    """Spans ``start-end`` (code points of the completion) to train on, comma-joined."""
    head, tail = len(START) + len(MIDDLE), len(END)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["role"]) + F.lit(head)
        end = begin + F.length(x["text"]) + F.lit(tail)
        span = F.concat(begin.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct(
            end.cast("bigint").alias("at"),
            F.when(x["role"] == TRAINED_ROLE, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    return F.array_join(F.aggregate(turns, start, step)["spans"], ",")


def format_preferences(conversations: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """``(pair_id, chosen_id, rejected_id, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans)``.

    ``conversations`` has a row per turn (``conv_id``, ``turn``, ``role``,
    ``text``; other columns are ignored), ``pairs`` one row per pair with a
    unique ``pair_id`` (default: :func:`adjacent_pairs`).  Turns are ordered by
    ``turn``, equal ones by role and text, null ones first; repeated rows are
    turns of their own; a null role or text counts as empty.  Turns equal in
    role and text are common, whatever their number.  Equal conversations have
    empty completions; a null or unknown side has no turns, so the prompt is
    empty and the other side is all completion.  A conversation is one result
    value, so it must fit in a row (2 GB).  An empty table gives no rows.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").cast("bigint").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    pairs = (adjacent_pairs(conversations) if pairs is None else pairs).select("pair_id", "chosen_id", "rejected_id")
    sides = pairs.select(
        "*",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("chosen_id").alias("member")),
                F.struct(F.lit(1).alias("side"), F.col("rejected_id").alias("member")),
            )
        ).alias("s"),
    ).select("pair_id", "chosen_id", "rejected_id", F.col("s.side").alias("side"), F.col("s.member").alias("member"))
    both = (
        sides.join(turns, sides.member == turns.conv_id, "left")
        .groupBy("pair_id", "chosen_id", "rejected_id")
        .agg(
            F.collect_list(F.when(F.col("side") == 0, F.col("t"))).alias("c"),
            F.collect_list(F.when(F.col("side") == 1, F.col("t"))).alias("r"),
        )
    )

    def ordered(name):
        return F.transform(F.sort_array(name), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))

    same = F.zip_with("c", "r", lambda x, y: x.eqNullSafe(y))
    cut = F.array_position(same, F.lit(False))
    rest = {s: F.slice(s, F.col("n") + 1, F.greatest(F.size(s) - F.col("n"), F.lit(0))) for s in "cr"}
    return (
        both.select("pair_id", "chosen_id", "rejected_id", ordered("c").alias("c"), ordered("r").alias("r"))
        .withColumn("n", F.when(cut == 0, F.size("c")).otherwise(cut - 1).cast("int"))
        .select(
            "pair_id",
            "chosen_id",
            "rejected_id",
            F.col("n").cast("bigint").alias("n_common"),
            _render(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
            _render(rest["c"]).alias("chosen"),
            _render(rest["r"]).alias("rejected"),
            _spans(rest["c"]).alias("chosen_spans"),
            _spans(rest["r"]).alias("rejected_spans"),
        )
    )


ORACLE = f"""
WITH ids AS (SELECT DISTINCT conv_id AS id FROM conversations WHERE conv_id IS NOT NULL),
pairs AS (SELECT CAST(floor(id / 2) AS BIGINT) AS pair_id, min(id) AS chosen_id,
                 CASE WHEN count(*) > 1 THEN max(id) END AS rejected_id FROM ids GROUP BY 1),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS idx
      FROM conversations),
c AS (SELECT pair_id, idx, role, text FROM pairs JOIN t ON conv_id = chosen_id),
r AS (SELECT pair_id, idx, role, text FROM pairs JOIN t ON conv_id = rejected_id),
d AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.idx, r.idx) AS idx,
             c.role = r.role AND c.text = r.text AS same
      FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.idx = r.idx),
n AS (SELECT pair_id, coalesce(min(CASE WHEN same IS NOT TRUE THEN idx END), count(*)) AS n_common
      FROM d GROUP BY pair_id),
s AS (
  SELECT side, pair_id, idx, n_common, role, '{START}' || role || '\n' || text || '<|im_end|>' || chr(10) AS seg,
         length(role) + {len(START) + 1} AS head
  FROM (SELECT 'c' AS side, * FROM c UNION ALL SELECT 'r', * FROM r) JOIN n USING (pair_id)),
a AS (
  SELECT *, CASE WHEN idx >= n_common THEN coalesce(sum(CASE WHEN idx >= n_common THEN length(seg) END) OVER (
           PARTITION BY side, pair_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS off
  FROM s),
g AS (
  SELECT pair_id,
    string_agg(CASE WHEN side = 'c' AND idx < n_common THEN seg END, '' ORDER BY idx) AS prompt,
    string_agg(CASE WHEN side = 'c' AND idx >= n_common THEN seg END, '' ORDER BY idx) AS chosen,
    string_agg(CASE WHEN side = 'r' AND idx >= n_common THEN seg END, '' ORDER BY idx) AS rejected,
    string_agg(CASE WHEN side = 'c' AND idx >= n_common AND role = '{TRAINED_ROLE}'
               THEN (off + head) || '-' || (off + length(seg)) END, ',' ORDER BY idx) AS chosen_spans,
    string_agg(CASE WHEN side = 'r' AND idx >= n_common AND role = '{TRAINED_ROLE}'
               THEN (off + head) || '-' || (off + length(seg)) END, ',' ORDER BY idx) AS rejected_spans
  FROM a GROUP BY pair_id)
SELECT pair_id, chosen_id, rejected_id, CAST(coalesce(n_common, 0) AS BIGINT) AS n_common,
       coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen, coalesce(rejected, '') AS rejected,
       coalesce(chosen_spans, '') AS chosen_spans, coalesce(rejected_spans, '') AS rejected_spans
FROM pairs LEFT JOIN n USING (pair_id) LEFT JOIN g USING (pair_id)
"""
