"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement runs on the driver's tables registered as views.  Column names
and types match :mod:`pointtally.plans.queries`: integers are ``BIGINT``
(DuckDB's ``sum`` of integers is ``HUGEINT``, so it is cast), distances are
``DOUBLE`` rounded to the same number of places.  The iterative operators
(farthest-first, greedy matching) are recursive CTEs that carry the chosen ids
as a list.
"""

from __future__ import annotations

from pointtally.plans.queries import DIGITS, K_GROUPS, K_POINTS, L_GROUPS, SEED

PTS = "p AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings)"
PAIRS = "pr AS (SELECT a.id AS i, b.id AS j, list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d2 FROM {src} a JOIN {src} b ON a.id < b.id)"

CLASS_COUNT = "SELECT event_type AS class, count(*)::BIGINT AS n FROM events GROUP BY event_type"

# A final line break ends the last line and opens no further one.
LINES = (
    r"pieces AS (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS p FROM documents), "
    "lines AS (SELECT doc_id, unnest(CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END) AS line FROM pieces)"
)
TOKENS = (
    "toks AS (SELECT unnest(CASE WHEN line = '' THEN [''] "
    "WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[] "
    "ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM lines)"
)
WORD_COUNT = f"WITH {LINES}, {TOKENS} SELECT word, count(*)::BIGINT AS n FROM toks GROUP BY word"


def _first_center(src: str) -> str:
    return f"(SELECT id FROM {src} ORDER BY md5('{SEED}:' || id), id LIMIT 1)"


def _farthest(src: str, chosen: str) -> str:
    """Id of the point of ``src`` farthest from the ids in ``chosen`` (ties: smallest id)."""
    return (
        f"(SELECT q.id FROM {src} q WHERE NOT list_contains({chosen}, q.id) "
        f"ORDER BY (SELECT min(list_distance(q.v, c.v)) FROM {src} c WHERE list_contains({chosen}, c.id)) DESC, q.id "
        "LIMIT 1)"
    )


KCENTER = f"""ff(pos, chosen) AS (
  SELECT 0, [{_first_center('p')}]
  UNION ALL
  SELECT pos + 1, list_append(chosen, {_farthest('p', 'ff.chosen')}) FROM ff WHERE pos < {K_POINTS - 1}
),
centers AS (SELECT pos, chosen[pos + 1] AS id FROM ff),
cp AS (SELECT p.id, p.v FROM p JOIN centers USING (id))"""

CORESET = f"""pp AS (SELECT id, v, ((id % {L_GROUPS}) + {L_GROUPS}) % {L_GROUPS} AS part FROM p),
cs(part, pos, chosen) AS (
  SELECT part, 0, [arg_min(id, md5('{SEED}:' || id))] FROM pp GROUP BY part
  UNION ALL
  SELECT part, pos + 1, list_append(chosen, (
      SELECT q.id FROM pp q WHERE q.part = cs.part AND NOT list_contains(cs.chosen, q.id)
      ORDER BY (SELECT min(list_distance(q.v, c.v)) FROM pp c WHERE list_contains(cs.chosen, c.id)) DESC, q.id
      LIMIT 1))
  FROM cs WHERE pos < {K_POINTS - 1} AND (SELECT count(*) FROM pp q WHERE q.part = cs.part) > pos + 1
),
core AS (SELECT part, pos, chosen[pos + 1] AS id FROM cs),
corep AS (SELECT p.id, p.v FROM p JOIN core USING (id))"""


def _greedy(src: str) -> str:
    """CTEs ``gm``/``sel``: greedy farthest-pair matching of ``k`` points of ``src``."""
    rounds = K_POINTS // 2
    odd = K_POINTS % 2
    pairs = PAIRS.format(src=src)
    last = (
        f"list_append(used, (SELECT min(id) FROM {src} WHERE NOT list_contains(used, id)))" if odd else "used"
    )
    return f"""{pairs},
gm(step, used) AS (
  SELECT 0, []::BIGINT[]
  UNION ALL
  SELECT step + 1, list_concat(used, (
      SELECT [i, j] FROM pr WHERE NOT list_contains(used, i) AND NOT list_contains(used, j)
      ORDER BY d2 DESC, i, j LIMIT 1))
  FROM gm WHERE step < {rounds}
),
fin AS (SELECT {last} AS sel FROM gm WHERE step = {rounds}),
chosen AS (SELECT (generate_subscripts(sel, 1) - 1)::BIGINT AS pos, unnest(sel)::BIGINT AS id FROM fin),
chosenp AS (SELECT chosen.pos, p.id, p.v FROM chosen JOIN p USING (id))"""


def _r(expr: str) -> str:
    return f"round({expr}, {DIGITS})"


AVG_PAIR_DISTANCE = _r("coalesce(avg(list_distance(a.v, b.v)), 'NaN'::DOUBLE)")


ORACLE: dict[str, str] = {
    "pair_parse": "SELECT event_id AS id, event_type AS class FROM events",
    "pair_count": "SELECT count(*)::BIGINT AS pair_count FROM events",
    "class_count": CLASS_COUNT,
    "class_partial_counts": (
        f"SELECT (event_id % {K_GROUPS})::BIGINT AS part, event_type AS class, count(*)::BIGINT AS n "
        "FROM events GROUP BY 1, 2"
    ),
    "class_count_rounds": CLASS_COUNT,
    "class_count_by_partition": CLASS_COUNT,
    "most_frequent_class": (
        f"SELECT class, n FROM ({CLASS_COUNT} UNION ALL SELECT '' AS class, -1::BIGINT AS n) "
        "ORDER BY n DESC, class LIMIT 1"
    ),
    "max_partition_size": (
        "SELECT coalesce(max(c), 0)::BIGINT AS max_partition_size "
        f"FROM (SELECT count(*) AS c FROM events GROUP BY event_id % {K_GROUPS})"
    ),
    "max_partition_size_physical": (
        "SELECT coalesce(max(c), 0)::BIGINT AS max_partition_size "
        f"FROM (SELECT count(*) AS c FROM events GROUP BY ((event_id % {K_GROUPS}) + {K_GROUPS}) % {K_GROUPS})"
    ),
    "lines_scan": f"WITH {LINES} SELECT line, count(*)::BIGINT AS n FROM lines GROUP BY line",
    "document_count": f"WITH {LINES} SELECT count(*)::BIGINT AS document_count FROM lines",
    "word_count": WORD_COUNT,
    "word_count_salted": WORD_COUNT,
    "word_count_partitioned": WORD_COUNT,
    "distinct_words": f"SELECT count(*)::BIGINT AS distinct_words FROM ({WORD_COUNT})",
    "avg_word_length": (
        "SELECT (sum(length(word)) // count(*))::BIGINT AS avg_word_length "
        f"FROM ({WORD_COUNT})"
    ),
    "points_parse": (
        "SELECT p_partkey AS id, p_size::DOUBLE AS x0, p_retailprice AS x1, 2::BIGINT AS dim FROM part"
    ),
    "points_scan": (
        "SELECT (row_number() OVER (ORDER BY p_partkey, tok) - 1)::BIGINT AS id, x0, x1, 2::BIGINT AS dim FROM ("
        "SELECT p_partkey, 0 AS tok, p_size::DOUBLE AS x0, p_retailprice AS x1 FROM part UNION ALL "
        "SELECT p_partkey, 1 AS tok, p_retailprice AS x0, p_size::DOUBLE AS x1 FROM part)"
    ),
    "point_count": "SELECT count(*)::BIGINT AS point_count FROM embeddings",
    "exact_diameter": (
        f"WITH {PTS} SELECT {_r('coalesce(max(list_distance(a.v, b.v)), -1.0)')} AS diameter "
        "FROM p a JOIN p b ON a.id < b.id"
    ),
    "avg_pairwise_distance": (
        f"WITH {PTS} SELECT {AVG_PAIR_DISTANCE} AS avg_distance "
        "FROM p a JOIN p b ON a.id < b.id"
    ),
    "sample_points": (
        f"WITH {PTS} SELECT (row_number() OVER (ORDER BY h, id) - 1)::BIGINT AS pos, id FROM "
        f"(SELECT id, md5('{SEED}:' || id) AS h FROM p ORDER BY h, id LIMIT {K_POINTS})"
    ),
    "two_approx_diameter": (
        f"WITH {PTS}, s AS (SELECT id, v FROM p ORDER BY md5('{SEED}:' || id), id LIMIT {K_POINTS}) "
        f"SELECT {_r('coalesce(max(list_distance(p.v, s.v)), -1.0)')} AS diameter FROM p, s"
    ),
    "kcenter_centers": f"WITH RECURSIVE {PTS}, {KCENTER} SELECT pos::BIGINT AS pos, id::BIGINT AS id FROM centers",
    "kcenter_diameter": (
        f"WITH RECURSIVE {PTS}, {KCENTER} "
        f"SELECT {_r('coalesce(max(list_distance(a.v, b.v)), -1.0)')} AS diameter FROM cp a JOIN cp b ON a.id < b.id"
    ),
    "nearest_center_distance": (
        f"WITH RECURSIVE {PTS}, {KCENTER} "
        f"SELECT p.id, {_r('min(list_distance(p.v, cp.v))')} AS dist FROM p, cp GROUP BY p.id"
    ),
    "coreset": (
        f"WITH RECURSIVE {PTS}, {CORESET} SELECT part::BIGINT AS part, pos::BIGINT AS pos, id::BIGINT AS id FROM core"
    ),
    "greedy_matching": f"WITH RECURSIVE {PTS}, {_greedy('p')} SELECT pos, id FROM chosen",
    "diversity_points": f"WITH RECURSIVE {PTS}, {CORESET}, {_greedy('corep')} SELECT pos, id FROM chosen",
    "diversity_value": (
        f"WITH RECURSIVE {PTS}, {CORESET}, {_greedy('corep')} "
        f"SELECT {AVG_PAIR_DISTANCE} AS diversity_value "
        "FROM chosenp a JOIN chosenp b ON a.id < b.id"
    ),
}
