"""Quality rules with adaptive thresholds, in Spark functions only.

Each document gets a few counts (:func:`word_rules`).  Their ratios, in whole
thousandths, are summarised per language and source in quantile sketches: a
count per bucket, where a bucket is a value below 64 or one of 32 equal steps
of an octave, so a quantile is at most 1/32 too low.  Sketches merge by adding
counts; that is what the partial aggregation, and the coarser sketches of a
language and of everything, do.  The merge is exact in any order, so results
do not depend on partitions or retries.

A group's limits lie outside its quartiles by ``FENCE`` times their distance,
or by a least width where a group hardly varies.  A source that uses symbols
throughout thus keeps them, one that does not is held to it.  Groups of fewer
than ``LEAST_DOCS`` documents take the limits of their language, and languages
of fewer those of all documents.  The limits are then joined to the counts and
filter them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointtally.llm.common import stored
from pointtally.runtime import fits_broadcast

# White space between words, and the characters that count as symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Least words, and repeated words in per cent, of the base rule.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

# Per metric: least distance of a limit from its quartile (thousandths), and
# whether low values are limited too.
METRICS = {"mean_word": (2500, True), "symbols": (150, False), "dup_lines": (400, False), "repeats": (250, False)}
FENCE = 6
LEAST_DOCS = 100
# Replicas of the limits where they are too many to be broadcast.
SALTS = 32


def _duplicated(h: Column) -> Column:
    """Ascending positions of the five-word windows (hashes ``h``, in order) that occur twice or more."""
    nothing = F.lit(None).cast("struct<h:bigint,i:int>")
    ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    before = F.concat(F.array(nothing), F.slice(ordered, 1, F.size(h) - 1))
    after = F.concat(F.slice(ordered, 2, F.size(h)), F.array(nothing))
    same = F.filter(
        F.arrays_zip(before.alias("b"), ordered.alias("o"), after.alias("a")),
        lambda x: F.coalesce(x["o"]["h"] == x["b"]["h"], F.lit(False))
        | F.coalesce(x["o"]["h"] == x["a"]["h"], F.lit(False)),
    )
    return F.array_sort(F.transform(same, lambda x: x["o"]["i"]))


def _covered(at: Column) -> Column:
    """Words in five-word windows that start at the ascending positions ``at``."""
    widths = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), lambda a, b: F.least(F.lit(5), F.coalesce(b - a, F.lit(5))))
    return F.aggregate(widths, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def word_rules(documents: DataFrame) -> DataFrame:
    """``(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)`` of every row.

    Words are runs without ASCII white space; a null text has none.  Repeated
    windows are found by a 64-bit hash of their words: two different windows
    of one text are taken for one with a chance of 2^-64 a pair.  Arrays of
    one row hold its words, hashes and windows, so a text needs about ten
    times its size in one task's memory.  Ids and other columns may be null
    or repeated; every row counts for itself.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def pairs(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))

    n = F.greatest(F.size("h") - 4, F.lit(0))
    two = pairs(F.slice("h", 1, n), F.slice("h", 2, n))
    four = pairs(two, pairs(F.slice("h", 3, n), F.slice("h", 4, n)))
    kept = ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines"]
    return (
        documents.select("doc_id", "lang", "source", text.alias("text"))
        .select(
            "doc_id",
            "lang",
            "source",
            F.length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
            F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
            lines.alias("lines"),
            F.transform(words, lambda w: F.xxhash64(w)).alias("h"),
        )
        .select(
            "doc_id",
            "lang",
            "source",
            F.size("h").cast("bigint").alias("n_words"),
            "word_chars",
            "n_symbols",
            F.size("lines").cast("bigint").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
            pairs(four, F.slice("h", 5, n)).alias("g"),
        )
        .select(*kept, "g", (F.size("g") > F.size(F.array_distinct("g"))).alias("twice"))
        .select(*kept, F.when(F.col("twice"), _duplicated(F.col("g"))).alias("at"))
        .select(*kept, F.coalesce(_covered(F.col("at")), F.lit(0)).cast("bigint").alias("n_repeat_words"))
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _ratios() -> dict[str, Column]:
    """The metrics in whole thousandths, of rows with words."""

    def per_mille(a: str, b: str) -> Column:
        return F.expr(f"1000 * {a} div {b}")

    return {
        "mean_word": per_mille("word_chars", "n_words"),
        "symbols": per_mille("n_symbols", "n_words"),
        "dup_lines": per_mille("n_dup_lines", "n_lines"),
        "repeats": per_mille("n_repeat_words", "n_words"),
    }


def bucket(value: Column) -> Column:
    """Lower end of the sketch bucket of a value of 0 or more."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(metrics: DataFrame) -> DataFrame:
    """``(lang, source, metric, value, c)``: documents per sketch bucket of rows that pass the base rule."""
    entries = F.array(*[F.struct(F.lit(k).alias("metric"), bucket(v).alias("value")) for k, v in _ratios().items()])
    return (
        metrics.filter(~base_failed())
        .select("lang", "source", F.inline(entries))
        .groupBy("lang", "source", "metric", "value")
        .agg(F.count(F.lit(1)).alias("c"))
    )


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups: counts added up."""
    return sketch.groupBy(*keys, "metric", "value").agg(F.sum("c").alias("c"))


def limits(sketch: DataFrame, *keys: str) -> DataFrame:
    """``(keys, n, low_<metric>, high_<metric>)`` of every group of a sketch."""
    upto = Window.partitionBy(*keys, "metric").orderBy("value")
    every = Window.partitionBy(*keys, "metric")
    ranked = sketch.withColumn("upto", F.sum("c").over(upto)).withColumn("n", F.sum("c").over(every))
    quartiles = ranked.groupBy(*keys, "metric").agg(
        F.max("n").alias("n"),
        F.min(F.when(4 * F.col("upto") >= F.col("n"), F.col("value"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("n"), F.col("value"))).alias("q3"),
    )
    spread = FENCE * (F.col("q3") - F.col("q1"))

    def one(metric: str, width: int, low: bool) -> list[Column]:
        here, out = F.col("metric") == metric, F.greatest(spread, F.lit(width))
        ends = [F.max(F.when(here, F.col("q3") + out)).alias(f"high_{metric}")]
        return ends + ([F.max(F.when(here, F.col("q1") - out)).alias(f"low_{metric}")] if low else [])

    columns = [c for metric, (width, low) in METRICS.items() for c in one(metric, width, low)]
    return quartiles.groupBy(*keys).agg(F.max("n").alias("n"), *columns)


def adaptive_limits(sketch: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The limits of every ``(lang, source)`` of the sketch: its own, its language's or all documents'."""
    own = limits(sketch, "lang", "source")
    by_lang = limits(merged(sketch, "lang"), "lang")
    names = [c for c in own.columns if c not in ("lang", "source", "n")]
    total = limits(merged(sketch)).first()  # one row of numbers
    lang = by_lang.select(*[F.col(c).alias(f"lang_{c}") for c in by_lang.columns])
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("lang_lang")))

    def chosen(source: Column, by_lang: Column, of_all: Column) -> Column:
        enough = F.when(F.col("n") >= least_docs, source).when(F.col("lang_n") >= least_docs, by_lang)
        return enough.otherwise(of_all)

    return joined.select(
        "lang",
        "source",
        chosen(F.lit("source"), F.lit("lang"), F.lit("all")).alias("limits_of"),
        *[
            chosen(F.col(c), F.col(f"lang_{c}"), F.lit(None if total is None else total[c]).cast("bigint")).alias(c)
            for c in names
        ],
    )


def _with_limits(metrics: DataFrame, table: DataFrame) -> DataFrame:
    """Every row with the limits of its language and source (null where there are none)."""
    spark = metrics.sparkSession
    keyed = table.withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    if fits_broadcast(spark, table.count(), 256):
        return metrics.join(F.broadcast(keyed), same, "left").drop("t_lang", "t_source")
    salted = keyed.withColumn("t_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = metrics.withColumn("m_salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, same & (F.col("m_salt") == F.col("t_salt")), "left").drop(
        "t_lang", "t_source", "t_salt", "m_salt"
    )


def judge(documents: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, limits_of)`` of every row.

    A row is kept if it passes the base rule and all its metrics lie within
    the limits of its language and source.  Null languages and sources are
    groups of their own; rows of repeated or null ids are judged one by one;
    a value equal to a limit passes; an empty table gives no rows; other
    columns are ignored.  Only numbers are stored and joined, never texts.
    """
    metrics = stored(word_rules(documents), "rules-metrics")
    table = stored(adaptive_limits(stored(sketches(metrics), "rules-sketch"), least_docs), "rules-limits")
    inside = F.lit(True)
    for metric, value in _ratios().items():
        inside &= value <= F.col(f"high_{metric}")
        if METRICS[metric][1]:
            inside &= value >= F.col(f"low_{metric}")
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = base_failed()
    return _with_limits(metrics, table).select(
        *counts,
        failed.alias("base_failed"),
        F.when(failed, F.lit(False)).otherwise(F.coalesce(inside, F.lit(False))).alias("kept"),
        "limits_of",
    )


def oracle() -> str:
    """DuckDB SQL for :func:`judge` without ``limits_of``."""

    def at(level: str, keys: str) -> str:
        group = f"{keys}, metric" if keys else "metric"
        select = f"{keys}, " if keys else ""
        fold = f"SELECT {select}metric, value, sum(c) AS c FROM sketch GROUP BY {group}, value"
        return f"""{level} AS (
  SELECT {group}, max(n) AS n, min(value) FILTER (4 * upto >= n) AS q1, min(value) FILTER (4 * upto >= 3 * n) AS q3
  FROM (SELECT *, sum(c) OVER (PARTITION BY {group} ORDER BY value) AS upto, sum(c) OVER (PARTITION BY {group}) AS n
        FROM ({fold})) GROUP BY {group})"""

    widths = " ".join(f"WHEN '{m}' THEN {w}" for m, (w, _) in METRICS.items())
    lows = ", ".join(f"'{m}'" for m, (_, low) in METRICS.items() if low)
    return f"""
WITH docs AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, row_number() OVER () AS row FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT row, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM split, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)
), twice AS (
  SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, g) > 1
), covered AS (
  SELECT row, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS c
  FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS nxt FROM twice) GROUP BY row
), metrics AS (
  SELECT s.*, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
    coalesce(c, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered USING (row)
), failed AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM metrics
), ratios AS (
  SELECT row, lang, source, unnest(['mean_word', 'symbols', 'dup_lines', 'repeats']) AS metric,
    unnest([1000 * word_chars // n_words, 1000 * n_symbols // n_words, 1000 * n_dup_lines // n_lines,
            1000 * n_repeat_words // n_words]) AS value
  FROM failed WHERE NOT base_failed
), sketch AS (
  SELECT lang, source, metric, (value >> greatest(length(bin(value)) - 6, 0)::BIGINT)
      << greatest(length(bin(value)) - 6, 0)::BIGINT AS value, count(*) AS c
  FROM ratios GROUP BY ALL
), {at("of_source", "lang, source")}, {at("of_lang", "lang")}, {at("of_all", "")},
chosen AS (
  SELECT s.lang, s.source, s.metric,
    CASE WHEN s.n >= {LEAST_DOCS} THEN s.q1 WHEN l.n >= {LEAST_DOCS} THEN l.q1 ELSE a.q1 END AS q1,
    CASE WHEN s.n >= {LEAST_DOCS} THEN s.q3 WHEN l.n >= {LEAST_DOCS} THEN l.q3 ELSE a.q3 END AS q3,
    CASE s.metric {widths} END AS width
  FROM of_source s JOIN of_lang l ON l.lang IS NOT DISTINCT FROM s.lang AND l.metric = s.metric
    JOIN of_all a ON a.metric = s.metric
), inside AS (
  SELECT row, bool_and(value <= q3 + greatest({FENCE} * (q3 - q1), width)
      AND (r.metric NOT IN ({lows}) OR value >= q1 - greatest({FENCE} * (q3 - q1), width))) AS ok
  FROM ratios r JOIN chosen c ON c.lang IS NOT DISTINCT FROM r.lang AND c.source IS NOT DISTINCT FROM r.source
    AND c.metric = r.metric
  GROUP BY row
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(ok, false) AS kept
FROM failed LEFT JOIN inside USING (row)
"""
