"""URL filters: host rules and pattern rules indexed by their rarest literal token.

Host rules ``(verdict, host, path)`` fit their host and all its subdomains when
the URL's path starts with the rule's; the longest rule wins.  A URL that no
host rule fits is judged by the pattern rules: every pattern is filed under one
literal token -- the one that is rarest in the URLs judged, counted over all of
them -- and a URL's tokens fetch the candidate rules; only those run their
regular expression.  Patterns without a complete literal token are filed under
no token and run for every URL.

Pattern syntax: ``*`` any characters, ``^`` a separator or the end, ``||`` at
the start a host or subdomain boundary, ``|`` at an end an anchor; everything
else is literal, matched on the URL with A-Z lower-cased.

The rule lists are parameters that travel with the tasks; they are not data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rules of the registered query, fixed by its contract.
HOST_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

# Default pattern rules: pages that hold no article, and links with a referral tag.
PATTERN_RULES = [
    "/login^",
    "/signup^",
    "/wp-admin/*",
    "/cart^",
    "/checkout^",
    "/tag/*",
    "^sessionid=",
    "^replytocom=",
    "&ref=*",
    "||ads.*",
    "||doubleclick.net^",
    ".zip|",
    ".exe|",
]

MAX_RULE_BYTES = 64 << 20

_TOKEN = re.compile(r"[a-z0-9]+")
_LOWER = {ord(a): ord(b) for a, b in zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}

SCHEMA = "page_id bigint, host string, path string, rule string, verdict string"


def url_parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(_LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def pattern_regex(pattern: str) -> str:
    """The regular expression of a pattern rule."""
    head, tail = "", ""
    body = pattern
    if body.startswith("||"):
        head, body = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?", body[2:]
    elif body.startswith("|"):
        head, body = "^", body[1:]
    if body.endswith("|"):
        tail, body = "$", body[:-1]
    parts = {"*": ".*", "^": r"(?:[^a-z0-9_.%-]|$)"}
    return "(?s)" + head + "".join(parts.get(ch, re.escape(ch)) for ch in body) + tail


def pattern_tokens(pattern: str) -> list[str]:
    """Literal tokens that every URL matching the pattern holds as whole tokens.

    A token counts only when both its ends are fixed by the pattern: by another
    literal character, a separator or an anchor; next to ``*`` or an open end
    the URL's token may be longer.
    """
    body, closed_start, closed_end = pattern, False, False
    if body.startswith("||"):
        body, closed_start = body[2:], True
    elif body.startswith("|"):
        body, closed_start = body[1:], True
    if body.endswith("|"):
        body, closed_end = body[:-1], True
    out = []
    for m in _TOKEN.finditer(body):
        left = body[m.start() - 1] != "*" if m.start() else closed_start
        right = body[m.end()] != "*" if m.end() < len(body) else closed_end
        if left and right:
            out.append(m[0])
    return out


def _count_fn(wanted: frozenset):
    def run(batches):
        import pyarrow as pa

        counts: dict[str, int] = {}
        for batch in batches:
            for url in batch.column(0).to_pylist():
                if url is not None:
                    for t in set(_TOKEN.findall(url.translate(_LOWER))) & wanted:
                        counts[t] = counts.get(t, 0) + 1
        yield pa.RecordBatch.from_pydict(
            {"token": list(counts), "n": list(counts.values())},
            schema=pa.schema([("token", pa.string()), ("n", pa.int64())]),
        )

    return run


def token_counts(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """How many of the URLs hold each of ``tokens`` (at most one row per token returns)."""
    if not tokens:
        return {}
    partial = urls.select("url").mapInArrow(_count_fn(frozenset(tokens)), "token string, n bigint")
    return {r["token"]: r["n"] for r in partial.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def rule_index(patterns: list[str], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """``({rarest token: rule numbers}, rules without a token)``."""
    index: dict[str, list[int]] = {}
    always = []
    for i, p in enumerate(patterns):
        tokens = pattern_tokens(p)
        if tokens:
            index.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
        else:
            always.append(i)
    return index, always


def _judge_fn(host_rules, patterns, index, always):
    def run(batches):
        import pyarrow as pa

        by_host: dict[str, list[tuple[str, str]]] = {}
        for verdict, host, path in host_rules:
            by_host.setdefault(host, []).append((path, verdict))
        regexes = [re.compile(pattern_regex(p)) for p in patterns]
        schema = pa.schema(
            [("page_id", pa.int64())] + [(c, pa.string()) for c in ("host", "path", "rule", "verdict")]
        )

        def host_rule(host, path):
            best = None
            at = 0
            while host:
                suffix = host[at:]
                for rule_path, verdict in by_host.get(suffix, ()):
                    if path.startswith(rule_path):
                        # longest wins; among equals block, then the name
                        key = (-len(suffix) - len(rule_path), verdict != "block", suffix + rule_path)
                        best = min(best, (key, verdict)) if best else (key, verdict)
                at = host.find(".", at) + 1
                if not at:
                    break
            return (best[0][2], best[1]) if best else (None, None)

        def pattern_verdict(url):
            low = (url or "").translate(_LOWER)
            for i in always:
                if regexes[i].search(low):
                    return "block"
            for t in set(_TOKEN.findall(low)):
                for i in index.get(t, ()):
                    if regexes[i].search(low):
                        return "block"
            return "allow"

        for batch in batches:
            rows = []
            for url in batch.column(1).to_pylist():
                host, path = url_parts(url)
                rule, verdict = host_rule(host, path)
                rows.append((host, path, rule, verdict or pattern_verdict(url)))
            cols = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(list(c), pa.string()) for c in cols)], schema=schema
            )

    return run


def filter_urls(
    pages: DataFrame,
    host_rules: list[tuple[str, str, str]] = HOST_RULES,
    patterns: list[str] = PATTERN_RULES,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every row of ``pages``.

    ``pages`` needs ``page_id`` and ``url``; other columns are ignored.  A null
    URL, or one without ``://``, has empty host and path and is judged by the
    patterns as the empty or whole text; repeated rows are judged alike, one
    result row each; an empty table gives no rows; a null ``page_id`` stays.
    Two passes over the URL column, no shuffle of URLs.
    """
    size = sum(len(p) for p in patterns) + sum(len(h) + len(p) for _, h, p in host_rules)
    if size > MAX_RULE_BYTES:
        raise ValueError(f"rules of {size} characters exceed the {MAX_RULE_BYTES} that travel with the tasks")
    urls = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    counts = token_counts(urls, {t for p in patterns for t in pattern_tokens(p)})
    index, always = rule_index(patterns, counts)
    return urls.mapInArrow(_judge_fn(list(host_rules), list(patterns), index, always), SCHEMA)


def oracle(host_rules=HOST_RULES, patterns=PATTERN_RULES) -> str:
    """DuckDB SQL for :func:`filter_urls`: every rule tried on every URL."""

    def quoted(s):
        return "'" + s.replace("'", "''") + "'"

    rules = ", ".join(f"({quoted(v)}, {quoted(h)}, {quoted(p)})" for v, h, p in host_rules)
    blocked = " OR ".join(f"regexp_matches(low, {quoted(pattern_regex(p))})" for p in patterns) or "false"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH u AS (
  SELECT row_number() OVER () AS rn, page_id, coalesce(url, '') AS url,
         translate(coalesce(url, ''), '{upper}', '{lower}') AS low,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM u),
p AS (SELECT rn, page_id, low, translate(raw_host, '{upper}', '{lower}') AS host,
             regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM h),
r(verdict, rhost, rpath) AS (VALUES {rules}),
m AS (
  SELECT rn, rhost || rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY rn ORDER BY length(rhost || rpath) DESC,
                            r.verdict <> 'block', rhost || rpath) AS k
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, m.rule AS rule,
       coalesce(m.verdict, CASE WHEN {blocked} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m ON m.rn = p.rn AND m.k = 1
"""
