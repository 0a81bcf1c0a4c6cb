"""Run a registered query in Spark and its SQL oracle in DuckDB, and compare.

Mirrors the driver's correctness gate: same row count, same column names,
and the same multiset of rows (order-insensitive).  Usable from pytest and as
a script: ``python tests/oracle_compare.py /root/testdata/sf0.01 [names...]``.
"""

from __future__ import annotations

import math
import sys
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return round(value, 9)
    return value


def _rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    from pointtally.plans import ORACLE, QUERIES

    sdf = QUERIES[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark {s_cols} vs duckdb {d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark {len(s_rows)} vs duckdb {len(d_rows)}"
    a, b = _rows(s_rows, s_cols), _rows(d_rows, d_cols)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s_rows)} rows match"


def main(argv: list[str]) -> int:
    import time

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    from pointtally.plans import ORACLE

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(ORACLE)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf_dir)
    bad = 0
    for name in names:
        t = time.time()
        try:
            ok, msg = compare(spark, con, name, sf_dir)
        except Exception as exc:  # report and continue
            ok, msg = False, f"{type(exc).__name__}: {str(exc)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.2f}s  {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
