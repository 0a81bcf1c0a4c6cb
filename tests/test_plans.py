"""Physical-plan properties that matter at scale, checked on the executed plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from pointtally import operators as O
from pointtally.operators import centers as C
from pointtally.operators import pairs as P
from pointtally.plans import tables as T
from pointtally.sources import document_tokens, scan_point_tokens

from conftest import SF

D = f"{SF}/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_class_count_prunes_columns_and_combines_map_side(spark):
    p = plan(O.class_count(T.labelled_pairs(spark, D)))
    assert "ReadSchema: struct<event_type:string>" in p
    assert p.index("partial_count") > p.index("Exchange hashpartitioning")  # partial below the exchange


def test_word_count_reads_only_text_and_aggregates_partially(spark):
    p = plan(O.word_count(T.tokens(spark, D)))
    assert "ReadSchema: struct<text:string>" in p
    assert "partial_count" in p


def test_pair_kernel_shuffles_blocks_and_never_broadcasts(spark):
    p = plan(O.pair_summary(T.points(spark, D), 500, 64))
    assert "MapInArrow" in p and "Broadcast" not in p and "rangepartitioning" not in p


def test_pair_partitions_are_bounded(spark):
    slots = spark.sparkContext.defaultParallelism
    for n in (10**6, 10**8):
        nb = P.kernel_blocks(spark, n, 64)
        assert nb <= -(-n * 8 * 64 // P.KERNEL_BLOCK_BYTES) + 1
        pairs = O.pair_groups(T.points(spark, D), n, 64)
        assert pairs.rdd.getNumPartitions() <= P.PARTITIONS_PER_SLOT * slots
    assert P.block_rows(10**6) * 8 * 10**6 <= P.KERNEL_BLOCK_BYTES


def test_hit_block_pairs_are_joined_before_copies_are_made(spark):
    hit = spark.createDataFrame([(0, 1, 0), (2, 2, 1)], "ki bigint, kj bigint, slot bigint")
    placed = P.hashed_blocks(T.points(spark, D), 4)
    p = plan(P.chosen_pairs(placed, hit, 2))
    assert "sequence" not in p  # no copy to every other block
    rows = P.chosen_pairs(placed, hit, 2).groupBy("ki", "kj").count().collect()
    sizes = {r["b"]: r["count"] for r in placed.groupBy("b").count().collect()}
    assert {(r["ki"], r["kj"]): r["count"] for r in rows} == {(0, 1): sizes[0] + sizes[1], (2, 2): sizes[2]}


def test_first_center_job_does_not_sort_the_points(spark):
    p = plan(C._firsts(C._state_base(T.points(spark, D), F.col("id") % 4), 42))
    below_map = p[p.index("MapInArrow") :]
    assert "Sort" not in below_map


def test_rounds_do_not_sort_the_points(spark):
    base = C._state_base(T.points(spark, D), F.col("id") % 4).cache()
    center = C._packed([(0, 1, [0.0] * 64), (1, 2, [1.0] * 64)], 0, 64)
    for pending in ([center], []):
        p = plan(C._farthest(base, pending, 64))
        below_map = p[p.index("MapInArrow") :]
        assert "InMemoryTableScan" in below_map and "Sort" not in below_map
        # winners carry their vector: the points are scanned once in a round
        assert p.count("InMemoryTableScan") == 1 and "array<double>" in str(C._farthest(base, pending, 64).schema.simpleString())
    base.unpersist()


def test_document_count_does_not_shuffle_texts(spark):
    p = plan(O.text_document_count(T.table(spark, D, "documents")))
    assert "RoundRobin" not in p and p.count("Exchange") == 1


def test_sizes_with_units(spark):
    from pointtally.runtime import parse_bytes

    assert [parse_bytes(x) for x in ("100", "100b", "100MB", "1g", "-1", "2KiB")] == [
        100, 100, 100 << 20, 1 << 30, -1, 2048,
    ]


def test_partitioned_word_count_stays_in_the_jvm(spark):
    tokens = T.dealt_tokens(spark, D, 8)
    p = plan(O.word_count_partitioned(tokens))
    assert "MapInArrow" not in p and "partial_count" in p
    assert p.count("Exchange hashpartitioning") == 1  # the other exchange deals documents, before they are split
    assert p.rindex("Exchange") > p.rindex("Generate")


def test_salt_is_made_before_lines_are_split(spark):
    p = plan(O.word_count_salted(document_tokens(O.with_salt(T.lines(spark, D), 8)), 8))
    below = p[p.rindex("Generate explode(") :]
    assert "xxhash64" in below and "xxhash64" not in p[: p.rindex("Generate explode(")]


def test_point_positions_take_two_scans(spark, monkeypatch):
    from pointtally.functions import ranges as R

    scans = []
    collect = R._step_totals
    monkeypatch.setattr(R, "_step_totals", lambda *a: scans.append(1) or collect(*a))
    p = plan(scan_point_tokens(T.part_point_text(spark, D), order_by="p_partkey"))
    assert len(scans) == 1 and p.count("FileScan") == 1


def test_a_group_of_half_the_points_fills_no_task(spark, monkeypatch):
    monkeypatch.setattr(C, "SALT_ROWS", 500)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    points = spark.range(20_000).select("id", F.array(F.col("id").cast("double"), F.lit(0.0)).alias("v"))
    part = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 1000)
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for budget in ("10m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", budget)
            base = C._state_base(points, part)
            firsts = C._firsts(base, 42)
            state, salts = C._salted(base, firsts, 10_000)
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            joined = C._with_newest(state, firsts.select("part", "id", "v"), salts)
            sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
            assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 8, sizes
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
