from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("pointtally-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(os.environ.get("TEST_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="pt-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def text_file(tmp_path):
    """Write ``content`` verbatim to a file and return its path."""

    def make(content: str, name: str = "input.txt") -> str:
        path = tmp_path / name
        path.write_text(content, encoding="utf-8")
        return str(path)

    return make


def points_df(spark, coords, ids=None):
    """Inline points ``(id, v)`` from a list of coordinate lists."""
    ids = list(range(len(coords))) if ids is None else ids
    return spark.createDataFrame(
        [(int(i), [float(x) for x in c]) for i, c in zip(ids, coords)], "id bigint, v array<double>"
    )
