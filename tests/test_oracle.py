"""Every registered query against its DuckDB oracle, as the driver checks it."""

from __future__ import annotations

import os

import pytest

from conftest import SF
from oracle_compare import compare, duck_connection

import __spark_entry__ as entry_mod
from pointtally.plans import ORACLE, QUERIES

SF_DIR = f"{SF}/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duck_connection(SF_DIR)
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF_DIR)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["pos", "id"] and len(rows) == 5
