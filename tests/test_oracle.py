"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate),
and the smoke entry at sf0.001."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from conftest import SF01  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

# The corpus operators (op1_ ... and pipeline) have tests of their own in tests/llm.
QUERIES = {k: v for k, v in E.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES), sorted(set(QUERIES) - set(ORACLES))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF01, QUERIES[name], ORACLES.get(name))
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["user_id", "day"]


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_results_do_not_depend_on_partition_count(spark, con, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for name in ("page", "sort_ci", "drop_last", "window_assign", "wide_join"):
            r = compare(spark, con, name, SF01, QUERIES[name], ORACLES[name])
            assert r["status"] == "ok", (partitions, r)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
