"""Hot keys (a third of all rows on one key) and plan hygiene of every registered query."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from reportwide.operators import flatten as FL
from reportwide.operators import paging as PG
from reportwide.operators.clean import dedup_ignoring_keys
from reportwide.operators.windows import assign_windows
from reportwide.operators.wide import wide_join

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    # key 0 holds a third of the rows
    return spark.range(N).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k",
        "CASE WHEN id % 3 = 0 THEN 1.0 ELSE CAST(id AS DOUBLE) END AS v")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_hot_group_combines_before_shuffle(hot):
    out = dedup_ignoring_keys(hot.select("id", "v"), ["id"])
    assert out.count() == hot.select("v").distinct().count()
    plan = _plan(out)
    assert "partial_min" in plan and plan.index("partial_min") > plan.index("Exchange")


def test_drop_last_hot_parent(hot):
    out = FL.drop_last_rows(hot.select("k", "id"), ["k"], ["id"])
    assert out.count() == N - hot.select("k").distinct().count()
    # key 0 holds ids 0, 3, ..., N - 3; the last one (N - 3) is removed
    assert out.filter("k = 0").agg(F.max("id")).first()[0] == N - 6
    assert "Window" not in _plan(out)


def test_widen_rows_hot_parent(hot):
    # One child at each position: two are an error.
    df = hot.selectExpr("k", "id % 4 AS pos", "id AS x").groupBy("k", "pos").agg(F.max("x").alias("x"))
    out = FL.widen_rows(df, ["k"], "pos", ["x"], 4)
    assert out.count() == hot.select("k").distinct().count()
    assert "partial_first" in _plan(out)


def test_global_row_number_hot_sort_key(hot):
    out = PG.global_row_number(hot, [F.col("k"), F.col("id")], "rn")
    got = out.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
    assert tuple(got) == (1, N, N)
    assert out.filter("k = 0").agg(F.max("rn")).first()[0] == N // 3


def test_assign_windows_hot_bucket(spark, hot):
    rows = hot.selectExpr("id", "CASE WHEN k = 0 THEN TIMESTAMP_NTZ'2024-01-15 00:00:00' "
                          "ELSE TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) END AS t")
    w = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 31))], "win_start date, win_end date")
    assert assign_windows(rows, "t", w).count() == N


def test_wide_join_hot_key_is_salted(hot):
    anchor = hot.select("id", "k")
    right = hot.groupBy("k").agg(F.count("*").alias("n"))
    right2 = hot.groupBy("k").agg(F.max("id").alias("m"))
    out = wide_join([anchor, right, right2], ["k"])
    assert out.count() == N
    assert out.filter("k = 0").select("n", "m").distinct().collect() == [(N // 3, N - 3)]
    plan = _plan(out)
    assert "__salt" in plan  # the hot key 0 is spread over salt buckets
    plain = wide_join([anchor, right, right2], ["k"], hot_share=None)
    key = lambda r: (r["id"], r["k"], r["n"], r["m"])
    assert sorted(map(key, out.collect())) == sorted(map(key, plain.collect()))


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_or_nested_loop(spark, name):
    df = E.queries()[name](spark, SF001)
    plan = _plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)


def test_window_filter_is_pushed_to_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = _plan(E.queries()["window_filter"](spark, SF001))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "EqualTo(o_orderstatus,F)" in plan
    assert "LessThan(o_orderdate" in plan
    assert "o_orderpriority" not in plan.split("ReadSchema:")[1].split("\n")[0]
