import re

import pytest

from reportwide.operators.wide import join_left, new_columns, wide_join
from reportwide.session import settings


def test_new_columns_sorted_capitals_first():
    assert new_columns(["k", "b", "Z", "a", "x"], ["k", "x"], ["k"]) == ["Z", "a", "b"]


def test_join_left_anchor_wins_and_right_only_keys_drop(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, s string, v int")
    right = spark.createDataFrame([(1, 99, 5), (3, 98, 6)], "k int, v int, w int")
    out = join_left(left, right, ["k"])
    assert out.columns == ["k", "s", "v", "w"]
    assert sorted(map(tuple, out.collect())) == [(1, "a", 10, 5), (2, "b", 20, None)]


def test_duplicate_right_keys_repeat_left_rows(spark):
    left = spark.createDataFrame([(1, 1)], "k int, a int")
    right = spark.createDataFrame([(1, 7), (1, 8)], "k int, b int")
    assert sorted(map(tuple, join_left(left, right, ["k"]).collect())) == [(1, 1, 7), (1, 1, 8)]


def test_null_safe_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1), (2, 2)], "k int, a int")
    right = spark.createDataFrame([(None, 5), (2, 6)], "k int, b int")
    plain = sorted(map(tuple, join_left(left, right, ["k"]).collect()), key=str)
    safe = sorted(map(tuple, join_left(left, right, ["k"], null_safe=True).collect()), key=str)
    assert (None, 1, None) in plain
    assert (None, 1, 5) in safe and (2, 2, 6) in safe
    assert join_left(left, right, ["k"], null_safe=True).columns == ["k", "a", "b"]


def test_case_clash_is_refused(spark):
    left = spark.createDataFrame([(1, 1)], "k int, goals int")
    right = spark.createDataFrame([(1, 2)], "k int, Goals int")
    with pytest.raises(ValueError, match="differ only by case"):
        join_left(left, right, ["k"])


def test_wide_join_keeps_anchor_rows_and_plans_one_exchange_per_table(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        base = spark.range(100).selectExpr("id % 10 AS g", "id AS k", "id * 2 AS v")
        tables = [base.groupBy("k").agg({"v": "max"}).withColumnRenamed("max(v)", f"c{i}")
                  for i in range(4)]
        anchor = spark.range(100).selectExpr("id AS k", "id AS a")
        wide = wide_join([anchor] + tables, ["k"])
        assert wide.count() == 100
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 5  # anchor + 4 reports, none between joins
        assert wide.columns == ["k", "a", "c0", "c1", "c2", "c3"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_unique_right_lets_catalyst_drop_unused_joins(spark):
    anchor = spark.range(50).selectExpr("id AS k", "id AS a")
    reps = [spark.range(50).selectExpr("id AS k", f"id * {i} AS c{i}") for i in range(1, 6)]
    wide = wide_join([anchor] + reps, ["k"], unique_right=True, hot_share=None)
    plan = wide.select("k", "a", "c3")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    plain = wide_join([anchor] + reps, ["k"], hot_share=None).select("k", "a", "c3")
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("Join") == 5
    # with a hot key salted, the unused report joins are still removed
    hot = anchor.union(spark.range(100).selectExpr("7 AS k", "id AS a"))
    salted = wide_join([hot] + reps, ["k"], unique_right=True).select("k", "a", "c3")
    splan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"__salt#\d+ = __salt#", splan)) == 1
    assert salted.filter("k = 7").count() == 101 and salted.filter("c3 = 21").count() == 101
    assert sorted(map(tuple, wide.select("k", "c3").collect())) == [(i, 3 * i) for i in range(50)]


def test_bucketed_tables_join_without_exchange(spark, tmp_dir):
    from reportwide.sources.sinks import write_bucketed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for i in range(3):
            df = spark.range(200).selectExpr("id AS k", f"id + {i} AS c{i}")
            write_bucketed(df, f"bkt_{i}", ["k"], 4, path=f"{tmp_dir}/bkt_{i}")
        tables = [spark.table(f"bkt_{i}") for i in range(3)]
        wide = wide_join(tables, ["k"], hot_share=None)
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert wide.count() == 200
        # without a hot key the default (hot-key check on) plans the same exchange-free chain
        checked = wide_join(tables, ["k"])
        assert "Exchange" not in checked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for i in range(3):
            spark.sql(f"DROP TABLE IF EXISTS bkt_{i}")


def test_merge_strategy_equals_chain_on_keyed_tables(spark):
    anchor = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (None, "n", 0.0)],
                                   "k int, s string, x double")
    r1 = spark.createDataFrame([(1, 10, "p"), (3, 30, "q"), (9, 90, "z"), (None, 5, "n")],
                               "k int, y int, s string")
    r2 = spark.createDataFrame([(2, [1, 2]), (3, None)], "k int, arr array<int>")
    chain = wide_join([anchor, r1, r2], ["k"])
    merge = wide_join([anchor, r1, r2], ["k"], strategy="merge")
    assert chain.columns == merge.columns == ["k", "s", "x", "y", "arr"]
    key = lambda r: str(tuple(r))
    assert sorted(map(key, chain.collect())) == sorted(map(key, merge.collect()))


def test_merge_strategy_refuses_repeated_keys(spark):
    anchor = spark.createDataFrame([(1, 1)], "k int, a int")
    dup = spark.createDataFrame([(1, 7), (1, 8)], "k int, b int")
    with pytest.raises(Exception, match="more than once"):
        wide_join([anchor, dup], ["k"], strategy="merge").collect()


def test_long_chain_is_cut_into_stages(spark):
    anchor = spark.range(300).selectExpr("id AS k")
    reps = [spark.range(300).selectExpr("id AS k", f"id * {i} AS c{i}").groupBy("k").agg(
        {f"c{i}": "max"}).withColumnRenamed(f"max(c{i})", f"c{i}") for i in range(18)]
    wide = wide_join([anchor] + reps, ["k"], joins_per_stage=8)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") <= 8
    assert wide.count() == 300
    assert wide.filter("c17 = k * 17").count() == 300


def test_long_chain_packs_columns_and_gives_the_plain_rows(spark):
    anchor = spark.createDataFrame([(1, 5), (2, None), (None, 7), (1, 6)], "k int, a int")
    reps = [spark.createDataFrame([(i % 3, i, None), (None, i, "n"), (1, 9, "x")], f"k int, c{i} int, `d.{i}` string")
            for i in range(9)] + [spark.createDataFrame([(1, 3)], "k int, a int")]
    for null_safe in (False, True):
        wide = wide_join([anchor, *reps], ["k"], null_safe=null_safe, hot_share=None)
        plain = anchor
        for r in reps:
            plain = join_left(plain, r, ["k"], null_safe)
        assert wide.columns == plain.columns and wide.schema.simpleString() == plain.schema.simpleString()
        assert wide.exceptAll(plain).isEmpty() and plain.exceptAll(wide).isEmpty()
    assert "struct(c0" in wide_join([anchor, *reps], ["k"], hot_share=None, joins_per_stage=0)._jdf.queryExecution().optimizedPlan().toString()


def test_long_report_sets_join_on_a_sorted_source_without_checkpoint(spark, monkeypatch):
    from reportwide.plans import reports as R
    from reportwide.plans.reports import LINEITEM_REPORTS_21 as RS
    src = spark.range(300).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE id % 40 END AS l_partkey", "id % 7 AS l_suppkey",
        "CAST(id % 7 + 1 AS INT) AS l_linenumber", "CAST(id AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice",
        "0.5D AS l_discount", "array('A', 'N', 'R')[id % 3] AS l_returnflag", "array('F', 'O')[id % 2] AS l_linestatus",
        "timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, CAST(id * 8 AS INT)) AS l_shipdate")
    plain = wide_join([R.build_report(src, RS, r) for r in RS.reports], RS.key_names, hot_share=None)
    want = plain.collect()
    monkeypatch.setattr(type(src), "checkpoint", lambda *a, **k: pytest.fail("the running table was checkpointed"))
    plans = []
    real = R.wide_join
    monkeypatch.setattr(R, "wide_join", lambda *a, **k: (lambda d: plans.append(
        d._jdf.queryExecution().executedPlan().toString()) or d)(real(*a, **k)))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        got = R.build_wide(src, RS)
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want))
    assert plans[0].count("SortMergeJoin") == 20
    assert not any(x in plans[0] for x in ("Exchange", "Sort [", "HashAggregate"))
    assert spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering") == "false"
