"""Nested types that drift, hot keys of right tables, windows that are broadcast or shuffled."""

import pytest
from pyspark.sql import functions as F

from reportwide.operators.combine import union_by_name
from reportwide.operators.wide import wide_join
from reportwide.operators.windows import assign_windows


def test_structs_merge_by_field(spark):
    a = spark.sql("SELECT 1 AS k, named_struct('x', 16777217, 'y', array(named_struct('p', 1))) AS s")
    b = spark.sql("SELECT 2 AS k, named_struct('z', 'q', 'x', 2.5D, 'y', "
                  "array(named_struct('p', 0.5D, 'r', true))) AS s")
    out = union_by_name([a, b])
    assert dict(out.dtypes)["s"] == "struct<x:double,y:array<struct<p:double,r:boolean>>,z:string>"
    rows = {r["k"]: r["s"].asDict(True) for r in out.collect()}
    assert rows[1] == {"x": 16777217.0, "y": [{"p": 1.0, "r": None}], "z": None}
    assert rows[2] == {"x": 2.5, "y": [{"p": 0.5, "r": True}], "z": "q"}


def test_null_nested_values_stay_null(spark):
    a = spark.createDataFrame([(None, None, None), ((1,), [1, None], {"a": 1})],
                              "s struct<x:int>, xs array<int>, m map<string,int>")
    b = spark.createDataFrame([((1.5, "u"), [2.5], {"b": 0.5})],
                              "s struct<x:double,y:string>, xs array<double>, m map<string,double>")
    rows = [r.asDict(True) for r in union_by_name([a, b]).collect()]
    assert {"s": None, "xs": None, "m": None} in rows
    assert {"s": {"x": 1.0, "y": None}, "xs": [1.0, None], "m": {"a": 1.0}} in rows
    assert {"s": {"x": 1.5, "y": "u"}, "xs": [2.5], "m": {"b": 0.5}} in rows


def test_nested_beside_plain_names_the_column(spark):
    a = spark.sql("SELECT named_struct('x', 1) AS odd")
    with pytest.raises(ValueError, match="odd"):
        union_by_name([a, spark.sql("SELECT 1 AS odd")])


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("anchor_hot", [False, True])
def test_right_hot_key_gives_the_plain_rows(spark, null_safe, anchor_hot):
    ids = 60 if anchor_hot else 4
    anchor = spark.range(ids).selectExpr("id", "CASE id % 4 WHEN 0 THEN NULL ELSE id % 4 END AS k")
    # Key 1 is hot, key 2 is rare, key 3 is absent; null keys are many.
    right = spark.range(300).selectExpr("CASE WHEN id < 100 THEN NULL WHEN id = 299 THEN 2 ELSE 1 END AS k",
                                        "id % 7 AS v")
    other = spark.range(3).selectExpr("id AS k", "id * 10 AS w")
    args = {"null_safe": null_safe}
    out = wide_join([anchor, right, other], ["k"], hot_rows=50, hot_share=0.05 if anchor_hot else 1.0, **args)
    plain = wide_join([anchor, right, other], ["k"], hot_share=None, **args)
    assert out.columns == plain.columns
    assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0
    # the hot rows meet on (key, salt)
    assert "__rsalt" in out._jdf.queryExecution().optimizedPlan().toString()


def test_no_hot_right_key_keeps_the_plain_plan(spark):
    anchor = spark.range(40).selectExpr("id AS k", "id AS a")
    right = spark.range(40).selectExpr("id AS k", "id AS b")
    assert "salt" not in wide_join([anchor, right], ["k"])._jdf.queryExecution().optimizedPlan().toString()


def test_few_windows_leave_the_rows_unshuffled(spark):
    rows = spark.range(400).select("id", F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id))").alias("t"))
    wins = spark.sql("SELECT id AS w, date_add(date'2024-01-01', int(id) * 20) AS win_start, "
                     "date_add(date'2024-01-01', int(id) * 20 + 24) AS win_end FROM range(15)")
    small, large = assign_windows(rows, "t", wins), assign_windows(rows, "t", wins, broadcast_rows=3)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert "hashpartitioning" in large._jdf.queryExecution().executedPlan().toString()
    got, want = ({(r["id"], r["w"]) for r in x.collect()} for x in (small, large))
    assert got == want == {(i, w) for w in range(15) for i in range(w * 20, min(w * 20 + 25, 400))}


def test_small_anchor_copies_no_right_rows(spark):
    # Seven keys hold a seventh of the anchor each, one row: the hot right rows are spread, not copied.
    anchor = spark.range(7).selectExpr("id AS k", "id AS a")
    right = spark.range(700).selectExpr("id % 7 AS k", "id AS v")
    out = wide_join([anchor, right], ["k"], hot_rows=50)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__rsalt" in plan and "__salt" not in plan
    assert sorted(map(tuple, out.collect())) == sorted((i % 7, i % 7, i) for i in range(700))
