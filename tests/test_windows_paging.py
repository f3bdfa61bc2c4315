import datetime as dt
import random

from pyspark.sql import functions as F

from reportwide.operators import paging as PG
from reportwide.operators.windows import assign_windows, fill_template, request_plan


def test_assign_windows_overlap_and_gaps(spark):
    rows = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=13 * i)) for i in range(200)],
        "id int, t timestamp_ntz")
    wins = [(0, dt.date(2024, 1, 1), dt.date(2024, 1, 10)),
            (1, dt.date(2024, 1, 10), dt.date(2024, 2, 3)),   # overlaps window 0 on Jan 10
            (2, dt.date(2024, 2, 20), dt.date(2024, 3, 31)),  # leaves a gap before it
            (3, dt.date(2024, 3, 5), dt.date(2024, 3, 1))]    # ends before it starts
    w = spark.createDataFrame(wins, "w int, win_start date, win_end date")
    got = sorted((r["id"], r["w"]) for r in assign_windows(rows, "t", w).collect())
    exp = []
    for i in range(200):
        t = dt.datetime(2024, 1, 1) + dt.timedelta(hours=13 * i)
        for k, s, e in wins:
            if dt.datetime.combine(s, dt.time()) <= t < dt.datetime.combine(e + dt.timedelta(1), dt.time()):
                exp.append((i, k))
    assert got == sorted(exp)


def test_request_plan_counts(spark):
    w = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
                               (dt.date(2024, 2, 1), dt.date(2024, 2, 29))],
                              "win_start date, win_end date")
    plan = request_plan(w, ["a", "b"], "u/{0}?start={1}&from={2}&to={3}")
    assert plan.count() == 2 * (81 + 76)
    r = plan.filter("report = 'b' AND page_start = 100 AND win_end = DATE'2024-02-29'").first()
    assert r["url"] == "u/b?start=100&from=2024-02-01&to=2024-02-29"


def test_fill_template_keeps_percent(spark):
    r = spark.range(1).select(fill_template("a%20{1}-{0}", F.lit("x"), F.lit("y")).alias("u")).first()
    assert r["u"] == "a%20y-x"


def test_global_row_number_matches_sort(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 20), i) for i in range(1000)]
    df = spark.createDataFrame(data, "a int, b int").repartition(7)
    got = [(r["a"], r["b"], r["rn"]) for r in
           PG.global_row_number(df, [F.col("a").desc(), F.col("b")], "rn").collect()]
    exp = sorted(data, key=lambda t: (-t[0], t[1]))
    assert sorted(got, key=lambda t: t[2]) == [(a, b, i + 1) for i, (a, b) in enumerate(exp)]


def test_page_both_paths_agree(spark, monkeypatch):
    df = spark.range(1000).selectExpr("id", "id % 13 AS g")
    order = PG.with_tie_breakers([F.col("g")], ["id"])
    small = [tuple(r) for r in PG.page(df, order, 230, 50).collect()]
    monkeypatch.setattr(PG, "TOP_K_LIMIT", 10)
    ranked = [tuple(r) for r in PG.page(df, order, 230, 50).collect()]
    exp = sorted(((i, i % 13) for i in range(1000)), key=lambda t: (t[1], t[0]))[230:280]
    assert small == exp
    assert sorted(ranked) == sorted(exp)


def test_paginate_and_page_sizes(spark):
    df = spark.range(250).selectExpr("id")
    paged = PG.paginate(df, [F.col("id")], 100)
    sizes = {r["page"]: (r["n_rows"], r["first_id"], r["is_last"])
             for r in PG.page_sizes(paged, 100, "id").collect()}
    assert sizes == {0: (100, 0, False), 1: (100, 100, False), 2: (50, 200, True)}


def test_sort_columns_case_insensitive(spark):
    df = spark.createDataFrame([("b", 1), ("A", 2), ("a", 3), ("B", 4)], "s string, k int")
    order = PG.sort_columns([{"property": "s", "direction": "ASC_CI"},
                             {"property": "k", "direction": "DESC"}])
    assert [r["k"] for r in df.orderBy(*order).collect()] == [3, 2, 4, 1]
