"""Inputs on which rows, values or digits were once lost without a word."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.functions.dates import month_windows_until
from reportwide.operators import flatten
from reportwide.operators.census import take_census
from reportwide.operators.combine import compact, union_by_name, widen
from reportwide.operators.keys import column_overlap, schema_catalog
from reportwide.operators.profile import exact_quantiles
from reportwide.sources.readers import discover
from reportwide.sources.sinks import write_landing
from reportwide.streaming.ingest import ingest_pages


def test_drop_last_keeps_children_of_null_parents(spark):
    rows = [(None, 1), (None, 2), (1, 1), (1, 2), (2, None)]
    df = spark.createDataFrame(rows, "p int, o int")
    got = sorted((tuple(r) for r in flatten.drop_last_rows(df, ["p"], ["o"]).collect()), key=str)
    assert got == [(1, 1), (None, 1)]


def test_positions_past_the_end_are_an_error(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 5, "b")], "p int, i int, v string")
    assert flatten.widen_rows(df, ["p"], "i", ["v"], 6).first().asDict()["5.v"] == "b"
    with pytest.raises(Exception, match="outside 0 to 1"):
        flatten.widen_rows(df, ["p"], "i", ["v"], 2).collect()
    arr = spark.createDataFrame([([("a",), ("b",)],)], "xs array<struct<v:string>>")
    assert flatten.widen_array(arr, "xs", ["v"], 2).first().asDict() == {"0.v": "a", "1.v": "b"}
    with pytest.raises(Exception, match="more than 1 elements"):
        flatten.widen_array(arr, "xs", ["v"], 1).collect()


def test_mixed_number_types_keep_their_digits(spark):
    a = spark.createDataFrame([(16777217,)], "v long")
    b = spark.createDataFrame([(0.5,)], "v float")
    out = union_by_name([a, b])
    assert out.schema["v"].dataType == T.DoubleType()
    assert sorted(r["v"] for r in out.collect()) == [0.5, 16777217.0]
    big = Decimal("12345678901234567890")
    c = spark.createDataFrame([(big,)], "v decimal(20,0)")
    d = spark.createDataFrame([(Decimal("0.25"),)], "v decimal(4,2)")
    assert sorted(r["v"] for r in union_by_name([c, d]).collect()) == [Decimal("0.25"), big]
    assert widen(T.DecimalType(4, 2), T.LongType()) == T.DecimalType(21, 2)
    with pytest.raises(ValueError, match="no common decimal"):
        widen(T.DecimalType(38, 0), T.DecimalType(38, 10))


def test_month_windows_have_no_default_limit(spark):
    df = spark.createDataFrame([(dt.date(1990, 1, 31),)], "s date")
    now = F.lit(dt.datetime(2020, 1, 1))
    assert month_windows_until(df, "s", now).count() == 360
    assert month_windows_until(df, "s", now, max_windows=180).count() == 180


def test_back_filled_rows_reach_the_sink(spark, tmp_dir):
    record = T.StructType.fromDDL("id long, at timestamp")
    for i, at in ((1, "2024-05-10"), (9, "2024-04-10")):
        with open(f"{tmp_dir}/page{i}.json", "w") as f:
            f.write(f'{{"page": 1, "data": [{{"id": {i}, "at": "{at}T00:00:00.000Z"}}]}}')
        ingest_pages(spark, f"{tmp_dir}/page*.json", record, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", ["id"], "at")
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == [1, 9]


def test_overlap_reads_no_table(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/t")
    tables = {n: spark.read.parquet(f"{tmp_dir}/t") for n in ("a", "b")}
    out = column_overlap(schema_catalog(spark, tables))
    assert [tuple(r) for r in out.collect()] == [("a", "b", 1, "id")]
    assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()


def test_partition_folders_become_columns(spark, tmp_dir):
    rows = [(1, "team", "a", "2024-01-01"), (2, "team", "b", "2024-02-01")]
    df = spark.createDataFrame(rows, "v int, rtype string, report string, window_start string")
    write_landing(df, f"{tmp_dir}/x.parquet.gzip")
    found, = discover(spark, tmp_dir, make_df=True).values()
    assert compact(spark, f"{tmp_dir}/x.parquet.gzip", f"{tmp_dir}/out")
    for got in (found, spark.read.parquet(f"{tmp_dir}/out")):
        assert sorted(tuple(map(str, r)) for r in got.select(df.columns).collect()) == [
            tuple(map(str, r)) for r in rows]


def test_alternating_schemas_take_one_scan_each(spark, tmp_dir):
    for i in range(8):
        spark.range(i, i + 1).selectExpr(f"cast(id as {('bigint', 'double')[i % 2]}) v").coalesce(1) \
            .write.parquet(f"{tmp_dir}/c/{i}")
    assert len(take_census(spark, f"{tmp_dir}/c").kinds) == 2
    assert compact(spark, f"{tmp_dir}/c", f"{tmp_dir}/out")
    assert sorted(r["v"] for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == list(map(float, range(8)))


def test_bad_pages_are_kept_aside(spark, tmp_dir):
    record = T.StructType.fromDDL("id long")
    pages = ['{"page": 1, "data": [{"id": 1}]}', '{"page": 2, "data": [{"id"', '{"page": 3}', "[]x"]
    os.mkdir(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/p.json", "w") as f:
        f.write("\n".join(pages) + "\n\n")
    for _ in range(2):
        ingest_pages(spark, f"{tmp_dir}/in", record, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    assert [r["id"] for r in spark.read.parquet(f"{tmp_dir}/out").collect()] == [1]
    bad = spark.read.parquet(f"{tmp_dir}/out_quarantine").collect()
    assert sorted(r["value"] for r in bad) == sorted(pages[1:])


@pytest.mark.parametrize("odd", [[float("inf")], [float("-inf")], [float("inf"), float("-inf")] * 40])
def test_quantiles_beside_infinities(spark, odd):
    values = sorted([float(i * i % 997) for i in range(3000)] + odd)
    df = spark.createDataFrame([("c", v) for v in values], "column_name string, v double")
    got = {r["p"]: r["value"] for r in exact_quantiles(df, [0.0, 0.25, 0.5, 1.0], final_rows=100, max_rounds=8).collect()}
    for p, v in got.items():
        at = p * (len(values) - 1)
        a, b = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
        assert v == (a if a == b or at == int(at) else a + (at - int(at)) * (b - a))
