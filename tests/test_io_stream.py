import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.sources import readers as R
from reportwide.sources import sinks as S
from reportwide.streaming.ingest import ingest_pages, land_pages


def test_format_rule():
    assert R.format_for("x.csv.parquet") == "parquet"
    assert R.format_for("a/b.csv") == "csv"
    assert R.format_for("a/b.json") == "json"
    with pytest.raises(ValueError):
        R.format_for("a/b.txt")


def test_read_by_suffix_csv_and_json_array(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "t.csv"), "w") as f:
        f.write("a,b\n1,x\n2,y\n")
    with open(os.path.join(tmp_dir, "t.json"), "w") as f:
        f.write('[{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]')
    c = R.read_by_suffix(spark, os.path.join(tmp_dir, "t.csv"))
    j = R.read_by_suffix(spark, os.path.join(tmp_dir, "t.json"))
    assert sorted(tuple(r) for r in c.collect()) == [(1, "x"), (2, "y")]
    assert sorted((r["a"], r["b"]) for r in j.collect()) == [(1, "x"), (2, "y")]


def test_discover_by_marker(spark, tmp_dir):
    df = spark.range(5)
    S.write_parquet(df, f"{tmp_dir}/team/a_data.parquet.gzip")
    S.write_parquet(df, f"{tmp_dir}/team/sub/b_data.parquet.gzip")
    df.write.csv(f"{tmp_dir}/team/c.csv")
    found = R.discover(spark, tmp_dir, make_df=True)
    assert sorted(p.rsplit("/", 1)[-1] for p in found) == ["a_data.parquet.gzip", "b_data.parquet.gzip"]
    assert all(d.count() == 5 for d in found.values())


def test_read_pages_quarantines_broken_file(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pages")
    os.makedirs(d)
    with open(f"{d}/p0.json", "w") as f:
        f.write('{"data": [{"id": 1}, {"id": 2}]}\n')
    with open(f"{d}/p1.json", "w") as f:
        f.write('{"data": [{"id": 3}, \n')
    good, bad = R.read_pages(spark, d, "data array<struct<id: bigint>>")
    assert sorted(r["id"] for r in good.select(F.inline("data")).collect()) == [1, 2]
    assert bad.count() == 1 and bad.first()["_file"].endswith("p1.json")


def test_landing_overwrite_and_append(spark, tmp_dir):
    df = spark.range(100).selectExpr("id", "'t' AS rtype", "CAST(id % 3 AS STRING) AS report",
                                     "DATE'2024-01-01' AS window_start")
    S.write_landing(df, f"{tmp_dir}/land")
    S.write_landing(df.filter("report = '1'"), f"{tmp_dir}/land")
    assert spark.read.parquet(f"{tmp_dir}/land").count() == 100
    assert S.append_table(df.filter("id < 0"), f"{tmp_dir}/app") is False
    assert S.append_table(df, f"{tmp_dir}/app") and S.append_table(df, f"{tmp_dir}/app")
    assert spark.read.parquet(f"{tmp_dir}/app").count() == 200


REC = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])


def test_stream_restart_and_dedup(spark, tmp_dir):
    df = spark.range(250).selectExpr("id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS ts")
    land_pages(df, f"{tmp_dir}/in", ["ts", "id"], page_size=100)
    ingest_pages(spark, f"{tmp_dir}/in", REC, f"{tmp_dir}/out", f"{tmp_dir}/ck")
    ingest_pages(spark, f"{tmp_dir}/in", REC, f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 250
    land_pages(df, f"{tmp_dir}/in2", ["ts", "id"], page_size=100, copies=2)
    ingest_pages(spark, f"{tmp_dir}/in2", REC, f"{tmp_dir}/out2", f"{tmp_dir}/ck2",
                 dedup_keys=["id"], event_time="ts", delay="1 day")
    land_pages(df, f"{tmp_dir}/in2", ["ts", "id"], page_size=100)
    ingest_pages(spark, f"{tmp_dir}/in2", REC, f"{tmp_dir}/out2", f"{tmp_dir}/ck2",
                 dedup_keys=["id"], event_time="ts", delay="1 day")
    out = spark.read.parquet(f"{tmp_dir}/out2")
    assert out.count() == 250 and out.select("id").distinct().count() == 250


def test_append_to_catalog_table(spark, tmp_dir):
    df = spark.range(10).selectExpr("id", "id * 2 AS v")
    assert S.append_table(df, path=f"{tmp_dir}/cat_t", table_name="rw_append_t")
    assert S.append_table(df, table_name="rw_append_t")
    assert not S.append_table(df.filter("id < 0"), table_name="rw_append_t")
    try:
        assert spark.table("rw_append_t").count() == 20
    finally:
        spark.sql("DROP TABLE IF EXISTS rw_append_t")
