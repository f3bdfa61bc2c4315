import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from reportwide.operators import flatten as FL
from reportwide.operators.combine import compact, read_chunks, union_by_name

SCHEDULE = ('{"dates": [{"date": "2024-01-01", "games": [{"id": 1, "linescore": {"periods": '
            '[{"n": 1, "g": 0}, {"n": 2, "g": 1}]}}, {"id": 2, "linescore": {"periods": '
            '[{"n": 1, "g": 2}]}}]}, {"date": "2024-01-02", "games": []}]}')
SCHEMA = ("dates array<struct<date: string, games: array<struct<id: bigint, linescore: "
          "struct<periods: array<struct<n: int, g: int>>>>>>>")


def test_explode_flatten_widen(spark):
    doc = FL.parse_json(spark.createDataFrame([(SCHEDULE,)], "body string"), "body", SCHEMA)
    games = FL.explode_path(doc.select("doc.*"), ["dates", "games"])
    assert sorted(r["id"] for r in games.collect()) == [1, 2]
    flat = FL.flatten_struct(games)
    assert flat.columns == ["id", "linescore.periods"]
    wide = FL.widen_array(flat, "linescore.periods", ["n", "g"], 2)
    assert wide.columns == ["id", "0.n", "0.g", "1.n", "1.g"]
    got = sorted(tuple(r) for r in wide.collect())
    assert got == [(1, 1, 0, 2, 1), (2, 1, 2, None, None)]


def test_widen_rows_pivot(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "p int, pos int, v string")
    out = FL.widen_rows(df, ["p"], "pos", ["v"], 3, sep="_")
    assert out.columns == ["p", "0_v", "1_v", "2_v"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "b", None), (2, "c", None, None)]


def test_drop_last_element_and_rows(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), ([7],)], "a array<int>")
    assert [r[0] for r in df.select(FL.drop_last_element("a")).collect()] == [[1, 2], [], []]
    rows = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 2, "y"), (2, 5, "z"), (3, 1, "q"),
                                  (3, 1, "q")], "p int, n int, v string")
    got = sorted(tuple(r) for r in FL.drop_last_rows(rows, ["p"], ["n"]).collect())
    assert got == [(1, 1, "x"), (1, 2, "y"), (3, 1, "q")]


def test_parse_json_flags_corrupt(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": 1',), (None,)], "t string")
    out = FL.parse_json(df, "t", "k int", corrupt="bad").select("doc.k", "bad").collect()
    assert [tuple(r) for r in out] == [(1, False), (None, True), (None, False)]


def test_union_widens_and_fills(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v bigint")
    b = spark.createDataFrame([(2, 2.5, "x")], "k int, v double, s string")
    out = union_by_name([a, b])
    assert dict(out.dtypes) == {"k": "int", "v": "double", "s": "string"}
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2.0, None), (2, 2.5, "x")]


def test_union_refuses_case_clash(spark):
    a = spark.createDataFrame([(1,)], "goals int")
    b = spark.createDataFrame([(1,)], "Goals int")
    with pytest.raises(ValueError):
        union_by_name([a, b])


def test_read_chunks_with_null_typed_and_conflicting_types(spark, tmp_dir):
    src = os.path.join(tmp_dir, "chunks")
    os.makedirs(src)
    pq.write_table(pa.table({"k": [1, 2], "v": pa.array([None, None], pa.null()),
                             "w": pa.array([1, 2], pa.int64())}), f"{src}/a.parquet.gzip",
                   compression="gzip")
    pq.write_table(pa.table({"k": [3], "v": ["text"], "w": pa.array([1.5])}),
                   f"{src}/b.parquet.gzip", compression="gzip")
    df = read_chunks(spark, src)
    assert dict(df.dtypes) == {"k": "bigint", "v": "string", "w": "double"}
    assert sorted(tuple(r) for r in df.collect()) == [(1, None, 1.0), (2, None, 2.0), (3, "text", 1.5)]
    assert compact(spark, src, os.path.join(tmp_dir, "out")) is True
    assert spark.read.parquet(os.path.join(tmp_dir, "out")).count() == 3


def test_compact_empty_folder_writes_nothing(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "empty"))
    assert compact(spark, os.path.join(tmp_dir, "empty"), os.path.join(tmp_dir, "o")) is False
    assert not os.path.exists(os.path.join(tmp_dir, "o"))


def test_render_json_roundtrip(spark):
    df = spark.createDataFrame([(1, "a")], "k int, s string")
    assert FL.render_json(df).select("json").first()[0] == '{"k":1,"s":"a"}'
    assert FL.parse_json(FL.render_json(df), "json", "k int, s string").select(
        F.col("doc.s")).first()[0] == "a"


def test_null_typed_chunk_meets_array_chunk(spark, tmp_dir):
    src = os.path.join(tmp_dir, "arr")
    os.makedirs(src)
    pq.write_table(pa.table({"k": [1], "v": pa.array([None], pa.null())}), f"{src}/a.parquet")
    pq.write_table(pa.table({"k": [2], "v": pa.array([[1, 2]], pa.list_(pa.int64()))}),
                   f"{src}/b.parquet")
    df = read_chunks(spark, src)
    assert dict(df.dtypes) == {"k": "bigint", "v": "array<bigint>"}
    assert sorted((r["k"], r["v"]) for r in df.collect()) == [(1, None), (2, [1, 2])]
