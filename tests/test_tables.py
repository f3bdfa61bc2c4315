"""Footer census, versioned tables, fan-out, found schemas, minimal keys, bucketed and incremental wide
tables, sketched quantiles."""

from __future__ import annotations

import itertools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.operators import profile as P
from reportwide.operators.census import take_census
from reportwide.operators.combine import compact, read_chunks
from reportwide.operators.flatten import widen_rows
from reportwide.operators.found_schema import find_type, normalize, spark_type
from reportwide.operators.keys import column_catalog, minimal_keys
from reportwide.plans.incremental import WideTable
from reportwide.plans.q_wide import join_saved, save_reports
from reportwide.plans.reports import LINEITEM_REPORTS_21
from reportwide.plans.registry import table
from reportwide.session import settings
from reportwide.sources.readers import discover
from reportwide.sources.sinks import READ_SORTED
from reportwide.sources.snapshots import Snapshot, VersionedTable
from reportwide.streaming.fanout import report_tables, send_batch

from conftest import SF001


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def jobs(spark, run):
    """Number of Spark jobs that ``run`` starts."""
    group = f"count-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


# --- footer census

def chunk(path, **columns):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path, compression="gzip")


def test_census_counts_files_and_rows_of_each_schema(spark, tmp_dir):
    for i in range(6):
        chunk(f"{tmp_dir}/in/{i}.parquet", k=pa.array([i, i], pa.int64() if i % 2 else pa.float64()))
    chunk(f"{tmp_dir}/in/deep/er/x.parquet", k=pa.array([9], pa.int64()))
    census = take_census(spark, f"{tmp_dir}/in")
    assert sorted((k["n_files"], k["n_rows"]) for k in census.kinds) == [(3, 6), (4, 7)]
    assert take_census(spark, f"{tmp_dir}/none") is None
    os.mkdir(f"{tmp_dir}/empty")
    assert read_chunks(spark, f"{tmp_dir}/empty") is None


def test_jobs_do_not_follow_the_number_of_alternating_chunks(spark, tmp_dir):
    for i in range(24):
        kind = (pa.int64(), pa.float64())[i % 2]
        for n in (6, 24):
            if i < n:
                chunk(f"{tmp_dir}/{n}/{i:03d}.parquet", v=pa.array([i], kind))
    few, many = (jobs(spark, lambda n=n: read_chunks(spark, f"{tmp_dir}/{n}").collect()) for n in (6, 24))
    assert few == many
    assert rows(read_chunks(spark, f"{tmp_dir}/24")) == rows(spark.range(24).selectExpr("double(id)"))


def test_chunks_read_through_executors_keep_their_types(spark, tmp_dir):
    df = spark.sql("""SELECT id, cast(id AS short) s, cast(id AS float) f, cast(id AS decimal(20,3)) d, id % 2 = 0 b,
        date'2020-01-01' + cast(id AS int) day, timestamp'2020-01-01 10:00:00.123456' ts, timestamp_ntz'2020-01-01 10:00:00' tn,
        cast(concat('x', id) AS binary) bin, named_struct('a', id, 'l', array(id, null)) st, map('k', id) m,
        if(id = 1, null, concat('é', id)) t FROM range(5)""")
    for form in ("INT96", "TIMESTAMP_MICROS"):
        with settings(spark, {"spark.sql.parquet.outputTimestampType": form}):
            df.repartition(2).write.mode("append").parquet(f"{tmp_dir}/c/{form}")
    got = read_chunks(spark, f"{tmp_dir}/c")
    assert got.dtypes == df.dtypes
    assert rows(got) == rows(df.union(df))


def test_partition_values_are_typed_decoded_and_null(spark, tmp_dir):
    df = spark.createDataFrame([(1, 7, "a/b=c +d", "2024-01-02"), (2, None, "x", "2024-05-01")],
                               "v int, n int, name string, day string")
    df.write.partitionBy("n", "name", "day").parquet(f"{tmp_dir}/p")
    got = read_chunks(spark, f"{tmp_dir}/p")
    assert dict(got.dtypes) == {"v": "int", "n": "int", "name": "string", "day": "date"}
    assert rows(got.select("v", "n", "name", F.col("day").cast("string"))) == rows(df)


def test_a_chunk_that_is_no_parquet_file_is_an_error(spark, tmp_dir):
    chunk(f"{tmp_dir}/in/a.parquet", k=[1])
    with open(f"{tmp_dir}/in/b.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="cannot read"):
        read_chunks(spark, f"{tmp_dir}/in")


def test_stores_that_only_spark_opens_are_read_too(spark, tmp_dir, monkeypatch):
    from reportwide.operators import census
    for i in range(4):
        chunk(f"{tmp_dir}/in/h=1/{i}.parquet", v=pa.array([i], (pa.int64(), pa.float64())[i % 2]))
    monkeypatch.setattr(census, "_opens_by_itself", lambda path: False)
    got = read_chunks(spark, f"{tmp_dir}/in")
    assert rows(got) == [(float(i), 1) for i in range(4)] and dict(got.dtypes) == {"v": "double", "h": "int"}


def test_discover_reads_folders_without_listing_their_files(spark, tmp_dir):
    for name in ("a", "b"):
        spark.range(5).repartition(3).write.parquet(f"{tmp_dir}/r/{name}.parquet.gzip")
    chunk(f"{tmp_dir}/r/deep/c.parquet.gzip", id=[1])
    found = discover(spark, f"{tmp_dir}/r", make_df=True)
    assert sorted(p.rsplit("/", 1)[1] for p in found) == ["a.parquet.gzip", "b.parquet.gzip", "c.parquet.gzip"]
    assert sorted(df.count() for df in found.values()) == [1, 5, 5]


# --- versioned tables

def test_versions_stay_readable_and_batches_are_added_once(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    assert t.read() is None and t.versions() == [] and t.compact() == Snapshot()
    t.append(spark.range(3), "pull", 0)
    t.append(spark.range(3), "pull", 0)
    assert t.append(spark.range(0), "pull", 1).version == 1  # nothing to add
    t.append(spark.range(3, 5).selectExpr("cast(id AS double) id", "'x' AS s"), "pull", 2)
    before = t.snapshot()
    after = t.compact()
    assert len(before.folders) == 2 and len(after.folders) == 1 and after.batches == {"pull": 2}
    assert rows(t.read(before.version)) == rows(t.read()) == rows(
        spark.range(5).selectExpr("cast(id AS double) id", "if(id > 2, 'x', null) s"))
    assert [r["id"] for r in t.read(1).orderBy("id").collect()] == [0, 1, 2]
    assert t.vacuum(keep=1) == 3 and t.versions() == [3] and t.read().count() == 5


def test_a_failed_compaction_leaves_the_table_as_it_was(spark, tmp_dir, monkeypatch):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    t.append(spark.range(3))
    t.append(spark.range(3, 6))
    bad = spark.range(6).selectExpr("if(id = 4, raise_error('disk'), id) AS id")
    monkeypatch.setattr(VersionedTable, "read", lambda self, version=None: bad)
    with pytest.raises(Exception, match="disk"):
        t.compact()
    monkeypatch.undo()
    assert t.versions() == [1, 2] and rows(t.read()) == [(i,) for i in range(6)]
    assert t.vacuum() == 1  # the folder of the failed run


def test_commits_of_two_writers_both_stand(spark, tmp_dir):
    a, b = VersionedTable(spark, f"{tmp_dir}/t"), VersionedTable(spark, f"{tmp_dir}/t")
    seen = []

    def slow(s):
        if not seen:  # another writer commits between reading and publishing
            seen.append(b.append(spark.range(1)))
        return Snapshot(0, {**s.folders, "x": "{}"}, s.batches)
    assert a.commit(slow).version == 2
    assert len(a.snapshot().folders) == 2


def test_a_compaction_keeps_folders_added_meanwhile(spark, tmp_dir, monkeypatch):
    t, other = VersionedTable(spark, f"{tmp_dir}/t"), VersionedTable(spark, f"{tmp_dir}/t")
    t.append(spark.range(2))
    real = VersionedTable.commit

    def late(self, change):
        monkeypatch.undo()
        other.append(spark.range(2, 4))
        return real(self, change)
    monkeypatch.setattr(VersionedTable, "commit", late)
    t.compact()
    assert rows(t.read()) == [(i,) for i in range(4)]


# --- fan-out

def test_a_batch_sent_twice_changes_no_table(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a/1"), (2, "b"), (3, None), (4, "a/1")], "v int, r string")
    assert len(send_batch(df, f"{tmp_dir}/t", "r", "s", 0)) == 3
    assert send_batch(df, f"{tmp_dir}/t", "r", "s", 0) == []
    # A batch that reached only one table is added to the others.
    part = spark.createDataFrame([(5, "b")], "v int, r string")
    send_batch(part, f"{tmp_dir}/t", "r", "s", 1)
    assert send_batch(part.union(spark.createDataFrame([(6, "c")], "v int, r string")), f"{tmp_dir}/t", "r", "s", 1) == ["c"]
    assert {k: rows(t.read()) for k, t in report_tables(spark, f"{tmp_dir}/t").items()} == {
        "a/1": [(1,), (4,)], "b": [(2,), (5,)], None: [(3,)], "c": [(6,)]}
    # Another stream has numbers of its own.
    assert send_batch(part, f"{tmp_dir}/t", "r", "other", 0) == ["b"]
    assert send_batch(df.filter("false"), f"{tmp_dir}/t", "r", "s", 2) == []


# --- found schemas

def test_schema_texts():
    assert spark_type("OBJECT<`a b`: BIGINT, c: OBJECT<d: ARRAY<DECIMAL(21,1)>>, `x``y`: VOID, g: OBJECT<>>") == T.StructType([
        T.StructField("a b", T.LongType()), T.StructField("c", T.StructType([T.StructField("d", T.ArrayType(T.DoubleType()))])),
        T.StructField("x`y", T.NullType()), T.StructField("g", T.VariantType())])
    assert spark_type("ARRAY<STRING>") == T.ArrayType(T.StringType())


def test_records_without_a_given_schema(spark):
    texts = [{"p": 1, "data": [{"id": 1, "team": {"name": "x", "wins": 2}}, {"id": 2, "odd": "s", "tags": [1, 2]}]},
             {"p": 2, "data": [{"id": 3.5, "odd": 7, "nil": None, "e": {}}]}, {"p": 3, "data": []}]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(texts)] + [(8, "{bad"), (9, None)], "i int, j string")
    got = normalize(df, "j", path=["data"], keep=["i"], sep="_")
    assert got.columns == ["i", "e", "id", "nil", "odd", "tags", "team_name", "team_wins"]
    assert dict(got.dtypes)["id"] == "double" and dict(got.dtypes)["odd"] == "string"
    by_id = {r["id"]: r.asDict() for r in got.collect()}
    assert by_id[1.0]["team_wins"] == 2 and by_id[2.0]["odd"] == '"s"' and by_id[3.5]["odd"] == "7"
    assert by_id[2.0]["tags"] == [1, 2] and by_id[3.5]["e"] == "{}" and len(by_id) == 3
    marked = normalize(df, "j", path=["data"], keep=["i"], corrupt="bad")
    assert {(r["i"], r["bad"]) for r in marked.collect()} == {(0, False), (1, False), (2, False), (8, True), (9, False)}
    with pytest.raises(ValueError, match="no field 'nope'"):
        normalize(df, "j", path=["nope"])


def test_a_list_of_records_and_plain_values(spark):
    df = spark.createDataFrame([('[{"a": 1}, {"b": true}]',), ("[]",)], "j string")
    assert rows(normalize(df, "j")) == [(None, True), (1, None)]
    assert rows(normalize(spark.createDataFrame([("1",), ("2",)], "j string"), "j")) == [("1",), ("2",)]
    assert find_type(df.filter("false"), "j") == T.NullType()


# --- minimal keys

@pytest.mark.parametrize("seed", range(2))
def test_minimal_keys_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    data = list(zip(*[[int(x) if x else None for x in rng.integers(0, hi, 150)] for hi in (2, 5, 9, 30, 400)]))
    df = spark.createDataFrame(data, "a int, b int, c int, d int, e int")
    want = []
    for n in (1, 2, 3):
        for s in itertools.combinations(range(5), n):
            if len({tuple(r[i] for i in s) for r in data}) == 150 and not any(set(w) < set(s) for w in want):
                want.append(s)
    got = {(r["keys"], r["n_columns"]) for r in minimal_keys(df).collect()}
    assert got == {(",".join("abcde"[i] for i in s), len(s)) for s in want}


def test_minimal_keys_of_unique_and_empty_tables(spark):
    df = spark.range(500).selectExpr("id AS `i.d`", "id % 7 AS x")
    assert rows(minimal_keys(df)) == [("i.d", 1)]
    assert rows(minimal_keys(df.filter("false"))) == [("i.d", 1), ("x", 1)]
    assert rows(minimal_keys(df.union(df))) == []


def test_nan_is_missing_in_the_catalogue_as_in_the_profile(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert column_catalog({"t": df}).first()["non_null"] == 1


# --- quantiles by sketch

def exact(values, p):
    v = sorted(values)
    at = p * (len(v) - 1)
    a, b = v[int(at)], v[min(int(at) + 1, len(v) - 1)]
    return a if a == b or at == int(at) else a + (at - int(at)) * (b - a)


@pytest.mark.parametrize("few", [60, 16_384])
def test_sketched_quantiles_are_exact(spark, monkeypatch, few):
    monkeypatch.setattr(P, "FEW", few)
    monkeypatch.setattr(P, "SKETCH_K", 200)
    rng = np.random.default_rng(few)
    n = 6_000
    data = {"normal": rng.normal(0, 1e6, n), "ties": rng.integers(0, 3, n).astype(float), "tail": np.exp(rng.normal(0, 30, n)),
            "one": np.full(n, 4.0), "half": np.where(rng.random(n) < 0.5, 0.0, rng.random(n))}
    data["inf"] = np.concatenate([np.full(2500, np.inf), np.full(2500, -np.inf), rng.random(n - 5_000)])
    cols = list(data)
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in data.values()])), ", ".join(f"{c} double" for c in cols))
    df = df.union(df.limit(1).select(*[F.lit(float("nan")).alias(c) for c in cols])).union(
        df.limit(1).select(*[F.lit(None).cast("double").alias(c) for c in cols]))
    probs = [0.0, 0.25, 0.5, 0.999]
    got = P.column_quantiles(df, cols, probs)
    for c, (m, q) in zip(cols, got):
        assert m["n"] == n
        for p, v in zip(probs, q):
            want = exact(data[c].tolist(), p)
            assert v == want or abs(v - want) <= 1e-12 * abs(want), (c, p)


def test_describe_of_empty_null_and_small_columns(spark):
    df = spark.createDataFrame([(1, None, 2.0), (3, None, float("nan"))], "a int, b double, c double")
    got = {r["column_name"]: r for r in P.describe(df).collect()}
    assert got["a"]["p50"] == 2.0 and got["b"]["count"] == 0 and got["b"]["p50"] is None and got["c"]["p25"] == 2.0
    assert {r["count"] for r in P.describe(df.filter("false")).collect()} == {0}


def test_describe_takes_two_scans(spark, tmp_dir):
    spark.range(50_000).selectExpr("id % 977 AS a", "cast(id * id AS double) AS b").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    run = []
    real = type(df).agg
    type(df).agg = lambda self, *a: run.append(1) or real(self, *a)
    try:
        P.describe(df)
    finally:
        type(df).agg = real
    assert len(run) == 2


# --- wide tables

def test_saved_reports_join_without_exchange_or_sort(spark, tmp_dir):
    names = save_reports(spark, table(spark, SF001, "lineitem"), LINEITEM_REPORTS_21, 4, f"{tmp_dir}/b-{os.urandom(3).hex()}")
    with settings(spark, READ_SORTED):
        df = join_saved(spark, names, LINEITEM_REPORTS_21.key_names)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 20 and "Exchange" not in plan and "Sort [" not in plan
        n = df.count()
    assert n == spark.table(names[0]).count()
    assert spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering") == "false"
    for x in names:
        spark.sql(f"DROP TABLE {x}")


def test_change_sets_touch_only_their_buckets(spark, tmp_dir):
    w = WideTable(spark, tmp_dir, ["a", "b"], ["k"], buckets=16)
    ab = [spark.createDataFrame([(i, i * 10 if i is not None else None) for i in [*range(20), None]], f"k int, {c} int") for c in "xy"]
    for n, (r, df) in enumerate(zip("ab", ab)):
        w.apply({r: df}, n)
    before = w.wide.snapshot()
    change = spark.createDataFrame([(3, 1), (3, 2), (99, 5)], "k int, x int")
    touched = w.apply({"a": change}, 2)
    assert 1 <= len(touched) <= 2
    assert len(set(before.folders) - set(w.wide.snapshot().folders)) <= 2 < len(before.folders)
    assert w.apply({"a": change}, 2) == touched and w.wide.versions() == [1, 2, 3]
    want = {(i, i * 10, i * 10) for i in range(20) if i != 3} | {(3, 1, 30), (3, 2, 30), (99, 5, None), (None, None, None)}
    got = {tuple(r) for r in w.read().select("k", "x", "y").collect()}
    assert {r for r in got if r[0] is not None} == {r for r in want if r[0] is not None}


# --- positional widening

@pytest.mark.parametrize("bad", [(1, None, "c", "y"), (1, 0, "c", "y"), (2, 5, "c", "y")])
def test_widen_rows_drops_and_mixes_nothing(spark, bad):
    good = [(1, 0, "a", None), (1, 1, "b", "z"), (2, 0, None, "w"), (None, 0, "n", None)]
    kind = "p int, i int, f string, g string"
    assert rows(widen_rows(spark.createDataFrame(good, kind), ["p"], "i", ["f", "g"], 2)) == [
        (None, "n", None, None, None), (1, "a", None, "b", "z"), (2, None, "w", None, None)]
    with pytest.raises(Exception, match="widen_rows"):
        widen_rows(spark.createDataFrame([*good, bad], kind), ["p"], "i", ["f", "g"], 2).select("p").collect()


# --- seek paging, replay

def test_pages_by_seek_cover_the_table_in_order(spark, tmp_dir):
    from reportwide.operators.paging import page_after, write_sorted
    data = [(None, 2), (None, 1), ("b", None), ("a", 3), ("b", 1), ("a", None), ("c", 0)]
    df = spark.createDataFrame(data, "k string, n int")
    t = spark.read.parquet(write_sorted(df, ["k", "n"], f"{tmp_dir}/s", 3))
    got, after = [], None
    while page := [tuple(r) for r in page_after(t, ["k", "n"], after, 2).collect()]:
        got += page
        after = page[-1]
    assert got == [(None, 1), (None, 2), ("a", None), ("a", 3), ("b", None), ("b", 1), ("c", 0)]
    plan = page_after(t, ["k", "n"], ("b", 1), 2)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,b)" in plan and "TakeOrderedAndProject" in plan
    with pytest.raises(ValueError):
        page_after(t, ["k", "n"], ("b",), 2)


def test_mended_pages_enter_once(spark, tmp_dir):
    from reportwide.streaming.quarantine import page_key, replay, replayed_records
    record = T.StructType.fromDDL("id long")
    bad = spark.createDataFrame([("f", "{cut"), ("f", "{cut"), ("g", "{other"), ("h", "{empty")], "file string, value string")
    key = lambda v: spark.range(1).select(page_key(F.lit(v))).first()[0]
    mended = [(key("{cut"), '{"data": [{"id": 1}, {"id": 2}]}'), (key("{other"), "{still bad"), (key("{empty"), '{"data": []}')]
    t = VersionedTable(spark, f"{tmp_dir}/r")
    for _ in range(2):
        open_ = replay(bad, spark.createDataFrame(mended, "_page string, text string"), record, t)
        assert [r["value"] for r in open_.collect()] == ["{other"]
        assert rows(replayed_records(t)) == [(1,), (2,)]
    later = spark.createDataFrame([(key("{other"), '{"data": [{"id": 3}]}')], "_page string, text string")
    assert replay(bad, later, record, t).isEmpty()
    assert rows(replayed_records(t)) == [(1,), (2,), (3,)]


def test_minimal_keys_group_all_values_of_keys_only(spark, monkeypatch):
    # Both pairs come near the row count; the repeats of (a, b) are found in one slice of its values.
    from reportwide.operators import keys as K
    df = spark.range(20_000).selectExpr("id", "id % 19000 AS a", "id % 1000 AS b", "CAST(id % 2000 AS DOUBLE) AS c")
    grouped = []
    real = K._repeats
    monkeypatch.setattr(K, "_repeats", lambda d, s: grouped.append((tuple(s), "pmod" in d._jdf.queryExecution().toString())) or real(d, s))
    assert rows(K.minimal_keys(df, max_size=2)) == [("a,c", 2), ("id", 1)]
    full = {s for s, sliced in grouped if not sliced}
    assert full == {("id",), ("a", "c")}
    assert {("a",), ("a", "b")} <= {s for s, sliced in grouped if sliced}
