"""Every operator on empty input returns an empty (or all-zero) result, never an error."""

from pyspark.sql import functions as F

from reportwide.functions import urls as U
from reportwide.operators import flatten as FL
from reportwide.operators import paging as PG
from reportwide.operators import profile as P
from reportwide.operators.clean import dedup_ignoring_keys, dedup_strict
from reportwide.operators.combine import union_by_name
from reportwide.operators.keys import candidate_keys, column_catalog, column_overlap
from reportwide.operators.wide import wide_join


def _empty(spark):
    return spark.createDataFrame([], "k int, x double, s string")


def test_wide_and_dedup_on_empty(spark):
    e = _empty(spark)
    r = spark.createDataFrame([(1, 2)], "k int, y int")
    assert wide_join([e, r], ["k"]).count() == 0
    assert wide_join([e, r], ["k"], strategy="merge").count() == 0
    assert dedup_ignoring_keys(e, ["k"]).count() == 0
    assert dedup_strict(e).count() == 0
    assert union_by_name([e, e]).count() == 0


def test_profiles_on_empty(spark):
    e = _empty(spark)
    assert tuple(P.shape(e).first()) == (0, 3)
    assert {r["column_name"]: r["null_count"] for r in P.null_counts(e).collect()} == \
        {"k": 0, "x": 0, "s": 0}
    assert sorted(r[0] for r in P.all_null_columns(e).collect()) == ["k", "s", "x"]
    d = {r["column_name"]: r for r in P.describe(e).collect()}
    assert d["x"]["count"] == 0 and d["x"]["p50"] is None
    assert P.describe(e, method="approx").first()["count"] == 0


def test_paging_on_empty(spark):
    e = _empty(spark)
    assert PG.global_row_number(e, [F.col("k")]).count() == 0
    assert PG.paginate(e, [F.col("k")], 10).count() == 0
    assert PG.page(e, [F.col("k")], 0, 10).count() == 0


def test_flatten_and_urls_on_empty(spark):
    e = _empty(spark)
    assert FL.drop_last_rows(e, ["k"], ["x"]).count() == 0
    assert FL.widen_rows(e.selectExpr("k", "CAST(x AS INT) AS pos", "s"), ["k"], "pos", ["s"], 3).count() == 0
    urls = spark.createDataFrame([], "url string")
    assert urls.select(U.alter_url("url", 0, 100)).count() == 0


def test_keys_on_empty(spark):
    e = _empty(spark)
    tables = {"a": e, "b": e.select("k", "s")}
    cat = column_catalog(tables)
    assert cat.count() == 5
    assert column_overlap(cat).first()["n_shared"] == 2
    ck = candidate_keys(tables).first()
    assert (ck["n_rows"], ck["n_distinct"], ck["is_unique"]) == (0, 0, True)
