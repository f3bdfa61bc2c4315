"""De-duplication, filters, sorting and paging queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reportwide.functions.dates import window_predicate
from reportwide.operators import paging as PG
from reportwide.operators.clean import dedup_ignoring_keys, dedup_strict, replace_with_null
from reportwide.operators.wide import drop_columns
from reportwide.plans.registry import register, table
from reportwide.session import work_path

DOC_COLS = "doc_id, text, lang, source, n_chars"


@register("dedup_ignore_key",
          f"SELECT {DOC_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY text, lang, source, "
          "n_chars ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def q_dedup_ignore_key(spark: SparkSession, sf_dir: str):
    return dedup_ignoring_keys(table(spark, sf_dir, "documents"), ["doc_id"])


@register("dedup_strict", f"SELECT DISTINCT {DOC_COLS} FROM documents")
def q_dedup_strict(spark: SparkSession, sf_dir: str):
    # A re-pulled chunk lands twice; strict de-duplication restores one copy of each row.
    docs = table(spark, sf_dir, "documents")
    return dedup_strict(docs.unionByName(docs))


@register("marker_columns",
          "SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus, o_orderdate, "
          "o_orderpriority FROM orders")
def q_marker_columns(spark: SparkSession, sf_dir: str):
    # A marker value becomes null; a column, and a name that is not there, go.
    orders = replace_with_null(table(spark, sf_dir, "orders"), ["o_orderstatus"], "P")
    return drop_columns(orders, ["o_totalprice", "no_such_column"])


# Fixed parameters of the window filter: inclusive day range and the status code kept.
FILTER_START, FILTER_END, FILTER_STATUS = dt.date(1996, 1, 1), dt.date(1996, 12, 31), "F"


@register("window_filter",
          "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders "
          f"WHERE o_orderdate >= DATE '{FILTER_START}' AND o_orderdate < DATE '{FILTER_END}' "
          "+ INTERVAL 1 DAY AND o_orderstatus = 'F'")
def q_window_filter(spark: SparkSession, sf_dir: str):
    orders = table(spark, sf_dir, "orders")
    pred = window_predicate("o_orderdate", FILTER_START, FILTER_END,
                            equals={"o_orderstatus": FILTER_STATUS})
    return orders.filter(pred).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


SEGMENT_MIXED = ("CASE WHEN c_nationkey % 2 = 0 THEN lower(c_mktsegment) "
                 "ELSE c_mktsegment END")


@register("sort_ci",
          f"SELECT c_custkey, {SEGMENT_MIXED} AS segment, c_acctbal, row_number() OVER (ORDER BY "
          f"lower({SEGMENT_MIXED}), c_acctbal DESC, c_custkey) AS sort_rank FROM customer")
def q_sort_ci(spark: SparkSession, sf_dir: str):
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr(SEGMENT_MIXED).alias("segment"), "c_acctbal")
    order = PG.sort_columns([{"property": "segment", "direction": "ASC_CI"},
                             {"property": "c_acctbal", "direction": "DESC"},
                             {"property": "c_custkey", "direction": "ASC"}])
    return PG.global_row_number(cust, order, "sort_rank")


PAGE_SIZE = 100
ORDER_RN = "row_number() OVER (ORDER BY o_orderdate, o_orderkey)"


def _orders_paged(spark: SparkSession, sf_dir: str):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    order = PG.with_tie_breakers(PG.sort_columns([("o_orderdate", "ASC")]), ["o_orderkey"])
    return PG.paginate(orders, order, PAGE_SIZE)


@register("page",
          f"SELECT o_orderkey, o_orderdate, ({ORDER_RN} - 1) // {PAGE_SIZE} AS page, "
          f"({ORDER_RN} - 1) % {PAGE_SIZE} AS row_in_page FROM orders")
def q_page(spark: SparkSession, sf_dir: str):
    return _orders_paged(spark, sf_dir)


@register("page_one",
          "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey "
          "LIMIT 100 OFFSET 200")
def q_page_one(spark: SparkSession, sf_dir: str):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return PG.page(orders, [F.col("o_orderdate"), F.col("o_orderkey")], start=200, limit=100)


@register("page_deep",
          "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey "
          "LIMIT 100 OFFSET 1000")
def q_page_deep(spark: SparkSession, sf_dir: str):
    # A page behind the depth that the top-k serves.
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return PG.page(orders, [F.col("o_orderdate"), F.col("o_orderkey")], start=1000, limit=100,
                   top_k_limit=500)


@register("page_sizes",
          f"SELECT page, count(*) AS n_rows, arg_min(o_orderkey, row_in_page) AS first_id, "
          f"count(*) < {PAGE_SIZE} AS is_last FROM (SELECT o_orderkey, ({ORDER_RN} - 1) // "
          f"{PAGE_SIZE} AS page, ({ORDER_RN} - 1) % {PAGE_SIZE} AS row_in_page FROM orders) "
          "GROUP BY page")
def q_page_sizes(spark: SparkSession, sf_dir: str):
    return PG.page_sizes(_orders_paged(spark, sf_dir), PAGE_SIZE, "o_orderkey")


SEEK_PAGES, SEEK_ROWS = 5, 400


@register("page_seek",
          "SELECT o_orderdate, o_orderkey, o_totalprice, CAST((rn - 1) // " f"{SEEK_ROWS} AS INTEGER) AS page FROM (SELECT "
          "*, row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey) AS rn FROM orders) "
          f"WHERE rn <= {SEEK_PAGES * SEEK_ROWS}")
def q_page_seek(spark: SparkSession, sf_dir: str):
    # Page after page of a sorted table, each found from the last key of the one before (the page
    # length and the number of pages asked for are the feature).
    keys = ["o_orderdate", "o_orderkey"]
    path = PG.write_sorted(table(spark, sf_dir, "orders").select(*keys, "o_totalprice"), keys, work_path(spark, "page_seek"))
    orders, after, out = spark.read.parquet(path), None, None
    for n in range(SEEK_PAGES):
        found = PG.page_after(orders, keys, after, SEEK_ROWS)
        mine = found.withColumn("page", F.lit(n))
        out = mine if out is None else out.unionByName(mine)
        last = found.orderBy(*[F.col(k).desc_nulls_last() for k in keys]).first()  # one key
        if last is None:
            break
        after = [last[k] for k in keys]
    return out
