"""Wide-join queries: events reports keyed by (user_id, day) and lineitem reports keyed by
(l_partkey, l_suppkey)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reportwide.operators.paging import head
from reportwide.operators.wide import wide_join
from reportwide.plans.incremental import WideTable
from reportwide.plans.registry import register, table
from reportwide.plans.reports import (EVENTS_REPORTS, LINE_COLUMNS, LINEITEM_REPORTS, LINEITEM_REPORTS_21,
                                      SOURCE_BLOCK, build_report, build_wide, buckets_of, keeps_source_order,
                                      sorted_source, wide_sql)
from reportwide.session import settings, work_path
from reportwide.sources.sinks import READ_SORTED, write_bucketed


def events_wide(spark: SparkSession, sf_dir: str):
    src = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    return build_wide(src, EVENTS_REPORTS)


@register("wide_join", wide_sql(EVENTS_REPORTS))
def q_wide_join(spark: SparkSession, sf_dir: str):
    return events_wide(spark, sf_dir)


@register("wide_join_hidim", wide_sql(LINEITEM_REPORTS))
def q_wide_join_hidim(spark: SparkSession, sf_dir: str):
    src = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return build_wide(src, LINEITEM_REPORTS)


@register("wide_head", f"SELECT * FROM ({wide_sql(EVENTS_REPORTS)}) ORDER BY user_id, day LIMIT 10")
def q_wide_head(spark: SparkSession, sf_dir: str):
    # O3: the first ten rows in key order (a top-k report; the limit is the feature).
    return head(events_wide(spark, sf_dir), ["user_id", "day"], 10)


@register("wide_join_21", wide_sql(LINEITEM_REPORTS_21))
def q_wide_join_21(spark: SparkSession, sf_dir: str):
    # 21 report tables joined wide, as in the reference's main notebook.
    return build_wide(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS), LINEITEM_REPORTS_21)


@register("wide_join_hot",
          "SELECT l.l_linenumber, l.l_orderkey, l.l_quantity, q.max_qty, p.max_price FROM lineitem l "
          "LEFT JOIN (SELECT l_linenumber, max(l_quantity) AS max_qty FROM lineitem GROUP BY 1) q "
          "USING (l_linenumber) LEFT JOIN (SELECT l_linenumber, max(l_extendedprice) AS max_price "
          "FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) p USING (l_linenumber)")
def q_wide_join_hot(spark: SparkSession, sf_dir: str):
    # Few keys hold all rows of the anchor: their rows are salted through the whole chain.
    li = table(spark, sf_dir, "lineitem")
    qty = li.groupBy("l_linenumber").agg(F.max("l_quantity").alias("max_qty"))
    price = (li.filter(F.col("l_returnflag") == "R").groupBy("l_linenumber")
             .agg(F.max("l_extendedprice").alias("max_price")))
    return wide_join([li.select("l_linenumber", "l_orderkey", "l_quantity"), qty, price], ["l_linenumber"])


@register("wide_join_right_hot",
          "SELECT s.l_linenumber, s.n_lines, l.l_orderkey, l.l_quantity FROM (SELECT l_linenumber, "
          "count(*) AS n_lines FROM lineitem GROUP BY 1) s LEFT JOIN lineitem l USING (l_linenumber)")
def q_wide_join_right_hot(spark: SparkSession, sf_dir: str):
    # A right table with many rows of one key: they are spread, the anchor's row is copied.
    li = table(spark, sf_dir, "lineitem")
    lines = li.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n_lines"))
    return wide_join([lines, li.select("l_linenumber", "l_orderkey", "l_quantity")], ["l_linenumber"],
                     hot_rows=500)


@register("wide_join_unique",
          "SELECT o_orderkey, o_custkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def q_wide_join_unique(spark: SparkSession, sf_dir: str):
    # Keyed right tables: the join whose columns are not read is not in the plan.
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    cust = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    spent = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spent"))
    wide = wide_join([orders, cust, spent], ["o_custkey"], unique_right=True)
    return wide.select("o_orderkey", "o_custkey", "c_name")


@register("wide_join_merge",wide_sql(LINEITEM_REPORTS))
def q_wide_join_merge(spark: SparkSession, sf_dir: str):
    # The same 14 keyed report tables as wide_join_hidim, merged by one union + group-by.
    src = table(spark, sf_dir, "lineitem")
    reports = [build_report(src, LINEITEM_REPORTS, r) for r in LINEITEM_REPORTS.reports]
    return wide_join(reports, LINEITEM_REPORTS.key_names, strategy="merge")


def save_reports(spark: SparkSession, src, rs, buckets: int, base: str) -> list[str]:
    """The report tables, saved bucketed by their keys; their names in join order. The source is shuffled
    once, not every report, if the reports keep its order."""
    tag = base.rstrip("/").rsplit("-", 1)[-1]

    def save(s, placed: bool) -> list[str]:
        return [write_bucketed(build_report(s, rs, r), f"{r.name}_{tag}", rs.key_names, buckets,
                               path=f"{base}/{r.name}", placed=placed, block_bytes=SOURCE_BLOCK) for r in rs.reports]

    if not keeps_source_order(rs):
        return save(src, False)
    with sorted_source(src, rs, base, buckets) as s:
        return save(s, True)


def join_saved(spark: SparkSession, names, keys):
    """Wide join of bucketed tables: no exchange, and under ``READ_SORTED`` no sort and so no
    sorter in any task: all joins run in one stage, without a checkpoint between."""
    return wide_join([spark.table(n) for n in names], keys, hot_share=None, joins_per_stage=0)


@register("wide_join_bucketed", wide_sql(LINEITEM_REPORTS_21))
def q_wide_join_bucketed(spark: SparkSession, sf_dir: str):
    # The 21 report tables of wide_join_21, saved co-partitioned once, then joined without a shuffle.
    base = work_path(spark, "wide_join_bucketed")
    src = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    names = save_reports(spark, src, LINEITEM_REPORTS_21, buckets_of(spark), base)
    with settings(spark, READ_SORTED):
        join_saved(spark, names, LINEITEM_REPORTS_21.key_names).write.parquet(f"{base}/wide")
    for n in names:  # the tables' files are in the work folder; only the names go
        spark.sql(f"DROP TABLE {n}")
    return spark.read.parquet(f"{base}/wide")


@register("wide_incremental", wide_sql(EVENTS_REPORTS))
def q_wide_incremental(spark: SparkSession, sf_dir: str):
    # Reports arrive in change sets: half of the keys first, with a wrong summary, then the rest, then
    # the corrections. The last change set is sent twice.
    src = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    base, keys = work_path(spark, "wide_incremental"), EVENTS_REPORTS.key_names
    reports = {}
    for r in EVENTS_REPORTS.reports:
        build_report(src, EVENTS_REPORTS, r).write.parquet(f"{base}/input/{r.name}")
        reports[r.name] = spark.read.parquet(f"{base}/input/{r.name}")
    early = F.pmod(F.xxhash64(*keys), F.lit(2)) == 0
    wide = WideTable(spark, f"{base}/tables", list(reports), keys, buckets=8)
    right = {name: df.filter(early) for name, df in reports.items()}
    wrong = {**right, "r_summary": right["r_summary"].withColumn("n_events", F.col("n_events") + 1)}
    rest = {name: df.filter(~early) for name, df in reports.items()}
    fix = {"r_summary": right["r_summary"]}
    for batch, changes in enumerate((wrong, rest, fix)):
        wide.apply(changes, batch)
    wide.apply(fix, 2)
    return wide.read()
