"""Source and sink round trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportwide.plans.q_wide import events_wide
from reportwide.plans.registry import register, table
from reportwide.plans.reports import EVENTS_REPORTS, _report_cte, build_report, wide_sql
from reportwide.session import work_path
from reportwide.sources import readers as R
from reportwide.sources import sinks as S

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
_OC = ", ".join(ORDER_COLS)


@register("scan_by_suffix", " UNION ALL ".join(
    f"SELECT '{fmt}' AS fmt, {_OC} FROM orders" for fmt in ("csv", "json", "parquet")))
def q_scan_by_suffix(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "scan_by_suffix")
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLS)
    orders.write.option("header", True).csv(f"{base}/orders.csv")
    orders.write.json(f"{base}/orders.json")
    orders.write.option("compression", "gzip").parquet(f"{base}/orders.parquet.gzip")
    parts = []
    for name in ("orders.csv", "orders.json", "orders.parquet.gzip"):
        path = f"{base}/{name}"
        # Spark writes JSON Lines, one record per line.
        df = R.read_by_suffix(spark, path, multi_line=not path.endswith(".json"))
        parts.append(df.select(F.lit(R.format_for(path)).alias("fmt"),
                               F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"),
                               F.col("o_orderstatus").cast("string"),
                               F.col("o_totalprice").cast("double")))
    return reduce(DataFrame.unionByName, parts)


@register("pages_quarantine",
          "SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id, CASE WHEN event_type "
          "<> 'error' THEN event_type END AS event_type, CASE WHEN event_type = 'error' THEN "
          "'{\"event_id\":' || event_id || ',\"event_type\":\"error\"' END AS raw FROM events")
def q_pages_quarantine(spark: SparkSession, sf_dir: str):
    # Landed JSON pages, some of them cut: good and quarantined pages together are all pages.
    base = work_path(spark, "pages_quarantine")
    body = F.to_json(F.struct("event_id", "event_type"))
    cut = F.when(F.col("event_type") == "error", F.expr("substr(body, 1, length(body) - 1)")).otherwise(F.col("body"))
    table(spark, sf_dir, "events").withColumn("body", body).select(cut.alias("value")).write.text(f"{base}/pages")
    good, bad = R.read_pages(spark, f"{base}/pages", "event_id bigint, event_type string")
    return good.withColumn("raw", F.lit(None).cast("string")).unionByName(
        bad.select(F.col("_corrupt_record").alias("raw")), allowMissingColumns=True)


_KEYS_SQL =" UNION ALL ".join(
    f"SELECT '{r.name}' AS table_name, user_id, day FROM {r.name}" for r in EVENTS_REPORTS.reports)
_CTES = "WITH " + ",\n".join(_report_cte(EVENTS_REPORTS, r) for r in EVENTS_REPORTS.reports)


@register("scan_recursive", f"{_CTES} {_KEYS_SQL}")
def q_scan_recursive(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "scan_recursive")
    src = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    for r in EVENTS_REPORTS.reports:
        S.write_parquet(build_report(src, EVENTS_REPORTS, r), f"{base}/team/{r.name}_data.parquet.gzip")
    # A file the marker does not match is skipped.
    table(spark, sf_dir, "region").write.option("header", True).csv(f"{base}/team/notes.csv")
    found = R.discover(spark, base, ".parquet.gzip", make_df=True)
    parts = []
    for path, df in found.items():
        name = path.rstrip("/").rsplit("/", 1)[-1].replace("_data.parquet.gzip", "")
        parts.append(df.select(F.lit(name).alias("table_name"), "user_id", "day"))
    return reduce(DataFrame.unionByName, parts)


@register("sink_roundtrip", f"SELECT * FROM ({wide_sql(EVENTS_REPORTS)}) UNION ALL "
                            f"SELECT * FROM ({wide_sql(EVENTS_REPORTS)})")
def q_sink_roundtrip(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "sink_roundtrip")
    wide = events_wide(spark, sf_dir)
    S.write_parquet(wide, f"{base}/gzip.parquet.gzip", compression="gzip",
                    sort_within=["user_id", "day"])
    S.write_parquet(wide, f"{base}/default.parquet.gzip", compression=None)
    a = R.read_table(spark, f"{base}/gzip.parquet.gzip")
    b = R.read_table(spark, f"{base}/default.parquet.gzip")
    return a.unionByName(b)


@register("sink_append", f"SELECT {_OC} FROM orders")
def q_sink_append(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "sink_append")
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLS)
    done = F.col("o_orderstatus").eqNullSafe("F")
    S.append_table(orders.filter(done), f"{base}/orders_table")
    S.append_table(orders.filter(~done), f"{base}/orders_table")
    if S.append_table(orders.filter(F.lit(False)), f"{base}/orders_table"):
        raise RuntimeError("an empty table was written")
    return spark.read.parquet(f"{base}/orders_table")


@register("sink_partitioned",
          "SELECT o_orderkey, o_totalprice, 'order' AS rtype, o_orderstatus AS report, "
          "CAST(date_trunc('month', o_orderdate) AS DATE) AS window_start FROM orders")
def q_sink_partitioned(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "sink_partitioned")
    orders = table(spark, sf_dir, "orders")
    landed = orders.select("o_orderkey", "o_totalprice", F.lit("order").alias("rtype"),
                           F.col("o_orderstatus").alias("report"),
                           F.to_date(F.date_trunc("month", "o_orderdate")).alias("window_start"))
    S.write_landing(landed, f"{base}/landing")
    # Re-landing one report replaces its partitions instead of doubling them.
    S.write_landing(landed.filter(F.col("report") == "F"), f"{base}/landing")
    return spark.read.parquet(f"{base}/landing").select(
        "o_orderkey", "o_totalprice", "rtype", "report", F.col("window_start").cast("date"))


@register("wide_from_files", wide_sql(EVENTS_REPORTS))
def q_wide_from_files(spark: SparkSession, sf_dir: str):
    # The report-folder flow: raw report tables land as <name>_data.parquet.gzip files (keys
    # still numeric, duplicates not removed), then discover, clean, join wide and save.
    from reportwide.plans.wide_table import wide_from_folder
    base = work_path(spark, "wide_from_files")
    src = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    for r in EVENTS_REPORTS.reports:
        raw = src.filter(F.expr(r.where)) if r.where else src
        raw = raw.groupBy(*[F.expr(e).alias(k) for k, e in EVENTS_REPORTS.keys]).agg(
            *[F.expr(e).alias(a) for a, e in r.aggs])
        S.write_parquet(raw, f"{base}/team/{r.name}_data.parquet.gzip")
    order = [r.name for r in EVENTS_REPORTS.reports]
    return wide_from_folder(spark, f"{base}/team", EVENTS_REPORTS.key_names, order=order,
                            key_as_string=EVENTS_REPORTS.key_as_string, out=f"{base}/wide")
