"""Union of drifting chunks with compaction, column catalogue and key discovery
(U1-U5, S10)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reportwide.operators.combine import compact
from reportwide.operators.flatten import flatten_struct
from reportwide.operators.keys import (candidate_keys, column_catalog, column_overlap,
                                       common_columns, running_keys, schema_catalog)
from reportwide.plans.registry import register, table
from reportwide.plans.reports import EVENTS_REPORTS, _report_cte, build_report
from reportwide.session import work_path
from reportwide.sources.sinks import write_landing

# ---- U1, U2, S10: orders landed as three drifting chunks, then compacted -------------------

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"


@register("union_drift",
          f"SELECT {ORDER_COLS}, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders "
          "WHERE o_orderstatus = 'F' UNION ALL "
          "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(trunc(o_totalprice) AS DOUBLE) AS "
          "o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'O' "
          f"UNION ALL SELECT {ORDER_COLS}, o_orderpriority FROM orders WHERE o_orderstatus IS DISTINCT "
          "FROM 'F' AND o_orderstatus IS DISTINCT FROM 'O'")
def q_union_drift(spark: SparkSession, sf_dir: str):
    orders = table(spark, sf_dir, "orders")
    base = work_path(spark, "union_drift")
    # Chunk F lacks a column; chunk O carries the price as bigint (truncated), the rest is whole.
    (orders.filter(F.col("o_orderstatus") == "F").drop("o_orderpriority")
     .write.option("compression", "gzip").parquet(f"{base}/chunks/F"))
    (orders.filter(F.col("o_orderstatus") == "O")
     .withColumn("o_totalprice", F.col("o_totalprice").cast("bigint"))
     .write.option("compression", "gzip").parquet(f"{base}/chunks/O"))
    (orders.filter(~F.col("o_orderstatus").eqNullSafe("F") & ~F.col("o_orderstatus").eqNullSafe("O"))
     .write.option("compression", "gzip").parquet(f"{base}/chunks/rest"))
    if not compact(spark, f"{base}/chunks", f"{base}/compact", n_files=4):
        raise RuntimeError("no chunk rows")
    return spark.read.parquet(f"{base}/compact")


@register("union_nested",
          "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(trunc(o_totalprice) AS DOUBLE) ELSE "
          "o_totalprice END AS doc_price, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS doc_cust, "
          "CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS doc_status FROM orders")
def q_union_nested(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "union_nested")
    orders = table(spark, sf_dir, "orders")
    whole = F.struct(F.col("o_totalprice").cast("bigint").alias("price"), F.col("o_custkey").alias("cust"))
    exact = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    # Four chunks that together hold every row, alternately with one struct and the other.
    for i in range(4):
        (orders.filter(F.col("o_orderkey") % 4 == i).select("o_orderkey", (exact if i % 2 else whole).alias("doc"))
         .write.parquet(f"{base}/chunks/{i}"))
    if not compact(spark, f"{base}/chunks", f"{base}/compact", n_files=4):
        raise RuntimeError("no chunk rows")
    return flatten_struct(spark.read.parquet(f"{base}/compact"), sep="_")


@register("compact_landing",
          "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice) AS DOUBLE) "
          "ELSE o_totalprice END AS o_totalprice, 'order' AS rtype, o_orderstatus AS report, "
          "CAST(date_trunc('month', o_orderdate) AS DATE) AS window_start FROM orders")
def q_compact_landing(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "compact_landing")
    landed = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.lit("order").alias("rtype"), F.col("o_orderstatus").alias("report"),
        F.to_date(F.date_trunc("month", "o_orderdate")).alias("window_start"))
    # Report F carries whole prices as bigint; type, report and window stand in folder names only.
    whole = F.col("report").eqNullSafe("F")
    write_landing(landed.filter(whole).withColumn("o_totalprice", F.round("o_totalprice").cast("bigint")),
                  f"{base}/landing")
    write_landing(landed.filter(~whole), f"{base}/landing")
    if not compact(spark, f"{base}/landing", f"{base}/compact", n_files=4):
        raise RuntimeError("no chunk rows")
    return spark.read.parquet(f"{base}/compact")


# ---- U3-U5 over the events report tables, documents and labels -----------------------------

def _catalog_tables(spark: SparkSession, sf_dir: str) -> dict:
    src = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    out = {r.name: build_report(src, EVENTS_REPORTS, r) for r in EVENTS_REPORTS.reports}
    out["documents"] = table(spark, sf_dir, "documents")
    out["labels"] = table(spark, sf_dir, "labels")
    li = table(spark, sf_dir, "lineitem")
    out["line_keys"] = li.select("l_orderkey", "l_linenumber").distinct()
    out["lineitem"] = li
    return out


# Static column lists of the same tables for the oracle.
_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
_LABEL_COLS = ["doc_id", "quality", "toxic"]
_LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
              "l_shipdate"]


def _static_tables() -> list[tuple[str, list[str], str]]:
    """(name, columns, SQL source) for the oracle."""
    out = []
    for r in EVENTS_REPORTS.reports:
        cols = EVENTS_REPORTS.key_names + [a for a, _ in r.aggs]
        out.append((r.name, cols, r.name))
    out.append(("documents", _DOC_COLS, "documents"))
    out.append(("labels", _LABEL_COLS, "labels"))
    out.append(("line_keys", ["l_orderkey", "l_linenumber"],
                "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)"))
    out.append(("lineitem", _LINE_COLS, "lineitem"))
    return out


_CTES = "WITH " + ",\n".join(_report_cte(EVENTS_REPORTS, r) for r in EVENTS_REPORTS.reports)
_CATALOG_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, count({c}) AS non_null FROM {src}"
    for name, cols, src in _static_tables() for c in cols)


@register("common_columns",
          f"{_CTES}, cat AS ({_CATALOG_SQL}) SELECT a.column_name, a.non_null AS non_null_a, "
          "b.non_null AS non_null_b FROM cat a JOIN cat b USING (column_name) "
          "WHERE a.table_name = 'r_summary' AND b.table_name = 'r_error'")
def q_common_columns(spark: SparkSession, sf_dir: str):
    tables = _catalog_tables(spark, sf_dir)
    cat = column_catalog({t: tables[t] for t in ("r_summary", "r_error")})
    return common_columns(cat, "r_summary", "r_error")


@register("column_overlap",
          f"{_CTES}, cat AS ({_CATALOG_SQL}) SELECT a.table_name AS table_a, b.table_name AS "
          "table_b, count(*) AS n_shared, string_agg(column_name, ',' ORDER BY column_name) AS "
          "shared FROM cat a JOIN cat b USING (column_name) WHERE a.table_name < b.table_name "
          "GROUP BY 1, 2")
def q_column_overlap(spark: SparkSession, sf_dir: str):
    return column_overlap(schema_catalog(spark, _catalog_tables(spark, sf_dir)))


def _candidate_sql() -> str:
    static = _static_tables()
    cands = running_keys([(n, c) for n, c, _ in static])
    src = {n: s for n, _, s in static}
    parts = []
    for name, keys in cands:
        if not keys:
            continue
        k = ", ".join(keys)
        parts.append(
            f"SELECT '{name}' AS table_name, '{','.join(keys)}' AS keys, n_rows, n_distinct, "
            f"n_rows = n_distinct AS is_unique FROM (SELECT count(*) AS n_rows FROM {src[name]}), "
            f"(SELECT count(*) AS n_distinct FROM (SELECT DISTINCT {k} FROM {src[name]}))")
    return f"{_CTES} " + "\nUNION ALL\n".join(parts)


@register("candidate_keys", _candidate_sql())
def q_candidate_keys(spark: SparkSession, sf_dir: str):
    return candidate_keys(_catalog_tables(spark, sf_dir))
