"""Profiling queries over the events wide table and over lineitem."""

from __future__ import annotations

from pyspark.sql import SparkSession

from reportwide.operators import profile as P
from reportwide.operators.clean import rows_missing
from reportwide.plans.q_wide import events_wide
from reportwide.plans.registry import register, table
from reportwide.plans.reports import (EVENTS_REPORTS, _event_report, build_wide, wide_columns,
                                      wide_sql)

WIDE = wide_sql(EVENTS_REPORTS)
# The keys are the wide table's row index, so profiles leave them out (as a keyed table's
# index is not one of its columns).
KEYS = EVENTS_REPORTS.key_names
COLS = [(c, t) for c, t in wide_columns(EVENTS_REPORTS) if c not in KEYS]

# A report whose type is listed but absent from the data: its columns are all null after the
# left joins, which is what the all-null check finds.
WITH_ABSENT = EVENTS_REPORTS.reports + (_event_report("refund"),)
COLS_ABSENT = [(c, t) for c, t in wide_columns(EVENTS_REPORTS, WITH_ABSENT) if c not in KEYS]
WIDE_ABSENT = wide_sql(EVENTS_REPORTS, WITH_ABSENT)


def _union(parts):
    return "\nUNION ALL\n".join(parts)


@register("null_count_one",
          f"WITH w AS ({WIDE}) SELECT 'error_count' AS column_name, "
          "count(*) FILTER (WHERE error_count IS NULL) AS null_count FROM w")
def q_null_count_one(spark: SparkSession, sf_dir: str):
    return P.null_count(events_wide(spark, sf_dir), "error_count")


@register("null_counts", f"WITH w AS ({WIDE}) " + _union(
    [f"SELECT {i} AS position, '{c}' AS column_name, "
     f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if t == 'double' else ''}) "
     "AS null_count FROM w" for i, (c, t) in enumerate(COLS)]))
def q_null_counts(spark: SparkSession, sf_dir: str):
    return P.null_counts(events_wide(spark, sf_dir), exclude=KEYS)


@register("all_null_columns", f"WITH w AS ({WIDE_ABSENT}) SELECT column_name, null_count FROM ("
          + _union([f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS "
                    "null_count, count(*) AS n_rows FROM w" for c, _ in COLS_ABSENT])
          + ") WHERE null_count = n_rows")
def q_all_null_columns(spark: SparkSession, sf_dir: str):
    src = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    wide = build_wide(src, EVENTS_REPORTS, WITH_ABSENT)
    return P.all_null_columns(wide, exclude=KEYS).select("column_name", "null_count")


@register("shape", f"WITH w AS ({WIDE}) SELECT count(*) AS n_rows, "
                   f"CAST({len(COLS)} AS BIGINT) AS n_cols FROM w")
def q_shape(spark: SparkSession, sf_dir: str):
    return P.shape(events_wide(spark, sf_dir), exclude=KEYS)


@register("schema_profile", f"WITH w AS ({WIDE}) " + _union(
    [f"SELECT {i} AS position, '{c}' AS column_name, count({c}) AS non_null_count, "
     f"'{t}' AS dtype FROM w" for i, (c, t) in enumerate(COLS)]))
def q_schema_profile(spark: SparkSession, sf_dir: str):
    return P.schema_profile(events_wide(spark, sf_dir), exclude=KEYS)


def _describe_sql(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({v}) AS count, round(avg({v}), 6) AS mean, "
            f"round(stddev_samp({v}), 6) AS std, round(min({v}), 6) AS min, "
            f"round(quantile_cont({v}, 0.25), 6) AS p25, round(quantile_cont({v}, 0.5), 6) AS p50, "
            f"round(quantile_cont({v}, 0.75), 6) AS p75, round(max({v}), 6) AS max FROM {src}")
    return _union(parts)


NUMERIC_WIDE = [c for c, t in COLS if t in ("bigint", "double")]


@register("describe_long", f"WITH w AS ({WIDE}) " + _describe_sql("w", NUMERIC_WIDE))
def q_describe_long(spark: SparkSession, sf_dir: str):
    return P.describe(events_wide(spark, sf_dir), digits=6, exclude=KEYS)


LINE_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax"]


@register("describe_lineitem", _describe_sql("lineitem", LINE_NUMERIC))
def q_describe_lineitem(spark: SparkSession, sf_dir: str):
    return P.describe(table(spark, sf_dir, "lineitem"), digits=6)


@register("rows_missing",
          "SELECT d.doc_id, d.lang, d.source, l.quality FROM documents d "
          "LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL")
def q_rows_missing(spark: SparkSession, sf_dir: str):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return rows_missing(docs.join(labels, "doc_id", "left"), "quality")
