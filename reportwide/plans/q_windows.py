"""Date windows, window assignment and the request plan over the orders table
(D1-D10, F1, F2, J4, J5)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reportwide.functions import dates as D
from reportwide.operators.windows import assign_windows, request_plan
from reportwide.plans.registry import register, table

# The team report catalogue, in the order the request planner lists it.
TEAM_REPORTS = ("summary", "daysbetweengames", "faceoffpercentages", "faceoffwins",
                "goalsagainstbystrength", "goalsbyperiod", "goalsforbystrength",
                "leadingtrailing", "realtime", "outshootoutshotby", "penalties", "penaltykill",
                "penaltykilltime", "powerplay", "summaryshooting", "scoretrailfirst", "shootout",
                "shottype", "goalgames", "powerplaytime", "percentages")

# A neutral request template with the same positional fields as the reference's:
# {0} report, {1} page offset, {2} window start, {3} window end.
URL_TEMPLATE = "https://warehouse.example.org/export/{0}.json?from_date={2}&to_date={3}&offset={1}&size=100"

FIELD, EXTRA = "o_orderdate", "o_orderstatus='F'"


def _first_orders(spark, sf_dir):
    """One row per customer: first order date and number of orders."""
    return (table(spark, sf_dir, "orders").groupBy("o_custkey")
            .agg(F.min("o_orderdate").alias("first_order"), F.count(F.lit(1)).alias("n_orders")))


FIRST_SQL = ("SELECT o_custkey, min(o_orderdate) AS first_order, count(*) AS n_orders "
             "FROM orders GROUP BY o_custkey")

PRED_SQL = ("'{f}<=\"' || strftime(win_end, '%Y-%m-%d') || ' 23:59:59\" and {f}>=\"' || "
            "strftime(win_start, '%Y-%m-%d') || '\" and {x}'").format(f=FIELD, x=EXTRA.replace("'", "''"))

WCOLS = "o_custkey, i, win_start, win_end, predicate"


def _out(df):
    return df.select("o_custkey", "i", "win_start", "win_end", "predicate")


# Day windows: 7 days each, as many as the customer has orders.
@register("windows_days",
          f"WITH f AS ({FIRST_SQL}), g AS (SELECT o_custkey, CAST(i AS INTEGER) AS i, "
          "CAST(CAST(first_order AS DATE) + INTERVAL (i * 7) DAY AS DATE) AS win_start "
          "FROM f, unnest(range(n_orders)) AS t(i)), h AS (SELECT *, CAST(win_start + "
          f"INTERVAL 7 DAY AS DATE) AS win_end FROM g) SELECT {WCOLS} FROM (SELECT *, {PRED_SQL} "
          "AS predicate FROM h)")
def q_windows_days(spark: SparkSession, sf_dir: str):
    f = _first_orders(spark, sf_dir)
    return _out(D.date_windows(f, "first_order", "days", 7, F.col("n_orders").cast("int"),
                               FIELD, EXTRA))


_MONTH_RUNMIN = (
    "min(day(last_day(date_trunc('month', CAST(first_order AS DATE)) + INTERVAL ({step}) MONTH)))"
    " OVER (PARTITION BY o_custkey ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


def _clamped_sql(step_months: str, end_sql: str) -> str:
    return (f"WITH f AS ({FIRST_SQL}), g AS (SELECT o_custkey, first_order, "
            "CAST(i AS INTEGER) AS i FROM f, unnest(range(n_orders)) AS t(i)), "
            "h AS (SELECT o_custkey, i, make_date(year(m), month(m), "
            "least(day(first_order), runmin)) AS win_start FROM (SELECT *, "
            f"CAST(date_trunc('month', CAST(first_order AS DATE)) + INTERVAL ({step_months}) MONTH "
            f"AS DATE) AS m, {_MONTH_RUNMIN.format(step=step_months)} AS runmin FROM g)), "
            f"k AS (SELECT *, {end_sql} AS win_end FROM h) "
            f"SELECT {WCOLS} FROM (SELECT *, {PRED_SQL} AS predicate FROM k)")


# Month windows: one month step, the end is the last day of the start's month.
@register("windows_months", _clamped_sql("i", "last_day(win_start)"))
def q_windows_months(spark: SparkSession, sf_dir: str):
    f = _first_orders(spark, sf_dir)
    return _out(D.date_windows(f, "first_order", "months", 1, F.col("n_orders").cast("int"),
                               FIELD, EXTRA))


# Year windows: two-year step, the end is 31 December of start + 2 years.
@register("windows_years", _clamped_sql("i * 24", "make_date(year(win_start) + 2, 12, 31)"))
def q_windows_years(spark: SparkSession, sf_dir: str):
    f = _first_orders(spark, sf_dir)
    return _out(D.date_windows(f, "first_order", "years", 2, F.col("n_orders").cast("int"),
                               FIELD, EXTRA))


NOW_SQL = "(SELECT max(o_orderdate) FROM orders)"


@register("windows_until",
          f"WITH f AS ({FIRST_SQL}), g AS (SELECT o_custkey, first_order, CAST(i AS INTEGER) AS i "
          "FROM f, unnest(range(180)) AS t(i)), h AS (SELECT o_custkey, i, make_date(year(m), "
          "month(m), least(day(first_order), runmin)) AS win_start FROM (SELECT *, "
          "CAST(date_trunc('month', CAST(first_order AS DATE)) + INTERVAL (i) MONTH AS DATE) AS m, "
          f"{_MONTH_RUNMIN.format(step='i')} AS runmin FROM g)) "
          "SELECT o_custkey, i, win_start, CAST(win_start + INTERVAL 1 MONTH - INTERVAL 1 DAY "
          f"AS DATE) AS win_end FROM h WHERE i = 0 OR CAST(win_start AS TIMESTAMP) <= {NOW_SQL}")
def q_windows_until(spark: SparkSession, sf_dir: str):
    orders = table(spark, sf_dir, "orders")
    now = orders.agg(F.max("o_orderdate")).scalar()
    f = _first_orders(spark, sf_dir)
    return D.month_windows_until(f, "first_order", now).select(
        "o_custkey", "i", "win_start", "win_end")


# D1-D6 on a date that arrives as text.
@register("date_columns",
          "SELECT o_orderkey, d AS day, last_day(d) AS month_end, make_date(year(d), 12, 31) AS year_end, "
          "CAST(d + INTERVAL 45 DAY AS DATE) AS plus_days, CAST(d + INTERVAL 13 MONTH AS DATE) AS plus_months, "
          "CAST(d + INTERVAL 3 YEAR AS DATE) AS plus_years, strftime(d, '%Y_%m_%d') AS stamp, "
          "strftime(d, '%Y-%m-%d') || ' 23:59:59' AS day_end, "
          "CAST(datediff('day', d, make_date(year(d), 12, 31)) + 1 AS INTEGER) AS days_left "
          "FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def q_date_columns(spark: SparkSession, sf_dir: str):
    text = table(spark, sf_dir, "orders").select("o_orderkey", D.format_day("o_orderdate").alias("text"))
    return text.select("o_orderkey", D.parse_date("text").alias("day")).select(
        "o_orderkey", "day", D.last_day_of_month("day").alias("month_end"),
        D.last_day_of_year("day").alias("year_end"), D.add_interval("day", "days", 45).alias("plus_days"),
        D.add_interval("day", "months", 13).alias("plus_months"),
        D.add_interval("day", "years", 3).alias("plus_years"), D.format_stamp("day").alias("stamp"),
        D.format_end_of_day("day").alias("day_end"),
        D.days_inclusive("day", D.last_day_of_year("day")).alias("days_left"))


MONTHS_SQL = ("SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start "
              "FROM orders")


@register("days_until",
          f"WITH m AS ({MONTHS_SQL}) SELECT month_start, CAST(d AS DATE) AS day FROM m, "
          "unnest(generate_series(CAST(month_start AS TIMESTAMP), CAST(month_start + INTERVAL 1 "
          "MONTH AS TIMESTAMP) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS t(d)")
def q_days_until(spark: SparkSession, sf_dir: str):
    months = (table(spark, sf_dir, "orders")
              .select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month_start"))
              .distinct())
    now = F.add_months("month_start", 1)
    return D.days_until(months, "month_start", now, out="day").select("month_start", "day")


def _span_windows(spark, sf_dir):
    """Month windows covering the orders table: from its first month, one per month spanned."""
    orders = table(spark, sf_dir, "orders")
    span = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    span = span.withColumn("n", (F.months_between(F.trunc("hi", "month"), F.trunc("lo", "month"))
                                 .cast("int") + 1))
    return D.date_windows(span, "lo", "months", 1, F.col("n"), FIELD, EXTRA)


SPAN_SQL = ("SELECT CAST(i AS INTEGER) AS i, CAST(date_trunc('month', lo) + INTERVAL (i) MONTH "
            "AS DATE) AS win_start FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi "
            "FROM orders), unnest(range(datediff('month', date_trunc('month', lo), "
            "date_trunc('month', hi)) + 1)) AS t(i)")


@register("window_assign",
          f"WITH w AS (SELECT i, win_start, last_day(win_start) AS win_end FROM ({SPAN_SQL})) "
          "SELECT o.o_orderkey, o.o_orderdate, w.i, w.win_start, w.win_end FROM orders o JOIN w "
          "ON o.o_orderdate >= w.win_start AND o.o_orderdate < w.win_end + INTERVAL 1 DAY")
def q_window_assign(spark: SparkSession, sf_dir: str):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    w = _span_windows(spark, sf_dir).select("i", "win_start", "win_end")
    return assign_windows(orders, "o_orderdate", w).select(
        "o_orderkey", "o_orderdate", "i", "win_start", "win_end")


def _template_sql() -> str:
    # DuckDB form of the template: positional pieces joined with ||.
    t = URL_TEMPLATE.replace("'", "''")
    for k, expr in (("{0}", "' || report || '"), ("{1}", "' || CAST(page_start AS VARCHAR) || '"),
                    ("{2}", "' || strftime(win_start, '%Y-%m-%d') || '"),
                    ("{3}", "' || strftime(win_end, '%Y-%m-%d') || '")):
        t = t.replace(k, expr)
    return f"'{t}'"


_REPORTS_SQL = ", ".join(f"'{r}'" for r in TEAM_REPORTS)


@register("request_plan",
          f"WITH w AS (SELECT i, win_start, last_day(win_start) AS win_end FROM ({SPAN_SQL})), "
          f"r AS (SELECT unnest([{_REPORTS_SQL}]) AS report), "
          "x AS (SELECT w.*, r.report, CAST(datediff('day', win_start, win_end) + 1 AS INTEGER) "
          "AS n_days FROM w, r), p AS (SELECT x.*, CAST(page_start AS INTEGER) AS page_start FROM x, "
          "unnest(range(0, n_days * 260, 100)) AS t(page_start)) "
          f"SELECT report, i, win_start, win_end, n_days, page_start, {_template_sql()} AS url FROM p")
def q_request_plan(spark: SparkSession, sf_dir: str):
    w = _span_windows(spark, sf_dir).select("i", "win_start", "win_end")
    return request_plan(w, TEAM_REPORTS, URL_TEMPLATE).select(
        "report", "i", "win_start", "win_end", "n_days", "page_start", "url")
