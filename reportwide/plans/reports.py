"""Keyed report tables derived from the driver tables.

A report is a filter plus a set of aggregates over a source table, grouped by the report
keys. Aggregates are SQL expression text, so the same definition drives the Spark plan
(``F.expr``) and the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportwide.operators.clean import clean_report
from reportwide.operators.wide import JOINS_PER_STAGE, wide_join
from reportwide.session import settings, work_path
from reportwide.sources.sinks import GROUP_SORTED, write_bucketed


@dataclass(frozen=True)
class Report:
    name: str
    where: str | None
    aggs: tuple[tuple[str, str], ...]  # (alias, SQL aggregate expression)
    # Columns that every report repeats; the anchor's copy wins in the wide join.
    shared: tuple[str, ...] = field(default=())


@dataclass(frozen=True)
class ReportSet:
    source: str
    # (key name, SQL expression over the source)
    keys: tuple[tuple[str, str], ...]
    reports: tuple[Report, ...]
    key_as_string: tuple[str, ...] = ()
    parity_dedup: bool = True

    @property
    def key_names(self) -> list[str]:
        return [k for k, _ in self.keys]


def build_report(src: DataFrame, rs: ReportSet, rep: Report) -> DataFrame:
    df = src.filter(F.expr(rep.where)) if rep.where else src
    df = df.groupBy(*[F.expr(e).alias(k) for k, e in rs.keys]).agg(
        *[F.expr(e).alias(a) for a, e in rep.aggs])
    return clean_report(df, rs.key_names, key_as_string=rs.key_as_string, parity=rs.parity_dedup)


# Row groups of a saved source: one task of the wide join holds one of every report at a time.
SOURCE_BLOCK = 16 << 20


def buckets_of(spark: SparkSession) -> int:
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def sorted_source(src: DataFrame, rs: ReportSet, base: str, buckets: int) -> Iterator[DataFrame]:
    """The source saved once, bucketed and sorted by the report keys. While the context holds, reports
    built on it are grouped where their rows lie, in key order: without an exchange, hash table or sort."""
    spark = src.sparkSession
    name = write_bucketed(src, f"source_{base.rstrip('/').rsplit('-', 1)[-1]}", rs.key_names, buckets,
                          path=f"{base}/source", block_bytes=SOURCE_BLOCK)
    try:
        with settings(spark, GROUP_SORTED):
            yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files are in the work folder; only the name goes


def keeps_source_order(rs: ReportSet) -> bool:
    """Whether the set's reports come out in the key order of their source: its keys are columns taken as
    they are, and the de-duplication groups by the keys too."""
    return not rs.parity_dedup and not rs.key_as_string and all(k == e for k, e in rs.keys)


def build_wide(src: DataFrame, rs: ReportSet, reports: Sequence[Report] | None = None) -> DataFrame:
    """The wide table of a source's reports. Chains longer than ``JOINS_PER_STAGE`` run on a sorted
    source, if the reports keep its order: every join finds both sides in place and in order, so that
    none holds a sorter and all run in one stage, without a checkpoint of the running table between."""
    reps = list(reports or rs.reports)
    # Every report is an aggregate grouped by the join keys, so the anchor holds one row per
    # key and no key can be hot: the hot-key check is skipped.
    if len(reps) - 1 <= JOINS_PER_STAGE or not keeps_source_order(rs):
        return wide_join([build_report(src, rs, r) for r in reps], rs.key_names, hot_share=None)
    spark = src.sparkSession
    base = work_path(spark, "wide_sorted")
    with sorted_source(src, rs, base, buckets_of(spark)) as s:
        wide = wide_join([build_report(s, rs, r) for r in reps], rs.key_names, hot_share=None, joins_per_stage=0)
        wide.write.parquet(f"{base}/wide")
    return spark.read.parquet(f"{base}/wide")


# ---- DuckDB oracle text for the same definitions -------------------------------------------

def _report_cte(rs: ReportSet, rep: Report) -> str:
    keys_sel = ", ".join(
        (f"CAST({e} AS VARCHAR) AS {k}" if k in rs.key_as_string else f"{e} AS {k}")
        for k, e in rs.keys)
    aggs = ", ".join(f"{e} AS {a}" for a, e in rep.aggs)
    where = f" WHERE {rep.where}" if rep.where else ""
    grp = ", ".join(str(i + 1) for i in range(len(rs.keys)))
    raw = f"SELECT {keys_sel}, {aggs} FROM {rs.source}{where} GROUP BY {grp}"
    if not rs.parity_dedup:
        return f"{rep.name} AS (SELECT DISTINCT * FROM ({raw}))"
    others = ", ".join(a for a, _ in rep.aggs)
    order = ", ".join(f"{k} ASC NULLS LAST" for k in rs.key_names)
    return (f"{rep.name} AS (SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {others} ORDER BY {order}) AS __rn FROM ({raw})) WHERE __rn = 1)")


def wide_sql(rs: ReportSet, reports: Sequence[Report] | None = None) -> str:
    reps = list(reports or rs.reports)
    ctes = ",\n".join(_report_cte(rs, r) for r in reps)
    have = set(rs.key_names) | {a for a, _ in reps[0].aggs}
    select = [f"{reps[0].name}.*"]
    joins = []
    for r in reps[1:]:
        add = sorted({a for a, _ in r.aggs} - have)
        have |= set(add)
        select += [f"{r.name}.{c}" for c in add]
        joins.append(f"LEFT JOIN {r.name} USING ({', '.join(rs.key_names)})")
    return f"WITH {ctes}\nSELECT {', '.join(select)} FROM {reps[0].name} " + " ".join(joins)


# ---- fixed report sets ---------------------------------------------------------------------

# The five event types present in the events table.
EVENT_TYPES = ("view", "click", "purchase", "signup", "error")


def _event_report(t: str) -> Report:
    return Report(
        name=f"r_{t}", where=f"event_type = '{t}'",
        aggs=(("n_events", "count(*)"),
              (f"{t}_count", "count(*)"),
              (f"{t}_value", "round(sum(value), 2)"),
              (f"{t}_max", "max(value)")),
        shared=("n_events",))


EVENTS_REPORTS = ReportSet(
    source="events",
    keys=(("user_id", "user_id"), ("day", "CAST(ts AS DATE)")),
    key_as_string=("user_id",),
    reports=(Report(name="r_summary", where=None,
                    aggs=(("n_events", "count(*)"),
                          ("total_value", "round(sum(value), 2)"),
                          ("max_value", "max(value)"))),)
    + tuple(_event_report(t) for t in EVENT_TYPES),
)

# The columns of lineitem that its reports read.
LINE_COLUMNS = ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                "l_returnflag", "l_linestatus", "l_shipdate")
# Return flag / line status pairs and ship years of the lineitem table.
LINE_FLAGS = (("A", "F"), ("A", "O"), ("N", "F"), ("N", "O"), ("R", "F"), ("R", "O"))
SHIP_YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)


def _line_report(name: str, where: str, tag: str) -> Report:
    return Report(
        name=name, where=where,
        aggs=(("n_lines", "count(*)"),
              (f"{tag}_lines", "count(*)"),
              (f"{tag}_qty", "sum(l_quantity)"),
              (f"{tag}_price", "round(sum(l_extendedprice), 2)"),
              (f"{tag}_maxdisc", "max(l_discount)")),
        shared=("n_lines",))


LINEITEM_REPORTS = ReportSet(
    source="lineitem",
    keys=(("l_partkey", "l_partkey"), ("l_suppkey", "l_suppkey")),
    parity_dedup=False,
    reports=(Report(name="r_all", where=None,
                    aggs=(("n_lines", "count(*)"),
                          ("qty", "sum(l_quantity)"),
                          ("revenue", "round(sum(l_extendedprice * (1 - l_discount)), 4)"))),)
    + tuple(_line_report(f"r_{f}{s}", f"l_returnflag = '{f}' AND l_linestatus = '{s}'", f"{f}{s}")
            for f, s in LINE_FLAGS)
    # Ship-year reports filter on a plain range so the parquet reader can skip row groups.
    + tuple(_line_report(f"r_y{y}", f"l_shipdate >= '{y}-01-01' AND l_shipdate < '{y + 1}-01-01'",
                         f"y{y}") for y in SHIP_YEARS),
)


def wide_columns(rs: ReportSet, reports: Sequence[Report] | None = None) -> list[tuple[str, str]]:
    """(name, Spark type) of the wide table's columns, in output order."""
    reps = list(reports or rs.reports)

    def agg_type(expr: str) -> str:
        return "bigint" if expr.lower().startswith("count(") else "double"

    key_types = {"CAST(ts AS DATE)": "date"}
    out = [(k, "string" if k in rs.key_as_string else key_types.get(e, "bigint")) for k, e in rs.keys]
    out += [(a, agg_type(e)) for a, e in reps[0].aggs]
    have = {n for n, _ in out}
    for r in reps[1:]:
        types = {a: agg_type(e) for a, e in r.aggs}
        for a in sorted(set(types) - have):
            out.append((a, types[a]))
            have.add(a)
    return out


# The line numbers present in the lineitem table.
LINE_NUMBERS = (1, 2, 3, 4, 5, 6, 7)

# Twenty-one report tables, the width of the reference's wide table: the 14 above plus one
# report per line number (20 left joins, so the chain is cut by a checkpoint).
LINEITEM_REPORTS_21 = ReportSet(
    source="lineitem",
    keys=LINEITEM_REPORTS.keys,
    parity_dedup=False,
    reports=LINEITEM_REPORTS.reports
    + tuple(_line_report(f"r_n{n}", f"l_linenumber = {n}", f"n{n}") for n in LINE_NUMBERS),
)
