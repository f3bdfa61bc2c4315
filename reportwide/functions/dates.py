"""Date functions and date-window generators.

All of them are Spark column expressions or row-local ``explode(sequence(..))`` steps, so a
table of starting points turns into a table of windows inside the same stage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportwide.operators.wide import col

Colish = Column | str


def _c(x: Colish) -> Column:
    return col(x) if isinstance(x, str) else x


def _lit_date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def last_day_of_month(d: Colish) -> Column:
    """D1."""
    return F.last_day(_c(d))


def parse_date(s: Colish, fmt: str = "yyyy-MM-dd") -> Column:
    """D2."""
    return F.to_date(_c(s), fmt)


def format_day(d: Colish) -> Column:
    """D3: 'yyyy-MM-dd'."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def format_end_of_day(d: Colish) -> Column:
    """D3: 'yyyy-MM-dd 23:59:59', the inclusive end of a day as text."""
    return F.concat(F.date_format(_c(d), "yyyy-MM-dd"), F.lit(" 23:59:59"))


def format_stamp(d: Colish) -> Column:
    """D3: 'yyyy_MM_dd', the file stamp form."""
    return F.date_format(_c(d), "yyyy_MM_dd")


def add_interval(d: Colish, unit: str, n: Colish | int) -> Column:
    """Add days, months or years (month ends clamp, as calendar arithmetic does)."""
    n = F.lit(n) if isinstance(n, int) else _c(n)
    if unit == "days":
        return F.date_add(_c(d), n)
    if unit == "months":
        return F.add_months(_c(d), n)
    if unit == "years":
        return F.add_months(_c(d), n * 12)
    raise ValueError(f"unknown unit {unit!r}")


def last_day_of_year(d: Colish) -> Column:
    """D5."""
    return F.make_date(F.year(_c(d)), F.lit(12), F.lit(31))


def days_inclusive(start: Colish, end: Colish) -> Column:
    """Number of days from start to end, both included."""
    return F.date_diff(_c(end), _c(start)) + 1


def window_predicate(column: str, start, end, equals: dict | None = None) -> Column:
    """Start <= column <= end (whole days, inclusive) plus equality terms.

    Written half-open (column < end + 1 day) so fractions of the last second count, and so
    the parquet reader gets two plain range filters to push down.
    """
    s, e = _lit_date(start), _lit_date(end)
    c = col(column)
    pred = (c >= s.cast("timestamp_ntz")) & (c < F.date_add(e, 1).cast("timestamp_ntz"))
    for k, v in (equals or {}).items():
        pred = pred & (col(k) == F.lit(v))
    return pred


def predicate_text(start: Colish, end: Colish, field: str, extra: str | None = None) -> Column:
    """the filter text for one window, e.g. d<="2000-10-31 23:59:59" and d>="2000-10-01"."""
    parts = [F.lit(f'{field}<="'), format_end_of_day(end),
             F.lit(f'" and {field}>="'), format_day(start), F.lit('"')]
    if extra:
        parts.append(F.lit(f" and {extra}"))
    return F.concat(*parts)


UNITS = ("days", "months", "years")


def date_windows(df: DataFrame, start: Colish, unit: str, value: int,
                 iterations: Colish | int, field: str = "date", extra: str | None = None,
                 index: str = "i") -> DataFrame:
    """``iterations`` windows per input row from a start date, advanced by ``value`` units.

    Window i starts at start advanced i times by ``value`` units; calendar clamping of day
    29-31 carries over from one step to the next (31 Jan, 29 Feb, 29 Mar, ...). Ends:
      days   - start + value days (neighbours overlap by one day)
      months - last day of the start's own month, whatever the value
      years  - 31 December of the year of start + value years
    Adds columns ``i``, ``win_start``, ``win_end`` (dates) and ``predicate`` (F1 text).
    """
    if unit not in UNITS:
        raise ValueError(f"increment unit must be one of {UNITS}, got {unit!r}")
    if value < 1:
        raise ValueError("increment value must be positive")
    s = F.to_date(_c(start))
    n = (F.lit(iterations) if isinstance(iterations, int) else _c(iterations)).cast("int")
    out = df.withColumn(index, F.explode(F.sequence(F.lit(0), F.greatest(n, F.lit(0)) - 1)))
    out = out.filter(n > 0)
    i = F.col(index)
    if unit == "days":
        ws = F.date_add(s, i * value)
        we = F.date_add(ws, value)
    elif unit == "months":
        m0 = F.trunc(s, "month")
        mi = F.add_months(m0, i * value)
        # Day 29-31 clamps stick: the day is the smallest month length met so far.
        run_min = F.array_min(F.transform(
            F.sequence(F.lit(0), i), lambda j: F.dayofmonth(F.last_day(F.add_months(m0, j * value)))))
        ws = F.make_date(F.year(mi), F.month(mi), F.least(F.dayofmonth(s), run_min))
        we = last_day_of_month(ws)
    else:
        m0 = F.trunc(s, "month")
        mi = F.add_months(m0, i * value * 12)
        run_min = F.array_min(F.transform(
            F.sequence(F.lit(0), i),
            lambda j: F.dayofmonth(F.last_day(F.add_months(m0, j * value * 12)))))
        ws = F.make_date(F.year(mi), F.month(mi), F.least(F.dayofmonth(s), run_min))
        we = last_day_of_year(add_interval(ws, "years", value))
    out = out.withColumn("win_start", ws).withColumn("win_end", we)
    return out.withColumn("predicate", predicate_text("win_start", "win_end", field, extra))


def month_windows_until(df: DataFrame, start: Colish, now: Colish, max_windows: int | None = None,
                        index: str = "i") -> DataFrame:
    """Month windows [d, d + 1 month - 1 day] from start; the first window always, then
    one more per month while its start is not after ``now``; all of them unless ``max_windows`` limits them."""
    s = F.to_date(_c(start))
    end = F.to_date(_c(now).cast("timestamp_ntz"))
    months = (F.year(end) - F.year(s)) * 12 + F.month(end) - F.month(s)
    last = F.greatest(F.coalesce(months, F.lit(0)), F.lit(0))
    if max_windows is not None:
        last = F.least(last, F.lit(max_windows - 1))
    out = df.withColumn(index, F.explode(F.sequence(F.lit(0), last)))
    i = F.col(index)
    m0 = F.trunc(s, "month")
    mi = F.add_months(m0, i)
    run_min = F.array_min(F.transform(
        F.sequence(F.lit(0), i), lambda j: F.dayofmonth(F.last_day(F.add_months(m0, j)))))
    ws = F.make_date(F.year(mi), F.month(mi), F.least(F.dayofmonth(s), run_min))
    out = out.withColumn("win_start", ws)
    out = out.filter((i == 0) | (F.col("win_start").cast("timestamp_ntz")
                                 <= _c(now).cast("timestamp_ntz")))
    return out.withColumn("win_end", F.date_sub(F.add_months(F.col("win_start"), 1), 1))


def days_until(df: DataFrame, start: Colish, now: Colish, out: str = "day") -> DataFrame:
    """Every day from start while it is before ``now``."""
    s = F.to_date(_c(start))
    last = F.to_date(_c(now))
    seq = F.when(s <= last, F.sequence(s, last)).otherwise(F.array().cast("array<date>"))
    res = df.withColumn(out, F.explode(seq))
    return res.filter(F.col(out).cast("timestamp_ntz") < _c(now).cast("timestamp_ntz"))


def page_starts(days: Colish, rows_per_day: int = 260, page_size: int = 100) -> Column:
    """Offsets 0, page_size, ... below days * rows_per_day."""
    total = _c(days) * rows_per_day
    return F.when(total > 0, F.sequence(F.lit(0), total - 1, F.lit(page_size))).otherwise(
        F.array().cast("array<int>"))
