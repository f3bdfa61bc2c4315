"""Window assignment and request planning.

``assign_windows`` is a range join written as an equi-join: each window is expanded into the
calendar buckets (months by default) it touches, rows join on their own bucket, and the exact
range test runs after the join. The expanded windows are computed once and counted: up to
``BROADCAST_WINDOWS`` rows they are broadcast and the row side is not shuffled; beyond that both
sides are shuffled on the bucket and AQE splits a hot bucket on the row side. A row can meet
zero, one or two windows when windows leave gaps or overlap.

``request_plan`` builds report x window x page rows with ``explode`` over a literal report
list and over page offsets, which keeps every step row-local (no join at all).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportwide.functions.dates import days_inclusive, format_day, page_starts
from reportwide.operators.wide import col
from reportwide.session import checkpoint_dir

BUCKETS = {"day": "day", "week": "week", "month": "month", "year": "year"}

# Most (window, bucket) rows that are broadcast.
BROADCAST_WINDOWS = 10_000


def assign_windows(rows: DataFrame, ts: str, windows: DataFrame, start: str = "win_start",
                   end: str = "win_end", end_inclusive_day: bool = True,
                   bucket: str = "month", broadcast_rows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Pair each row with every window that contains its time.

    With ``end_inclusive_day`` the window covers [start, end + 1 day), i.e. whole days. Windows
    of at most ``broadcast_rows`` rows, one for each bucket they touch, are broadcast.
    """
    unit = BUCKETS[bucket]
    w_start = F.col(start).cast("timestamp_ntz")
    w_end = (F.date_add(F.col(end), 1) if end_inclusive_day else F.col(end)).cast("timestamp_ntz")
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    first = F.date_trunc(unit, w_start)
    last = F.date_trunc(unit, w_end - F.expr("INTERVAL 1 MICROSECOND"))
    # A window that ends before it starts covers no bucket (and meets no row).
    buckets = F.when(first <= last, F.sequence(first, last, step)).otherwise(
        F.array().cast("array<timestamp_ntz>"))
    wx = (windows.withColumn("__ws", w_start).withColumn("__we", w_end)
          .withColumn("__b", F.explode(buckets)))
    checkpoint_dir(windows.sparkSession)
    wx = wx.checkpoint(eager=True)
    if wx.limit(broadcast_rows + 1).count() <= broadcast_rows:
        wx = F.broadcast(wx)
    rx =rows.withColumn("__b", F.date_trunc(unit, col(ts).cast("timestamp_ntz")))
    j = rx.join(wx, "__b")
    t = col(ts).cast("timestamp_ntz")
    return j.filter((t >= F.col("__ws")) & (t < F.col("__we"))).drop("__b", "__ws", "__we")


def _positional(template: str) -> str:
    """'{0}/{1}' -> '%1$s/%2$s' for format_string; literal % doubled."""
    t = template.replace("%", "%%")
    return re.sub(r"\{(\d+)\}", lambda m: f"%{int(m.group(1)) + 1}$s", t)


def fill_template(template: str, *args: Column | str) -> Column:
    """positional fill of a text template such as a request URL."""
    return F.format_string(_positional(template), *[col(a) if isinstance(a, str) else a
                                                    for a in args])


def request_plan(windows: DataFrame, reports: Sequence[str], template: str,
                 rows_per_day: int = 260, page_size: int = 100, start: str = "win_start",
                 end: str = "win_end") -> DataFrame:
    """Report x window x page request rows with their URL.

    Template fields: {0} report, {1} page offset, {2} window start, {3} window end.
    """
    out = windows.withColumn("report", F.explode(F.array(*[F.lit(r) for r in reports])))
    out = out.withColumn("n_days", days_inclusive(start, end))
    out = out.withColumn("page_start", F.explode(page_starts("n_days", rows_per_day, page_size)))
    return out.withColumn("url", fill_template(
        template, F.col("report"), F.col("page_start").cast("string"), format_day(start),
        format_day(end)))
