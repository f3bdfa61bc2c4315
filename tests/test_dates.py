import calendar
import datetime as dt

import pytest
from pyspark.sql import functions as F

from reportwide.functions import dates as D


def _add_months(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.month - 1 + n, 12)
    y, m = d.year + y, m + 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def _brute(start: dt.date, unit: str, value: int, n: int):
    """Step-by-step calendar arithmetic: each start is the previous one advanced."""
    out, cur = [], start
    for i in range(n):
        if unit == "days":
            end = cur + dt.timedelta(days=value)
        elif unit == "months":
            end = dt.date(cur.year, cur.month, calendar.monthrange(cur.year, cur.month)[1])
        else:
            end = dt.date(_add_months(cur, 12 * value).year, 12, 31)
        out.append((i, cur, end))
        cur = (cur + dt.timedelta(days=value) if unit == "days"
               else _add_months(cur, value if unit == "months" else 12 * value))
    return out


@pytest.mark.parametrize("start", ["2024-01-31", "2023-01-29", "2000-10-01", "2024-02-29",
                                   "2023-12-30"])
@pytest.mark.parametrize("unit,value", [("days", 1), ("days", 7), ("months", 1),
                                        ("months", 2), ("years", 1), ("years", 3)])
def test_date_windows_rules(spark, start, unit, value):
    df = spark.createDataFrame([(dt.date.fromisoformat(start),)], "s date")
    got = [(r["i"], r["win_start"], r["win_end"])
           for r in D.date_windows(df, "s", unit, value, 14, field="d").orderBy("i").collect()]
    assert got == _brute(dt.date.fromisoformat(start), unit, value, 14)


def test_month_clamp_sticks(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),)], "s date")
    starts = [r["win_start"] for r in D.date_windows(df, "s", "months", 1, 3).orderBy("i").collect()]
    assert starts == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 29)]


def test_unknown_unit_fails_before_spark(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),)], "s date")
    with pytest.raises(ValueError):
        D.date_windows(df, "s", "weeks", 1, 3)


def test_predicate_text(spark):
    df = spark.createDataFrame([(dt.date(2000, 10, 1),)], "s date")
    r = D.date_windows(df, "s", "months", 1, 1, field="gameDate", extra="gameTypeId=2").first()
    assert r["predicate"] == ('gameDate<="2000-10-31 23:59:59" and gameDate>="2000-10-01" '
                              'and gameTypeId=2')


def test_month_windows_until(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),)], "s date")
    now = F.lit(dt.datetime(2024, 4, 15, 12, 0))
    got = [(r["win_start"], r["win_end"]) for r in
           D.month_windows_until(df, "s", now).orderBy("i").collect()]
    assert got == [(dt.date(2024, 1, 31), dt.date(2024, 2, 28)),
                   (dt.date(2024, 2, 29), dt.date(2024, 3, 28)),
                   (dt.date(2024, 3, 29), dt.date(2024, 4, 28))]
    # the first window is kept even when it starts after now; the cap holds
    late = D.month_windows_until(df, "s", F.lit(dt.datetime(2000, 1, 1)))
    assert late.count() == 1
    assert D.month_windows_until(df, "s", F.lit(dt.datetime(2100, 1, 1)), max_windows=180).count() == 180


def test_days_until_and_pages(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30),)], "s date")
    days = [r["day"] for r in D.days_until(df, "s", F.lit(dt.datetime(2024, 2, 2, 0, 0))).collect()]
    assert days == [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    assert D.days_until(df, "s", F.lit(dt.datetime(2024, 1, 1))).count() == 0
    n = spark.range(1).select(D.page_starts(F.lit(31)).alias("p")).first()["p"]
    assert n == list(range(0, 31 * 260, 100)) and len(n) == 81


def test_scalar_date_helpers(spark):
    r = spark.range(1).select(
        D.last_day_of_month(F.lit(dt.date(2023, 2, 10))).alias("a"),
        D.last_day_of_year(F.lit(dt.date(2023, 2, 10))).alias("b"),
        D.days_inclusive(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 31))).alias("c"),
        D.format_stamp(F.lit(dt.date(2024, 3, 5))).alias("d"),
        D.add_interval(F.lit(dt.date(2024, 2, 29)), "years", 1).alias("e"),
        D.parse_date(F.lit("2024-03-05")).alias("f")).first()
    assert tuple(r) == (dt.date(2023, 2, 28), dt.date(2023, 12, 31), 31, "2024_03_05",
                        dt.date(2025, 2, 28), dt.date(2024, 3, 5))
