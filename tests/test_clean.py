import math

from reportwide.operators.clean import (dedup_ignoring_keys, dedup_strict, keys_to_string,
                                        nan_to_null, replace_with_null, rows_missing)


def test_dedup_ignoring_keys_keeps_lowest_text_key(spark):
    df = spark.createDataFrame([("10", 1, 5.0), ("9", 1, 5.0), ("2", 2, 5.0), ("3", 1, 6.0)],
                               "g string, t int, v double")
    out = sorted(map(tuple, dedup_ignoring_keys(df, ["g"]).collect()))
    # ("10",1,5.0) and ("9",1,5.0) share every non-key value; "10" < "9" as text.
    assert out == [("10", 1, 5.0), ("2", 2, 5.0), ("3", 1, 6.0)]
    assert dedup_ignoring_keys(df, ["g"]).columns == ["g", "t", "v"]
    # With both columns as keys only v is compared: all 5.0 rows collapse to the lowest key.
    both = sorted(map(tuple, dedup_ignoring_keys(df, ["g", "t"]).collect()))
    assert both == [("10", 1, 5.0), ("3", 1, 6.0)]


def test_dedup_ignoring_keys_puts_missing_keys_last(spark):
    df = spark.createDataFrame([(None, 1.0), ("b", 1.0)], "g string, v double")
    assert [tuple(r) for r in dedup_ignoring_keys(df, ["g"]).collect()] == [("b", 1.0)]


def test_nan_and_null_are_one_missing_kind(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "k int, v double")
    clean = nan_to_null(df)
    assert clean.filter("v IS NULL").count() == 2
    assert dedup_ignoring_keys(clean, ["k"]).count() == 2
    assert rows_missing(df, "v").count() == 2  # NaN counted as missing before conversion too


def test_strict_keeps_one_copy(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "k int, s string")
    assert dedup_strict(df).count() == 2


def test_key_cast_keeps_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "g bigint")
    assert sorted(map(tuple, keys_to_string(df, ["g"]).collect()), key=str) == [("1",), (None,)]


def test_marker_to_null(spark):
    df = spark.createDataFrame([("NaN",), ("3",)], "s string")
    out = [r[0] for r in replace_with_null(df, ["s"]).collect()]
    assert sorted(out, key=str) == ["3", None]
    assert not any(isinstance(x, float) and math.isnan(x) for x in out)
