"""Property checks: profile invariants and de-duplication against plain Python."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reportwide.operators import profile as P
from reportwide.operators.clean import dedup_ignoring_keys, nan_to_null

vals = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=False, width=32),
                 st.integers(-3, 3).map(float))
rows = st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None]), vals),
                min_size=0, max_size=25)

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(data=rows)
def test_null_plus_non_null_is_row_count(spark, data):
    df = spark.createDataFrame(data, "k int, s string, v double")
    nulls = {r["column_name"]: r["null_count"] for r in P.null_counts(df).collect()}
    prof = {r["column_name"]: r["non_null_count"] for r in P.schema_profile(df).collect()}
    for c in df.columns:
        assert nulls[c] + prof[c] == len(data)
    exp_v = sum(1 for _, _, v in data if v is None or math.isnan(v))
    assert nulls["v"] == exp_v


@SETTINGS
@given(data=rows)
def test_dedup_ignoring_keys_matches_python(spark, data):
    df = nan_to_null(spark.createDataFrame(data, "k int, s string, v double"))
    got = sorted((tuple(r) for r in dedup_ignoring_keys(df, ["k"]).collect()), key=repr)
    best = {}
    for k, s, v in data:
        v = None if v is not None and math.isnan(v) else v
        if (s, v) not in best or k < best[(s, v)]:
            best[(s, v)] = k
    exp = sorted(((k, s, v) for (s, v), k in best.items()), key=repr)
    norm = lambda t: (t[0], t[1], None if t[2] is None else t[2] + 0.0)  # noqa: E731 (-0.0)
    assert sorted(map(repr, map(norm, got))) == sorted(map(repr, map(norm, exp)))
