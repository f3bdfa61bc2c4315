import math
import random

import numpy as np
import pandas as pd
import pytest

from reportwide.operators import profile as P


@pytest.fixture()
def frame(spark):
    data = [(1, 2.0, "a", None), (2, float("nan"), None, None), (3, 4.5, "c", None),
            (4, None, "d", None)]
    return spark.createDataFrame(data, "k int, x double, s string, z double")


def test_null_counts_count_nan(frame):
    got = {r["column_name"]: r["null_count"] for r in P.null_counts(frame).collect()}
    assert got == {"k": 0, "x": 2, "s": 1, "z": 4}


def test_all_null_columns_default_and_threshold(frame):
    assert [r[0] for r in P.all_null_columns(frame).collect()] == ["z"]
    assert sorted(r[0] for r in P.all_null_columns(frame, threshold=2).collect()) == ["x"]


def test_shape_and_schema(frame):
    assert tuple(P.shape(frame).first()) == (4, 4)
    prof = {r["column_name"]: (r["non_null_count"], r["dtype"]) for r in P.schema_profile(frame).collect()}
    assert prof == {"k": (4, "int"), "x": (2, "double"), "s": (3, "string"), "z": (0, "double")}


def test_describe_matches_pandas(spark):
    rnd = random.Random(7)
    vals = [rnd.choice([None, float("nan")]) if rnd.random() < 0.1 else rnd.gauss(0, 10)
            for _ in range(500)]
    ints = [rnd.randint(-5, 5) for _ in range(500)]
    df = spark.createDataFrame(list(zip(vals, ints)), "x double, i bigint")
    got = {r["column_name"]: r for r in P.describe(df).collect()}
    pdf = pd.DataFrame({"x": [np.nan if v is None else v for v in vals], "i": ints}).describe()
    for c in ("x", "i"):
        exp = pdf[c]
        r = got[c]
        assert r["count"] == exp["count"]
        for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert math.isclose(r[ours], exp[theirs], rel_tol=1e-9, abs_tol=1e-9), (c, ours)


@pytest.mark.parametrize("kind", ["gauss", "ties", "magnitudes", "negative_ints"])
def test_exact_quantiles_multi_round_equals_numpy(spark, kind):
    rnd = random.Random(hash(kind) % 1000)
    n = 3000
    if kind == "gauss":
        vals = [rnd.gauss(5, 3) for _ in range(n)]
    elif kind == "ties":
        vals = [float(rnd.choice([1, 1, 1, 2, 3, 1000])) for _ in range(n)]
    elif kind == "magnitudes":
        vals = [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-300, 300) for _ in range(n)]
    else:
        vals = [float(rnd.randint(-50, 50)) for _ in range(n)]
    df = spark.createDataFrame([("c", v) for v in vals] + [("d", v * 2) for v in vals[:100]],
                               "column_name string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    # Tiny bins and final_rows force several histogram rounds.
    got = {(r["column_name"], r["p"]): r["value"]
           for r in P.exact_quantiles(df, probs, bins=4, final_rows=7).collect()}
    for c, arr in (("c", np.array(vals)), ("d", np.array(vals[:100]) * 2)):
        for p in probs:
            exp = float(np.percentile(arr, p * 100))
            assert math.isclose(got[(c, p)], exp, rel_tol=1e-12, abs_tol=1e-300), (kind, c, p)


def test_describe_approx_is_close(spark):
    df = spark.range(10000).selectExpr("CAST(id AS DOUBLE) AS v")
    r = P.describe(df, method="approx").first()
    assert abs(r["p50"] - 4999.5) < 20


def test_batched_profile_equals_one_pass(spark, tmp_dir, monkeypatch):
    df = spark.range(200).selectExpr(
        *[f"CASE WHEN id % {j + 2} = 0 THEN NULL ELSE id * {j} END AS c{j}" for j in range(12)],
        "CASE WHEN id % 5 = 0 THEN double('NaN') ELSE 1.0 END AS x")
    df.write.parquet(f"{tmp_dir}/wide")
    src = spark.read.parquet(f"{tmp_dir}/wide")
    one = sorted(map(tuple, P.schema_profile(src).collect()))
    monkeypatch.setattr(P, "PROFILE_BATCH", 5)
    batched = sorted(map(tuple, P.schema_profile(src).collect()))
    assert one == batched
    assert P.schema_profile(src)._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 3
    assert sorted(map(tuple, P.null_counts(src).collect()))[-1] == (12, "x", 40)
