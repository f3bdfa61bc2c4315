"""The report-folder flow against a pandas brute force on hand-made report files.

Report files are written the way a pull lands them: one gzip parquet file per report, an
integer game key, NaN in stats, repeated rows under different keys, overlapping columns.
"""

import math
import os

import numpy as np
import pandas as pd

from reportwide.plans.wide_table import wide_from_folder

KEYS = ["gameId", "teamId"]


def _reports():
    rng = np.random.default_rng(5)
    games = [2000020001 + i for i in range(12)]
    rows = [(g, t) for g in games for t in (1, 2)]
    summary = pd.DataFrame({"gameId": [g for g, _ in rows], "teamId": [t for _, t in rows],
                            "goals": rng.integers(0, 5, len(rows)).astype(float),
                            "shots": rng.integers(10, 40, len(rows)).astype(float)})
    summary.loc[3, "goals"] = np.nan
    # two keys share every stat value: the key-ignoring de-duplication keeps the lower key
    summary.loc[5, ["goals", "shots"]] = summary.loc[4, ["goals", "shots"]].values
    faceoff = summary[["gameId", "teamId"]].iloc[::2].copy()
    faceoff["faceoffPct"] = rng.random(len(faceoff))
    faceoff["goals"] = 99.0  # overlaps the anchor's column: the anchor wins
    shottype = summary[["gameId", "teamId"]].iloc[1:20].copy()
    shottype["shotsOnNetSlap"] = rng.integers(0, 3, len(shottype)).astype(float)
    shottype.loc[shottype.index[2], "shotsOnNetSlap"] = np.nan
    shottype["Zcol"] = 1.0
    return {"summary": summary, "faceoffpercentages": faceoff, "shottype": shottype}


def _expected(reports, order):
    frames = []
    for name in order:
        df = reports[name].copy()
        df["gameId"] = df["gameId"].astype(str)
        df = df.set_index(KEYS).sort_index()
        frames.append(df.drop_duplicates())
    wide = frames[0]
    for df in frames[1:]:
        wide = wide.join(df[df.columns.difference(wide.columns)], how="left")
    return wide.reset_index()


def test_folder_flow_matches_pandas(spark, tmp_dir):
    reports = _reports()
    root = os.path.join(tmp_dir, "team")
    os.makedirs(root)
    for name, df in reports.items():
        df.to_parquet(os.path.join(root, f"{name}_data.parquet.gzip"), compression="gzip",
                      index=False)
    order = ["summary", "faceoffpercentages", "shottype"]
    got = wide_from_folder(spark, root, KEYS, anchor="summary", key_as_string=["gameId"],
                           out=os.path.join(tmp_dir, "wide"))
    exp = _expected(reports, order)
    assert got.columns == list(exp.columns)

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return v.item() if hasattr(v, "item") else v

    got_rows = sorted((tuple(norm(v) for v in r) for r in got.collect()), key=repr)
    exp_rows = sorted((tuple(norm(v) for v in r) for r in exp.itertuples(index=False)), key=repr)
    assert got_rows == exp_rows


def test_profiles_leave_out_the_index_like_pandas(spark, tmp_dir):
    from reportwide.operators import profile as P
    reports = _reports()
    root = os.path.join(tmp_dir, "team2")
    os.makedirs(root)
    for name, df in reports.items():
        df.to_parquet(os.path.join(root, f"{name}_data.parquet.gzip"), index=False)
    got = wide_from_folder(spark, root, KEYS, anchor="summary", key_as_string=["gameId"])
    exp = _expected(reports, ["summary", "faceoffpercentages", "shottype"]).set_index(KEYS)
    assert tuple(P.shape(got, exclude=KEYS).first()) == exp.shape
    nulls = {r["column_name"]: r["null_count"] for r in P.null_counts(got, exclude=KEYS).collect()}
    assert nulls == exp.isnull().sum().to_dict()
    d = {r["column_name"]: r for r in P.describe(got, exclude=KEYS).collect()}
    pd_desc = exp.describe()
    assert sorted(d) == sorted(pd_desc.columns)
    for c in pd_desc.columns:
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("p50", "50%"), ("max", "max")):
            a, b = d[c][ours], pd_desc[c][theirs]
            assert (a is None and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9), (c, ours)
