"""The corpus operators against brute force, on small frames with odd rows and at sf0.001."""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from conftest import SF001  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from reportwide.llm import (chat_trees, class_lm, decontamination, jaccard_join, license_scan,  # noqa: E402
                            pattern_packing, quality_classifier, quality_rules, sharding, substring_dedup)
from reportwide.llm.queries import tokenizer_path  # noqa: E402

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PASSAGE = " ".join(f"shared{i}" for i in range(15))
LONG = " ".join(f"w{i % 997}x{i // 7}" for i in range(30_000))
TEXTS = [
    (1, "alpha beta " + PASSAGE + " gamma"), (2, PASSAGE + " other words here"), (3, None), (4, ""),
    (5, " \t\n"), (6, "alpha beta " + PASSAGE + " gamma"), (6, "alpha beta " + PASSAGE + " gamma"),
    (None, "null id " + PASSAGE), (7, LONG), (8, LONG + " tail"), (9, "éé x Éé\x1f y. MIT License"),
    (10, "one two three"), (11, "one two three"), (12, "x" * 5000 + " GNU General Public License, CC-BY cc by"),
    (13, "a\nb\na\n \nb"), (14, "the cat sat on the mat today and the cat sat on the mat again")]
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, h long, `__rest` int"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, equal ids, and columns that clash with inner names."""
    return spark.createDataFrame([(i, t, None if i == 9 else "en", "s", 5, 6, 7) for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false").select("doc_id", "text", "lang", "source", "n_words", "h")


@pytest.fixture(scope="module")
def sf(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]


def key(r):
    return tuple((x is not None, x) for x in r)


# --- 1: substring dedup

def brute_dedup(rows, n=13):
    lo = {}
    for i, t in rows:
        w = SPACE.findall(t or "")
        for p in range(len(w) - n + 1):
            if i is not None:
                k = tuple(w[p:p + n])
                lo[k] = min(lo.get(k, i), i)
    out = []
    for i, t in rows:
        w = SPACE.findall(t or "")
        gone = set()
        for p in range(len(w) - n + 1):
            if i is not None and lo[tuple(w[p:p + n])] < i:
                gone |= set(range(p, p + n))
        out.append((i, len(w), len(gone), [x for q, x in enumerate(w) if q not in gone]))
    return out


def test_dedup_matches_brute_force(docs):
    out = substring_dedup.dedup_substrings(docs.drop("__rest"))
    assert out.columns == ["doc_id", "text", "lang", "source", "h", "n_words", "n_removed"]
    got = [(r["doc_id"], r["n_words"], r["n_removed"], SPACE.findall(r["text"] or "")) for r in out.collect()]
    assert sorted(got, key=lambda r: key(r[:3])) == sorted(brute_dedup(TEXTS), key=lambda r: key(r[:3]))


def test_dedup_leaves_untouched_texts_as_they_were(docs):
    out = substring_dedup.dedup_substrings(docs.select("doc_id", "text"))
    kept = {r["doc_id"]: r["text"] for r in out.filter("n_removed = 0").collect()}
    assert kept[3] is None and kept[5] == " \t\n" and kept[9].startswith("éé x")


def test_repeats_are_looked_for_in_one_hash_slice_at_a_time(docs, monkeypatch):
    """No join of window hashes sees more than a slice of them, and all slices together see each row once."""
    seen, real = [], substring_dedup._repeated

    def counted(rows, keys, of):
        seen.append((of, rows.count(), rows.agg(F.collect_set("h")).first()[0]))
        return real(rows, keys, of)
    monkeypatch.setattr(substring_dedup, "_repeated", counted)
    got = substring_dedup.dedup_substrings(docs.select("doc_id", "text"))
    rows = [(r["doc_id"], r["n_words"], r["n_removed"], SPACE.findall(r["text"] or "")) for r in got.collect()]
    assert sorted(rows, key=lambda r: key(r[:3])) == sorted(brute_dedup(TEXTS), key=lambda r: key(r[:3]))
    for of in ("key", "doc_id"):
        n, h = [x[1] for x in seen if x[0] == of], [x[2] for x in seen if x[0] == of]
        assert len(n) == 4 and max(n) < sum(n)
        assert sum(map(len, h)) == len(set().union(*h)) > 0


def test_levels_double_until_none_survive(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(20))
    rows = [(1, f"x {a} y {b}"), (2, f"{a} z"), (3, f"q {b} r")]
    out = substring_dedup.repeat_levels(spark.createDataFrame(rows, "doc_id long, text string"))
    want = Counter()
    for level in (13, 26, 52, 104):
        seen = {}
        for i, t in rows:
            w = t.split()
            for p in range(len(w) - level + 1):
                seen.setdefault(tuple(w[p:p + level]), set()).add(i)
        for ids in seen.values():
            if len(ids) > 1:
                want.update((i, level) for i in ids)
    assert {(r["doc_id"], r["level"]): r["n_windows"] for r in out.collect()} == dict(want)
    assert max(k[1] for k in want) == 52


# --- 2: quality rules

def brute_base(t):
    w = SPACE.findall(t or "")
    grams = Counter(tuple(w[p:p + 5]) for p in range(len(w) - 4))
    rep = {q for p in range(len(w) - 4) if grams[tuple(w[p:p + 5])] > 1 for q in range(p, p + 5)}
    lines = [x for x in (t or "").split("\n") if SPACE.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep),
            len(w) < 10 or 100 * len(rep) > 20 * len(w))


def test_base_rules_match_brute_force(docs, sf, spark):
    frame = docs.drop("__rest").unionByName(spark.createDataFrame(
        sf, "doc_id long, text string").withColumn("lang", F.lit("x")), allowMissingColumns=True)
    got = quality_rules.judge(frame).collect()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = sorted(((i, *brute_base(t)) for i, t in TEXTS + sf), key=key)
    assert sorted(((r["doc_id"], *(r[c] for c in cols)) for r in got), key=key) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_outliers_go_and_typical_texts_stay(spark):
    rng = np.random.default_rng(1)

    def text(odd):
        w = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(rng.integers(60, 300))]
        return " ".join(x + "%%%" if odd else x for x in w)
    rows = [(i, text(i % 10 == 0), "en", "a" if i % 3 else None) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(frame).collect()}
    assert got == {i: i % 10 != 0 for i in range(600)}
    kept = quality_rules.keep_good(frame.withColumn("distance", F.lit(3)))
    assert kept.columns == [*frame.columns, "distance"]
    assert {tuple(r)[:2] for r in kept.collect()} == {(i, t) for i, t, *_ in rows if i % 10}


def test_concentration_matches_a_direct_estimate():
    """A concentration step over bins equals mean and covariance of the nearest three quarters."""
    import pandas as pd
    rng = np.random.default_rng(2)
    q = np.round(rng.normal(size=(400, quality_rules.P)) * quality_rules.SCALE).astype(np.int64)
    order = np.arange(400)  # every document its own bin: the first 300 are the core
    pairs = [(i, j) for i in range(quality_rules.P) for j in range(i, quality_rules.P)]
    frame = pd.DataFrame({"g_lang": "a", "g_source": "b", "bin": order, "n": 1,
                          **{f"s{i}": q[:, i] for i in range(quality_rules.P)},
                          **{f"s{i}{j}": q[:, i] * q[:, j] for i, j in pairs}})
    got = quality_rules._concentrate(("a", "b"), frame).iloc[0]
    core = q[:300] / quality_rules.SCALE
    assert np.allclose(got["mean"], core.mean(0))
    want = quality_rules.CONSISTENCY * np.cov(core.T, bias=True) + np.diag(np.square(quality_rules.LEAST_SD))
    assert np.allclose(np.linalg.inv(np.reshape(got["inverse"], (quality_rules.P,) * 2)), want)


def test_concentration_goes_on_until_no_determinant_falls(spark, monkeypatch):
    """Sixteen falling determinants, more than a fixed dozen of steps, are all taken."""
    real, n = quality_rules.materialize, []

    def counted(df, name):
        if name.startswith("step"):
            n.append(name)
            df = df.withColumn("logdet", F.lit(-float(min(len(n), 16))))
        return real(df, name)
    monkeypatch.setattr(quality_rules, "materialize", counted)
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(20 + k % 9)), "en", "s") for k in range(80)]
    stats = quality_rules.statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    got = quality_rules.estimate(stats, quality_rules.groups(stats)).collect()
    assert len(n) == 17 and got[0]["logdet"] == -16.0


# --- 3: license scan

def brute_license(t):
    w = ALNUM.findall((t or "").translate(LOWER))
    hits = [(p, label) for phrase, label in license_scan.BASE for p in range(len(w))
            if w[p:p + len(phrase.split())] == phrase.split()]
    at = [p for p, _ in hits]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def test_license_base_matches_brute_force(docs, sf, spark):
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(sf, "doc_id long, text string"))
    got = license_scan.scan(frame).collect()
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(((i, *brute_license(t)) for i, t in TEXTS + sf), key=key)
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"] for r in got)


@pytest.mark.parametrize("text,labels,score", [
    ("GNU Lesser General Public License, version 2.1 or later", "lgpl", 0.9),
    ("SPDX-License-Identifier: Apache-2.0", "apache", 1.0),
    ("released under the terms of the 3-clause BSD license", "bsd", 0.95),
    ("CC BY-NC-SA 4.0", "cc-by,cc-by-nc-sa", 0.9),
    ("Licensed under the Mozilla Public License, v2.0; see also the MIT license", "mit,mpl", 0.95),
    ("apache helicopters mit der bahn", "", 0.0)])
def test_license_rules(text, labels, score):
    got = license_scan.scan_text(text.encode())
    assert (got[5], got[6]) == (labels, score)
    assert len(license_scan.rules()) > 200


def test_license_prefilter_drops_no_detection(sf):
    """Every match of any rule in the words of a text comes with one of the rule's keywords and the gate."""
    for _, t in sf + TEXTS:
        joined = b" ".join((t or "").encode().translate(license_scan.ALNUM_TABLE).split())
        for _p, _s, _l, keywords, regex in license_scan.rules():
            for m in regex.finditer(joined) if len(joined) < 5000 else ():
                assert keywords & set(m[0].decode().split()) and any(g in b" " + joined + b" " for g in license_scan.GATE)


def spellings(pattern, rng, n):
    """Random texts that a pattern matches."""
    from re import _parser

    def one(parsed):
        out = ""
        for op, arg in parsed:
            op = str(op)
            if op == "LITERAL":
                out += chr(arg)
            elif op == "IN":
                kind, v = arg[rng.integers(len(arg))]
                out += chr(v) if str(kind) == "LITERAL" else "a"
            elif op == "BRANCH":
                out += one(arg[1][rng.integers(len(arg[1]))])
            elif op == "SUBPATTERN":
                out += one(arg[3])
            elif op == "MAX_REPEAT":
                out += "".join(one(arg[2]) for _ in range(rng.integers(arg[0], min(int(arg[1]), 12) + 1)))
            else:
                assert op == "ASSERT_NOT"
        return out
    return {one(_parser.parse(pattern)) for _ in range(n)}


@pytest.mark.parametrize("text,label", [
    ("distributed under the GPL version 2", "gpl"), ("released under the GNU GPL v3", "gpl"), ("MPL-2.0", "mpl"),
    ("BSD-3-Clause", "bsd"), ("Apache-2.0", "apache")])
def test_license_found_without_other_license_words(text, label):
    assert license_scan.scan_text(f"some words {text} and more".encode())[5] == label


def test_license_rules_find_texts_made_from_their_pattern():
    """A text made from a rule's pattern has a detection that covers the rule's match."""
    rng = np.random.default_rng(3)
    for _p, _s, label, keywords, regex in license_scan.rules():
        for text in spellings(regex.pattern.decode(), rng, 20):
            joined = b" ".join(text.encode().translate(license_scan.ALNUM_TABLE).split())
            m = regex.search(joined)
            if m and keywords & set(joined.decode().split()):
                assert any(a <= m.start() and m.end() <= z for a, z, *_ in license_scan.scan_text(text.encode())[7]), (label, text)


@pytest.mark.parametrize("text,label", [
    ("Internet Systems Consortium license", "isc"), ("the unlicence", "unlicense"), ("Open Font License", "ofl"),
    ("Creative Commons Attribution NoDerivs", "cc-by-nd"),
    ("Creative Commons Attribution Non-Commercial Share Alike", "cc-by-nc-sa"),
    ("Creative Commons Attribution Non-Commercial No Derivs", "cc-by-nc-nd")])
def test_license_spelled_out_names(text, label):
    assert license_scan.scan_text(text.encode())[5] == label


def test_license_keywords_are_in_every_spelling():
    rng = np.random.default_rng(4)
    for label, keywords, names, spdx, _version in license_scan.FAMILIES:
        for pattern in [*names, spdx]:
            for text in spellings(pattern, rng, 300):
                assert set(keywords) & set(text.split()), (label, text)


# --- 4: chat trees

def test_tree_paths_ranked_and_formatted(spark):
    rows = [("t", 1, None, 1.0), ("t", 2, 1, 5.0), ("t", 3, 1, 2.0), ("t", 4, 3, 4.0), ("t", 5, 4, 0.0),
            ("u", 10, 99, None), ("c", 20, 21, 1.0), ("c", 21, 20, 1.0)]
    m = spark.createDataFrame(rows, "tree string, node long, parent long, score double")
    got = chat_trees.chosen_paths(m, 2).collect()
    paths = {}
    for r in sorted(got, key=lambda r: r["pos"]):
        paths.setdefault((r["tree"], r["branch"]), []).append(r["node"])
    assert paths == {("t", 0): [1, 3, 4, 5], ("t", 1): [1, 2], ("u", 0): [10]}


def test_chat_round_trip(spark):
    odd = "\\### Assistant: </turn> ok\\l\\\\b\n### user:\nx</turn>\n"
    rows = [(1, 0, "user", odd), (1, 1, "assistant", None), (1, 2, odd, odd), (1, 3, "assistant", odd),
            (2, 0, None, ""), (3, 5, "assistant", "b"), (3, 5, "assistant", "a"), (3, 5, "assistant", "a"),
            (None, 0, "user", "n"), (4, None, "user", "x" * 100_000)]
    rows += [(5, k, "assistant", f"t{k}") for k in range(40)]
    c = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1))
    out = {r["tree"]["conv_id"]: r for r in chat_trees.read_back(chat_trees.format_paths(chat_trees.linear(c))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] or 0, r[1] or "", r[2] or ""))
        turns = [(x or "", y or "") for _, x, y in own]
        assert [tuple(t) for t in out[conv]["turns"]] == turns
        assert "".join(out[conv]["masked"]) == "".join(y for x, y in turns if x == "assistant")
        assert out[conv]["formatted"].count("</turn>\n") == len(turns)
    empty = c.filter("false")
    assert chat_trees.format_paths(chat_trees.linear(empty)).count() == 0


# --- 5: sharding

@pytest.mark.parametrize("n", [1, 2, 3, 40, 41, 1000, 4097])
def test_feistel_is_a_permutation_with_an_inverse(n):
    f = sharding.Feistel(n)
    p = f.forward(np.arange(n))
    assert sorted(p.tolist()) == list(range(n))
    assert (f.inverse(p) == np.arange(n)).all()


def test_shards_are_even_and_gapless(docs, none):
    got = sharding.shard(docs, 5).collect()
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in TEXTS), key=key)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=key) == want
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(s) for s in by.values()]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(5))
    f = sharding.Feistel(len(got))
    place = {tuple(divmod(int(p), 5)): i for i, p in enumerate(f.forward(np.arange(len(got))))}
    order = [w[0] for w in want]
    assert all(order[place[(r["slot"], r["shard"])]] == r["doc_id"] for r in got)
    assert sharding.shard(none, 5).count() == 0


# --- 6: quality classifier

def test_classifier_held_out_accuracy(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.train(d, lab)
    got = quality_classifier.classify(d, model).join(lab, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    bad = [r["predicted"] for r in got if r["quality"] == 0]
    assert np.mean(bad) < 0.5


def test_classifier_odd_rows(spark, docs, none):
    lab = spark.createDataFrame([(1, 1), (2, 0), (12, 0), (12, 1), (None, 1), (7, None)], "doc_id long, quality int")
    got = quality_classifier.classify(docs, quality_classifier.train(docs, lab)).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"]: r["held_out"] for r in got if r["doc_id"]} == {
        i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in TEXTS if i}
    only = quality_classifier.train(none, lab)
    assert quality_classifier.classify(none, only).count() == 0
    assert {r["score"] for r in quality_classifier.classify(docs, only).collect()} == {0.5}


def test_dual_descent_reaches_the_hinge_optimum():
    rng = np.random.default_rng(3)
    xs = [np.sort(rng.choice(50, 8, replace=False)).astype(np.int32) for _ in range(200)]
    y = np.array([int((x < 20).sum() + rng.normal() > 3) for x in xs])
    m = quality_classifier.fit(xs, y, epochs=300)
    rows = [m.ratio[x] / np.linalg.norm(m.ratio[x]) for x in xs]
    s = np.where(y > 0, 1, -1)

    def loss(w, b):
        margin = np.array([w[x] @ v + b for x, v in zip(xs, rows)])
        return 0.5 * (w @ w + b * b) + np.maximum(0, 1 - s * margin).sum()
    best = loss(m.weights, m.intercept)
    for _ in range(200):
        step = np.zeros_like(m.weights)
        step[:50] = rng.normal(size=50) * 0.02
        assert loss(m.weights + step, m.intercept + rng.normal() * 0.02) > best - 1e-2


# --- 7: decontamination

def brute_leaks(rows, items, n=10):
    phrases = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        if i is not None and w:
            for p in range(max(1, len(w) - n + 1)):
                phrases.setdefault(tuple(w[p:p + n]), set()).add(str(i))
    sizes, out = {len(p) for p in phrases}, []
    for i, t in rows:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                own = phrases.get(tuple(w[p:p + k]))
                if own:
                    hit |= set(range(p, p + k))
                    found |= own
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return out


def test_decontamination_matches_brute_force(spark, docs, none):
    items = [(1, "SHARED0 " + " ".join(f"shared{i}" for i in range(1, 12))), (2, "one, two-three"), (3, None), (4, "..."),
             (None, "cat sat on the mat"), (5, "cat sat on the mat"), (10, "cat sat on the mat"), (6, "never there")]
    b = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.decontaminate(docs.drop("__rest"), b)
    assert [c for c in out.columns if c not in ("n_words", "n_hit", "items")] == ["doc_id", "text", "lang", "source", "h"]
    got = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in out.collect()]
    assert sorted(got, key=key) == sorted(brute_leaks(TEXTS, items), key=key)
    assert decontamination.decontaminate(none, b).count() == 0
    assert decontamination.decontaminate(docs.select("doc_id", "text"), b.filter("false")).filter("n_hit > 0").count() == 0


def test_proximity_matches(spark):
    d = spark.createDataFrame([(1, "red green blue stone"), (2, "green red blue x stone"), (3, "red a b c d e f blue green")],
                              "doc_id long, text string")
    b = spark.createDataFrame([(7, "red green blue")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in decontamination.decontaminate(d, b, slop=3).collect()}
    assert got == {1: (3, 1), 2: (0, 1), 3: (0, 0)}


# --- 8: class language model

def test_base_scores_match_brute_force(spark, docs, sf, none):
    rows = TEXTS + [(i + 1000, t) for i, t in sf]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(rows[len(TEXTS):], "doc_id long, text string"))

    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tok = {k: [*SPACE.findall((t or "").translate(LOWER)), None] for k, (_, t) in enumerate(rows)}
    c = Counter(x for k, (i, _) in enumerate(rows) if not held(i) for x in tok[k])
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(tok[k]), sum(c[x] > 0 for x in tok[k]), n,
                    sum(np.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tok[k])) for k, (i, _) in enumerate(rows)), key=key)
    got = sorted((tuple(r)[:6] for r in class_lm.score(frame).collect()), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert class_lm.score(none.select("doc_id", "text")).count() == 0


def test_classes_beat_unigrams_on_held_out_texts(spark):
    out = class_lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    r = out.filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert r[1] > r[0]


def test_exchange_finds_word_classes():
    """Words of two kinds that only follow each other end in two classes."""
    rng = np.random.default_rng(4)
    table = np.zeros((13, 13))
    for _ in range(5000):
        a, b = rng.integers(0, 6), rng.integers(6, 12)
        table[a, b] += 1
        table[b, a] += 1
    of = class_lm.cluster(table, 12, classes=2, sweeps=20)
    assert len(set(of[:6])) == 1 and len(set(of[6:])) == 1 and of[0] != of[6]


def test_best_classes_match_the_likelihood():
    """The class chosen for a word is the one with the highest likelihood of all bigrams."""
    rng = np.random.default_rng(7)
    table = rng.poisson(0.6, (30, 30)).astype(float)
    of = np.append(rng.integers(0, 4, 29), 4)  # the last unit is the end
    hot = np.eye(5)[of]
    rest = table - np.diag(np.diag(table))
    got = class_lm.best_classes(hot.T @ table @ hot, 4, of[:29], np.diag(table)[:29], (rest @ hot)[:29], (rest.T @ hot)[:29])
    for w in range(29):
        value = []
        for c in range(4):
            h = np.eye(5)[np.where(np.arange(30) == w, c, of)]
            value.append(class_lm.likelihood(h.T @ table @ h))
        assert value[got[w]] >= max(value) - 1e-6


def test_rare_words_are_clustered_too(spark):
    """Words far beyond the most frequent ones get the class of the words in whose places they stand."""
    rng = np.random.default_rng(8)
    rows = [(None, " ".join(f"{'xy'[k % 2]}{rng.integers(2000)}q" for k in range(200))) for _ in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    counts, t = class_lm.train(d)
    x = class_lm.W.tokenize(*next(class_lm.W.slices(pa.array([" ".join(f"x{i}q" for i in range(2000))])))[2:], class_lm.W.SPACE)
    is_x = np.isin(counts.toArrow().column("h").to_numpy(), x.hashes().view(np.int64))
    cls = counts.toArrow().column("cls").to_numpy()
    assert len(cls) > 3500 and (cls < len(t.transitions)).all()
    right = sum(max(Counter(is_x[cls == c].tolist()).values()) for c in set(cls.tolist()))
    assert right > 0.95 * len(cls)


def test_transitions_sum_to_one():
    g = np.random.default_rng(5).integers(0, 9, (7, 7)).astype(float)
    g[3] = 0
    assert np.allclose((10 ** class_lm.transitions(g)).sum(1), 1)


# --- 9: n-gram Jaccard join

def brute_links(rows):
    sets = []
    for _, t in rows:
        w = SPACE.findall(t or "")
        sets.append({tuple(w[p:p + 5]) for p in range(max(1, len(w) - 4))} if w else set())
    link = [[b for b in range(len(rows)) if a != b and sets[a] and sets[b]
             and Fraction(len(sets[a] & sets[b]), len(sets[a] | sets[b])) >= Fraction(4, 5)] for a in range(len(rows))]
    out = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in link[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        out.append((rows[a][0], min(ids, default=None), len(link[a])))
    return out


def test_join_matches_brute_force(spark, docs, none):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(120)]
    near = []
    for i in range(60):  # a group in which some pairs link and some do not
        w = list(base)
        for p in rng.choice(120, rng.integers(0, 4), replace=False):
            w[p] = f"n{rng.integers(1000)}"
        near.append((100 + i, " ".join(w)))
    rows = TEXTS + near
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id long, text string"))
    got = [tuple(r) for r in jaccard_join.jaccard_classes(frame).collect()]
    assert sorted(got, key=key) == sorted(brute_links(rows), key=key)
    assert jaccard_join.jaccard_classes(none).count() == 0


def test_blocks_give_the_same_links(spark, monkeypatch):
    """Groups larger than a block are compared block by block with the same result."""
    monkeypatch.setattr(jaccard_join._dealt, "__defaults__", (7,))
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base[:i % 3], *([f"x{i}"] if i % 2 else []), *base[i % 3:]])) for i in range(50)]
    got = [tuple(r) for r in jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(brute_links(rows))


def test_one_of_each_keeps_whole_rows(docs):
    out = jaccard_join.one_of_each(docs)
    assert out.columns == docs.columns
    kept = Counter(r["doc_id"] for r in out.collect())
    want = Counter({i for i, low, _ in brute_links(TEXTS) if i == low})
    assert kept == want


def test_one_of_each_under_null_and_equal_ids(spark):
    """One row of each class, whatever ids its rows have."""
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcde")
    rows = [(None, a), (None, b), (None, c), (None, c), (1, d), (1, e), (2, d), (3, "a " + a), (4, b), (4, "x " + b),
            (None, None), (None, ""), (None, " "), (5, None), (5, None), (6, "\n\t"), (6, "one"), (7, "one"), (None, "one")]
    out = jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(None, c), (1, d), (1, e), (3, "a " + a), (None, None), (None, ""), (None, " "), (5, None), (5, None),
            (6, "\n\t"), (6, "one")]
    got = Counter(tuple(r) for r in out.collect())
    of_b = {k: n for k, n in got.items() if (k[1] or "").endswith(b)}  # either text of doc 4, once
    assert sum(of_b.values()) == 1 and {i for i, _ in of_b} == {4}
    assert {k: n for k, n in got.items() if k not in of_b} == Counter(want)


def test_pruning_bound_is_the_posterior_mass():
    need = jaccard_join.needed(0.8, 1e-9)
    x = np.linspace(0, 1, 200_001)
    for n, m in need.items():
        for k, above in ((m, True), (m - 1, False)):
            if k >= 0:
                d = x**k * (1 - x)**(n - k)
                assert (d[x >= 0.8].sum() / d.sum() >= 1e-9) == above


# --- 10: packing

def test_pieces_and_places(spark, docs, none):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    odd = [(20, "It's <|startoftext|>X <|STARTOFTEXT|> a.'s U.S.A. é. ﬁ 3.14!? Don'T,"), (21, "ÀÉ—. ΑΣ, ΣΑΣ."), (22, "HELLO.World a,b")]
    rows = TEXTS + odd
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    got = [r.asDict() for r in pattern_packing.pack(frame, tokenizer_path(), 512).collect()]
    want = []
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for p, a in enumerate(range(0, len(ids), 512)):
            x = ids[a:a + 512]
            want.append((i, p, a, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    cols = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert pattern_packing.pack(none, tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    rng = np.random.default_rng(seed)
    cap = 128
    h = np.zeros(cap + 1, np.int64)
    v = rng.integers(1, cap + 1, 4000) if seed % 2 else rng.geometric(0.05, 4000).clip(1, cap)
    np.add.at(h, v, 1)
    if seed == 5:
        h[:] = 0
        h[1] = 10_000
    steps = pattern_packing.plan(h, cap)
    used = np.zeros(cap + 1, np.int64)
    for pattern, n in steps:
        assert 0 < sum(pattern) <= cap and n > 0
        for x in pattern:
            used[x] += n
    assert (used == h).all()
    total = int((h * np.arange(cap + 1)).sum())
    big = int(h[cap // 2 + 1:].sum())
    assert sum(n for _, n in steps) <= 1.03 * max(-(-total // cap), big) + 1


def test_fit_is_the_least_squares_optimum():
    """The gradient of the squared distance is zero where counts are positive and not negative elsewhere."""
    rng = np.random.default_rng(7)
    cap = 40
    h = rng.integers(0, 50, cap + 1).astype(np.int64)
    h[0] = h[cap] = 0
    fitted = pattern_packing.fit_counts(h, cap, sweeps=3000)
    r = h.astype(float)
    for p, x in fitted:
        for v in p:
            r[v] -= x
    for p, x in fitted:
        if x > 1e-3:
            assert abs(sum(r[v] for v in p)) < 0.5
    for a in range(1, cap):
        for b in range(a + 1, cap - a):
            c = cap - a - b
            if c > b:
                assert r[a] + r[b] + r[c] < 0.5 or not h[a]


# --- queries and pipeline

NAMES = ["op1_substring_dedup", "op4_chat_trees", "op7_positional_decontamination", "op9_ngram_jaccard_join"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF001), name, SF001, E.queries()[name], E.oracle_sql()[name])
    assert r["status"] == "ok", r


def test_every_operator_has_a_query():
    ops = {int(m[1]) for k in E.queries() if (m := re.match(r"op(\d+)_", k))}
    assert ops == set(range(1, 14)) and "pipeline" in E.queries()


def test_pipeline_matches_brute_force(spark):
    """Each stage against its brute force on what the stage before kept."""
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    cols, rows = d.columns, {r["doc_id"]: r["text"] for r in d.collect()}
    steps = [f for _, f in corpus_pipeline.STAGES]
    kept = steps[0](spark, d, SF001)
    assert kept.columns == cols
    now = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert not any(brute_base(t)[5] for t in now.values()) and all(rows[i] == t for i, t in now.items())
    kept = steps[1](spark, kept, SF001)
    want = {i for i, low, _ in brute_links(sorted(now.items())) if i == low}
    now = {i: t for i, t in now.items() if i in want}
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == now
    kept = steps[2](spark, kept, SF001)
    assert kept.columns == cols
    brute = {i: (gone, w) for i, _, gone, w in brute_dedup(sorted(now.items()))}
    now = {i: " ".join(brute[i][1]) if brute[i][0] else t for i, t in now.items()}
    got = kept.collect()
    assert {r["doc_id"]: r["text"] for r in got} == now and all(r["n_chars"] == len(r["text"]) for r in got)
    kept = steps[3](spark, kept, SF001)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    clean = {i for i, _, n, _ in brute_leaks(sorted(now.items()), items) if not n}
    assert kept.columns == cols and {r["doc_id"] for r in kept.collect()} == clean
    assert {r["doc_id"] for r in steps[4](spark, kept, SF001).collect()} == clean
