"""Vector codes, spelling variants and toxicity against brute force, on odd rows and at sf0.001."""

from __future__ import annotations

import hashlib
import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from conftest import SF001, SF01  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from reportwide.llm import anchor_codes, spelling_variants, toxicity  # noqa: E402


def key(r):
    return tuple((x is not None, x) for x in r)


# --- 11: vector codes

def brute_codes(rows, parts, entries, rounds):
    kept = [(i, e, n) for i, e, n in rows if e and all(x is not None and np.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [int(np.floor(x * 256)) for x in r[1]]))
    v = np.floor(np.array([r[1] for r in kept], np.float64) * 256).astype(np.int64)
    q = v.reshape(len(v), parts, -1).transpose(1, 0, 2)
    books = q[:, :entries].copy()

    def assign():
        d = ((q[:, :, None, :] - books[:, None, :, :]) ** 2).sum(3)
        return d.argmin(2), d.min(2)
    for _ in range(rounds):
        code, _d = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = q[p][code[p] == e]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    code, d = assign()
    error = d.sum(0).tolist()
    total = Counter()
    for (_, _, n), x in zip(kept, error):
        total[n] += x
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in code[:, k]), error[k], total[n], sha)
                   for k, (i, _, n) in enumerate(kept)), key=key)


VECTORS = "vec_id long, embedding array<float>, label int, code string, v int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, n, "x", 3) for i, e, n in rows], VECTORS)


def coded(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_codes_match_brute_force_on_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(0, 0.3, 8).round(2).tolist(), [None, 1, 2][k % 3]) for k in range(300)]
    rows += [(7, rows[7][1], 1), (7, rows[8][1], 1), (None, rows[5][1], None)] + [(1000 + k, rows[9][1], 2) for k in range(150)]
    rows += [(500, None, 1), (501, [], 1), (502, [None] + [0.0] * 7, 1), (503, [float("nan")] * 8, 2),
             (504, [float("inf")] + [0.0] * 7, None)]
    got = anchor_codes.compress(vectors(spark, rows), parts=4, entries=16, rounds=3)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert coded(got) == brute_codes(rows, 4, 16, 3)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_codes_of_few_vectors(spark, n):
    rows = [(k, [0.1 * k, -0.2, 0.3, 0.4], None) for k in range(n)]
    got = coded(anchor_codes.compress(vectors(spark, rows), parts=2, entries=64))
    assert got == (brute_codes(rows, 2, 64, 2) if n else [])


def test_codes_of_another_length_and_of_large_components(spark):
    rows = [(k, [float(k), 1.0, 2.0, 1e30 if k == 3 else 3.0], 1) for k in range(6)] + [(9, [1.0, 2.0], 1)]
    got = anchor_codes.compress(vectors(spark, rows), parts=2, entries=2).collect()
    assert sorted(r["vec_id"] for r in got) == list(range(6))
    assert all(r["error"] >= 0 for r in got)
    with pytest.raises(ValueError, match="equal parts"):
        anchor_codes.compress(vectors(spark, rows), parts=3)


@pytest.mark.parametrize("seed", range(4))
def test_trees_hold_their_points_and_walks_find_the_nearest_entry(seed):
    rng = np.random.default_rng(seed)
    scale = (3, 40, 400, 400)[seed]
    v = rng.integers(-scale, scale, (700, 6))
    if seed == 3:  # tight clumps, so that many balls are wholly owned
        v = rng.integers(-scale, scale, (12, 6))[rng.integers(0, 12, 700)] + rng.integers(-4, 5, (700, 6))
    f = anchor_codes.Forest.loads(anchor_codes.Forest(v, 3).dumps())
    for b in range(len(f.count)):
        inside = f.points[f.lo[b]:f.hi[b]]
        assert np.sqrt(((inside - f.centre[b]) ** 2).sum(1)).max() <= f.radius[b] + 1e-9
        if f.child[b, 0] >= 0:
            assert (f.sum[f.child[b]].sum(0) == f.sum[b]).all() and f.count[f.child[b]].sum() == f.count[b]
    assert (f.points[f.point].reshape(len(v), -1) == v).all()
    books = v[:20].reshape(20, 3, 2).transpose(1, 0, 2).copy()
    books[:, 5] = books[:, 2]  # equal entries
    d = ((v.reshape(-1, 3, 1, 2) - books[None]) ** 2).sum(3)
    code, error = f.codes(books)
    assert (code == d.argmin(2)).all() and (error == d.min(2).sum(1)).all()
    total = f.totals(books)
    for p in range(3):
        for e in range(20):
            mine = v[code[:, p] == e, 2 * p:2 * p + 2]
            assert total[p, e].tolist() == [*mine.sum(0).tolist(), len(mine)]
    if seed == 3:
        owned = f.walk(books)[0]
        assert len(owned) and f.count[owned].max() > 1  # cached sums were used


# --- 12: spelling variants

def brute_variants(rows, least=3):
    n = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= least}

    def close(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    near = {w: [v for v in n if close(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=key)


def variants(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def noisy_texts(seed, size=160):
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list("abcé×"), rng.integers(4, 9))) for _ in range(40)]
    out = []
    for k in range(size):
        words = []
        for _ in range(30):
            w = base[min(int(rng.exponential(8)), 39)]
            if rng.random() < 0.3:
                p = int(rng.integers(0, len(w)))
                w = w[:p] + rng.choice(["", "a", w[p] * 2]) + w[p + 1:]
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append((None if k % 50 == 0 else k // 2, " ".join(words) + "."))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_variants_match_brute_force(spark, seed):
    long = "x" * 3000
    rows = noisy_texts(seed) + [(900, None), (901, ""), (902, "12 !?"), (903, f"{long} {long}y {long} {long}y {long}y {long} " * 3),
                                (904, "Наука Étéé naïve naïve naïve naive naive naive " * 2)]
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, n int, word string").repartition(5)
    got = variants(spelling_variants.group_variants(docs))
    assert got == brute_variants(rows)
    assert any(r[1] for r in got) and any(r[2] not in (r[0], r[1]) for r in got)  # forms, and chains of them


def test_variants_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, "short few")], "doc_id long, text string")
    assert variants(spelling_variants.group_variants(docs)) == []
    assert variants(spelling_variants.group_variants(docs.filter("false"))) == []


def test_variants_do_not_depend_on_ranges(spark, monkeypatch):
    docs = spark.createDataFrame(noisy_texts(5), "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert variants(spelling_variants.group_variants(docs)) == brute_variants(noisy_texts(5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", range(20))
def test_equal_numbers_mean_equal_prefixes(seed):
    rng = np.random.default_rng(seed)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(1, 7))) for _ in range(60)})
    cuts = sorted(rng.integers(1, len(words), 6).tolist())
    parts = [p for p in np.split(np.array(words, object), cuts) if len(p)]
    ranges = spelling_variants.Ranges([(3 * k, p[0], p[-1]) for k, p in enumerate(parts)])
    rows = [(3 * k, w) for k, p in enumerate(parts) for w in p]
    node, times = {}, Counter(w[:d] for w in words for d in range(len(w) + 1))
    found = list(spelling_variants.paths(iter(rows), ranges))
    assert [w for w, _, _ in found] == words and [r for *_, r in found] == sorted(r for *_, r in found)
    for w, path, _ in found:
        for d, number in enumerate(path):
            assert node.setdefault(w[:d], number) == number
        for d in range(len(path), len(w) + 1):
            assert times[w[:d]] == 1  # only nodes of one word stay without a number
    assert len(set(node.values())) == len(node)


# --- 13: toxicity

@pytest.mark.parametrize("text", [
    "you idiot", "YOU IDIOT!", "1d10t", "іdiоt", "ＩＤＩＯＴ", "ídiöt", "id​iot", "lo$er", "l0ser", "m0r0n",
    "@sshole", "ѕcum", "stυpid", "trash.", "(trash)", "\U0001d426oron"])
def test_folded_spellings_match(text):
    assert toxicity.Model({t: 1.0 for t in toxicity.lexicon()}).level(text)[1] == 1


@pytest.mark.parametrize("text", [
    "", "455 people", "idiotically", "trash can", "the TRASH  can.", "clown-fish", "pond scum", "scum$$$", "assess the class", None])
def test_other_texts_do_not_match(text):
    model = toxicity.Model({t: 1.0 for t in toxicity.lexicon()})
    assert model.level(text)[1] == (1 if text == "scum$$$" else 0)


def test_exceptions_spare_only_what_they_cover():
    model = toxicity.Model({"trash": 2.0, "moro*": 1.0, "moron": 3.0})
    assert model.found(toxicity.fold("trash can trash moron moronic")) == (6.0, 3)
    assert model.found(toxicity.fold("trash can")) == (0.0, 0)


def test_longer_texts_need_more_terms():
    model = toxicity.Model({"idiot": 3.0})
    short, long = (model.level("idiot " + "word " * n)[0] for n in (10, 10_000))
    assert model.scores(np.array([short, long]))[0] > model.scores(np.array([short, long]))[1]


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.score(docs, toxicity.train(docs, labels))


def test_toxicity_on_held_out_labels(scored):
    docs, labels, got = scored
    rows = got.filter("held_out").join(labels.filter("toxic is not null"), "doc_id").select("toxic", "predicted").collect()
    found = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert len(rows) > 60 and sum(found) >= 0.5 * len(found) and sum(clean) <= 0.05 * len(clean)
    assert got.count() == docs.count()


def test_labels_of_held_out_rows_are_not_learned_from(scored):
    docs, labels, got = scored
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.score(docs, toxicity.train(docs, other))
    assert got.exceptAll(again).isEmpty()


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good text here", 1.0), (1, "you idiot", 1.0), (None, None, 1.0), (2, "", None), (3, "idiot " + "ok " * 300_000, 0.0),
         (4, "pathetic loser", 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    for known in (labels, labels.filter("false")):
        rows = {(r["doc_id"], r["n_terms"]): r for r in toxicity.score(docs, toxicity.train(docs, known)).collect()}
        assert set(rows) == {(1, 0), (1, 1), (None, 0), (2, 0), (3, 1), (4, 2)}
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())
        assert rows[4, 2]["predicted"] == 1 and rows[2, 0]["score"] == rows[None, 0]["score"] == rows[1, 0]["score"]
    assert toxicity.score(docs.filter("false"), toxicity.train(docs.filter("false"), labels)).collect() == []


def test_copies_count_once():
    words = [f"w{k}" for k in range(300)]
    assert toxicity.sketch(words) == toxicity.sketch(words + words[-1:])  # a near copy
    assert toxicity.sketch([]) == 0


@pytest.mark.parametrize("name", ["op11_anchor_codes", "op12_spelling_variants"])
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF001), name, SF001, E.queries()[name], E.oracle_sql()[name])
    assert r["status"] == "ok", r
