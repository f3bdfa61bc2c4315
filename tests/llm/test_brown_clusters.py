"""Brown clusters: adjacency rows, transitions and moves against brute force, and scores from the tables."""

from __future__ import annotations

import os
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reportwide.llm import brown_clusters as B  # noqa: E402
from reportwide.llm import class_lm  # noqa: E402

END = None


def corpus(seed=1, docs=60):
    rng = np.random.default_rng(seed)
    rows = [(2 * k, " ".join(f"w{min(int(rng.exponential(12)), 90)}" for _ in range(rng.integers(0, 40)))) for k in range(docs)]
    return [*rows, (900, None), (901, ""), (902, "one one one"), (None, "w1 w2 w3"), (902, "one one one")]


def hashes(words):
    """{word: hash} as the operator sees them."""
    w = class_lm.W.tokenize(*next(class_lm.W.slices(pa.array([" ".join(words)])))[2:], class_lm.W.SPACE, lower=True)
    return dict(zip(words, w.hashes()))


def pairs(rows):
    out = Counter()
    for _, t in rows:
        w = [END, *(t or "").split(), END]
        out.update(zip(w[:-1], w[1:]))
    return out


def rows_of(spark, rows, core):
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).select("text")
    return B.adjacency(texts, core, lambda buf, offs: class_lm._tokens(buf, offs)[0])


@pytest.mark.parametrize("heavy,size", [(3, 20), (0, 60), (1024, 1000)])
def test_transitions_match_brute_force(spark, monkeypatch, heavy, size):
    monkeypatch.setattr(B, "HEAVY", heavy)
    rows = corpus()
    count = Counter(w for _, t in rows for w in (t or "").split())
    words = sorted(count, key=lambda w: (-count[w], w))
    core = words[:size]
    h = hashes(words)
    core_rows, others = rows_of(spark, rows, np.array([h[w] for w in core], np.uint64))
    assert core_rows.filter("id < 0").isEmpty() and others.count() == len(words) - len(core)
    rng = np.random.default_rng(heavy)
    total = 7  # five classes, the end, and none
    cls = np.append(rng.integers(0, 5, len(core)), 5)
    of = {w: cls[i] for i, w in enumerate(core)} | {END: 5}
    want = np.zeros((total, total))
    for (a, z), n in pairs(rows).items():
        if a in of or z in of:  # pairs of two words outside the core are in no core row
            want[of.get(a, 6), of.get(z, 6)] += n
    assert (B.transition_counts(core_rows, cls, total) == want).all()
    # With classes of the other words joined, all pairs count.
    more = {w: int(rng.integers(0, 5)) for w in words[size:]}
    table = spark.createDataFrame([(int(np.int64(h[w])), c) for w, c in more.items()], "h long, cls int")
    both = core_rows.union(others)
    tail = both.mapInArrow(B._tail_pairs, "h long, piece int, other long, side int, n long")
    near = B._with_others(both, tail, table)
    full = np.zeros((total, total))
    for (a, z), n in pairs(rows).items():
        full[(of | more)[a], (of | more)[z]] += n
    assert (B.transition_counts(near, cls, total) == full).all()


@pytest.mark.parametrize("heavy", [0, 4])
def test_moves_match_the_best_class_of_each_word(spark, monkeypatch, heavy):
    monkeypatch.setattr(B, "HEAVY", heavy)
    rows = corpus(3)
    count = Counter(w for _, t in rows for w in (t or "").split())
    words = sorted(count, key=lambda w: (-count[w], w))
    h = hashes(words)
    core_rows, others = rows_of(spark, rows, np.array([h[w] for w in words], np.uint64))
    assert others.isEmpty()
    rng, classes = np.random.default_rng(5), 4
    cls = np.append(rng.integers(0, classes, len(words)), classes)
    g = B.transition_counts(core_rows, cls, classes + 2)
    got, _ = B.exchange(core_rows, g, cls, classes, 1, 0)
    unit = {w: i for i, w in enumerate(words)} | {END: len(words)}
    table = np.zeros((len(unit), len(unit)))
    for (a, z), n in pairs(rows).items():
        table[unit[a], unit[z]] += n
    for w in range(len(words)):
        value = []
        for c in range(classes):
            hot = np.eye(classes + 2)[np.where(np.arange(len(unit)) == w, c, cls)]
            value.append(B.likelihood(hot.T @ table @ hot))
        assert value[got[w]] >= max(value) - 1e-6
        assert got[w] == cls[w] or value[got[w]] > value[cls[w]]


@pytest.mark.parametrize("heavy,turn", [(0, 0), (4, 1)])
def test_a_round_over_all_words_joins_few_rows(spark, monkeypatch, heavy, turn):
    """Transitions come from pairs alone; rows that do not move, and dealt ones, are not joined, and yet every
    word that moves gets the best class of all."""
    monkeypatch.setattr(B, "HEAVY", heavy)
    rows, size, classes = corpus(11), 25, 4
    count = Counter(w for _, t in rows for w in (t or "").split())
    words = sorted(count, key=lambda w: (-count[w], w))
    h = hashes(words)
    core_rows, others = rows_of(spark, rows, np.array([h[w] for w in words[:size]], np.uint64))
    rng, total = np.random.default_rng(2), classes + 2
    of = dict(zip(words, rng.integers(0, classes, len(words)).tolist())) | {END: classes}
    cls = np.array([of[w] for w in [*words[:size], END]])
    table = spark.createDataFrame([(int(np.int64(h[w])), of[w]) for w in words[size:]], "h long, cls int")
    unit = {w: i for i, w in enumerate([*words, END])}
    big = np.zeros((len(unit), len(unit)))
    for (a, z), n in pairs(rows).items():
        big[unit[a], unit[z]] += n
    hot = np.eye(total)[list(of.values())]
    both = core_rows.union(others)
    tail = both.mapInArrow(B._numbered_pairs, "h long, piece int, other long, side int, n long, id int")
    g = B.transition_counts(core_rows.drop("tail"), cls, total) + B.other_counts(tail, table, cls, total)
    assert (g == hot.T @ big @ hot).all()
    near, dealt = B._near(both, tail, table, size, 2, turn)
    moving = {w: bool(B._moving(np.array([h[w]], np.uint64).view(np.int64), 2, turn)[0]) for w in words}
    joined = near.filter("own is not null or size(x) > 0").select("h").toArrow().column("h").to_numpy()
    assert {np.uint64(x) for x in joined.view(np.uint64)} <= {h[w] for w in words[heavy:] if moving[w]}
    got, moves = B.exchange(near, g, cls, classes, 2, turn, dealt)
    new = {r["h"]: r["cls"] for r in moves.filter("id < 0").collect()}
    for k, w in enumerate(words):
        mine = int(got[k]) if k < size else new.get(int(np.int64(h[w])), of[w])
        value = []
        for c in range(classes):
            to = hot.copy()
            to[unit[w]] = np.eye(total)[c]
            value.append(B.likelihood(to.T @ big @ to))
        assert value[mine] >= max(value) - 1e-6 if moving[w] else mine == of[w]
    assert any(moving[w] for w in words[:4]) and any(moving[w] for w in words[size:])


def test_scores_match_the_tables(spark, monkeypatch):
    """Every score is the sum over tokens of the mean of class and frequency probability."""
    for m in (B, class_lm):
        monkeypatch.setattr(m, "CORE", 25)
    rows = corpus(7) + [(1, "w1 unseen9 w2"), (6, "w3 zzz9 qqq9 w5")]  # 6 is held out
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(class_lm, "train", lambda docs, real=class_lm.train: kept.setdefault("t", real(docs)))
    kept: dict = {}
    got = sorted((tuple(r) for r in class_lm.score(frame).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[6]))
    counts, t = kept["t"]
    known = {np.uint64(np.int64(r["h"])): (r["n"], r["cls"]) for r in counts.collect()}
    assert len(known) > 40 and len(t.shared.sorted) == 26  # words outside the core too

    def one(text):
        tokens, kind, _row, _at = class_lm._tokens(*next(class_lm.W.slices(pa.array([text or ""])))[2:])
        total, before = 0.0, len(t.transitions) - 1
        for x, k in zip(tokens, kind):
            n, c = known.get(x, (0, int(t.endings[k])))
            base = (n + 0.5) / (t.n + 0.5 * (t.v + 1))
            p = 10 ** t.transitions[before, c] * (n + 0.5) / (t.class_n[c] + 0.5 * (t.class_v[c] + 1))
            total += np.log10(0.5 * p + 0.5 * base)
            before = c
        return total
    want = sorted(((i, one(t_)) for i, t_ in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[6] for g in got], [w[1] for w in want], rtol=1e-9)


def test_classes_beat_unigrams_on_few_texts_too(spark):
    out = class_lm.score(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    r = out.filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert r[1] > r[0]


def test_a_text_of_a_megabyte(spark):
    text = " ".join(f"w{k % 5003}" for k in range(190_000))
    frame = spark.createDataFrame([(2, text), (3, "w1 w2")], "doc_id long, text string")
    r = {x["doc_id"]: x for x in class_lm.score(frame).collect()}
    assert len(text) > 1 << 20 and r[2]["n_tokens"] == r[2]["n_known"] == 190_001 and r[2]["score"] > r[2]["base_score"]


@pytest.mark.parametrize("turn,size", [(0, 1200), (1, 1030)])
def test_a_round_over_packed_rows_matches_brute_force(spark, monkeypatch, turn, size):
    """A round over all words handles no row for each pair or word, and gives the counts and classes of brute force."""
    monkeypatch.setattr(B, "BUCKET", 7)
    rng, classes = np.random.default_rng(13), 4
    rows = [(2 * k, " ".join(f"w{int(x * x * 1500)}" for x in rng.random(rng.integers(0, 60)))) for k in range(250)] + corpus(13)
    count = Counter(w for _, t in rows for w in (t or "").split())
    words = sorted(count, key=lambda w: (-count[w], w))
    h = hashes(words)
    core = np.array([h[w] for w in words[:size]], np.uint64)
    core_rows, other_rows = rows_of(spark, rows, core)
    total, unit = classes + 2, {w: i for i, w in enumerate([*words, END])}
    big = np.zeros((len(unit), len(unit)))
    for (a, z), n in pairs(rows).items():
        big[unit[a], unit[z]] += n
    cls = np.append(np.random.default_rng(4).integers(0, classes, size), classes)
    others = B.Others(core_rows, other_rows, core, classes, len(words))
    assert others.others.count() <= others.buckets == max(32, len(words) // 7)
    state = others.start(B.transition_counts(core_rows, cls, total), cls)

    def numbered(c, state):
        new = {r["h"]: r["cls"] for r in others.table(state).collect()}
        assert len(new) == len(words) - size
        return np.array([*c[:size], *(new[int(np.int64(h[w]))] for w in words[size:]), classes])
    before = numbered(cls, state)

    def measured(c, state):
        return B.transition_counts(core_rows.drop("tail"), c, total) + others.counts(state)
    hot = np.eye(total)[before]
    g = measured(cls, state)
    assert (g == hot.T @ big @ hot).all()
    new, after = others.move(g, cls, state, 2, turn)
    got = numbered(new, after)
    for k, w in [*enumerate(words)][::5]:
        value = []
        for c in range(classes):
            to = hot.copy()
            to[k] = np.eye(total)[c]
            value.append(B.likelihood(to.T @ big @ to))
        moving = bool(B._moving(np.array([h[w]], np.uint64).view(np.int64), 2, turn)[0])
        assert value[got[k]] >= max(value) - 1e-6 if moving else got[k] == before[k]
    assert (got != before).any()
    hot = np.eye(total)[got]
    assert (measured(new, after) == hot.T @ big @ hot).all()
