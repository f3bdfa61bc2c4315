"""Memory of tasks does not follow the size of Arrow batches: batches are cut by bytes, results stay."""

from __future__ import annotations

import os
import sys
import tracemalloc

import numpy as np
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reportwide.llm import brown_clusters as B  # noqa: E402
from reportwide.llm import class_lm, decontamination  # noqa: E402
from reportwide.llm import substring_dedup as S  # noqa: E402
from reportwide.llm import words as W  # noqa: E402


def texts(n, words, seed=3):
    rng = np.random.default_rng(seed)
    return [" ".join(f"w{k}" for k in rng.zipf(1.3, words) % 5000) for _ in range(n)]


def test_pieces_keep_rows_in_order(monkeypatch):
    monkeypatch.setattr(W, "PIECE_BYTES", 100)
    rows = [(i, "x" * (i * 7 % 90), [i] * (i % 4) if i % 5 else None) for i in range(50)] + [(50, "y" * 500, [])]
    b = pa.RecordBatch.from_pylist([dict(zip(("i", "t", "l"), r)) for r in rows])
    got = list(W.pieces([b, b.slice(0, 0), b.slice(7, 20)]))
    assert all(x.nbytes <= 100 or x.num_rows == 1 for x in got) and any(x.num_rows > 1 for x in got)
    assert [tuple(r.values()) for x in got for r in x.to_pylist()] == rows + rows[7:27]


class Shared:
    value = (B.Lookup(np.array([], np.uint64)), 0)


def tokens_of(buf, offs):
    return class_lm._tokens(buf, offs)[0]


def pairs_of(batches):
    """{(word, neighbour, side): n} of adjacency rows."""
    out = {}
    for b in B._tail_pairs(batches):
        for r in b.to_pylist():
            k = (r["h"], r["other"], r["side"])
            out[k] = out.get(k, 0) + r["n"]
    return out


def test_adjacency_memory_does_not_follow_the_batch(monkeypatch):
    monkeypatch.setattr(B, "TOKENS", 1 << 20, raising=False)
    t = pa.RecordBatch.from_arrays([pa.array(texts(8000, 500))], ["text"])
    assert t.nbytes > 3 * W.PIECE_BYTES

    def peak(b):
        W.family(0)
        tracemalloc.start()
        for _ in B._adjacency([b], Shared, tokens_of):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most
    small = peak(t.slice(0, 2000))
    assert peak(t) < 1.5 * small


def test_pieces_give_the_same_neighbours(monkeypatch):
    t = pa.RecordBatch.from_arrays([pa.array([*texts(60, 40), "", None], pa.string())], ["text"])
    want = pairs_of(B._adjacency([t], Shared, tokens_of))
    monkeypatch.setattr(W, "PIECE_BYTES", 400)
    monkeypatch.setattr(B, "TOKENS", 300)
    monkeypatch.setattr(B, "PAIRS", 50)
    slices = W.slices
    monkeypatch.setattr(W, "slices", lambda x: slices(x, 400))
    cut = list(B._adjacency([t], Shared, tokens_of))
    assert len(cut) > 5 and pairs_of(cut) == want
    order = np.lexsort((np.concatenate([b.column("piece").to_numpy() for b in cut]),
                        np.concatenate([b.column("h").to_numpy() for b in cut])))
    rows = pa.Table.from_batches(cut).take(pa.array(order)).combine_chunks().to_batches()
    merged = list(B._merged(rows))
    assert pairs_of(merged) == want
    keys = [(r["h"], r["piece"]) for b in merged for r in b.select(["h", "piece"]).to_pylist()]
    assert len(keys) == len(set(keys))


def test_cut_texts_leave_in_small_batches():
    value = texts(4000, 600)
    n = len(value)
    w = W.tokenize(*next(W.slices(pa.array(value[:1])))[2:], W.SPACE)
    bad = W.ngrams(w.hashes(1), 13)[:1].view(np.int64).tolist()
    b = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), pa.array(value), pa.array([0] * n), pa.array([False] * n),
         pa.array([bad] + [None] * (n - 1), pa.list_(pa.int64()))], ["doc_id", "text", "__rest", "copy", "bad"])
    assert b.nbytes > 2 * W.PIECE_BYTES
    got = list(S._cut(13)([b]))
    assert max(x.nbytes for x in got) < 1.2 * W.PIECE_BYTES
    out = pa.Table.from_batches(got)
    assert out.column("doc_id").to_pylist() == list(range(n)) and out.column("n_removed").to_pylist() == [13] + [0] * (n - 1)
    assert out.column("text").to_pylist() == [" ".join(value[0].split()[13:]), *value[1:]]


def test_operators_bound_batches_by_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, "64m")
    d = spark.range(3000).selectExpr("id AS doc_id", "concat(repeat('some words ', 600), id) AS text").coalesce(1)
    out = S.dedup_substrings(d)
    assert out.count() == 3000

    def seen(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])
    assert d.select("text").mapInArrow(seen, "n long").agg({"n": "max"}).first()[0] < 5 << 20


def test_exact_hits_are_not_written(spark, monkeypatch):
    names, write = [], decontamination.materialize
    monkeypatch.setattr(decontamination, "materialize", lambda df, name: (names.append(name), write(df, name))[1])
    d = spark.createDataFrame([(1, "x a b c d e f g h i j y"), (2, "a b c d e f g h i x j")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "a b c d e f g h i j")], "item_id string, text string")
    got = {r["doc_id"]: r["n_hit"] for r in decontamination.decontaminate(d, items).collect()}
    assert got == {1: 10, 2: 0} and "hits" not in names
    decontamination.decontaminate(d, items, slop=3).collect()
    assert "hits" in names
