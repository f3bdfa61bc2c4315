"""Substring dedup by level-wise doubling of repeated windows.

The first level looks at half windows (7 words for windows of 13): of the half windows inside
each window the one with the smallest hash stands for it, so equal windows pick equal half
windows and about a quarter of all positions is shuffled. Half windows seen in one document
alone end there. Only windows over a repeated half window go to the next level, where an 80-bit
hash of all words decides; ``repeat_levels`` goes on doubling until no candidates survive.

Documents with equal texts are folded before the first level: a copy repeats every window of
the copy with the smallest doc_id.

Groups are reduced with min and max (partial aggregates), and the marks are joined back by
hash with unique right sides, which the adaptive skew join can split; no group is gathered. Both
happen in one hash slice after another, so only a slice's shuffles are on disk at a time.

Defined cases: a null text has no words and stays null; rows with a null doc_id are neither
sources nor cut; rows that share a doc_id are no earlier than each other; texts of fewer words
than a window stay. A text of which nothing is removed is returned as it was.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportwide.llm import words as W
from reportwide.llm.tables import drop_tables, keep_rest, materialize, release

WINDOW = 13
SLICES = 4  # of the hashes whose repeats are looked for at a time


def _low(g: np.ndarray, span: int, n: int) -> np.ndarray:
    """Smallest of ``span`` consecutive hashes from each of the first n positions."""
    m = g[:n].copy()
    for j in range(1, span):
        np.minimum(m, g[j:j + n], out=m)
    return m


def _half(window: int) -> int:
    return (window + 1) // 2


def _seeds(w: W.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window start: the standing half window's hash, and whether the window is in one document."""
    k = _half(window)
    n = max(0, w.n - window + 1)
    return _low(W.ngrams(w.hashes(), k), window - k + 1, n), W.inside(w.doc, window)


def _emit_seeds(window: int):
    def run(batches):
        for b in batches:
            keys = b.column("__key").to_numpy(zero_copy_only=False)
            for lo, _hi, buf, offs in W.slices(b.column("text")):
                w = W.tokenize(buf, offs, W.SPACE)
                m, ok = _seeds(w, window)
                d, m = w.doc[:len(m)][ok], m[ok]
                new = np.ones(len(m), np.bool_)
                new[1:] = (m[1:] != m[:-1]) | (d[1:] != d[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m[new].view(np.int64)), pa.array(keys[lo + d[new]])], ["h", "key"])
    return run


def _emit_windows(length: int, marked: int):
    """Hashes of windows of ``length`` words at positions whose marks survived the level before.

    ``marked`` 0: the marks are half-window hashes; else they are hashes of windows of ``marked``
    words, and a window needs one at its first and one at its last ``marked`` words.
    A mark repeats in the whole corpus, so the marks of a slice can be looked up together.
    """
    def run(batches):
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            marks = b.column("marks")
            for lo, hi, buf, offs in W.slices(b.column("text")):
                w = W.tokenize(buf, offs, W.SPACE)
                n = max(0, w.n - length + 1)
                own = np.unique(marks.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).astype(np.int64))
                ok = W.inside(w.doc, length)
                if marked:
                    hit = np.isin(W.ngrams(w.hashes(1), marked).view(np.int64), own)
                    ok &= hit[:n] & hit[length - marked:length - marked + n]
                else:
                    ok &= np.isin(_seeds(w, length)[0].view(np.int64), own)
                at = np.flatnonzero(ok)
                if not len(at):
                    continue
                h = W.ngrams(w.hashes(1), length)[at].view(np.int64)
                t = (W.ngrams(w.hashes(0), length)[at] & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(t), pa.array(ids[lo + w.doc[at]].astype(np.int64))], ["h", "t", "doc_id"])
    return run


def _cut(window: int):
    """Kept text of each row: words under a window whose hash is in ``bad`` go."""
    def one(text: bytes, bad) -> tuple[bytes | None, int, int]:
        parts = text.split()
        if bad is None or len(parts) < window:
            return None, len(parts), 0
        buf = np.frombuffer(text, np.uint8)
        w = W.tokenize(buf, np.array([0, len(buf)]), W.SPACE)
        hit = np.isin(W.ngrams(w.hashes(1), window).view(np.int64), bad)
        gone = W.covered(hit, window, w.n)
        if not gone.any():
            return None, len(parts), 0
        return b" ".join([p for p, g in zip(parts, gone.tolist()) if not g]), len(parts), int(gone.sum())

    def run(batches):
        for b in W.pieces(batches):
            text, copy = b.column("text"), b.column("copy").to_pylist()
            bad, out, n_words, n_gone = b.column("bad"), [], [], []
            for i, value in enumerate(text):
                if not value.is_valid:
                    kept, n, gone = None, 0, 0
                elif copy[i]:
                    n = len(value.as_buffer().to_pybytes().split())
                    kept, gone = ("", n) if n >= window else (value, 0)
                else:
                    marks = bad[i].values.to_numpy() if bad[i].is_valid else None
                    kept, n, gone = one(value.as_buffer().to_pybytes(), marks)
                    kept = value if kept is None else kept.decode()
                out.append(kept.as_py() if isinstance(kept, pa.Scalar) else kept)
                n_words.append(n)
                n_gone.append(gone)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(out, pa.string()), b.column("__rest"),
                 pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64())],
                ["doc_id", "text", "__rest", "n_words", "n_removed"])
    return run


def _repeated(rows: DataFrame, keys: list[str], of: str) -> DataFrame:
    """Keys with at least two different values of ``of``, with the smallest of them."""
    return (rows.groupBy(*keys).agg(F.min(of).alias("lo"), F.max(of).alias("hi"))
            .filter("lo < hi").drop("hi"))


def _by_slice(rows: DataFrame, name: str, find) -> DataFrame:
    """``find`` of every hash slice of a written table, written one after another; ``rows`` are deleted."""
    spark, parts = rows.sparkSession, []
    for k in range(SLICES):
        parts.append(materialize(find(rows.filter(F.pmod("h", F.lit(SLICES)) == k)), name))
        release(spark)
    drop_tables(spark, rows)
    return reduce(DataFrame.union, parts)


def _marked_texts(docs: DataFrame, window: int) -> DataFrame:
    """``docs`` (doc_id, text, __rest) with the repeated half windows of each text, written once.

    Adds ``marks`` (null: none) and ``copy``: the text also stands in a row with a smaller doc_id.
    A half window counts as repeated if texts that differ hold it; texts are told apart by 40 bits
    of their hash here (two that share them at worst lose what only they share), and by their MD5
    where copies are found.
    """
    spark = docs.sparkSession
    docs = docs.withColumn("__key", F.shiftrightunsigned(F.xxhash64("text"), 24)).withColumn(
        "__md5", F.unhex(F.md5(F.col("text").cast("binary"))))
    live = docs.filter("doc_id is not null and text is not null")
    seeds = materialize(live.select("__key", "text").mapInArrow(_emit_seeds(window), "h long, key long"), "seeds")
    again = _by_slice(seeds, "again", lambda x: x.join(_repeated(x, ["h"], "key").select("h"), "h", "left_semi"))
    marks = materialize(again.groupBy(F.col("key").alias("__key")).agg(F.collect_set("h").alias("marks")), "marks")
    drop_tables(spark, again)
    del again, seeds
    release(spark)
    info = live.groupBy("__md5", "__key").agg(F.min("doc_id").alias("__lo")).join(marks, "__key", "left").drop("__key")
    out = (docs.drop("__key").join(info, "__md5", "left")
           .withColumn("copy", F.coalesce(F.col("__lo") < F.col("doc_id"), F.lit(False))).drop("__md5", "__lo"))
    out = materialize(out, "texts")
    drop_tables(spark, marks)
    release(spark)
    return out


def _windows(texts: DataFrame, length: int, marked: int) -> DataFrame:
    return materialize(texts.select("doc_id", "text", "marks").mapInArrow(
        _emit_windows(length, marked), "h long, t short, doc_id long"), f"windows{length}")


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``; adds n_words and n_removed.

    A word goes if a window of ``window`` words that covers it also starts in a document with a
    smaller doc_id. Input columns called n_words or n_removed are replaced.
    """
    spark, docs = docs.sparkSession, docs.drop("n_words", "n_removed")
    texts = _marked_texts(keep_rest(docs, ["doc_id", "text"]), window)
    found = _windows(texts.filter("doc_id is not null and not copy and marks is not null"), window, 0)
    later = _by_slice(found, "later", lambda x: x.join(_repeated(x, ["h", "t"], "doc_id"), ["h", "t"])
                      .filter("lo < doc_id").select("doc_id", "h"))
    bad = materialize(later.groupBy("doc_id").agg(F.collect_set("h").alias("bad")), "bad")
    drop_tables(spark, later)
    del later, found
    release(spark)
    cut = texts.drop("marks").join(bad, "doc_id", "left")
    rest = cut.schema["__rest"].dataType.simpleString()
    kind = docs.schema["doc_id"].dataType.simpleString()
    done = cut.select("doc_id", "text", "__rest", "copy", "bad").mapInArrow(
        _cut(window), f"doc_id {kind}, text string, __rest {rest}, n_words long, n_removed long")
    return done.select(*[F.col(f"`{c}`") if c in ("doc_id", "text") else F.col(f"__rest.`{c}`") for c in docs.columns],
                       "n_words", "n_removed")


def repeat_levels(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, level, n_windows): distinct windows of each length that stand in several documents.

    Lengths double from ``window``; the loop ends when no candidates survive. Copies of a text
    count as its first document.
    """
    texts = (_marked_texts(keep_rest(docs, ["doc_id", "text"]), window)
             .filter("doc_id is not null and not copy").select("doc_id", "text", "marks"))
    length, marked, out = window, 0, None
    while True:
        found = _windows(texts.filter("marks is not null"), length, marked)
        kept = found.distinct().join(_repeated(found, ["h", "t"], "doc_id"), ["h", "t"])
        marks = materialize(kept.groupBy("doc_id").agg(F.collect_set("h").alias("marks")), "marks")
        level = marks.select("doc_id", F.lit(length).alias("level"), F.size("marks").cast("long").alias("n_windows"))
        out = level if out is None else out.union(level)
        if marks.isEmpty():
            return out
        texts = texts.drop("marks").join(marks, "doc_id")
        length, marked = 2 * length, length
