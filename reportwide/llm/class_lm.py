"""LM scoring with Brown classes: P(word | word before) = P(class | class before) P(word | class).

Every training word is put into a class by exchange clustering (``brown_clusters``), each to the class
that raises the likelihood of the training bigrams most; the number of classes grows with the cube root
of the vocabulary. Words never seen in training have the class most frequent among training words of
their last two bytes (hashed to ``ENDINGS`` groups), and the end of a text is a class of its own. Class
transitions are interpolated with class frequencies (Witten-Bell), emissions have 0.5 added for every
word of a class and one unknown word, and each token's probability is the mean of that of the classes
and that of its frequency alone.

Counts cover all training texts. Counts and classes of the ``CORE`` most frequent words are broadcast,
a bounded table; every other word meets them in a shuffled join, so no word that is frequent enough to
skew the join is in it.

Words are told apart by 64-bit hashes.

Defined cases: a null or empty text has one token, its end; rows with equal or null doc_id are
scored one by one (null ids are training rows, as their remainder is not 1); without training
tokens every probability is that of an unknown word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportwide.llm import words as W
from reportwide.llm.brown_clusters import (CORE, COUNTS, END_HASH, HELD, PAIRS, Lookup, _bucket, _buckets,  # noqa: F401
                                           _some, _split, _together, _unpacked, best_classes, brown_classes,
                                           cluster, likelihood)
from reportwide.llm.tables import materialize, release

ENDINGS = 64
COUNT_BUCKETS = 1024
DELTA = 0.5
SHARE = 0.5  # of the classes' probability in a token's


def held_out() -> Column:
    return F.coalesce((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) == 1, F.lit(False))


def _tokens(buf, offs):
    """Hash, ending and row of every token, the end of each row included."""
    w = W.tokenize(buf, offs, W.SPACE, lower=True)
    h = w.hashes()
    h[h == END_HASH] = np.uint64(2)
    last, second = w.buf[w.ends - 1].astype(np.uint64), w.buf[np.maximum(w.ends - 2, w.starts)].astype(np.uint64)
    ending = (W.mix(last << np.uint64(8) | second) % np.uint64(ENDINGS)).astype(np.int32)
    rows = len(offs) - 1
    at = w.first[1:] + np.arange(rows)  # places of the ends among all tokens
    total = w.n + rows
    is_end = np.zeros(total, np.bool_)
    is_end[at] = True
    tokens, kind, row = np.empty(total, np.uint64), np.empty(total, np.int32), np.empty(total, np.int64)
    tokens[at], kind[at], row[at] = END_HASH, ENDINGS, np.arange(rows)
    tokens[~is_end], kind[~is_end], row[~is_end] = h, ending, w.doc
    return tokens, kind, row, at


def _summed(keys: np.ndarray, n: np.ndarray, *more: np.ndarray):
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    n = np.add.reduceat(n[order], first) if len(keys) else n
    return (keys[first], n, *(m[order[first]] for m in more))


def _count(batches):
    """Counts of words, packed by bucket of their hash; a word has the same ending wherever it stands."""
    held: list = []

    def packed():
        h, n, kind = _summed(*(np.concatenate(x) for x in zip(*held)))
        held.clear()
        order, runs = _split(_bucket(h, COUNT_BUCKETS))
        h, n, kind = h[order], n[order], kind[order]
        for bucket, lo, hi in runs:
            yield bucket, COUNTS, h[lo:hi], n[lo:hi], kind[lo:hi]

    def rows():
        for b in batches:
            for _lo, _hi, buf, offs in W.slices(b.column("text")):
                tokens, kind, _row, _at = _tokens(buf, offs)
                held.append(_summed(tokens, np.ones(len(tokens), np.int64), kind))
                if sum(len(x[0]) for x in held) > HELD:
                    yield from packed()
        if held:
            yield from packed()
    return _some(rows(), 3)


def _counted(batches):
    """The words of each bucket with their counts."""
    for _bucket_, held in _buckets(batches):
        h, n, kind = (np.concatenate([_unpacked(b, c, k, t) for b, k in held[COUNTS]]) for c, t in zip(
            "abc", (np.uint64, np.int64, np.int32)))
        h, n, kind = _summed(h, n, kind)
        for lo in range(0, len(h), PAIRS):
            here = slice(lo, lo + PAIRS)
            yield pa.RecordBatch.from_arrays([pa.array(h[here].view(np.int64)), pa.array(kind[here]), pa.array(n[here])], ["h", "ending", "n"])


class Tables:
    """What a scoring task needs; its size follows the parameters and the number of classes."""

    def __init__(self, n, v, shared, shared_n, of, endings, transitions, class_n, class_v):
        self.n, self.v, self.of, self.endings = n, v, of, endings
        self.shared, self.shared_n, self.transitions = Lookup(shared), shared_n, transitions
        self.class_n, self.class_v = class_n, class_v


def transitions(g: np.ndarray) -> np.ndarray:
    """log10 P(class | class before): Witten-Bell with add-0.5 class frequencies."""
    n, kinds = g.sum(1, keepdims=True), (g > 0).sum(1, keepdims=True)
    base = (g.sum(0) + 0.5) / (g.sum() + 0.5 * len(g))
    return np.log10((g + np.maximum(kinds, 1) * base) / (n + np.maximum(kinds, 1)))


def train(docs: DataFrame) -> tuple[DataFrame, Tables]:
    """Counts (h, cls, n) of all training words, and the tables."""
    spark, end_hash = docs.sparkSession, int(END_HASH)
    texts = docs.filter(~held_out()).select("text")
    packed = texts.mapInArrow(_count, "bucket int, kind int, a binary, b binary, c binary")
    counts = materialize(_together(packed).mapInArrow(_counted, "h long, ending int, n long"), "words")
    release(spark)
    top = counts.filter(F.col("h") != end_hash).orderBy(F.desc("n"), "h").limit(CORE).toArrow()
    core, core_n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    core_cls, others, g = brown_classes(texts, core, counts.count(), lambda buf, offs: _tokens(buf, offs)[0])
    shared = spark.sparkContext.broadcast((Lookup(core), core_cls))

    def attach(batches):
        look, cls = shared.value
        for b in batches:
            h = b.column("h").to_numpy().view(np.uint64)
            at = np.where(h == END_HASH, len(cls) - 1, look.find(h))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cls[at].astype(np.int32), mask=at < 0)], [*b.schema.names, "core"])
    counts = counts.mapInArrow(attach, "h long, ending int, n long, core int").join(others, "h", "left").select(
        "h", "ending", "n", F.coalesce("core", "cls").alias("cls"))
    counts = materialize(counts, "classed")
    total = len(g)
    class_n, class_v = np.zeros(total), np.zeros(total)
    types, once = np.zeros((ENDINGS + 1, total)), np.zeros((ENDINGS + 1, total))
    for r in counts.groupBy("ending", "cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"),
                                                 F.count_if(F.col("n") == 1).alias("once")).collect():
        class_n[r["cls"]] += r["n"]
        class_v[r["cls"]] += r["v"]
        types[r["ending"], r["cls"]], once[r["ending"], r["cls"]] = r["v"], r["once"]
    # Words seen once stand for unseen ones; where an ending has none, all its words, then all words.
    guess = np.where(once.any(1)[:, None], once, np.where(types.any(1)[:, None], types, types.sum(0)))
    endings = np.append(guess[:ENDINGS, :total - 1].argmax(1), total - 1)
    n_end = class_n[total - 1]  # the end of a text is alone in its class
    ends = np.array([END_HASH] if n_end else [], np.uint64)
    return counts, Tables(int(class_n.sum()), int(class_v.sum()), np.append(core, ends),
                          np.append(core_n, [n_end] * len(ends)).astype(np.int64),
                          np.append(core_cls[:-1], [total - 1] * len(ends)).astype(np.int64), endings, transitions(g),
                          class_n, class_v)


def _base(t: Tables, c):
    return np.log10((c + 0.5) / (t.n + 0.5 * (t.v + 1)))


def _emission(t: Tables, c, cls):
    return np.log10((c + DELTA) / (t.class_n[cls] + DELTA * (t.class_v[cls] + 1)))


def _mixed(classes, base):
    """log10 of the mean of two probabilities given by their log10."""
    return np.logaddexp(classes * _LN10 + np.log(SHARE), base * _LN10 + np.log(1 - SHARE)) / _LN10


_LN10 = np.log(10)

# rare: tokens that are not shared, with the classes next to them (-1: not shared either), and the
# emission and base probability of a shared token after them.
_RARE = ("h long", "ending int", "at int", "before int", "after int", "emission double", "frequency double")
_PARTS = ("held_out boolean, rid long, n_tokens long, n_known long, base double, score double, "
          f"rare array<struct<{','.join(x.replace(' ', ':') for x in _RARE)}>>")


def _score(shared, batches):
    from pyspark import TaskContext
    t, rid = shared.value, TaskContext.get().partitionId() << 40
    end = len(t.transitions) - 1
    for b in batches:
        for lo, hi, buf, offs in W.slices(b.column("text")):
            tokens, kind, row, at = _tokens(buf, offs)
            rows = hi - lo
            place = t.shared.find(tokens)
            known = place >= 0
            is_end = kind == ENDINGS
            cls = np.full(len(tokens), -1, np.int64)
            if known.any():
                cls[known] = t.of[place[known]]
            cls[is_end] = end
            before = np.concatenate([[end], cls[:-1]])
            c = t.shared_n[place[known]] if known.any() else np.empty(0)
            base, emission, score = np.zeros(len(tokens)), np.zeros(len(tokens)), np.zeros(len(tokens))
            base[known], emission[known] = _base(t, c), _emission(t, c, cls[known])
            no_end = is_end & ~known  # no training text: the end is a word never seen
            base[no_end], emission[no_end] = _base(t, 0), _emission(t, 0, end)
            both = (before >= 0) & (cls >= 0)
            score[both] = _mixed(t.transitions[before[both], cls[both]] + emission[both], base[both])
            rare = np.flatnonzero(~known & ~is_end)
            lists = np.searchsorted(row[rare], np.arange(rows + 1)).astype(np.int32)
            columns = [tokens[rare].view(np.int64), *(x.astype(np.int32) for x in (
                kind[rare], rare, before[rare], cls[rare + 1])), emission[rare + 1], base[rare + 1]]
            items = pa.StructArray.from_arrays([pa.array(x) for x in columns], [x.split()[0] for x in _RARE])
            cols = [b.column("doc_id").slice(lo, rows), b.column("held_out").slice(lo, rows),
                    pa.array(rid + np.arange(rows)), pa.array(np.bincount(row, minlength=rows)),
                    pa.array(np.bincount(row[known], minlength=rows)),
                    pa.array(np.bincount(row, base, rows)), pa.array(np.bincount(row, score, rows)),
                    pa.ListArray.from_arrays(pa.array(lists), items)]
            rid += rows
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "rid", "n_tokens", "n_known", "base", "score", "rare"])


def _rare_scores(shared, batches):
    """Known tokens, base and class scores of each row's tokens that are not shared."""
    t = shared.value
    for b in batches:
        x, rows = b.column("x"), b.num_rows
        offs = x.offsets.to_numpy()
        fields = [f.to_numpy(zero_copy_only=False) for f in x.values.flatten()]
        span = slice(offs[0], offs[-1])
        row = np.repeat(np.arange(rows), np.diff(offs))
        order = np.lexsort((fields[0][span], row))
        _at, before, after, emission, frequency, cls, n, ending = (v[span][order] for v in fields)
        cls = np.where(cls < 0, t.endings[ending], cls)
        before = np.where(before < 0, np.concatenate([[0], cls[:-1]]), before)
        base = _base(t, n)
        score = _mixed(_emission(t, n, cls) + t.transitions[before, cls], base)
        score += np.where(after >= 0, _mixed(t.transitions[cls, after] + emission, frequency), 0)
        yield pa.RecordBatch.from_arrays(
            [b.column("rid"), pa.array(np.bincount(row[n > 0], minlength=rows)), pa.array(np.bincount(row, base, rows)),
             pa.array(np.bincount(row, score, rows))], ["rid", "known2", "base2", "score2"])


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    counts, t = train(docs.select("doc_id", "text"))
    shared = spark.sparkContext.broadcast(t)
    parts = materialize(docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        lambda bs: _score(shared, bs), f"doc_id {kind}, {_PARTS}"), "scores")
    rare = parts.select("rid", F.explode("rare").alias("x")).select("rid", "x.*")
    rare = rare.join(counts.select("h", "n", "cls"), "h", "left")
    found = F.struct("at", "before", "after", "emission", "frequency", F.coalesce("cls", F.lit(-1)).alias("cls"),
                     F.coalesce("n", F.lit(0)).alias("n"), "ending")
    extra = rare.groupBy("rid").agg(F.collect_list(found).alias("x")).mapInArrow(
        lambda bs: _rare_scores(shared, bs), "rid long, known2 long, base2 double, score2 double")
    out = parts.drop("rare").join(extra, "rid", "left")
    add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return out.select("doc_id", "held_out", "n_tokens", add("n_known", "known2").cast("long").alias("n_known"),
                      F.lit(t.n).cast("long").alias("train_tokens"), add("base", "base2").alias("base_score"),
                      add("score", "score2").alias("score"))
