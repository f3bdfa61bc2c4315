"""Quality classifier: naive Bayes features in a linear support vector machine.

Features are indicators of hashed n-grams: words and word pairs, and runs of three bytes. Runs of
two or three equal words count as a gram of their own besides, whatever the word. Each feature is
scaled by its class log-count ratio and rows are scaled to unit length; a linear hinge-loss model
is fitted by dual coordinate descent; its margins become scores with a fitted logistic curve.

The model is fitted on at most ``SAMPLE`` labelled rows, the ones with the smallest hash of
their doc_id, a size that does not follow the corpus; the labels of the sample are broadcast to
find its texts. Scoring is one narrow pass over all whole texts.

Defined cases: a null or empty text has no features and gets the score of the intercept; labels
with a null doc_id or quality are not used, conflicting ones are averaged (0.5 or more: 1); rows
with equal or null doc_id are scored one by one; without labels of both classes every score is
the share of good labels (0.5 without any).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportwide.llm import words as W

BITS = 18
SAMPLE = 6000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
SEED = 7


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each row, and row offsets into them."""
    w = W.tokenize(buf, offs, W.SPACE)
    h, doc, rows = w.hashes(), w.doc, len(offs) - 1
    parts = [(h, doc)]
    for k in (2, 3):
        ok = W.inside(doc, k)
        n = len(ok)
        if k == 2:
            parts.append((W.ngrams(h, 2)[ok], doc[:n][ok]))
        same = ok.copy()
        for j in range(1, k):
            same &= h[:n] == h[j:j + n]
        parts.append((np.full(int(same.sum()), k, np.uint64), doc[:n][same]))
    if len(buf) > 2:
        code = (buf[:-2].astype(np.uint64) << np.uint64(16)) | (buf[1:-1].astype(np.uint64) << np.uint64(8)) | buf[2:]
        of = np.repeat(np.arange(rows), np.diff(offs))
        ok = of[:-2] == of[2:]
        parts.append((W.mix(code[ok] + np.uint64(1 << 32)), of[:-2][ok]))
    value = np.concatenate([W.mix(p[0]) >> np.uint64(64 - BITS) for p in parts])
    of = np.concatenate([p[1] for p in parts])
    key = np.unique((of.astype(np.uint64) << np.uint64(BITS)) | value)
    of, value = (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int32)
    return value, np.searchsorted(of, np.arange(rows + 1))


def _featurize(batches):
    for b in batches:
        for lo, hi, buf, offs in W.slices(b.column("text")):
            value, at = features(buf, offs)
            yield pa.RecordBatch.from_arrays(
                [b.column("y").slice(lo, hi - lo),
                 pa.array([value[a:z].tobytes() for a, z in zip(at[:-1], at[1:])], pa.binary())], ["y", "x"])


class Model:
    """Weights of the feature indicators, intercept, and the curve from margins to scores."""

    def __init__(self, ratio, weights, intercept, slope, shift):
        self.ratio, self.weights, self.intercept, self.slope, self.shift = ratio, weights, intercept, slope, shift

    def scores(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        dot = np.concatenate([[0.0], np.cumsum((self.ratio * self.weights)[value])])
        square = np.concatenate([[0.0], np.cumsum(np.square(self.ratio)[value])])
        length = np.sqrt(square[at[1:]] - square[at[:-1]])
        margin = (dot[at[1:]] - dot[at[:-1]]) / np.where(length > 1e-9, length, 1) + self.intercept
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def fit(xs: list[np.ndarray], y: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> Model:
    """Log-count ratios, then dual coordinate descent for the hinge loss."""
    size = 1 << BITS
    good = y > 0
    if good.all() or not good.any():
        share = (good.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return Model(np.zeros(size), np.zeros(size), 0.0, 0.0, float(np.log(share / (1 - share))))
    counts = [np.bincount(np.concatenate([x for x, g in zip(xs, good) if g == c] or [np.empty(0, np.int32)]),
                          minlength=size) + SMOOTHING for c in (True, False)]
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    values = [ratio[x] for x in xs]
    values = [v / max(1e-9, float(np.sqrt(v @ v))) for v in values]
    sign = np.where(good, 1.0, -1.0)
    w, bias, alpha, rng = np.zeros(size), 0.0, np.zeros(len(y)), np.random.default_rng(SEED)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            x, v = xs[i], values[i]
            gradient = sign[i] * (w[x] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / (float(v @ v) + 1), 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                w[x] += step * v
                bias += step
                alpha[i] = new
                moved += abs(step)
        if moved < 1e-3 * len(y) * cost:
            break
    margin = np.array([w[x] @ v + bias for x, v in zip(xs, values)])
    a, c = 1.0, 0.0
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    for _ in range(50):  # Newton steps of the logistic curve
        p = 1 / (1 + np.exp(-np.clip(a * margin + c, -500, 500)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        q = p * (1 - p)
        hess = np.array([[(q * margin * margin).sum(), (q * margin).sum()], [(q * margin).sum(), q.sum()]]) + np.eye(2) * 1e-3
        step = np.linalg.solve(hess, g)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return Model(ratio, w, float(bias), float(a), float(c))


def held_out() -> Column:
    """Rows that no model may learn from."""
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows that are not held out."""
    known = (labels.filter("doc_id is not null and quality is not null").filter(~held_out())
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most ``sample`` rows
            .mapInArrow(_featurize, "y int, x binary"))
    got = rows.orderBy(F.xxhash64("x"), "y").limit(2 * sample).toArrow()
    xs = [np.frombuffer(v, np.int32) for v in got.column("x").to_pylist()]
    return fit(xs, np.array(got.column("y").to_pylist(), np.int64))


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2 ** BITS weights

    def score(batches):
        for b in batches:
            for lo, hi, buf, offs in W.slices(b.column("text")):
                s = shared.value.scores(*features(buf, offs))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), b.column("held_out").slice(lo, hi - lo),
                     pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])
    return (docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
            .mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int"))
