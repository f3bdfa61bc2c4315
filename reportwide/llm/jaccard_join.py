"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles (a document of fewer words is one shingle of all its
words). Documents with the same set form a class and are joined once. Of each set 120 MinHash
values are kept; sets that agree on one of 30 bands of 4 values are candidates (two sets of
similarity 0.8 share no band with a probability of about 1e-7). Within a bucket the values are
compared 20 at a time, and a pair is dropped once the posterior probability of similarity 0.8
or more, under a uniform prior, falls below 1e-9. All that stay are verified on their whole
shingle sets.

A bucket may hold any share of the corpus and is never expanded into pairs of rows: its members
are dealt into blocks of at most 256, tasks compare two blocks at a time in numpy, and send on
for each member one edge to the smallest member it hangs together with. Verification deals the
connected survivors in the same way and counts each document's links. Every link is counted; a
group of n near copies with different texts costs n * n comparisons but only n rows a block.

Result rows: doc_id, class_id (smallest doc_id of the documents connected by links), n_links
(other documents at similarity 0.8 or more, copies included).

Defined cases: null or word-less texts have no shingles, link to nothing and are their own
class; rows with equal or null doc_id are documents of their own (a class of null ids has a null
class_id); extra columns are left out. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportwide.llm import words as W
from reportwide.llm.tables import checked_broadcast, components, keep_rest, materialize, release

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
BANDS, ROWS = 30, 4
HASHES = BANDS * ROWS
STEP = 20
TOLERANCE = 1e-9
BLOCK = 256

_A = W.mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def shingles(buf: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within rows, and row offsets into them."""
    w = W.tokenize(buf, offs, W.SPACE)
    h, rows = w.hashes(), len(offs) - 1
    g, doc = W.ngrams(h, k), w.doc
    ok = W.inside(doc, k)
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    whole = np.array([_fold(h[w.first[i]:w.first[i + 1]]) for i in short], np.uint64)
    values = np.concatenate([g[ok], whole])
    of = np.concatenate([doc[:len(g)][ok], short])
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.ones(len(values), np.bool_)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    values, of = values[new], of[new]
    return values, np.searchsorted(of, np.arange(rows + 1))


def _fold(h: np.ndarray) -> np.uint64:
    x = np.array([len(h)], np.uint64)
    for v in h:
        x = W.mix(x * np.uint64(0x9E3779B97F4A7C15) + v)
    return x[0]


def set_keys(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hash of each row's set."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(W.mix(values ^ np.uint64(0x7F4A7C159E3779B9)))])
    return W.mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64))


def _signatures(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash values, 16 bits each, of the rows that have shingles."""
    starts = at[:-1][np.diff(at) > 0]
    out = np.empty((len(starts), HASHES), np.uint16)
    for i, a in enumerate(_A):
        out[:, i] = W.mix(np.minimum.reduceat(values * a, starts)) >> np.uint64(48)
    return out


def _describe(batches):
    for b in batches:
        for lo, hi, buf, offs in W.slices(b.column("text")):
            values, at = shingles(buf, offs)
            n = np.diff(at)
            has = n > 0
            sig = pa.array([None] * (hi - lo), pa.binary())
            if has.any():
                flat = iter(_signatures(values, at))
                sig = pa.array([next(flat).tobytes() if x else None for x in has.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(lo, hi - lo), b.column("th").slice(lo, hi - lo),
                 pa.array(set_keys(values, at).view(np.int64), mask=~has), pa.array(n.astype(np.int64)), sig],
                ["doc_id", "th", "node", "n", "sig"])


def _sets(batches):
    """(node, values) of texts whose set is the expected one."""
    for b in batches:
        want = b.column("node").to_numpy()
        for lo, hi, buf, offs in W.slices(b.column("text")):
            values, at = shingles(buf, offs)
            same = set_keys(values, at).view(np.int64) == want[lo:hi]
            keep = np.flatnonzero(same)
            yield pa.RecordBatch.from_arrays(
                [pa.array(want[lo + keep]), pa.array([values[at[i]:at[i + 1]].tobytes() for i in keep], pa.binary())],
                ["node", "values"])


def needed(threshold: float, tolerance: float, hashes: int = HASHES, step: int = STEP) -> dict[int, int]:
    """Fewest equal values among the first n with which a pair may still reach the threshold.

    With m of n equal and a uniform prior, similarity has the distribution Beta(m + 1, n - m + 1);
    its mass above t is the probability of at most m successes in n + 1 trials of chance t.
    """
    out = {}
    for n in range(step, hashes + 1, step):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        out[n] = m
    return out


def grouped(batches, keys: list[str]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Runs of equal keys in sorted batches; a run that crosses batches is carried over."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if rest is not None:
            t = pa.concat_tables([rest, t]).combine_chunks()
        if not t.num_rows:
            continue
        new = np.zeros(t.num_rows, np.bool_)
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        edges = [0, *np.flatnonzero(new).tolist()]
        if len(edges) > 1:
            yield t.slice(0, edges[-1]).combine_chunks(), list(zip(edges[:-1], edges[1:]))
        rest = t.slice(edges[-1])
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), [(0, rest.num_rows)]


def _smallest(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node that each node hangs together with over the pairs (i, j)."""
    low = nodes.copy()
    while len(i):
        m = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        if (new == low).all():
            break
        low = new
    return low


def _pairs(side: np.ndarray, crossed: bool) -> tuple[np.ndarray, np.ndarray]:
    if crossed:
        a, b = np.flatnonzero(side == side.min()), np.flatnonzero(side != side.min())
        return np.repeat(a, len(b)), np.tile(b, len(a))
    return np.triu_indices(len(side), 1)


def _survivors(least: dict[int, int]):
    """For each member of a block: the smallest member it hangs together with over pairs not dropped."""
    def run(batches):
        for t, runs in grouped(batches, ["key", "lo", "hi"]):
            node, n = t.column("node").to_numpy(), t.column("n").to_numpy()
            side, lo, hi = (t.column(c).to_numpy() for c in ("side", "lo", "hi"))
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)
            us, vs = [], []
            for a, z in runs:
                i, j = _pairs(side[a:z], lo[a] != hi[a])
                x, y = n[a + i], n[a + j]
                ok = np.minimum(x, y) * THRESHOLD.denominator >= np.maximum(x, y) * THRESHOLD.numerator
                i, j = i[ok], j[ok]
                equal = np.zeros(len(i), np.int64)
                for upto, m in least.items():
                    if not len(i):
                        break
                    equal += (sig[a + i, upto - STEP:upto] == sig[a + j, upto - STEP:upto]).sum(1)
                    ok = equal >= m
                    i, j, equal = i[ok], j[ok], equal[ok]
                low = _smallest(node[a:z], i, j)
                off = np.flatnonzero(low != node[a:z])
                us.append(node[a:z][off])
                vs.append(low[off])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["a", "b"])
    return run


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of membership matrices a few columns wide."""
    m, out = len(sets), np.zeros((len(sets), len(sets)), np.float64)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    _, col, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n > 1
    place = np.cumsum(shared) - 1
    use = shared[col]
    row, col = row[use], place[col[use]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for first in range(0, int(shared.sum()), columns):
        a, z = np.searchsorted(col, [first, first + columns])
        x = np.zeros((m, columns), np.float32)
        x[row[a:z], col[a:z] - first] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _verified(batches):
    """For each member of a block: documents it links to there, and the smallest node it hangs together with."""
    t_num, t_den = THRESHOLD.numerator, THRESHOLD.denominator
    for t, runs in grouped(batches, ["comp", "lo", "hi"]):
        node, mult = t.column("node").to_numpy(), t.column("mult").to_numpy()
        side, lo, hi, values = *(t.column(c).to_numpy() for c in ("side", "lo", "hi")), t.column("values")
        us, vs, ls = [], [], []
        for a, z in runs:
            _, first = np.unique(node[a:z], return_index=True)
            at = a + np.sort(first)
            sets = [np.frombuffer(values[int(i)].as_buffer(), np.uint64) for i in at]
            size = np.array([len(s) for s in sets])
            both = overlaps(sets)
            i, j = _pairs(side[at], lo[a] != hi[a])
            o = both[i, j]
            ok = o * t_den >= (size[i] + size[j] - o) * t_num
            i, j = i[ok], j[ok]
            links = np.bincount(i, mult[at][j], len(at)) + np.bincount(j, mult[at][i], len(at))
            us.append(node[at])
            vs.append(_smallest(node[at], i, j))
            ls.append(links.astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in (us, vs, ls)], ["a", "b", "links"])


def _dealt(df: DataFrame, key: str, size: str, block: int = BLOCK) -> DataFrame:
    """Rows of each key in blocks of about ``block``, one copy for each pair of blocks they are part of."""
    blocks = F.ceil(F.col(size) / block)
    df = df.withColumn("side", F.pmod(F.xxhash64("node"), blocks))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return (df.withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))
            .drop("other", size).repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi"))


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, th, node) of ``docs``, and (node, comp, class_id, n_links) of every set."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    rows = materialize(texts.mapInArrow(
        _describe, f"doc_id {kind}, th long, node long, n long, sig binary"), "shingled")
    nodes = materialize(rows.filter("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("mult"), F.min(F.struct("doc_id", "th")).alias("rep"),
        F.max("n").alias("n"), F.max("sig").alias("sig")), "nodes")

    # Buckets of two or more, each member set once however many bands it shares.
    key = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        i, F.substring("sig", i * 2 * ROWS + 1, 2 * ROWS)))
    bands = nodes.select("node", F.explode(key).alias("key"))
    buckets = (bands.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("members"))
               .filter("m > 1").groupBy("members", "m").agg(F.min("key").alias("key")))
    members = bands.join(buckets.select("key", "m"), "key").join(nodes.select("node", "n", "sig"), "node")
    edges = _dealt(members, "key", "m").mapInArrow(_survivors(needed(float(THRESHOLD), TOLERANCE)), "a long, b long")
    near = components(materialize(edges, "survivors"))
    near = materialize(near.withColumnRenamed("node", "a").join(
        nodes.select(F.col("node").alias("a"), "mult", "rep"), "a"), "groups")

    # Whole shingle sets of one document for each surviving class.
    sizes = near.groupBy("comp").agg(F.count(F.lit(1)).alias("m"))
    reps = near.select(F.col("a").alias("node"), F.col("rep.doc_id").alias("__id"), F.col("rep.th").alias("__th"))
    found = texts.join(checked_broadcast(reps), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")))
    sets = found.select("node", "text").mapInArrow(_sets, "node long, values binary")
    sets = (sets.join(near.select(F.col("a").alias("node"), "comp", "mult"), "node").join(sizes, "comp"))
    links = materialize(_dealt(sets, "comp", "m").mapInArrow(_verified, "a long, b long, links long"), "links")
    release(spark)

    comps = components(links)
    n_links = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    info = (nodes.select("node", "mult", F.col("rep.doc_id").alias("first_id"))
            .join(comps, "node", "left").join(n_links, "node", "left")
            .select("node", F.coalesce("comp", "node").alias("comp"), "first_id",
                    (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links")))
    classes = info.groupBy("comp").agg(F.min("first_id").alias("class_id"))
    info = materialize(info.join(classes, "comp").select("node", "comp", "class_id", "n_links"), "classes")
    return rows.select("doc_id", "th", "node"), info


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links for every row of ``docs``."""
    rows, info = _classes(docs)
    return rows.select("doc_id", "node").join(info, "node", "left").select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class, of the smallest doc_id (null last); rows without words all stay."""
    rows, info = _classes(docs)
    texts = rows.filter("node is not null").groupBy("doc_id", "th", "node").agg(F.count(F.lit(1)).alias("n"))
    kept = (texts.join(info.select("node", "comp"), "node").groupBy("comp")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "n")).alias("k")))
    kept = materialize(kept.select(F.col("k.doc_id").alias("__id"), F.col("k.th").alias("__key"),
                                   F.col("k.n").alias("__n")), "kept")
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Other columns travel packed, so that no name of theirs meets a name used here.
    packed = keep_rest(docs, ["doc_id", "text"])
    found = (packed.filter(has_words).withColumn("__th", F.xxhash64("text"))
             .join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__th") == F.col("__key"))))
    # Rows of one doc_id and text are copies: one of them stays.
    one = found.filter("__n = 1").union(found.filter("__n > 1").dropDuplicates(["doc_id", "__th"]))
    every = one.select(*packed.columns).union(packed.filter(~has_words))
    return every.select(*[F.col(c) if c in ("doc_id", "text") else F.col("__rest").getField(c).alias(c) for c in docs.columns])
