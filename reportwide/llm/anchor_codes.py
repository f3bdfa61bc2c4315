"""Vector code compression: product codes by k-means over the parts, with anchors-hierarchy metric trees.

Vectors become whole numbers, are cut into equal parts, and every part position gets a codebook by
rounds of k-means. Vectors are worked through in blocks. In each block the distinct parts of a
position form a metric tree, built middle out: about sqrt(n) anchors are found first, each new one
the point furthest from its own anchor, taking over the points it is nearer to (points within half
the distance of two anchors are not asked); the anchors' balls are then merged, the pair with the
smallest joint ball first, up to one root, and every anchor's points are treated the same way below.
Each ball caches the sum and count of its parts. The trees are built once and written.

A round walks the trees from the roots with lists of candidate entries. An entry goes from a ball's
list when the whole ball lies on the nearer side of the plane halfway to the entry nearest to the
ball's centre; children inherit what is left. A ball with one candidate is wholly owned: its cached
sum and count are added at once. Parts of the smallest balls are compared one by one, in whole
numbers, ties to the lower entry. What leaves a task are the sums and counts of the entries; the
driver holds the codebooks.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped,
as are vectors of another length than the most frequent one (ties: the longer). Scaled components
beyond +-2**26 are set to that bound, so that squared distances stay in 64 bits. Rows with equal
vec_id are told apart by their vector; a null vec_id sorts last. With fewer kept rows than entries
the codebooks have one entry for each row; without any the result is empty. A length that cannot be
cut into equal parts is an error.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.llm.tables import checked_broadcast, materialize
from reportwide.session import work_path

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
BLOCK = 2048  # vectors of one forest
LEAF = 32  # most distinct parts of a ball without children
BOUND = 1 << 26
ROW_GROUP = 16 << 20  # bytes of forests that a task reads at once


def _square(x: np.ndarray) -> np.ndarray:
    return np.einsum("...i,...i->...", x, x)


def anchors(x: np.ndarray, k: int) -> np.ndarray:
    """Owner (0 to at most k - 1) of each of the distinct points ``x``."""
    owner, at = np.zeros(len(x), np.int64), [0]
    d = _square(x - x[0])
    for j in range(1, k):
        far = int(np.argmax(d))
        if d[far] == 0:
            break
        apart = _square(x[at] - x[far])
        ask = np.flatnonzero(d > (apart // 4)[owner])
        new = _square(x[ask] - x[far])
        take = new < d[ask]
        owner[ask[take]], d[ask[take]] = j, new[take]
        at.append(far)
    return owner


class Forest:
    """Metric trees of a block, one for each part position, in flat arrays.

    Balls: centre, radius, part position, children (-1: none), points lo to hi, cached sum and count.
    Points are distinct parts in ball order; ``point`` gives the point of (vector, position).
    """

    def __init__(self, vectors: np.ndarray, parts: int):
        m, width = len(vectors), vectors.shape[1] // parts
        self.centre, self.radius, self.pos, self.child = [], [], [], []
        self.lo, self.hi, self.sum, self.count = [], [], [], []
        self.roots, points, self.point = [], [], np.empty((m, parts), np.int64)
        done = 0
        for p in range(parts):
            x, back, times = np.unique(vectors[:, p * width:(p + 1) * width], axis=0, return_inverse=True, return_counts=True)
            self.x, self.times, self.base, self.order = x, times, done, []
            self.roots.append(self._tree(np.arange(len(x)), p))
            order = np.array(self.order)
            place = np.empty(len(x), np.int64)
            place[order] = done + np.arange(len(x))
            self.point[:, p] = place[back.ravel()]
            points.append(x[order])
            done += len(x)
        del self.x, self.times, self.base, self.order
        self.points = np.concatenate(points)
        self.centre, self.child = np.array(self.centre), np.array(self.child)
        self.radius, self.sum = np.array(self.radius), np.array(self.sum)
        self.pos, self.lo, self.hi, self.count = (np.array(v) for v in (self.pos, self.lo, self.hi, self.count))

    def _ball(self, ids: np.ndarray, pos: int, lo: int, children: tuple[int, int]) -> int:
        x, t = self.x[ids], self.times[ids]
        total = (x * t[:, None]).sum(0)
        centre = total // t.sum()
        self.centre.append(centre)
        self.radius.append(float(np.sqrt(float(_square(x - centre).max()))) * (1 + 1e-9))
        self.pos.append(pos)
        self.child.append(children)
        self.lo.append(lo)
        self.hi.append(lo + len(ids))
        self.sum.append(total)
        self.count.append(int(t.sum()))
        return len(self.count) - 1

    def _tree(self, ids: np.ndarray, pos: int) -> int:
        if len(ids) <= LEAF:
            lo = self.base + len(self.order)
            self.order.extend(ids.tolist())
            return self._ball(ids, pos, lo, (-1, -1))
        owner = anchors(self.x[ids], max(2, round(len(ids) ** 0.5)))
        groups = [ids[owner == j] for j in range(owner.max() + 1)]
        return self._merged(groups, pos)

    def _merged(self, groups: list[np.ndarray], pos: int) -> int:
        """Ball over all groups: which pairs to merge is settled first, then the balls are made in order."""
        k = len(groups)
        n = np.array([self.times[g].sum() for g in groups], np.float64)
        c = np.array([self.x[g].T @ self.times[g] / self.times[g].sum() for g in groups])
        r = np.array([np.sqrt(_square(self.x[g] - c[i]).max()) for i, g in enumerate(groups)])
        joint = np.full((k, k), np.inf)

        def measure(i, others):
            middle = (c[i] * n[i] + c[others] * n[others, None]) / (n[i] + n[others])[:, None]
            size = np.maximum(np.sqrt(_square(middle - c[i])) + r[i], np.sqrt(_square(middle - c[others])) + r[others])
            joint[i, others] = joint[others, i] = size
        for i in range(1, k):
            measure(i, np.arange(i))
        tree, alive = list(range(k)), np.ones(k, np.bool_)
        for _ in range(k - 1):
            i, j = divmod(int(np.argmin(joint)), k)
            size = joint[i, j]
            c[i] = (c[i] * n[i] + c[j] * n[j]) / (n[i] + n[j])
            n[i], r[i], alive[j], tree[i] = n[i] + n[j], size, False, (tree[i], tree[j])
            joint[j, :] = joint[:, j] = np.inf
            alive[i] = False
            rest = np.flatnonzero(alive)
            alive[i] = True
            if len(rest):
                measure(i, rest)
        # Children first, without recursion over merges (they can form a long chain).
        stack, made = [(tree[int(np.flatnonzero(alive)[0])], False)], []
        while stack:
            t, ready = stack.pop()
            if not isinstance(t, tuple):
                made.append((self._tree(groups[t], pos), groups[t]))
            elif ready:
                (b, ids_b), (a, ids_a) = made.pop(), made.pop()
                ids = np.concatenate([ids_a, ids_b])
                made.append((self._ball(ids, pos, self.lo[a], (a, b)), ids))
            else:
                stack += [(t, True), (t[1], False), (t[0], False)]
        return made[0][0]

    def walk(self, books: np.ndarray):
        """(balls, their only entry, points, their entry): owned balls, and points compared one by one.

        ``books`` is positions x entries x components. An entry equal to an earlier one owns nothing.
        """
        gap = np.sqrt(_square(books[:, :, None, :] - books[:, None, :, :]).astype(np.float64))
        first = np.array([[not (b[:e] == b[e]).all(1).any() for e in range(len(b))] for b in books])
        start = [np.flatnonzero(f) for f in first]
        ball = np.repeat(self.roots, [len(s) for s in start])
        cand = np.concatenate(start)
        owned, owner, single, entry = [], [], [], []
        while len(ball):
            new = np.flatnonzero(np.concatenate([[True], ball[1:] != ball[:-1]]))
            size = np.diff(np.append(new, len(ball)))
            pos = self.pos[ball]
            d = _square(self.centre[ball] - books[pos, cand])
            least = np.repeat(np.minimum.reduceat(d, new), size)
            best = np.flatnonzero(d == least)
            seg = np.repeat(np.arange(len(new)), size)
            star = cand[best[np.searchsorted(seg[best], np.arange(len(new)))]][seg]
            margin = 2 * self.radius[ball] * gap[pos, cand, star]
            keep = (cand == star) | (d - least <= margin * (1 + 1e-9) + 1e-6)
            ball, cand = ball[keep], cand[keep]
            left = np.add.reduceat(keep.astype(np.int64), new)
            whole = np.repeat(left == 1, left)
            owned.append(ball[whole])
            owner.append(cand[whole])
            ball, cand = ball[~whole], cand[~whole]
            leaf = self.child[ball, 0] < 0
            if leaf.any():
                p, e = self._compare(books, ball[leaf], cand[leaf])
                single.append(p)
                entry.append(e)
            ball, cand = ball[~leaf], cand[~leaf]
            both = np.concatenate([self.child[ball, 0], self.child[ball, 1]])
            order = np.argsort(both, kind="stable")
            ball, cand = both[order], np.concatenate([cand, cand])[order]
        flat = lambda v: np.concatenate(v) if v else np.empty(0, np.int64)
        return flat(owned), flat(owner), flat(single), flat(entry)

    def _compare(self, books, ball, cand):
        """Nearest candidate of every point of the leaves, ties to the lower entry."""
        size = self.hi[ball] - self.lo[ball]
        pair = np.repeat(np.arange(len(ball)), size)
        point = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + self.lo[ball][pair]
        c = cand[pair]
        d = _square(self.points[point] - books[self.pos[ball][pair], c])
        order = np.lexsort((c, d, point))
        point, c = point[order], c[order]
        new = np.concatenate([[True], point[1:] != point[:-1]])
        return point[new], c[new]

    def totals(self, books: np.ndarray) -> np.ndarray:
        """Sums and counts of the entries: positions x entries x (components + 1)."""
        parts, k, width = books.shape
        out = np.zeros((parts * k, width + 1), np.int64)
        owned, owner, single, entry = self.walk(books)
        np.add.at(out, self.pos[owned] * k + owner, np.column_stack([self.sum[owned], self.count[owned]]))
        if len(single):
            times = np.bincount(self.point.ravel(), minlength=len(self.points))[single]
            at = self._position(single) * k + entry
            np.add.at(out, at, np.column_stack([self.points[single] * times[:, None], times]))
        return out.reshape(parts, k, width + 1)

    def _position(self, point: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lo[self.roots], point, "right") - 1

    def codes(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries (vectors x positions) and squared error of every vector."""
        owned, owner, single, entry = self.walk(books)
        code = np.empty(len(self.points), np.int64)
        code[single] = entry
        size = self.hi[owned] - self.lo[owned]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.lo[owned], size)
        code[at] = np.repeat(owner, size)
        error = _square(self.points - books[self._position(np.arange(len(code))), code])
        return code[self.point], error[self.point].sum(1)

    def dumps(self) -> bytes:
        small = {k: v.astype(np.int32) if k in ("centre", "points", "pos", "child", "lo", "hi", "point") else v
                 for k, v in vars(self).items()}
        return pickle.dumps(small, protocol=5)

    @classmethod
    def loads(cls, data: bytes) -> Forest:
        f = cls.__new__(cls)
        for k, v in pickle.loads(data).items():
            setattr(f, k, v.astype(np.int64) if isinstance(v, np.ndarray) and v.dtype == np.int32 else v)
        return f


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): scaled whole components of the vectors that can be coded."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    limit = F.lit(float(BOUND))
    whole = lambda x: F.greatest(-limit, F.least(limit, F.floor(x.cast("double") * scale).cast("double"))).cast("int")
    kept = rows.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.exists("embedding", bad))
    return kept.select("vec_id", "label", F.transform("embedding", whole).alias("v"))


def _forests(batches, parts: int):
    for b in batches:
        for lo in range(0, b.num_rows, BLOCK):
            c = b.slice(lo, BLOCK)
            v = c.column("v").flatten().to_numpy().reshape(c.num_rows, -1).astype(np.int64)
            ids = pa.StructArray.from_arrays([c.column("vec_id"), c.column("label")], ["vec_id", "label"])
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, c.num_rows], pa.int32()), ids),
                 pa.array([Forest(v, parts).dumps()], pa.binary())], ["rows", "forest"])


def _each(batches):
    for b in batches:
        for rows, f in zip(b.column("rows"), b.column("forest")):
            yield rows.values, Forest.loads(f.as_py())


def _next(forests: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round; the driver gets one row for each component of an entry."""
    shared = forests.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        total = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        for _rows, f in _each(batches):
            total += f.totals(shared.value)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "n"])
    got = forests.select("forest", "rows").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
    total.ravel()[got.column("at").to_numpy()] = got.column("n").to_numpy()
    count = total[:, :, -1:]
    return np.where(count > 0, total[:, :, :-1] // np.maximum(count, 1), books)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row with a usable vector."""
    spark = rows.sparkSession
    kept = whole_vectors(rows.select("vec_id", "embedding", "label"))
    kind, label = (rows.schema[c].dataType for c in ("vec_id", "label"))
    sizes = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], T.StructType([
            T.StructField("vec_id", kind), T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
            T.StructField("label_error", T.LongType()), T.StructField("codebooks_sha256", T.StringType())]))
    width = sizes[0]["n"]
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    kept = kept.filter(F.size("v") == width)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    path = work_path(spark, "forests")
    shape = (f"rows array<struct<vec_id:{kind.simpleString()},label:{label.simpleString()}>>, forest binary")
    (kept.mapInArrow(lambda bs: _forests(bs, parts), shape).write
     .option("parquet.block.size", ROW_GROUP).parquet(path))
    forests = spark.read.schema(shape).parquet(path)
    for _ in range(rounds):
        books = _next(forests, books)
    shared = spark.sparkContext.broadcast(books)

    def run(batches):
        for ids, f in _each(batches):
            code, error = f.codes(shared.value)
            text = [bytes(c).hex() for c in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([ids.field("vec_id"), ids.field("label"), pa.array(text), pa.array(error)],
                                             ["vec_id", "label", "code", "error"])
    coded = materialize(forests.mapInArrow(
        run, f"vec_id {kind.simpleString()}, label {label.simpleString()}, code string, error long"), "codes")
    by_label = materialize(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    out = coded.join(checked_broadcast(by_label), F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
