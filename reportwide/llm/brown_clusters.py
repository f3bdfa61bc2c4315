"""Exchange clustering of words by the words beside them (Brown classes), over adjacency rows.

Every training word is a row (frequent words are several) that holds its neighbours with their counts.
The ``core``, the ``CORE`` most frequent words, have numbers: their classes are a small array that every
task gets, so a round over core words is a narrow pass over the rows, without a join or a shuffle. Other
words have their classes in a table that is joined.

1. The ``SEEDS`` most frequent words are exchanged one by one, on their own.
2. Core words are exchanged in rounds. A round has two passes: the counts of class transitions, and the
   best class of every word given all others. Words move together, half of them in a round; a round
   that lowers the likelihood is taken back, and then half as many move. The rounds end when one gains
   less than ``TOLERANCE`` a token.
3. Other words take the best class by their core neighbours; then rounds go on over all words and all
   neighbours, with the same rule to end (``Others``). Words outside the core are packed into buckets, a row
   each, beside their classes. In a round they send their class to their neighbours; messages travel packed by
   the neighbour's bucket, and one pass over the buckets moves the words and sends the next messages.
   ``_near`` and ``other_counts`` are the same round written with joins; tests hold them against brute force.

The ``HEAVY`` most frequent words and the end of a text are dealt over ``PIECES`` rows by neighbour;
tasks send the class counts of these pieces, and the driver finds their best classes. What else reaches
the driver: classes of core words, class transitions, both bounded by parameters and the number of
classes, which grows with the cube root of the vocabulary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportwide.llm import words as W
from reportwide.llm.tables import drop_tables, materialize, release
from reportwide.session import work_path

SEEDS = 512
CORE = 1 << 18
HEAVY = 1024
PIECES = 64
CLASSES = 40  # at least
SWEEPS = 10  # over the seeds
TOLERANCE = 0.005  # nats
END_HASH = np.uint64(1)
CELLS = 1_000_000  # of the largest array of a block
TOKENS = 1 << 22  # of a block of texts whose adjacency rows are made together
PAIRS = 1 << 18  # of a batch of adjacency rows
SMALL = 32  # counts whose gains are looked up

_OUT, _IN, _SELF = range(3)


class Lookup:
    """Position of hashes in a sorted table, or -1.

    ``start`` leads from the upper bits of a hash to the first of the table with such bits."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        bits = max(1, len(hashes).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.start = np.searchsorted(self.sorted >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1)
        if not len(self.sorted):
            return out
        upper = (h >> self.shift).astype(np.int64)
        at, end = self.start[upper], self.start[upper + 1]
        left = np.flatnonzero(at < end)
        at, end, h = at[left], end[left], h[left]
        for _ in range(8):  # hashes are even: hardly any has so many beside it
            hit = self.sorted[at] == h
            out[left[hit]] = self.order[at[hit]]
            at = at + 1
            go = np.flatnonzero(~hit & (at < end))
            if not len(go):
                return out
            left, at, end, h = left[go], at[go], end[go], h[go]
        i = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        out[left] = np.where(self.sorted[i] == h, self.order[i], -1)
        return out


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def cluster(table: np.ndarray, size: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each of the first ``size`` units; the other units keep a class each."""
    units = len(table)
    fixed = units - size
    of = np.concatenate([np.arange(size) % classes, classes + np.arange(fixed)])
    total = classes + fixed
    hot = np.zeros((units, total))
    hot[np.arange(units), of] = 1
    g = hot.T @ table @ hot
    out, into = table @ hot, table.T @ hot  # units x classes
    for _ in range(sweeps):
        moved = False
        for w in range(size):
            a, self_ = of[w], table[w, w]
            o, i = out[w].copy(), into[w].copy()
            o[a] -= self_
            i[a] -= self_
            g[a, :] -= o
            g[:, a] -= i
            g[a, a] -= self_
            # Likelihood gained by adding the word to each class c.
            rows, cols = g[:classes], g[:, :classes]
            gain = (_f(rows + o) - _f(rows)).sum(1) + (_f(cols + i[:, None]) - _f(cols)).sum(0)
            c = np.arange(classes)
            d = g[c, c]
            gain += _f(d + o[c] + i[c] + self_) - _f(d) - (_f(d + o[c]) - _f(d)) - (_f(d + i[c]) - _f(d))
            left, right = (g.sum(1) + i)[:classes], (g.sum(0) + o)[:classes]
            n_out, n_in = o.sum() + self_, i.sum() + self_
            gain -= _f(left + n_out) - _f(left) + _f(right + n_in) - _f(right)
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            g[best, :] += o
            g[:, best] += i
            g[best, best] += self_
            if best != a:
                moved = True
                of[w] = best
                out[:, a] -= table[:, w]
                out[:, best] += table[:, w]
                into[:, a] -= table[w, :]
                into[:, best] += table[w, :]
        if not moved:
            break
    return of[:size]


class Gains:
    """What a count adds to the likelihood of each transition: small counts are looked up."""

    def __init__(self, g: np.ndarray):
        self.g, self.sums = g, (g.sum(1), g.sum(0))
        self.before, self.after = np.ascontiguousarray(g.T), g  # rows: the neighbour's class
        self.known: dict[tuple[int, int], np.ndarray] = {}
        self.sizes = [_f(x + np.arange(SMALL + 1.0)[:, None]) - _f(x) for x in self.sums]

    def size(self, which: int, n: np.ndarray) -> np.ndarray:
        """What words of n tokens add to the sum of each class, before (0) or after (1)."""
        small = (n <= SMALL) & (n == np.floor(n))
        out = self.sizes[which][np.where(small, n, 0).astype(np.int64)]
        if not small.all():
            big = np.flatnonzero(~small)
            out[big] = _f(self.sums[which] + n[big, None]) - _f(self.sums[which])
        return out

    def rows(self, side: int, d: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Gain of adding n transitions with class d on that side, for every class of the word."""
        table = self.before if side == _OUT else self.after
        out = np.empty((len(d), len(table)))
        for c in np.unique(np.minimum(n, SMALL + 1)).tolist():
            at = np.flatnonzero(np.minimum(n, SMALL + 1) == c)
            if c <= SMALL and c == int(c):
                if (side, int(c)) not in self.known:
                    self.known[side, int(c)] = _f(table + c) - _f(table)
                out[at] = self.known[side, int(c)][d[at]]
            else:
                x = table[d[at]]
                out[at] = _f(x + n[at, None]) - _f(x)
        return out


def best_classes(g: np.ndarray | Gains, classes: int, of: np.ndarray, self_: np.ndarray, o: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Best class of each word, all else left as it is: the gains of ``cluster``, by non-zero counts.

    ``o`` and ``i`` are each word's counts of the classes after and before it, without itself.
    """
    def listed(counts):
        code = np.flatnonzero(counts)
        return code, counts.ravel()[code]
    return _best(g if isinstance(g, Gains) else Gains(g), classes, of, self_, listed(o), listed(i))


def _at(codes: np.ndarray, n: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Counts of the wanted codes, 0 where there is none."""
    if not len(codes):
        return np.zeros(len(want))
    k = np.minimum(np.searchsorted(codes, want), len(codes) - 1)
    return np.where(codes[k] == want, n[k], 0)


def _best(gains: Gains, classes: int, of: np.ndarray, self_: np.ndarray, out: tuple, into: tuple) -> np.ndarray:
    """``best_classes`` of counts given as (word * total + class, count), in order of the first."""
    g, m, total = gains.g, len(of), len(gains.g)
    w = np.arange(m)
    gain = np.zeros((m, total))
    size = []
    for side, table, (code, n), other in ((_OUT, gains.before, out, into), (_IN, gains.after, into, out)):
        row, d = code // total, code % total
        size.append(np.bincount(row, n, m) + self_)
        if not len(d):
            continue
        x = gains.rows(side, d, n)
        # Without the word itself: the column of its own class, and the row of that class.
        at = of[row]
        here = table[d, at] - n
        own = np.flatnonzero(d == at)
        if len(own):
            r = row[own]
            t = table[d[own]]
            t -= _dense_rows(*other, r, total)
            t[np.arange(len(own)), at[own]] -= n[own] + self_[r]
            x[own] = _f(t + n[own, None]) - _f(t)
            here[own] = t[np.arange(len(own)), at[own]]
        x[np.arange(len(d)), at] = _f(here + n) - _f(here)
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        gain[row[first]] += np.add.reduceat(x, first, axis=0)
    # Within a class: nothing to correct where the word does not stand on both sides of the class.
    both = np.intersect1d(out[0], into[0], assume_unique=True)
    beside = np.flatnonzero(self_ > 0)
    if len(beside):
        both = np.union1d(both, (beside[:, None] * total + np.arange(total)).ravel())
    r, c = both // total, both % total
    o_, i_, s_ = _at(*out, both), _at(*into, both), self_[r]
    d = np.diag(g)[c] - np.where(of[r] == c, o_ + i_ + s_, 0)
    gain[r, c] += _f(d + o_ + i_ + s_) + _f(d) - _f(d + o_) - _f(d + i_)
    for which, n in enumerate(size):
        x = gains.size(which, n)
        left = gains.sums[which][of] - n
        x[w, of] = _f(left + n) - _f(left)
        gain -= x
    best = np.argmax(gain[:, :classes], axis=1)
    return np.where((of < classes) & (gain[w, best] <= gain[w, of] + 1e-9), of, best)


def _dense_rows(code: np.ndarray, n: np.ndarray, rows: np.ndarray, total: int) -> np.ndarray:
    """Counts of all classes of some words (in order, each at most once)."""
    out = np.zeros((len(rows), total))
    lo, hi = np.searchsorted(code, rows * total), np.searchsorted(code, (rows + 1) * total)
    size = hi - lo
    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out[np.repeat(np.arange(len(rows)), size), code[at] % total] = n[at]
    return out


def likelihood(g: np.ndarray) -> float:
    """Log likelihood of the bigrams but for the words' own counts, which no exchange changes."""
    return float(_f(g).sum() - _f(g.sum(1)).sum() - _f(g.sum(0)).sum())


# --- packed rows

# Rows of a bucket of words, packed into arrays: no value is a Spark row of its own. STATE: classes, in order of the
# hashes. TO_WORD, TO_CORE: what words outside the core send to a neighbour: its hash or number, and
# (count, side, class). WORDS: hashes or numbers, then sizes and pairs of both lists of neighbours.
# DEALT, COUNTED: sums by code, for words dealt over pieces and for class transitions. ROWS: adjacency rows of a block
# of texts: hashes, (number, piece), sizes of both lists, and their pairs. COUNTS: hashes, counts and endings.
STATE, TO_WORD, TO_CORE, DEALT, COUNTED, WORDS, ROWS, COUNTS = range(8)
BUCKET = 1 << 14  # words
PACKED_BYTES = 8 << 20  # of adjacency rows that are packed together
HELD = 1 << 20  # messages of a task until they leave
_PACK = "bucket int, kind int, a binary, b binary"
_PACKED = _PACK + ", c binary, d binary, e binary"


def _pack(rows: list[tuple], width: int = 2) -> pa.RecordBatch:
    """A batch of (bucket, kind, array, ...) rows."""
    columns = [pa.array([r[k] for r in rows], pa.int32()) for k in (0, 1)]
    for k in range(2, 2 + width):
        values = [np.ascontiguousarray(r[k]).view(np.uint8).ravel() if len(r) > k else np.empty(0, np.uint8) for r in rows]
        offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
        columns.append(pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(values))]))
    return pa.RecordBatch.from_arrays(columns, ["bucket", "kind", *"abcde"[:width]])


def _unpacked(b: pa.RecordBatch, name: str, k: int, dtype) -> np.ndarray:
    return np.frombuffer(b.column(name)[k].as_buffer(), dtype)


def _buckets(batches):
    """(bucket, {kind: [(batch, row)]}) of rows that come bucket by bucket."""
    now, held = None, {}
    for b in batches:
        for k, (bucket, kind) in enumerate(zip(b.column("bucket").to_pylist(), b.column("kind").to_pylist())):
            if bucket != now:
                if held:
                    yield now, held
                now, held = bucket, {}
            held.setdefault(kind, []).append((b, k))
    if held:
        yield now, held


def _together(*tables: DataFrame, parts: int | None = None) -> DataFrame:
    """Packed rows of several tables, bucket by bucket; ``parts`` keeps few buckets in a task."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    out = out.repartition("bucket") if parts is None else out.repartition(parts, "bucket")
    return out.sortWithinPartitions("bucket", "kind")


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (key.view(np.uint64) % np.uint64(buckets)).astype(np.int32)


def _split(bucket: np.ndarray):
    """(order, [(bucket, from, to)]) that puts rows of a bucket side by side."""
    order = np.argsort(bucket.astype(np.uint16) if not len(bucket) or bucket.max() < 1 << 16 else bucket, kind="stable")
    sorted_ = bucket[order]
    edge = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])[:len(bucket)])
    return order, list(zip(sorted_[edge].tolist(), edge.tolist(), [*edge[1:].tolist(), len(bucket)]))


def _some(rows, width: int = 2, limit: int = 2 << 20):
    """Packed batches of few megabytes."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(x.nbytes for x in r[2:])
        if size > limit:
            yield _pack(held, width)
            held, size = [], 0
    if held:
        yield _pack(held, width)


# --- adjacency rows

_ADJACENCY = "h long, id int, piece int, core binary, tail binary"


def _blobs(values: np.ndarray, size: np.ndarray) -> pa.Array:
    """Binary values made of runs of rows of ``values``."""
    width = values.dtype.itemsize * values.shape[1]
    offsets = np.concatenate([[0], np.cumsum(size * width)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _unblob(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, row of each pair) of a column of ``_blobs``."""
    width = 2 * np.dtype(dtype).itemsize
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    pairs = np.frombuffer(data[offsets[0]:offsets[-1]].tobytes(), dtype).reshape(-1, 2)
    return pairs, np.repeat(np.arange(len(column)), np.diff(offsets) // width)


def _rows_of(h, ids, piece, core, core_row, tail, tail_row) -> pa.RecordBatch:
    n = len(h)
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(ids.astype(np.int32)), pa.array(piece.astype(np.int32)),
         _blobs(core.astype(np.int32), np.bincount(core_row, minlength=n)),
         _blobs(tail.astype(np.int64), np.bincount(tail_row, minlength=n))], ["h", "id", "piece", "core", "tail"])


def _is_dealt(ids: np.ndarray, end: int) -> np.ndarray:
    return ((ids >= 0) & (ids < HEAVY)) | (ids == end)


def _adjacency(batches, shared, tokens_of):
    """Neighbours of the words of a batch of texts. A pair in ``core`` is (number * 4 + side, count), in
    ``tail`` (hash, count * 4 + side); a word beside itself counts once, as side SELF."""
    look, end = shared.value
    for t in _token_blocks(batches, tokens_of):
        u, z = np.unique(t, return_inverse=True)  # every row ends with an end, so all words before are here, too
        ids = look.find(u)
        ids[u == END_HASH] = end
        a = np.concatenate([[np.searchsorted(u, END_HASH)], z[:-1]])
        a *= len(u)
        a += z
        del t, z
        code, n = np.unique(a, return_counts=True)
        del a
        a, z = code // len(u), code % len(u)
        n, differ = n.astype(np.int32), a != z
        del code
        word, other = np.concatenate([a, z[differ]]), np.concatenate([z, a[differ]])
        side = np.concatenate([np.where(differ, np.int8(_OUT), np.int8(_SELF)), np.full(differ.sum(), _IN, np.int8)])
        n = np.concatenate([n, n[differ]])
        del a, z, differ
        piece = np.where(_is_dealt(ids[word], end), (u[other] % np.uint64(PIECES)).astype(np.int64), 0)
        word *= PIECES
        word += piece
        del piece
        order = np.argsort(word, kind="stable")
        word, other, side, n = word[order], other[order], side[order], n[order]
        del order
        new = np.concatenate([[True], word[1:] != word[:-1]])
        key, row = word[new], np.cumsum(new) - 1
        del word, new
        # Rows leave in runs of few pairs: their columns are small.
        edges = np.searchsorted(row, np.arange(len(key) + 1))
        lo = 0
        while lo < len(key):
            hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + PAIRS, "right")) - 1)
            here = slice(edges[lo], edges[hi])
            o, s, c, r, k = other[here], side[here].astype(np.int64), n[here].astype(np.int64), row[here] - lo, key[lo:hi]
            core = ids[o] >= 0
            yield _rows_of(u[k // PIECES], ids[k // PIECES], k % PIECES,
                           np.column_stack([ids[o[core]] * 4 + s[core], c[core]]), r[core],
                           np.column_stack([u[o[~core]].view(np.int64), c[~core] * 4 + s[~core]]), r[~core])
            lo = hi


def _token_blocks(batches, tokens_of):
    """Tokens of whole texts, some ``TOKENS`` at a time: the more, the fewer rows are shuffled."""
    held, size = [], 0
    for b in batches:
        for _lo, _hi, buf, offs in W.slices(b.column("text")):
            t = tokens_of(buf, offs)
            if held and size + len(t) > TOKENS:
                yield np.concatenate(held)
                held, size = [], 0
            held.append(t)
            size += len(t)
    if held:
        yield np.concatenate(held)


def _order(row: np.ndarray, key: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Order by row, key, side."""
    known, place = np.unique(key, return_inverse=True)
    return np.argsort((row * max(1, len(known)) + place) * 4 + side)


def _merged(batches):
    """Rows of one (word, piece), which come one after another, made one."""
    def merge(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        h, piece, ids = (t.column(c).to_numpy() for c in ("h", "piece", "id"))
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (piece[1:] != piece[:-1])])
        row, first = np.cumsum(new) - 1, np.flatnonzero(new)
        parts = []
        for name, dtype in (("core", np.int32), ("tail", np.int64)):
            pairs, at = _unblob(t.column(name).chunk(0), dtype)
            key, side, n = pairs[:, 0], pairs[:, 1] % 4, pairs[:, 1] // 4
            if name == "core":
                side, n = np.zeros_like(key), pairs[:, 1].astype(np.int64)
            order = _order(row[at], key, side)
            r, key, side, n = row[at][order], key[order], side[order], n[order]
            if len(r):
                edge = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (key[1:] != key[:-1]) | (side[1:] != side[:-1])]))
                n = np.add.reduceat(n, edge)
                r, key, side = r[edge], key[edge], side[edge]
                if name == "core" and n.max() > np.iinfo(np.int32).max:
                    raise OverflowError("a word pair occurs more than 2**31 times")
            parts += [np.column_stack([key, n if name == "core" else n * 4 + side]), r]
        return _rows_of(h[first], ids[first], piece[first], *parts)
    held: pa.Table | None = None
    for b in W.pieces(batches):
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        h, piece = t.column("h").to_numpy(), t.column("piece").to_numpy()
        last = np.flatnonzero((h != h[-1]) | (piece != piece[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        held = t.slice(cut)
        if cut:
            yield merge(t.slice(0, cut))
    if held is not None:
        yield merge(held)


def _adjacency_of(batches, buckets: int):
    """Adjacency rows packed by bucket of word and piece, some megabytes of them at a time."""
    def packed(held: list[pa.RecordBatch]):
        t = pa.Table.from_batches(held).combine_chunks()
        h, ids, piece = (t.column(c).to_numpy() for c in ("h", "id", "piece"))
        order, runs = _split(_bucket(W.mix(h.view(np.uint64) + piece.astype(np.uint64)), buckets))
        t = t.take(pa.array(order))
        h, ids, piece = h[order], ids[order], piece[order]
        lists = []
        for name, dtype in (("core", np.int32), ("tail", np.int64)):
            pairs, at = _unblob(t.column(name).combine_chunks(), dtype)
            n = np.bincount(at, minlength=len(h)).astype(np.int32)
            lists.append((n, pairs, np.concatenate([[0], np.cumsum(n, dtype=np.int64)])))
        (n_core, core, c), (n_tail, tail, e) = lists
        for bucket, lo, hi in runs:
            here = slice(lo, hi)
            yield (bucket, ROWS, h[here], np.column_stack([ids[here], piece[here]]), np.column_stack([n_core[here], n_tail[here]]),
                   core[c[lo]:c[hi]], tail[e[lo]:e[hi]])

    def rows():
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.nbytes
            if size > PACKED_BYTES:
                yield from packed(held)
                held, size = [], 0
        if held:
            yield from packed(held)
    return _some(rows(), 5)


def _merged_buckets(batches):
    """``_merged`` rows of packed ones, bucket by bucket."""
    for _bucket_, held in _buckets(batches):
        h, ids, sizes, core, tail = (np.concatenate([_unpacked(b, c, k, t) for b, k in held[ROWS]]) for c, t in zip(
            "abcde", (np.int64, np.int32, np.int32, np.int32, np.int64)))
        ids, sizes, core, tail = (x.reshape(-1, 2) for x in (ids, sizes, core, tail))
        order = np.lexsort((ids[:, 1], h))
        place = np.empty(len(h), np.int64)
        place[order] = np.arange(len(h))
        lists = []
        for n, pairs in zip(sizes.T, (core, tail)):
            to = np.repeat(place, n)
            lists += [pairs[np.argsort(to, kind="stable")], np.sort(to)]
        # Cut between words into batches of few megabytes.
        yield from _merged([_rows_of(h[order].view(np.uint64), ids[order, 0], ids[order, 1], *lists)])


def adjacency(texts: DataFrame, core: np.ndarray, tokens_of, vocabulary: int = 0) -> tuple[DataFrame, DataFrame]:
    """Adjacency rows of core words and of other words, written; ``core`` are the hashes of numbers 0, 1, ...

    Rows travel packed by bucket: no word of a block of texts is a Spark row of its own before it is merged."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((Lookup(core), len(core)))
    buckets = max(32, 2 * vocabulary // BUCKET)
    rows = texts.mapInArrow(lambda bs: _adjacency_of(_adjacency(bs, shared, tokens_of), buckets), _PACKED)
    merged = _together(rows, parts=max(16, buckets // 4)).mapInArrow(_merged_buckets, _ADJACENCY)
    path = work_path(spark, "adjacency")
    merged.withColumn("kind", F.when(F.col("id") >= 0, "core").otherwise("other")).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    schema = merged.schema
    del rows, merged
    release(spark)
    # Reading both kinds from the root keeps a kind without rows readable.
    both = spark.read.schema(schema.add("kind", "string")).parquet(path)
    return tuple(both.filter(F.col("kind") == k).drop("kind") for k in ("core", "other"))


# --- passes over the rows

_NEAR = "h long, id int, piece int, own int, x array<struct<side:int,d:int,n:long>>"


def _class_counts(b: pa.RecordBatch, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, side, class, count) of a batch of adjacency rows: core neighbours, and joined ones if given."""
    pairs, row = _unblob(b.column("core"), np.int32)
    side, d, n = pairs[:, 0] % 4, cls[pairs[:, 0] // 4], pairs[:, 1].astype(np.int64)
    if "x" in b.schema.names:
        x = b.column("x")
        more = np.repeat(np.arange(b.num_rows), np.diff(x.offsets.to_numpy())) if x.null_count < len(x) else np.empty(0, np.int64)
        if len(more):
            s, e, c = (f.to_numpy(zero_copy_only=False) for f in x.flatten().flatten())
            row, side, d, n = np.concatenate([row, more]), np.concatenate([side, s]), np.concatenate([d, e]), np.concatenate([n, c])
    return row, side, d.astype(np.int64), n


def _own(b: pa.RecordBatch, cls: np.ndarray, unknown: int) -> np.ndarray:
    ids = b.column("id").to_numpy()
    own = b.column("own").fill_null(unknown).to_numpy() if "own" in b.schema.names else np.full(len(ids), unknown)
    return np.where(ids >= 0, cls[ids], own).astype(np.int64)


def transition_counts(rows: DataFrame, cls: np.ndarray, total: int) -> np.ndarray:
    """Counts of class transitions out of the words of ``rows``, and into them from words without a class."""
    shared = rows.sparkSession.sparkContext.broadcast(cls)
    unknown = total - 1

    def run(batches):
        g = np.zeros(total * total, np.int64)
        for b in W.pieces(batches):
            own = _own(b, shared.value, unknown)
            row, side, d, n = _class_counts(b, shared.value)
            out = side != _IN
            g += np.bincount(own[row[out]] * total + d[out], n[out], total * total).astype(np.int64)
            if "tail" in b.schema.names:  # neighbours without a class, told by the tail alone
                pairs, at = _unblob(b.column("tail"), np.int64)
                s, c = pairs[:, 1] % 4, pairs[:, 1] // 4
                g += np.bincount(np.where(s == _IN, unknown * total + own[at], own[at] * total + unknown), c, total * total).astype(np.int64)
        code = np.flatnonzero(g)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(g[code])], ["code", "n"])
    return _square(rows.mapInArrow(run, "code long, n long"), total)


def _square(counts: DataFrame, total: int) -> np.ndarray:
    """Sums of (code, n) as a matrix."""
    got = counts.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    g = np.zeros(total * total)
    g[got.column("code").to_numpy()] = got.column("n").to_numpy()
    return g.reshape(total, total)


def other_counts(pairs: DataFrame, of: DataFrame, cls: np.ndarray, total: int) -> np.ndarray:
    """Counts of class transitions out of or into the words outside the core (``of``), from ``_tail_pairs``."""
    shared = pairs.sparkSession.sparkContext.broadcast(cls)
    met = F.col("d").cast("long")

    def run(batches):
        for b in batches:
            ids, side, d, n = (b.column(c).to_numpy() for c in ("id", "side", "d", "n"))
            own = shared.value[ids].astype(np.int64)
            code, at = np.unique(np.where(side == _IN, d * total + own, own * total + d), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(np.bincount(at, n, len(code)).astype(np.int64))], ["code", "n"])
    core = _classed(pairs.filter("id >= 0"), of).select("id", "side", met.alias("d"), "n").mapInArrow(run, "code long, n long")
    rest = _classed(pairs.filter((F.col("id") < 0) & (F.col("side") != _IN)), of).join(
        of.withColumnRenamed("cls", "own"), "h").select((F.col("own") * F.lit(total).cast("long") + met).alias("code"), "n")
    return _square(core.union(rest), total)


def _dense(row, side, d, n, m: int, total: int):
    """(counts after, counts before, self) of m words."""
    o, i = (np.bincount(row[side == s] * total + d[side == s], n[side == s], m * total).reshape(m, total) for s in (_OUT, _IN))
    return o, i, np.bincount(row[side == _SELF], n[side == _SELF], m)


def _moving(h: np.ndarray, parts: int, turn: int) -> np.ndarray:
    return W.mix(h.view(np.uint64)) % np.uint64(parts) == turn % parts


_MOVES = "h long, id int, cls int, code long, n long"


def _moves(batches, shared, classes: int, parts: int, turn: int, end: int):
    """New classes of the words that move (``cls``), and class counts of words dealt over pieces (``code``)."""
    g, cls = shared.value
    gains, total, sums = Gains(g), len(g), []

    def summed():
        code, n = _summed(*(np.concatenate(x) for x in zip(*sums)))
        sums.clear()
        none = pa.nulls(len(code), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(code), np.int64)), none, none, pa.array(code),
                                           pa.array(n.astype(np.int64))], ["h", "id", "cls", "code", "n"])
    for b in W.pieces(batches):
        h, ids = b.column("h").to_numpy(), b.column("id").to_numpy()
        own = _own(b, cls, total - 1)
        go = (_moving(h, parts, turn) | (own > classes)) & (ids != end)
        b, h, ids, own = b.filter(pa.array(go)), h[go], ids[go], own[go]
        row, side, d, n = _class_counts(b, cls)
        dealt = _is_dealt(ids, end)
        keep = dealt[row]
        if keep.any():
            sums.append(_summed((ids[row[keep]].astype(np.int64) * 3 + side[keep]) * total + d[keep], n[keep]))
            if sum(len(x) for x, _ in sums) > HELD:
                yield summed()
        keep = ~dealt[row]
        new = _new_classes(gains, classes, own, row[keep], side[keep], d[keep], n[keep], ~dealt)
        moved = np.flatnonzero(new != own)
        none = pa.nulls(len(moved), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[moved]), pa.array(ids[moved]), pa.array(new[moved].astype(np.int32)), none, none],
            ["h", "id", "cls", "code", "n"])
    if sums:
        yield summed()


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums by code, in order."""
    order = np.argsort(code)
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])[:len(code)])
    return code[first], np.add.reduceat(n[order], first).astype(np.float64) if len(code) else np.zeros(0)


def _new_classes(gains: Gains, classes: int, own: np.ndarray, row, side, d, n, go: np.ndarray) -> np.ndarray:
    """Classes after the words marked in ``go`` have moved; counts (row, side, d, n) in any order."""
    total, new = len(gains.g), own.copy()
    keep = go[row]
    place = np.cumsum(go) - 1
    row, side, d, n = place[row[keep]], side[keep], d[keep], n[keep]
    w = np.flatnonzero(go)
    code, count = _summed((row * 3 + side) * total + d, n)
    at = np.searchsorted(code, np.arange(len(w) + 1) * 3 * total)
    lo = 0
    while lo < len(w):
        # A block: few enough counts and words for the arrays of gains.
        hi = int(np.searchsorted(at, at[lo] + CELLS // total, "right")) - 1
        hi = max(lo + 1, min(hi, lo + CELLS // total, len(w)))
        c, k = code[at[lo]:at[hi]] - lo * 3 * total, count[at[lo]:at[hi]]
        r, s, e = c // (3 * total), c // total % 3, c % total
        out, into, self_ = (np.flatnonzero(s == x) for x in (_OUT, _IN, _SELF))
        new[w[lo:hi]] = _best(gains, classes, own[w[lo:hi]], np.bincount(r[self_], k[self_], hi - lo),
                              *((r[x] * total + e[x], k[x]) for x in (out, into)))
        lo = hi
    return new


def exchange(rows: DataFrame, g: np.ndarray, cls: np.ndarray, classes: int, parts: int, turn: int,
             dealt: DataFrame | None = None) -> tuple[np.ndarray, DataFrame]:
    """(classes of core words, moves) after the words of this turn have moved; other words' moves have a negative id.

    ``dealt``: further counts (id, side, d, n) of words of this turn that are dealt over pieces."""
    spark, end, total = rows.sparkSession, len(cls) - 1, len(g)
    shared = spark.sparkContext.broadcast((g, cls))
    moves = materialize(rows.mapInArrow(lambda bs: _moves(bs, shared, classes, parts, turn, end), _MOVES), "moves")
    new = cls.copy()
    core = moves.filter("id >= 0").select("id", "cls").toArrow()  # at most ``CORE`` rows
    new[core.column("id").to_numpy()] = core.column("cls").to_numpy()
    sums = moves.filter("code is not null").select("code", "n")  # words dealt over pieces
    if dealt is not None:
        sums = sums.union(dealt.select(((F.col("id").cast("long") * 3 + F.col("side")) * total + F.col("d")).alias("code"), "n"))
    sums = sums.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    code, n = sums.column("code").to_numpy(), sums.column("n").to_numpy()
    ids, row = np.unique(code // total // 3, return_inverse=True)
    if len(ids):
        o, i, self_ = _dense(row, code // total % 3, code % total, n, len(ids), total)
        new[ids] = best_classes(g, classes, cls[ids].astype(np.int64), self_, o, i)
    return new, moves


def _seed(rows: DataFrame, size: int, end: int, classes: int, total: int) -> np.ndarray:
    """Classes of core words: the most frequent ones exchanged on their own, the others without a class."""
    seeds = min(SEEDS, size)
    unit = np.full(end + 1, seeds + 1)
    unit[:seeds], unit[end] = np.arange(seeds), seeds
    # The units' transitions are counted like classes.
    table = transition_counts(rows.filter(F.col("id").between(0, seeds - 1) | (F.col("id") == end)), unit, seeds + 2)
    # Words that are no units: what comes out of them is what goes into the units from them.
    table[seeds + 1, :seeds + 1] = _into_units(rows, unit, seeds)
    cls = np.full(end + 1, total - 1)
    cls[:seeds] = cluster(table, seeds, classes)
    cls[end] = classes
    return cls


def _into_units(rows: DataFrame, unit: np.ndarray, seeds: int) -> np.ndarray:
    shared = rows.sparkSession.sparkContext.broadcast(unit)

    def run(batches):
        n = np.zeros(seeds + 1, np.int64)
        for b in W.pieces(batches):
            own = shared.value[b.column("id").to_numpy()]
            row, side, d, c = _class_counts(b, shared.value)
            ok = (side == _IN) & (d == seeds + 1)
            n += np.bincount(own[row[ok]], c[ok], seeds + 2)[:seeds + 1].astype(np.int64)
            pairs, at = _unblob(b.column("tail"), np.int64)
            ok = pairs[:, 1] % 4 == _IN
            n += np.bincount(own[at[ok]], pairs[ok, 1] // 4, seeds + 2)[:seeds + 1].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(seeds + 1)), pa.array(n)], ["code", "n"])
    got = (rows.filter(F.col("id").between(0, seeds - 1) | (F.col("id") == len(unit) - 1)).mapInArrow(run, "code long, n long")
           .groupBy("code").agg(F.sum("n").alias("n")).toArrow())
    n = np.zeros(seeds + 1)
    n[got.column("code").to_numpy()] = got.column("n").to_numpy()
    return n


def _tail_pairs(batches):
    for b in W.pieces(batches):
        pairs, row = _unblob(b.column("tail"), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(b.column(c).to_numpy()[row]) for c in ("h", "piece")]
            + [pa.array(pairs[:, 0]), pa.array((pairs[:, 1] % 4).astype(np.int32)), pa.array(pairs[:, 1] // 4)],
            ["h", "piece", "other", "side", "n"])


def _numbered_pairs(batches):
    """``_tail_pairs`` with the number of their word, in ``id``."""
    for b in W.pieces(batches):
        ids = b.column("id").to_numpy()
        for t in _tail_pairs([b]):
            _pairs, row = _unblob(b.column("tail"), np.int64)
            yield t.append_column("id", pa.array(ids[row]))


def _classed(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """Pairs with the class ``d`` of their neighbour."""
    return pairs.join(of.select(F.col("h").alias("other"), F.col("cls").alias("d")), "other")


def _turn(parts: int, turn: int):
    """The rows of words that move in a turn."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_moving(b.column("h").to_numpy(), parts, turn)))
    return run


def _near(rows: DataFrame, pairs: DataFrame, of: DataFrame, end: int, parts: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """(rows, dealt) for ``exchange`` over all words and all neighbours, not written.

    Only words that move are joined with the classes of their neighbours, and of the core only those that
    have neighbours outside it; what such neighbours add to dealt words is summed apart."""
    move = lambda x: x.mapInArrow(_turn(parts, turn), x.schema)
    dealt = F.col("id").between(0, HEAVY - 1) | (F.col("id") == end)
    alone = dealt | ((F.col("id") >= 0) & (F.length("tail") == 0))
    pairs = move(pairs)
    joined = _with_others(move(rows.filter(~alone).select("h", "id", "piece", "core")),
                          pairs.filter(~dealt).drop("id"), of)
    own = rows.filter(alone).select("h", "id", "piece", F.lit(None).cast("int").alias("own"), "core",
                                    F.array().cast("array<struct<side:int,d:int,n:bigint>>").alias("x"))
    return own.union(joined), _classed(pairs.filter(dealt & (F.col("id") != end)), of).select("id", "side", "d", "n")


def _with_others(rows: DataFrame, pairs: DataFrame, of: DataFrame) -> DataFrame:
    """Adjacency rows with their own class and the class counts of their neighbours outside the core."""
    # One list for each row; a class that comes twice in it is summed where the list is read.
    met = _classed(pairs, of).groupBy("h", "piece").agg(F.collect_list(F.struct("side", "d", "n")).alias("x"))
    # Rows of frequent words are spread by piece; others have one row.
    return rows.join(met, ["h", "piece"], "left").join(
        of.withColumnRenamed("cls", "own").withColumn("piece", F.lit(0)), ["h", "piece"], "left").select(
        "h", "id", "piece", "own", "core", F.coalesce("x", F.array().cast("array<struct<side:int,d:int,n:bigint>>")).alias("x"))


# --- rounds over all words

def _words_of(batches, buckets: int, by: str):
    """Adjacency rows packed by bucket of their hash (``h``) or number (``id``)."""
    def rows():
        for b in batches:
            key = b.column(by).cast(pa.int64()).to_numpy()
            lists = [_unblob(b.column(c), t) for c, t in (("core", np.int32), ("tail", np.int64))]
            order, runs = _split(_bucket(key, buckets))
            sizes = [np.bincount(row, minlength=len(key)).astype(np.int32) for _, row in lists]
            place = np.empty(len(key), np.int64)
            place[order] = np.arange(len(key))
            pairs = [x[np.argsort(place[row], kind="stable")] for x, row in lists]
            ends = [np.concatenate([[0], np.cumsum(n[order], dtype=np.int64)]) for n in sizes]
            for bucket, lo, hi in runs:
                yield (bucket, WORDS, key[order[lo:hi]], *(x for n, p, e in zip(sizes, pairs, ends)
                                                          for x in (n[order[lo:hi]], p[e[lo]:e[hi]])))
    return _some(rows(), 5)


def _one_row(batches):
    """One row of a bucket's words, in order of their hashes or numbers."""
    def rows():
        for bucket, held in _buckets(batches):
            key, n_core, core, n_tail, tail = (np.concatenate([_unpacked(b, c, k, t) for b, k in held[WORDS]]) for c, t in zip(
                "abcde", (np.int64, np.int32, np.int32, np.int32, np.int64)))
            order = np.argsort(key)
            place = np.empty(len(key), np.int64)
            place[order] = np.arange(len(key))
            core, tail = (x.reshape(-1, 2)[np.argsort(np.repeat(place, n), kind="stable")] for x, n in ((core, n_core), (tail, n_tail)))
            yield bucket, WORDS, key[order], n_core[order], core, n_tail[order], tail
    return _some(rows(), 5)


def _words(held, name: str = "a"):
    """(keys, core pairs and their rows, tail pairs and their rows) of a bucket, with no row: empty."""
    if WORDS not in held:
        return None
    b, k = held[WORDS][0]
    key = _unpacked(b, "a", k, np.int64)
    out = [key]
    for size, pairs, t in (("b", "c", np.int32), ("d", "e", np.int64)):
        out += [_unpacked(b, pairs, k, t).reshape(-1, 2), np.repeat(np.arange(len(key)), _unpacked(b, size, k, np.int32))]
    return out


def _messages(held, kind: int, key: np.ndarray):
    """(row, side, class, count) of the messages to the words of a bucket."""
    got = held.get(kind, ())
    to, code = (np.concatenate([np.empty(0, np.int64), *(_unpacked(b, c, k, np.int64) for b, k in got)]) for c in "ab")
    return np.searchsorted(key, to), code >> 16 & 3, code & 0xFFFF, code >> 18


def _core_moves(batches, shared, classes: int, parts: int, turn: int):
    """New classes of core words that are not dealt, from their core neighbours and the messages of others."""
    g, cls, core = shared.value
    gains = Gains(g)
    for _bucket_, held in _buckets(batches):
        words = _words(held)
        if words is None:
            continue
        ids, pairs, at = words[:3]
        own = cls[ids].astype(np.int64)
        go = _moving(core[ids], parts, turn) | (own > classes)
        near = ((at, pairs[:, 0] % 4, cls[pairs[:, 0] // 4], pairs[:, 1]), _messages(held, TO_CORE, ids))
        new = _new_classes(gains, classes, own, *(np.concatenate(x).astype(np.int64) for x in zip(*near)), go)
        moved = np.flatnonzero(new != own)
        yield pa.RecordBatch.from_arrays([pa.array(ids[moved].astype(np.int32)), pa.array(new[moved].astype(np.int32))], ["id", "cls"])


_BACK = np.array([_IN, _OUT, _SELF])  # a neighbour's side, seen from the neighbour


def _other_moves(batches, shared, classes: int, parts: int, turn: int, buckets: int):
    """New classes of words outside the core, and what they send: messages to neighbours that are not dealt, sums for
    those that are, and counts of class transitions between them and the core, whose new classes are known."""
    g, cls, cls_new = shared.value
    gains, total, end = Gains(g), len(g), len(cls) - 1
    counted = np.zeros(total * total)
    sums = (np.empty(0, np.int64), np.empty(0))
    out: dict[int, list] = {TO_WORD: [], TO_CORE: []}

    def sent():
        for kind, held in out.items():
            if held:
                to, code = (np.concatenate(x) for x in zip(*held))
                order, runs = _split(_bucket(to, buckets))
                to, code = to[order], code[order]
                for bucket, lo, hi in runs:
                    yield bucket, kind, to[lo:hi], code[lo:hi]
                held.clear()

    def rows():
        nonlocal counted, sums
        size = 0
        for bucket, held in _buckets(batches):
            words = _words(held)
            if words is None:
                continue
            h, core, at, tail, tail_at = words
            b, k = held[STATE][0] if STATE in held else (None, 0)
            own = np.full(len(h), total - 1) if b is None else _unpacked(b, "a", k, np.int32).astype(np.int64)
            near = ((at, core[:, 0] % 4, cls[core[:, 0] // 4], core[:, 1]), _messages(held, TO_WORD, h))
            go = _moving(h, parts, turn) | (own > classes)
            new = _new_classes(gains, classes, own, *(np.concatenate(x).astype(np.int64) for x in zip(*near)), go)
            yield bucket, STATE, new.astype(np.int32), np.empty(0, np.int32)
            ids, side, n, mine = core[:, 0] // 4, core[:, 0] % 4, core[:, 1].astype(np.int64), new[at]
            theirs = cls_new[ids].astype(np.int64)
            counted += np.bincount(np.where(side == _IN, theirs * total + mine, mine * total + theirs), n, total * total)
            back = _BACK[side]
            dealt = _is_dealt(ids, end)
            some = dealt & (ids != end)
            sums = _summed(np.concatenate([sums[0], (ids[some].astype(np.int64) * 3 + back[some]) * total + mine[some]]),
                           np.concatenate([sums[1], n[some]]))
            out[TO_CORE].append((ids[~dealt].astype(np.int64), (n << 18 | back << 16 | mine)[~dealt]))
            out[TO_WORD].append((tail[:, 0], tail[:, 1] // 4 << 18 | _BACK[tail[:, 1] % 4] << 16 | new[tail_at]))
            size += len(core) + len(tail)
            if size > HELD:
                yield from sent()
                size = 0
        yield from sent()
        code = np.flatnonzero(counted)
        yield 0, COUNTED, code, counted[code].astype(np.int64)
        yield 0, DEALT, sums[0], sums[1].astype(np.int64)
    return _some(rows())


def _codes(batches):
    for b in batches:
        for k in range(b.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(_unpacked(b, c, k, np.int64)) for c in "ab"], ["code", "n"])


class Others:
    """Words outside the core in packed rows, and the core words beside them: what a round over all words reads.

    ``start`` gives the first state, ``move`` the next one; a state is a written table of packed rows.
    """

    def __init__(self, core_rows: DataFrame, other_rows: DataFrame, core: np.ndarray, classes: int, vocabulary: int):
        spark = core_rows.sparkSession
        self.core_rows, self.core, self.classes, self.total, self.end = core_rows, core, classes, classes + 2, len(core)
        self.buckets = buckets = max(32, vocabulary // BUCKET)
        self.parts = max(16, buckets // 8)
        if self.total >= 1 << 16:
            raise OverflowError("more classes than a message holds")
        single = core_rows.filter((F.col("id") >= HEAVY) & (F.col("id") != self.end))
        made = []
        for rows, by in ((other_rows, "h"), (single.withColumn("tail", F.lit(b"")), "id")):
            packed = rows.select(by, "core", "tail").mapInArrow(lambda bs, by=by: _words_of(bs, buckets, by), _PACKED)
            made.append(materialize(_together(packed, parts=self.parts).mapInArrow(_one_row, _PACKED), "packed"))
            release(spark)
        self.others, self.singles = made

    def _pass(self, tables, g, cls, cls_new, parts: int, turn: int) -> DataFrame:
        spark, classes, buckets = self.others.sparkSession, self.classes, self.buckets
        shared = spark.sparkContext.broadcast((g, cls, cls_new))
        out = _together(*tables, parts=self.parts).mapInArrow(lambda bs: _other_moves(bs, shared, classes, parts, turn, buckets), _PACK)
        path = work_path(spark, "state")
        out.write.option("compression", "zstd").partitionBy("kind").parquet(path)
        del out
        release(spark)
        return spark.read.schema(_PACK).parquet(path)

    def start(self, g: np.ndarray, cls: np.ndarray) -> DataFrame:
        """All words outside the core take the best class by their core neighbours."""
        return self._pass((self.others,), g, cls, cls, 1, 0)

    def move(self, g: np.ndarray, cls: np.ndarray, state: DataFrame, parts: int, turn: int) -> tuple[np.ndarray, DataFrame]:
        spark, classes, core = self.others.sparkSession, self.classes, self.core
        heavy = core[:HEAVY]
        ids = np.flatnonzero(_moving(heavy, parts, turn) | (cls[:len(heavy)] > classes)).tolist()
        rows = self.core_rows.filter(F.col("id").isin(ids) if ids else F.lit(False)).drop("tail")
        parted = ("cast(code div {0} as int) id", "cast(code div {1} % 3 as int) side", "cast(code % {1} as int) d", "n")
        dealt = self.codes(state, DEALT).selectExpr(*(x.format(3 * self.total, self.total) for x in parted))
        dealt = dealt.filter(F.col("id").isin(ids) if ids else F.lit(False))
        new, moves = exchange(rows, g, cls, classes, parts, turn, dealt)
        drop_tables(spark, moves)
        shared = spark.sparkContext.broadcast((g, cls, core))
        got = _together(self.singles, state.filter(F.col("kind") == TO_CORE), parts=self.parts).mapInArrow(
            lambda bs: _core_moves(bs, shared, classes, parts, turn), "id int, cls int").toArrow()  # at most ``CORE`` rows
        new[got.column("id").to_numpy()] = got.column("cls").to_numpy()
        release(spark)
        return new, self._pass((self.others, state.filter(F.col("kind").isin(STATE, TO_WORD))), g, cls, new, parts, turn)

    @staticmethod
    def codes(state: DataFrame, kind: int) -> DataFrame:
        return state.filter(F.col("kind") == kind).mapInArrow(_codes, "code long, n long")

    def counts(self, state: DataFrame) -> np.ndarray:
        """Counts of class transitions that touch a word outside the core."""
        total = self.total

        def run(batches):
            g = np.zeros(total * total)
            for _b, held in _buckets(batches):
                if STATE in held and TO_WORD in held:
                    (b, k), (words, at) = held[STATE][0], held[WORDS][0]
                    row, side, d, n = _messages(held, TO_WORD, _unpacked(words, "a", at, np.int64))
                    out = side != _IN
                    own = _unpacked(b, "a", k, np.int32).astype(np.int64)
                    g += np.bincount(own[row[out]] * total + d[out], n[out], total * total)
            code = np.flatnonzero(g)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(g[code].astype(np.int64))], ["code", "n"])
        among = _together(self.others.select("bucket", "kind", "a"), state.filter(F.col("kind").isin(STATE, TO_WORD)))
        return _square(among.mapInArrow(run, "code long, n long").union(self.codes(state, COUNTED)), total)

    def table(self, state: DataFrame) -> DataFrame:
        """(h, cls) of the words outside the core."""
        def run(batches):
            for _b, held in _buckets(batches):
                (words, at), (b, k) = held[WORDS][0], held[STATE][0]
                yield pa.RecordBatch.from_arrays([pa.array(_unpacked(words, "a", at, np.int64)), pa.array(_unpacked(b, "a", k, np.int32))], ["h", "cls"])
        return materialize(_together(self.others.select("bucket", "kind", "a"), state.filter(F.col("kind") == STATE)).mapInArrow(
            run, "h long, cls int"), "classes")


def brown_classes(texts: DataFrame, core: np.ndarray, vocabulary: int, tokens_of) -> tuple[np.ndarray, DataFrame, np.ndarray]:
    """(classes of core words, (h, cls) of the other words, counts of class transitions).

    The class after the words' is that of the end of a text, the one after it that of words not yet in a
    class; the latter is gone at the end.
    """
    spark = texts.sparkSession
    classes = max(CLASSES, round(vocabulary ** (1 / 3)))
    total, end = classes + 2, len(core)
    core_rows, other_rows = adjacency(texts, core, tokens_of, vocabulary)
    cls = _seed(core_rows, len(core), end, classes, total) if len(core) else np.array([classes])
    none = spark.createDataFrame([], "h long, cls int")

    def rounds(state, measure, move):
        """Exchange until a round gains too little; ``measure`` counts the transitions."""
        cls, of = state
        g = measure(cls, of)
        parts, turn, tokens = 2, 0, g.sum()
        while tokens:
            new, of_new = move(g, cls, of, parts, turn)
            g_new = measure(new, of_new)
            waiting = g[:, total - 1].any() or g[total - 1].any()
            gain = (likelihood(g_new) - likelihood(g)) / tokens
            if gain < 0 and not (waiting and turn == 0):  # words that moved together did harm: fewer at a time
                forget(of_new, of)
                parts *= 2
                if parts > vocabulary:
                    break
                continue
            forget(of, of_new)
            cls, of, g, turn = new, of_new, g_new, turn + 1
            if gain < TOLERANCE and turn > 1:
                break
        return (cls, of), g

    def forget(old, kept):
        """Delete a written table that is not the one kept in its place."""
        if old is not kept:
            drop_tables(spark, old)

    def move_core(g, c, of, parts, turn):
        new, moves = exchange(core_rows.drop("tail"), g, c, classes, parts, turn)
        drop_tables(spark, moves)
        return new, of

    (cls, of), g = rounds((cls, none), lambda c, _of: transition_counts(core_rows, c, total), move_core)
    if not other_rows.isEmpty():
        # Words outside the core take the best class by their core neighbours, all at once.
        others = Others(core_rows, other_rows, core, classes, vocabulary)
        drop_tables(spark, other_rows, part="/kind=other")  # they are packed now
        plain = core_rows.drop("tail")
        state = others.start(g, cls)
        (cls, state), g = rounds((cls, state), lambda c, of: transition_counts(plain, c, total) + others.counts(of), others.move)
        of = others.table(state)
        drop_tables(spark, state, others.others, others.singles)
    drop_tables(spark, core_rows)
    return cls, of, g[:classes + 1, :classes + 1]
