"""Best-fit packing by fitted length patterns (non-negative least squares).

Texts become token ids, documents longer than a sequence are cut, and the histogram of piece
lengths (at most ``capacity`` + 1 numbers, whatever the corpus) is planned on the driver:

* patterns of two or three lengths that fill a sequence exactly are enumerated; repeat counts
  x >= 0 with the least squared distance between the pattern's lengths and the histogram are
  found by exact block coordinate descent (patterns with the same smallest length share no
  other length, so their block reduces to finding one number);
* counts are rounded, clipped to what the histogram has, and the residual pieces are packed
  best-fit decreasing, equal lengths at a time.

The plan is a list of (pattern, count). Pieces take their places by rank within their length:
per-partition counts of lengths give each partition its first ranks, so no length, however
common, is gathered in a task, and texts are not shuffled.

Defined cases: a null or empty text is the single id 0; rows with equal or null doc_id are
packed one by one; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportwide.llm import words as W
from reportwide.llm.tables import materialize

CAPACITY = 2048
END = 0
SWEEPS = 30
# Words a task keeps token ids for; beyond that the memory starts anew.
CACHED_WORDS = 1_000_000
# Words tokenized in one call.
LEARN = 4096

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long, __part int, __seq long"


_ALNUM = np.zeros(256, np.bool_)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, np.bool_)
_STOP[list(b".,;:!?")] = True


class WordTokens:
    """Token ids of the parts of words, remembered by part.

    For tokenizers that drop white space, fold case and split between a letter or digit and a
    punctuation mark, as the one named here: a text's ids are then those of its parts, which are
    cut at white space and before .,;:!? after an ASCII letter or digit, with A-Z in lower case.
    Special tokens stay what the library makes of them (a slice that may hold one keeps its case).
    """

    def __init__(self, path: str):
        # One thread: Spark runs a task on every core, and each thread's allocations stay with the worker.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self):
        self.known = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)
        self.offsets = np.zeros(1, np.int64)

    def _learn(self, h: np.ndarray, texts: list[str]) -> None:
        if len(self.known) + len(h) > CACHED_WORDS and len(self.known):
            self._clear()
        n, parts = np.empty(len(texts), np.int64), [self.ids]
        for a in range(0, len(texts), LEARN):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts[a:a + LEARN], add_special_tokens=False)]
            n[a:a + len(ids)] = list(map(len, ids))
            parts.append(np.array([i for x in ids for i in x], np.uint32))
        at = len(self.lengths) + np.arange(len(texts))
        self.ids = np.concatenate(parts)
        self.lengths = np.concatenate([self.lengths, n])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(n)])
        known, at = np.concatenate([self.known, h]), np.concatenate([self.at, at])
        order = np.argsort(known, kind="stable")
        self.known, self.at = known[order], at[order]

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in order, number of ids of each row)."""
        raw = buf.tobytes()
        w = W.tokenize(buf, offs, W.SPACE, lower=b"<|" not in raw)
        if not w.n:
            return np.empty(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        cuts = np.flatnonzero(_STOP[buf[1:]] & _ALNUM[buf[:-1]]) + 1
        cuts = cuts[~np.isin(cuts, w.starts)]  # a document may end before the mark
        starts = np.sort(np.concatenate([w.starts, cuts]))
        w = W.Words(w.buf, starts, np.sort(np.concatenate([w.ends, cuts])), np.searchsorted(starts, offs))
        h, first, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, h)
        new = np.ones(len(h), np.bool_)
        inner = place < len(self.known)
        new[inner] = self.known[place[inner]] != h[inner]
        if new.any():
            raw = w.buf.tobytes()
            if len(self.known) + new.sum() > CACHED_WORDS:
                self._clear()
                new[:] = True
            self._learn(h[new], [raw[w.starts[i]:w.ends[i]].decode() for i in first[new]])
            place = np.searchsorted(self.known, h)
        at = self.at[place][inverse]
        n = self.lengths[at]
        ends = np.cumsum(n)
        take = np.arange(ends[-1]) + np.repeat(self.offsets[at] - (ends - n), n)
        total = np.concatenate([[0], ends])
        return self.ids[take], total[w.first[1:]] - total[w.first[:-1]]


def _cut(path: str, capacity: int):
    def run(batches):
        from pyspark import TaskContext
        part, seq, tokens = TaskContext.get().partitionId(), 0, WordTokens(path)
        for b in batches:
            for lo, _hi, buf, offs in W.slices(b.column("text")):
                ids, n = tokens.encode(buf, offs)
                ends = np.cumsum(n)
                rows, out = [], []
                for i, (a, z) in enumerate(zip((ends - n).tolist(), ends.tolist())):
                    own = np.append(ids[a:z], np.uint32(END)).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        x = own[start:start + capacity]
                        rows.append(lo + i)
                        out.append((piece, start, len(x), zlib.crc32(x.tobytes())))
                piece, start, length, crc = np.array(out, np.int64).reshape(-1, 4).T
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(length), pa.array(crc),
                     pa.array(np.full(len(rows), part, np.int32)), pa.array(seq + np.arange(len(rows)))],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "__part", "__seq"])
                seq += len(rows)
    return run


def fit_counts(histogram: np.ndarray, capacity: int, sweeps: int = SWEEPS) -> list[tuple[tuple[int, ...], float]]:
    """Non-negative repeat counts of the exact patterns of two and three lengths."""
    x2 = np.zeros(capacity // 2 + 1)
    x3: dict[int, np.ndarray] = {}
    r = histogram.astype(np.float64).copy()
    small = [a for a in range(1, capacity // 3 + 1) if histogram[a]]
    blocks = {a: (np.arange(a, (capacity - a) // 2 + 1),) for a in small}
    blocks = {a: (b, capacity - a - b) for a, (b,) in blocks.items()}
    pair = np.arange(1, capacity // 2 + 1)

    def add(at, by):
        np.add.at(r, at, by)

    for _ in range(sweeps):
        moved = 0.0
        # Pairs: no two share a length; a pattern of two equal lengths counts its length twice.
        old = x2[pair]
        same = pair * 2 == capacity
        grad = np.where(same, 2 * r[pair], r[pair] + r[capacity - pair])
        new = np.maximum(0, old + grad / np.where(same, 4, 2))
        add(pair, old - new)
        add(capacity - pair, old - new)
        x2[pair] = new
        moved += float(np.abs(new - old).sum())
        for a in small:
            b, c = blocks[a]
            old = x3.get(a, np.zeros(len(b)))
            # Patterns (a, a, c) or (a, b, b) hold a length twice; they are left to pairs' and best fit.
            use = (b != a) & (b != c) & (c != a)
            u = np.where(use, (r[b] + r[c]) / 2 + old, -np.inf)
            total = r[a] + old.sum()
            # x = max(0, u - s) with s = (sum(x) - total) / 2: sort and find the active set.
            top = np.sort(u[u > -np.inf])[::-1]
            k = np.arange(1, len(top) + 1)
            s = (np.cumsum(top) - total) / (2 + k)
            active = int((top > s).sum())
            shift = s[active - 1] if active else -total / 2
            new = np.where(use, np.maximum(0, u - shift), 0.0)
            add(b, old - new)
            add(c, old - new)
            r[a] += old.sum() - new.sum()
            x3[a] = new
            moved += float(np.abs(new - old).sum())
        if moved < 1e-3 * max(1, histogram.sum()):
            break
    out = [((int(p), capacity - int(p)), float(x2[p])) for p in pair if x2[p] > 0]
    for a, x in x3.items():
        b, c = blocks[a]
        out += [((a, int(b[i]), int(c[i])), float(x[i])) for i in np.flatnonzero(x > 0)]
    return out


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences): every piece of the histogram once."""
    left = histogram.astype(np.int64).copy()
    done: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        done.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    for pattern, x in sorted(fit_counts(left, capacity), key=lambda p: -p[1]):
        need = defaultdict(int)
        for v in pattern:
            need[v] += 1
        n = min(int(x + 0.5), *(int(left[v]) // k for v, k in need.items()))
        if n > 0:
            done.append((pattern, n))
            for v, k in need.items():
                left[v] -= n * k
    # Residual: best-fit decreasing; bins of equal content are one entry (content, count) per free space.
    free: dict[int, list[list]] = defaultdict(list)
    spaces: list[int] = []

    def put(space, content, count):
        if space == 0:
            done.append((content, count))
            return
        if space not in free:
            bisect.insort(spaces, space)
        free[space].append([content, count])

    for v in range(capacity - 1, 0, -1):
        n = int(left[v])
        while n:
            i = bisect.bisect_left(spaces, v)
            space = spaces[i] if i < len(spaces) else capacity
            content, count = free[space].pop() if i < len(spaces) else ((), -(-n // (capacity // v)))
            if i < len(spaces) and not free[space]:
                del free[space]
                spaces.pop(i)
            each = space // v
            whole = min(count, n // each)
            if whole:
                put(space - each * v, content + (v,) * each, whole)
                n -= whole * each
            if n and whole < count:
                put(space - n * v, content + (v,) * n, 1)
                whole, n = whole + 1, 0
            if whole < count and content:
                put(space, content, count - whole)
    done += [(content, count) for rest in free.values() for content, count in rest]
    return done


class Places:
    """Rank within a length -> (sequence, offset), from a plan. Its size follows the plan's."""

    def __init__(self, steps: list[tuple[tuple[int, ...], int]], capacity: int):
        firsts = np.concatenate([[0], np.cumsum([n for _, n in steps])]) if steps else np.zeros(1, np.int64)
        runs: dict[int, list] = defaultdict(list)
        for (pattern, n), first in zip(steps, firsts.tolist()):
            offset = 0
            for v in pattern:
                runs[v].append((n, first, offset))
                offset += v
        self.by_length = {}
        for v, x in runs.items():
            n, first, offset = np.array(x, np.int64).T
            self.by_length[v] = (np.cumsum(n) - n, first, offset)

    def find(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, first, offset = self.by_length[length]
        i = np.searchsorted(starts, rank, "right") - 1
        return first[i] + rank - starts[i], offset[i]


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = materialize(docs.select("doc_id", "text").mapInArrow(
        _cut(tokenizer_path, capacity), PIECES.format(id=kind)), "pieces")
    # Bounded by partitions x (capacity + 1); summed per length on the executors for the plan.
    counts = materialize(pieces.groupBy("__part", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r["length"]] = r["n"]
    places = docs.sparkSession.sparkContext.broadcast(Places(plan(histogram, capacity), capacity))
    lead = Window.partitionBy("length").orderBy("__part")
    first = counts.select("__part", "length", (F.sum("n").over(lead) - F.col("n")).alias("__first"))
    # Ranks within one partition's pieces of a length, plus those of the partitions before.
    own = Window.partitionBy("__part", "length").orderBy("__seq")
    ranked = (pieces.withColumn("__rank", F.row_number().over(own) - 1).join(first, ["__part", "length"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("__first") + F.col("__rank")).alias("rank")))

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for v in np.unique(length).tolist():
                at = np.flatnonzero(length == v)
                sequence[at], offset[at] = places.value.find(v, rank[at])
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
