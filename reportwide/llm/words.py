"""Words, 64-bit word hashes and word n-grams of Arrow text columns, vectorised with numpy.

Texts are worked through in slices of about a megabyte, so a task's memory does not follow
the size of its Arrow batches (``pieces`` does the same for whole batches). A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
PIECE_BYTES = 4 << 20

# Separator bytes of the two kinds of words the operators use.
# SPACE: words [^\x20\x09-\x0D]+; ALNUM: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
SPACE = np.zeros(256, np.bool_)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
ALNUM = np.zeros(256, np.bool_)
ALNUM[0x00:0x30] = True
ALNUM[0x3A:0x61] = True
ALNUM[0x7B:0x80] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

# For bytes.translate: A-Z to lower case, the other ALNUM separators to a space.
ALNUM_TABLE = bytes(0x20 if ALNUM[b] else int(b) for b in LOWER)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


class _Family:
    """A polynomial hash modulo 2**64 over random byte values: any span from prefix sums."""

    def __init__(self, seed: int, base: int):
        self.values, self.base = _byte_values(seed), base
        self.inverse = pow(base, -1, 1 << 64)
        self._grow(SLICE_BYTES + 1)

    def _grow(self, n: int) -> None:
        def powers(b):
            p = np.full(n, np.uint64(b))
            p[0] = 1
            return np.multiply.accumulate(p)
        self.pow, self.inv = powers(self.base), powers(self.inverse)

    def spans(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(buf)
        if n >= len(self.pow):
            self._grow(2 * n)
        c = np.empty(n + 1, np.uint64)
        c[0] = 0
        np.cumsum(self.values[buf] * self.pow[:n], out=c[1:])
        size = (ends - starts).astype(np.uint64)
        return mix((c[ends] - c[starts]) * self.inv[starts] + size * np.uint64(0xD1342543DE82EF95))


_FAMILIES: dict[int, _Family] = {}


def family(i: int) -> _Family:
    if i not in _FAMILIES:
        _FAMILIES[i] = _Family(0x5851F42D4C957F2D * (i + 1) % (1 << 64), (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)[i])
    return _FAMILIES[i]


def slices(text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets into them) of runs of rows up to ``limit`` bytes."""
    if text.null_count:
        text = pc.fill_null(text, "")
    if not len(text):
        return
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    offs = np.frombuffer(text.buffers()[1], kind)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def pieces(batches) -> Iterator[pa.RecordBatch]:
    """Record batches cut into slices of at most ``PIECE_BYTES``, or of one row."""
    for b in batches:
        left = [b]
        while left:
            b = left.pop()
            if b.num_rows > 1 and b.nbytes > PIECE_BYTES:
                half = b.num_rows // 2
                left += [b.slice(half), b.slice(0, half)]
            else:
                yield b


@dataclass
class Words:
    """Words of a slice: byte spans, document of each word, first word of each document."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def n(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        return family(which).spans(self.buf, self.starts, self.ends)


def tokenize(buf: np.ndarray, offs: np.ndarray, separators: np.ndarray, lower: bool = False) -> Words:
    if lower:
        buf = LOWER[buf]
    n = len(buf)
    is_word = ~separators[buf]
    edge = offs[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    before = np.zeros(n, np.bool_)
    before[1:] = is_word[:-1]
    before[edge] = False
    after = np.zeros(n, np.bool_)
    after[:-1] = is_word[1:]
    after[edge - 1] = False
    starts = np.flatnonzero(is_word & ~before)
    return Words(buf, starts, np.flatnonzero(is_word & ~after) + 1, np.searchsorted(starts, offs))


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words (also those that cross documents)."""
    n = max(0, len(h) - k + 1)
    g = h[:n].copy()
    for j in range(1, k):
        g *= np.uint64(0x9E3779B97F4A7C15)
        g += h[j:j + n]
    return mix(g)


def inside(doc: np.ndarray, k: int) -> np.ndarray:
    """True where a run of k words stays in one document."""
    n = max(0, len(doc) - k + 1)
    return doc[:n] == doc[k - 1:k - 1 + n]


def covered(hit: np.ndarray, k: int, n: int) -> np.ndarray:
    """Words (of n) that a marked run of k words covers; ``hit`` marks run starts."""
    step = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(hit)
    step[:n] += np.bincount(at, minlength=n)[:n]
    step += np.bincount(at + k, minlength=n + 1)[:n + 1] * -1
    return np.cumsum(step)[:n] > 0
