"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0 to n - 1 in the order of doc_id, size and checksum (range-partitioned sort,
in parallel). A keyed Feistel network permutes the smallest even-bit domain that holds n;
values outside are permuted again until they fall inside (cycle walking), which gives a
permutation of 0 to n - 1. Row p of the permuted order lies in shard p mod shards at slot
p div shards: counts differ by at most one, slots have no gaps, and shard and slot of any row
number can be computed, or inverted, without the table.

Defined cases: null doc_ids come first and null texts have size 16; rows equal in all three
sort columns are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportwide.llm.words import mix
from reportwide.operators.paging import global_row_number

SEED = 20240601
ROUNDS = 6


class Feistel:
    """Permutation of 0 to n - 1."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, ((max(1, n - 1)).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        return mix(x + key) & self.mask

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in self.keys:
            left, right = right, left ^ self._round(right, k)
        return (left << np.uint64(self.half)) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in self.keys[::-1]:
            left, right = right ^ self._round(left, k), left
        return (left << np.uint64(self.half)) | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(np.asarray(x, np.uint64))
        while (out := x >= np.uint64(self.n)).any():
            x[out] = step(x[out])
        return x.astype(np.int64)

    def forward(self, x) -> np.ndarray:
        return self._walk(x, self._once)

    def inverse(self, x) -> np.ndarray:
        return self._walk(x, self._back)


def shard(docs: DataFrame, shards: int = 40, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    numbered = global_row_number(rows, [F.col("doc_id"), F.col("size"), F.col("text_crc32")], "row_number")
    n = numbered.count()
    kind = rows.schema["doc_id"].dataType.simpleString()

    def place(batches):
        f = Feistel(n, seed)
        for b in batches:
            p = f.forward(b.column("row_number").to_numpy() - 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("size"), b.column("text_crc32"),
                 pa.array(["rows"] * len(p), pa.string()), pa.array((p % shards).astype(np.int32)),
                 pa.array(p // shards), pa.nulls(len(p), pa.int32())],
                ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"])
    return numbered.mapInArrow(
        place, f"doc_id {kind}, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")
