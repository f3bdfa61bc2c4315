"""Spelling variants: words one inserted, deleted or replaced character apart, by pairs of trie nodes.

Every word is a path in a trie of the words and in a trie of the reversed words. A pair (node of the
first i characters, node of the rest) names the word split at i; a pair that leaves out character i
names the word with a gap. Two words with a common gap pair differ in that one character; a word
whose split pair is another's gap pair lacks that one character. As nodes are numbered, the pairs are
exact. In a run of equal characters only the first gap meets split pairs, so each neighbour is met once.

Nodes are numbered in one pass over the sorted words: a node is new where a word leaves the word
before it. Only nodes that several words share are numbered, since no other node joins anything.
Words are sorted in ranges; what a range shares with the next one is known from the ranges' first and
last words (the driver gets these two of each range), so ranges are numbered side by side.

All words with one pair differ in one character, so a group is at most as large as the alphabet. Of
each group a member gets the number of its neighbours and the most frequent one; no pairs are listed.
Chains of forms are shortened by jumps, each round twice as far.

Defined cases: a null or empty text has no words; a null doc_id is written as the empty string; rows
with equal doc_id or text all count; a table without words gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.llm.tables import drop_tables, materialize

LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2
DAMAGE = 97
HELD = 200_000  # distinct words a task holds before it passes them on

# Letters of words are A-Z, a-z and U+00C0 to U+00FF; all else separates them.
_LETTER = [0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0xC0 for b in range(256)]
_FOLD = bytes((b + 32 if b <= 0x5A else b) if ok else 0x20 for b, ok in enumerate(_LETTER))

SPLIT, GAP, FIRST_GAP = range(3)


def text_words(doc_id: str, text: str, damage: int = DAMAGE) -> Counter:
    """Words of a text (as Latin-1 bytes) with their counts, after one code point of some went."""
    out: Counter = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for w, n in Counter(text.encode("latin-1", "replace").translate(_FOLD).split()).items():
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
        if h % damage == 0:
            h %= len(w)
            w = w[:h] + w[h + 1:]
        out[w] += n
    return out


def _counted(batches):
    held: Counter = Counter()

    def flush():
        rows = [(w.decode("latin-1"), n) for w, n in held.items() if len(w) >= LEAST_LENGTH]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()),
                                           pa.array([n for _, n in rows], pa.int64())], ["word", "n"])
    for b in batches:
        for i, t in zip(b.column("id"), b.column("text")):
            if t.is_valid:
                held.update(text_words(i.as_py(), t.as_py()))
            if len(held) > HELD:
                yield flush()
    yield flush()


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counts = rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counts.filter(F.col("n") >= least), "vocabulary")


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


class Ranges:
    """First and last word of each range in order, and the numbers of nodes that cross into a range.

    The root is 0, other crossing nodes are negative, nodes inside a range are made by its pass.
    """

    def __init__(self, edges: list[tuple[int, str, str]]):
        self.at = {part: k for k, (part, _, _) in enumerate(edges)}
        self.edges = [(a, z) for _, a, z in edges]
        self.into: list[list[int]] = []
        next_ = -1
        for k, (a, z) in enumerate(self.edges):
            depth = common(self.edges[k - 1][1], a) if k else 0
            through = common(*self.edges[k - 1]) if k else 0
            path = self.into[k - 1][:min(depth, through) + 1] if k else [0]
            made = depth + 1 - len(path)
            path = path + [next_ - j for j in range(made)]
            next_ -= made
            self.into.append(path)

    def before(self, k: int) -> str:
        return self.edges[k - 1][1] if k else ""

    def after(self, k: int) -> str:
        return self.edges[k + 1][0] if k + 1 < len(self.edges) else ""


def paths(words, ranges: Ranges):
    """(word, node numbers of its shared prefixes, number in order) of (part, word) rows in order."""
    rows = iter(words)
    now = next(rows, None)
    part, made, place = None, 0, 0
    while now is not None:
        if now[0] != part:
            part, made, place = now[0], 0, 0
            k = ranges.at[part]
            path = list(ranges.into[k])
            _, last = ranges.edges[k]
            out = ranges.into[k + 1] if k + 1 < len(ranges.edges) else [0]
        word, then = now[1], next(rows, None)
        ahead = common(word, then[1] if then is not None and then[0] == part else ranges.after(k))
        if ahead >= len(path):
            crossing = min(common(word, last), len(out) - 1)
            for depth in range(len(path), ahead + 1):
                if depth <= crossing:
                    path.append(out[depth])
                else:
                    made += 1
                    path.append((part + 1) << 40 | made)
        yield word, path, (part << 40) | place
        path = path[:ahead + 1]
        place += 1
        now = then


def with_paths(words: DataFrame, key, name: str) -> DataFrame:
    """Adds ``name``, the nodes of the key's shared prefixes, and ``rank``, the key's place in order."""
    spark = words.sparkSession
    kept = [c for c in words.columns if c != "rank"]
    sorted_ = materialize(words.select(*kept, key.alias("key")).repartitionByRange("key")
                          .withColumn("part", F.spark_partition_id()), "ranges")
    edges = sorted_.groupBy("part").agg(F.min("key"), F.max("key")).orderBy("part").collect()
    shared = spark.sparkContext.broadcast(Ranges([tuple(e) for e in edges]))
    schema = sorted_.drop("key", "part").schema.add(name, T.ArrayType(T.LongType())).add("rank", T.LongType())

    def run(batches):
        waiting = []

        def rows():
            for b in batches:
                waiting.append([b.select(kept), 0])
                yield from zip(b.column("part").to_pylist(), b.column("key").to_pylist())
        found, ranks = [], []

        def ready():
            while waiting and len(found) >= waiting[0][0].num_rows:
                b, n = waiting[0][0], waiting[0][0].num_rows
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(found[:n], pa.list_(pa.int64())), pa.array(ranks[:n], pa.int64())],
                    [*kept, name, "rank"])
                del found[:n], ranks[:n]
                waiting.pop(0)
        for _word, path, rank in paths(rows(), shared.value):
            found.append(list(path))
            ranks.append(rank)
            if waiting and len(found) >= waiting[0][0].num_rows:
                yield from ready()
        yield from ready()
    out = materialize(sorted_.repartition("part").sortWithinPartitions("part", "key").mapInArrow(run, schema), name)
    drop_tables(spark, sorted_)
    return out


def word_pairs(word: str, f: list[int], r: list[int]):
    """(prefix node, suffix node, kind) of the splits and gaps whose nodes other words share."""
    n, deep, back = len(word), len(f) - 1, len(r) - 1
    for i in range(max(0, n - back), min(deep, n) + 1):
        yield f[i], r[n - i], SPLIT
    for i in range(max(0, n - 1 - back), min(deep, n - 1) + 1):
        yield f[i], r[n - 1 - i], FIRST_GAP if i == 0 or word[i] != word[i - 1] else GAP


def _pairs(batches):
    for b in batches:
        p, s, kind, at = [], [], [], []
        for k, (w, f, r) in enumerate(zip(*(b.column(c).to_pylist() for c in ("word", "f", "r")))):
            for x, y, z in word_pairs(w, f, r):
                p.append(x)
                s.append(y)
                kind.append(z)
                at.append(k)
        at = pa.array(at, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int64()), pa.array(s, pa.int64()), pa.array(kind, pa.int32()),
             b.column("id").take(at), b.column("n").take(at)], ["p", "s", "kind", "id", "n"])


def near_words(numbered: DataFrame) -> DataFrame:
    """(id, n_near, form_n, form_id): number of near words, and the most frequent, of words that have one."""
    pairs = numbered.select("word", "f", "r", "id", "n").mapInArrow(
        _pairs, "p long, s long, kind int, id long, n long")
    # Best first: more frequent, then earlier in code-point order (ids follow it).
    member = F.struct(F.col("n"), (-F.col("id")).alias("minus"), F.col("kind"))
    groups = (pairs.groupBy("p", "s").agg(F.sort_array(F.collect_list(member), asc=False).alias("m"))
              .filter(F.size("m") > 1)
              .select("m", F.get(F.filter("m", lambda x: x["kind"] == SPLIT), F.lit(0)).alias("whole"),
                      F.filter("m", lambda x: x["kind"] != SPLIT).alias("gaps"),
                      F.filter("m", lambda x: x["kind"] == FIRST_GAP).alias("firsts")))
    bare = lambda x: F.when(x.isNotNull(), F.struct(x["n"].alias("n"), x["minus"].alias("minus")))
    best, second = bare(F.get("gaps", F.lit(0))), bare(F.get("gaps", F.lit(1)))
    each = groups.select(F.explode("m").alias("x"), "whole", F.size("gaps").alias("n_gaps"), F.size("firsts").alias("n_firsts"),
                         best.alias("best"), second.alias("second"), bare(F.get("firsts", F.lit(0))).alias("first"))
    split, meets = F.col("x.kind") == SPLIT, (F.col("x.kind") == FIRST_GAP) & F.col("whole").isNotNull()
    other = F.when(F.col("x.minus") == F.col("best.minus"), F.col("second")).otherwise(F.col("best"))
    each = each.select(
        (-F.col("x.minus")).alias("id"),
        F.when(split, F.col("n_firsts")).otherwise(F.col("n_gaps") - 1 + meets.cast("int")).alias("n_near"),
        F.when(split, F.col("first")).otherwise(F.greatest(other, F.when(meets, bare(F.col("whole"))))).alias("top"))
    return (each.filter("n_near > 0").groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max("top").alias("top"))
            .select("id", "n_near", F.col("top.n").alias("form_n"), (-F.col("top.minus")).alias("form_id")))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root_id) of every word with a form; forms grow in count, so no chain comes back."""
    up = materialize(forms.select("id", F.col("form_id").alias("root_id")), "roots")
    while True:
        further = up.select(F.col("id").alias("root_id"), F.col("root_id").alias("next"))
        up = materialize(up.join(further, "root_id", "left").select(
            "id", F.coalesce("next", "root_id").alias("root_id"), F.col("next").isNotNull().alias("moved")), "roots")
        if up.filter("moved").isEmpty():
            return up.drop("moved")
        up = up.drop("moved")


def group_variants(docs: DataFrame, ratio: int = RATIO, least: int = LEAST_COUNT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = vocabulary(docs.select("doc_id", "text"), least)
    forward = with_paths(words, F.col("word"), "f").withColumnRenamed("rank", "id")
    numbered = with_paths(forward, F.reverse("word"), "r").drop("rank")
    near = materialize(near_words(numbered), "near")
    names = numbered.select("id", "word")
    known = numbered.select("id", "word", "n").join(near, "id", "left")
    changes = F.col("form_n") >= ratio * F.col("n")
    known = materialize(known.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(changes, F.col("form_id")).alias("form_id"),
                                     F.when(changes, F.col("form_n")).alias("form_n")), "known")
    chained = known.filter(F.col("form_id").isNotNull())
    name = lambda c, to: names.select(F.col("id").alias(c), F.col("word").alias(to))
    told = (chained.join(roots(chained), "id").join(name("form_id", "form"), "form_id").join(name("root_id", "root"), "root_id"))
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    alone = known.filter(F.col("form_id").isNull()).select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return told.select(*columns).union(alone.select(*columns))
