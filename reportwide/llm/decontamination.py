"""Benchmark decontamination with a positional inverted index, in DataFrame functions only.

``build_index`` stores postings (key, pos, term) of the training texts for a vocabulary of test
terms; a text's key is its 64-bit hash. ``search`` picks the rarest terms of each test phrase by
their counts in the index, reads only their posting lists, shifts positions by the term's offset
in the phrase and intersects the lists by counting the terms that agree on a start. Phrases are
then compared word by word with the texts that hold such a start, so hash collisions and terms
that were not looked up do no harm. Proximity matches come from the same lists: all looked-up
terms at shifted positions at most ``slop`` apart, in any order.

The test phrases are a stated query set; its tables are broadcast up to a checked number of
rows and joined by shuffle beyond. Posting lists are never gathered: starts are counted with
partial aggregates, and equal texts share their key. A text row meets its own starts only.

Defined cases: a null or empty text has no words; items with a null item_id or without words
have no phrases; rows with equal or null doc_id are judged one by one by their text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from reportwide.llm.tables import checked_broadcast, keep_rest, materialize

PHRASE_WORDS = 10
RAREST = 3
SLOP = 3

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; null has none."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


def phrases(benchmark: DataFrame, size: int = PHRASE_WORDS) -> DataFrame:
    """(phrase_id, phrase, terms, items): the different windows of ``size`` words of all items."""
    items = (benchmark.filter("item_id is not null")
             .select(F.col("item_id").cast("string").alias("item"), word_array(F.col("text")).alias("w"))
             .filter(F.size("w") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return (items.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("terms"))
            .groupBy("terms").agg(F.collect_set("item").alias("items"))
            .withColumn("phrase", F.array_join("terms", " "))
            .withColumn("phrase_id", F.xxhash64("phrase")))


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings (key, pos, term) of all texts for the terms of ``vocabulary``, written once."""
    tokens = docs.select(F.xxhash64("text").alias("key"), F.posexplode(word_array(F.col("text"))).alias("pos", "term"))
    return materialize(tokens.join(checked_broadcast(vocabulary.select("term").distinct()), "term")
                       .select("key", "pos", "term"), "postings")


def anchors(index: DataFrame, wanted: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(term, phrase_id, offset, slot, k): the rarest terms of each phrase that can occur at all."""
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    terms = wanted.select("phrase_id", F.posexplode("terms").alias("offset", "term")).join(counts, "term", "left")
    ranked = terms.withColumn("slot", F.row_number().over(
        Window.partitionBy("phrase_id").orderBy(F.coalesce("n", F.lit(0)), "offset")) - 1)
    return (ranked.withColumn("least", F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("phrase_id")))
            .withColumn("k", F.least(F.count(F.lit(1)).over(Window.partitionBy("phrase_id")), F.lit(rarest)))
            .filter((F.col("least") > 0) & (F.col("slot") < rarest))
            .select("term", "phrase_id", "offset", "slot", "k"))


def search(index: DataFrame, wanted: DataFrame, rarest: int = RAREST,
           slop: int | None = SLOP) -> tuple[DataFrame, DataFrame | None]:
    """Exact candidates (key, phrase_id, start) and proximity matches (key, phrase_id).

    A start is one on which all ``rarest`` terms agree. A proximity match has all of them at
    shifted positions at most ``slop`` apart.
    """
    lists = materialize(anchors(index, wanted, rarest), "anchors")
    lists = checked_broadcast(lists)
    full = F.expr("shiftleft(1, k) - 1")
    hits = (index.join(lists, "term")
            .select("key", "phrase_id", (F.col("pos") - F.col("offset")).alias("start"),
                    F.expr("shiftleft(1, slot)").alias("bit"), "k"))
    if slop is not None:  # read twice; exact matches alone are counted as the hits come
        hits = materialize(hits, "hits")
    exact = (hits.filter("start >= 0").groupBy("key", "phrase_id", "start")
             .agg(F.bit_or("bit").alias("bits"), F.first("k").alias("k"))
             .filter(F.col("bits") == full).select("key", "phrase_id", "start"))
    if slop is None:
        return exact, None
    # Each hit opens a window [start, start + slop] and also stands in those of the slop starts before it.
    opened = hits.select("key", "phrase_id", "bit", "k", F.explode(F.sequence(
        F.col("start") - slop, F.col("start"))).alias("low"))
    near = (opened.groupBy("key", "phrase_id", "low").agg(F.bit_or("bit").alias("bits"), F.first("k").alias("k"))
            .filter(F.col("bits") == full).select("key", "phrase_id").distinct())
    return exact, near


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = PHRASE_WORDS,
                  rarest: int = RAREST, slop: int | None = None) -> DataFrame:
    """All columns of ``docs`` with n_words, n_hit, items (sorted) and, given a ``slop``, n_near.

    n_hit counts the words inside an exact occurrence of a phrase, items are the item_ids whose
    phrases occur, n_near the items with a proximity match (exact ones included). Input columns
    of these names are replaced.
    """
    results = ["n_words", "n_hit", "items", "n_near"]
    packed = keep_rest(docs.drop(*results), ["text"])
    wanted = materialize(phrases(benchmark, size), "phrases")
    vocabulary = materialize(wanted.select(F.explode("terms").alias("term")).distinct(), "terms")
    index = build_index(docs, vocabulary)
    exact, near = search(index, wanted, rarest, slop)
    known = checked_broadcast(wanted.select("phrase_id", "phrase", "items", F.size("terms").alias("size")))
    starts = (exact.join(known, "phrase_id").groupBy("key")
              .agg(F.collect_list(F.struct("start", "size", "phrase", "items")).alias("found")))
    if near is not None:
        close = (near.join(known, "phrase_id").select("key", F.explode("items").alias("item")).distinct()
                 .groupBy("key").agg(F.count(F.lit(1)).alias("n_near")))
        starts = starts.join(close, "key", "full")
    rows = (packed.withColumn("key", F.xxhash64("text")).join(starts, "key", "left")
            .withColumn("w", word_array(F.col("text"))))
    true_hits = F.filter(F.coalesce("found", F.array()), lambda c: F.array_join(
        F.slice("w", c["start"] + 1, c["size"]), " ") == c["phrase"])
    rows = rows.withColumn("found", true_hits)
    words = F.flatten(F.transform("found", lambda c: F.sequence(c["start"], c["start"] + c["size"] - 1)))
    found = [F.size("w").cast("long").alias("n_words"),
             F.size(F.array_distinct(words)).cast("long").alias("n_hit"),
             F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda c: c["items"])))).alias("items")]
    if near is not None:
        found.append(F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
    return rows.select(*[F.col("text") if c == "text" else F.col(f"__rest.`{c}`") for c in docs.columns
                         if c not in results], *found)
