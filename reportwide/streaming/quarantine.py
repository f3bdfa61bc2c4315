"""Replay of quarantined pages (S5, T1): mended pages enter once.

A page is known by the hash of its raw text. Replayed records are added to a versioned table together
with their page's hash, in one commit; so what was replayed is told by the table itself, and a replay
that is run again, or again after a crash, finds those hashes by an anti join and adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.sources.snapshots import VersionedTable
from reportwide.streaming.ingest import JSON_OPTS, page_schema

PAGE = "_page"


def page_key(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def open_pages(quarantine: DataFrame, replayed: VersionedTable) -> DataFrame:
    """(page, value): quarantined pages that have not been replayed, each text once."""
    pages = quarantine.select(page_key(F.col("value")).alias(PAGE), "value").dropDuplicates([PAGE])
    done = replayed.read()
    return pages if done is None else pages.join(done.select(PAGE).distinct(), PAGE, "left_anti")


def replay(quarantine: DataFrame, mended: DataFrame, record: T.StructType, replayed: VersionedTable) -> DataFrame:
    """Add the records of mended pages, and return the pages that stay open: (page, value, text).

    ``mended`` has (page, text): the hash of a quarantined text and the text to take in its place. A
    mended text that does not parse in full, and a page without one (text null), stay open. A page mended
    twice is an error of the caller: the smaller text is taken.
    """
    texts = mended.groupBy(PAGE).agg(F.min("text").alias("text"))
    full = T.StructType(page_schema(record).fields + [T.StructField("__corrupt", T.StringType())])
    doc = F.from_json("text", full, {**JSON_OPTS, "columnNameOfCorruptRecord": "__corrupt"})
    pages = open_pages(quarantine, replayed).join(texts, PAGE, "left").withColumn("doc", doc)
    good = F.coalesce(F.col("doc.data").isNotNull() & F.col("doc.__corrupt").isNull(), F.lit(False))
    # An empty page leaves its hash too: the record is null then.
    replayed.append(pages.filter(good).select(PAGE, F.explode_outer("doc.data").alias("record")))
    return open_pages(quarantine, replayed).join(texts, PAGE, "left")


def replayed_records(replayed: VersionedTable) -> DataFrame | None:
    rows = replayed.read()
    return None if rows is None else rows.filter("record is not null").select("record.*")
