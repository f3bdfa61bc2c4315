"""Streaming ingest of landed pages, with restart and de-duplication."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.plans.registry import register, table
from reportwide.session import work_path
from reportwide.sources.snapshots import VersionedTable
from reportwide.streaming.ingest import ingest_pages, land_pages
from reportwide.streaming.quarantine import page_key, replay, replayed_records

EVENT_RECORD = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType())])
EVENT_COLS = [f.name for f in EVENT_RECORD.fields]


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(*EVENT_COLS)


@register("stream_pages", f"SELECT {', '.join(EVENT_COLS)} FROM events")
def q_stream_pages(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "stream_pages")
    land_pages(_events(spark, sf_dir), f"{base}/landing", ["ts", "event_id"], page_size=100)
    ingest_pages(spark, f"{base}/landing", EVENT_RECORD, f"{base}/table", f"{base}/ckpt")
    # A restart with the same checkpoint finds no new file and appends nothing.
    ingest_pages(spark, f"{base}/landing", EVENT_RECORD, f"{base}/table", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/table")


@register("stream_dedup", f"SELECT {', '.join(EVENT_COLS)} FROM events")
def q_stream_dedup(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "stream_dedup")
    # Every page lands twice in the first pull and once more in a later re-pull; the stream
    # keeps one copy of each event across both runs.
    for copies in (2, 1):
        land_pages(_events(spark, sf_dir), f"{base}/landing", ["ts", "event_id"],
                   page_size=100, copies=copies)
        ingest_pages(spark, f"{base}/landing", EVENT_RECORD, f"{base}/table", f"{base}/ckpt",
                     dedup_keys=["event_id"], event_time="ts", delay="30 days")
    return spark.read.parquet(f"{base}/table")


@register("stream_bad_pages",
          "SELECT event_id, FALSE AS bad FROM events UNION ALL SELECT NULL, TRUE FROM "
          "(SELECT row_number() OVER () AS i FROM events) WHERE i % 100 = 1")
def q_stream_bad_pages(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "stream_bad_pages")
    land_pages(_events(spark, sf_dir), f"{base}/landing", ["ts", "event_id"], page_size=100)
    # Every page also lands cut in half: none of these parses, and each must be kept aside.
    spark.read.text(f"{base}/landing").select(F.expr("left(value, length(value) div 2)").alias("value")) \
        .write.text(f"{base}/cut")
    ingest_pages(spark, f"{base}/{{landing,cut}}", EVENT_RECORD, f"{base}/table", f"{base}/ckpt",
                 quarantine=f"{base}/bad")
    good = spark.read.parquet(f"{base}/table").select("event_id", F.lit(False).alias("bad"))
    return good.unionByName(spark.read.parquet(f"{base}/bad").select(
        F.lit(None).cast("long").alias("event_id"), F.lit(True).alias("bad")))


@register("stream_backfill", f"SELECT {', '.join(EVENT_COLS)} FROM events")
def q_stream_backfill(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "stream_backfill")
    events = _events(spark, sf_dir)
    month = F.date_trunc("month", "ts")
    last = events.agg(F.max(month)).first()[0]
    # The newest month lands first, all older months (and rows without a time) in a later pull.
    for part in (events.filter(month == F.lit(last)), events.filter(~month.eqNullSafe(F.lit(last)))):
        land_pages(part, f"{base}/landing", ["ts", "event_id"], page_size=100)
        ingest_pages(spark, f"{base}/landing", EVENT_RECORD, f"{base}/table", f"{base}/ckpt",
                     dedup_keys=["event_id"])
    return spark.read.parquet(f"{base}/table")


@register("stream_replay", f"SELECT {', '.join(EVENT_COLS)} FROM events")
def q_stream_replay(spark: SparkSession, sf_dir: str):
    base = work_path(spark, "stream_replay")
    land_pages(_events(spark, sf_dir), f"{base}/whole", ["ts", "event_id"], page_size=100)
    # Every other page lands cut in half. It is kept aside, mended later, and replayed twice.
    pages = spark.read.text(f"{base}/whole").withColumn("cut", F.expr("left(value, length(value) div 2)"))
    odd = F.xxhash64("value") % 2 != 0
    pages.select(F.when(odd, F.col("cut")).otherwise(F.col("value")).alias("value")).write.text(f"{base}/landing")
    ingest_pages(spark, f"{base}/landing", EVENT_RECORD, f"{base}/table", f"{base}/ckpt", quarantine=f"{base}/bad")
    mended = pages.filter(odd).select(page_key(F.col("cut")).alias("_page"), F.col("value").alias("text"))
    replayed = VersionedTable(spark, f"{base}/replayed")
    for _ in range(2):
        still_open = replay(spark.read.schema("file string, value string").parquet(f"{base}/bad"), mended, EVENT_RECORD, replayed)
    if not still_open.isEmpty():
        raise RuntimeError("a mended page stayed open")
    good, late = spark.read.parquet(f"{base}/table"), replayed_records(replayed)
    return good if late is None else good.unionByName(late)
