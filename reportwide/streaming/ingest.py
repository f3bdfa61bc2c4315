"""Incremental page ingest and de-duplication with Structured Streaming.

Landed JSON pages ({"data": [record, ...]}, one page per line) are read as a file stream,
their records unpacked with ``inline`` and appended to a parquet table. The checkpoint
records which files were consumed, so a restart appends nothing twice (exactly-once file
sink). ``trigger(availableNow=True)`` drains what has landed and stops, which suits a
scheduled job; drop it for a continuously running query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reportwide.operators.paging import paginate
from reportwide.session import settings

ROCKSDB_PROVIDER = ("org.apache.spark.sql.execution.streaming.state."
                    "RocksDBStateStoreProvider")

# Full microsecond precision for timestamps in landed JSON.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_FORMAT}


def land_pages(df: DataFrame, path: str, order: Sequence[str], page_size: int = 100,
               copies: int = 1) -> str:
    """Write ``df`` as JSON pages of ``page_size`` records (one page per line) below ``path``.

    ``copies`` > 1 lands every page that many times, as a re-pull does. Each page is one
    group of at most ``page_size`` records.
    """
    paged = paginate(df, [F.col(c) for c in order], page_size)
    rec = F.struct(F.col("row_in_page").alias("__pos"),
                   F.struct(*[F.col(c) for c in df.columns]).alias("__rec"))
    # Records keep their order inside the page.
    pages = paged.groupBy("page").agg(
        F.transform(F.array_sort(F.collect_list(rec)), lambda x: x["__rec"]).alias("data"))
    body = pages.select(F.to_json(F.struct("page", "data"), JSON_OPTS).alias("value"))
    if copies > 1:
        body = body.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("__copy")
    body.write.mode("append").text(path)
    return path


def page_schema(record: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("page", T.LongType()),
                         T.StructField("data", T.ArrayType(record))])


def page_stream(spark: SparkSession, path: str, record: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """The records of every page that parses; a field of another type than asked for is null."""
    return _parsed_pages(spark, path, record, max_files_per_trigger).select(F.inline("doc.data"))


def bad_page_stream(spark: SparkSession, path: str, record: T.StructType,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """(file, value): the raw text of every page that does not parse, has no record list, or
    holds a field that ``page_stream`` had to make null."""
    pages = _parsed_pages(spark, path, record, max_files_per_trigger)
    return pages.filter("bad").select("file", "value")


def _parsed_pages(spark: SparkSession, path: str, record: T.StructType,
                  max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    full = T.StructType(page_schema(record).fields + [T.StructField("__corrupt", T.StringType())])
    doc = F.from_json("value", full, {**JSON_OPTS, "columnNameOfCorruptRecord": "__corrupt"})
    bad = F.col("doc.__corrupt").isNotNull() | F.col("doc.data").isNull()
    return (reader.text(path).filter(F.length(F.trim("value")) > 0)
            .select("value", F.col("_metadata.file_path").alias("file"), doc.alias("doc"))
            .withColumn("bad", bad))


def ingest_pages(spark: SparkSession, src: str, record: T.StructType, sink: str,
                 checkpoint: str, dedup_keys: Sequence[str] | None = None,
                 event_time: str | None = None, delay: str | None = None,
                 quarantine: str | None = None) -> int:
    """T1 (and T2 with ``dedup_keys``): append every newly landed record to ``sink`` once.

    With ``event_time`` and a ``delay`` the de-duplication state is bounded by a watermark
    (``dropDuplicatesWithinWatermark``), and rows later than that are not taken; without a delay
    (back-fills of any age) state keeps every key seen and no row is lost. Pages that do not
    parse in full are appended to ``quarantine`` (``sink`` with ``_quarantine`` added if not given), by a
    second query with a checkpoint of its own.
    Returns the number of the last micro-batch of this run, -1 if there was none.
    """
    # De-duplication state lives off the JVM heap in RocksDB, so millions of keys inside the watermark
    # do not pressure executor memory, unless the session names another provider. A query keeps the
    # settings it was started with, a checkpoint the provider.
    provider = "spark.sql.streaming.stateStore.providerClass"
    state = {provider: ROCKSDB_PROVIDER} if dedup_keys and not spark.conf.get(provider, None) else {}
    stream = page_stream(spark, src, record)
    if dedup_keys:
        if event_time and delay:
            # Watermarks need a session-zone timestamp; a local (NTZ) time is read as UTC.
            stream = (stream.withColumn("__et", F.col(event_time).cast("timestamp"))
                      .withWatermark("__et", delay)
                      .dropDuplicatesWithinWatermark(list(dedup_keys)).drop("__et"))
        else:
            stream = stream.dropDuplicates(list(dedup_keys))
    sink, checkpoint = sink.rstrip("/"), checkpoint.rstrip("/")
    with settings(spark, state):
        q = _append(stream, sink, checkpoint)
    bad = _append(bad_page_stream(spark, src, record), quarantine or f"{sink}_quarantine",
                  f"{checkpoint}_quarantine")
    for running in (q, bad):
        running.awaitTermination()
        if running.exception() is not None:
            raise running.exception()
    return q.lastProgress["batchId"] if q.lastProgress else -1


def _append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (stream.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())
