"""One stream of landed pages to a table for each report, each batch once.

A micro-batch is written once, split into a folder for each report, and every report's folder is added
to that report's versioned table under the stream's name and the batch number. A batch that is sent
again (a restart after a crash between the write and the stream's own checkpoint, or a pull by hand
with the same number) finds its number in the tables' manifests and changes nothing; one that had
reached only some of the tables is added to the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportwide.operators.wide import col
from reportwide.sources.snapshots import VersionedTable

NULL_REPORT = "__HIVE_DEFAULT_PARTITION__"


def report_tables(spark: SparkSession, root: str) -> dict[str | None, VersionedTable]:
    """{report: table} of all reports below ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    names = [f.getPath().getName() for f in fs.listStatus(path) if f.getPath().getName().startswith("report=")]
    tables = {n: VersionedTable(spark, f"{root.rstrip('/')}/{n}") for n in sorted(names)}
    return {None if n == f"report={NULL_REPORT}" else unquote(n[len("report="):]): t for n, t in tables.items() if t.versions()}


def send_batch(df: DataFrame, root: str, report: str, stream: str, batch: int, compression: str = "gzip") -> list[str]:
    """Add the rows of one batch to the table of their report below ``root``; the names of the reports
    that changed. The column ``report`` says where a row goes; it is not stored again in the table."""
    spark, root = df.sparkSession, root.rstrip("/")
    landing = f"{root}/_landing/{stream}/{batch:012d}-{uuid.uuid4().hex[:8]}"
    rows = df.withColumn("__report", col(report).cast("string")).drop(report)
    # A report may hold most rows of a batch: its rows are written by several tasks.
    salt = F.pmod(F.xxhash64(*[col(c) for c in rows.columns]), F.lit(8))
    rows = rows.withColumnRenamed("__report", "report").repartition("report", salt)
    rows.write.option("compression", compression).partitionBy("report").parquet(landing)
    path = spark._jvm.org.apache.hadoop.fs.Path(landing)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    changed = []
    for f in fs.listStatus(path):  # one entry for each report of the batch
        name = f.getPath().getName()
        if name.startswith("report="):
            table, folder = VersionedTable(spark, f"{root}/{name}"), f"{landing}/{name}"
            if folder in table.add(folder, table.schema_of(folder, rows.drop("report")), stream, batch).folders:
                changed.append(name[len("report="):])
    return changed


def fan_out(root: str, report: str, stream: str) -> Callable[[DataFrame, int], None]:
    """The function for ``writeStream.foreachBatch``."""
    def send(df: DataFrame, batch: int) -> None:
        send_batch(df, root, report, stream, batch)
    return send


def ingest_reports(stream: DataFrame, root: str, report: str, checkpoint: str, name: str) -> int:
    """Drain the stream into the report tables; the number of the last batch, -1 if there was none."""
    q = (stream.writeStream.foreachBatch(fan_out(root, report, name)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q.lastProgress["batchId"] if q.lastProgress else -1
