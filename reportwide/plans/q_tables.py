"""Versioned tables, footer census, fan-out of a stream and schemas found in the data (S8, S10, T1,
U1, U5, N2, N4)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reportwide.operators.combine import compact
from reportwide.operators.found_schema import normalize
from reportwide.operators.keys import minimal_keys
from reportwide.plans.q_flatten import conversation_pages
from reportwide.plans.q_stream import EVENT_COLS, EVENT_RECORD
from reportwide.plans.registry import register, table
from reportwide.session import work_path
from reportwide.sources.snapshots import VersionedTable
from reportwide.streaming.fanout import ingest_reports, report_tables, send_batch
from reportwide.streaming.ingest import land_pages, page_stream

CHUNKS = 200


@register("chunks_alternating",
          f"SELECT o_orderkey, CASE WHEN o_orderkey % {CHUNKS} % 2 = 0 THEN CAST(trunc(o_totalprice) AS DOUBLE) "
          f"ELSE o_totalprice END AS price, CASE WHEN o_orderkey % {CHUNKS} % 2 = 1 THEN o_orderstatus END AS status, "
          f"CAST(o_orderkey % {CHUNKS} AS INTEGER) AS chunk FROM orders")
def q_chunks_alternating(spark: SparkSession, sf_dir: str):
    # Two hundred chunks whose schemas alternate: even ones hold whole prices, odd ones a further column.
    base = work_path(spark, "chunks_alternating")
    orders = table(spark, sf_dir, "orders").withColumn("chunk", (F.col("o_orderkey") % CHUNKS).cast("int"))
    even = F.col("chunk") % 2 == 0
    whole = orders.filter(even).select("o_orderkey", F.col("o_totalprice").cast("bigint").alias("price"), "chunk")
    exact = orders.filter(~even).select("o_orderkey", F.col("o_totalprice").alias("price"),
                                        F.col("o_orderstatus").alias("status"), "chunk")
    for part in (whole, exact):
        part.repartition("chunk").write.mode("append").partitionBy("chunk").parquet(f"{base}/chunks")
    if not compact(spark, f"{base}/chunks", f"{base}/compact", n_files=4):
        raise RuntimeError("no chunk rows")
    return spark.read.parquet(f"{base}/compact")


@register("table_versions",
          "SELECT 'first' AS version, o_orderkey, CAST(o_custkey AS BIGINT) AS who FROM orders WHERE o_orderkey % 3 = 0 "
          "UNION ALL SELECT 'second', o_orderkey, CAST(o_custkey AS BIGINT) FROM orders WHERE o_orderkey % 3 < 2 "
          "UNION ALL SELECT 'last', o_orderkey, CAST(o_custkey AS BIGINT) FROM orders")
def q_table_versions(spark: SparkSession, sf_dir: str):
    # Pulls are appended (one of them twice) and compacted two times; old versions stay readable.
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("who"))
    t = VersionedTable(spark, work_path(spark, "table_versions"))
    third = lambda k: orders.filter(F.col("o_orderkey") % 3 == k)
    t.append(third(0).withColumn("who", F.col("who").cast("int")), "pull", 0)
    first = t.compact().version
    t.append(third(1), "pull", 1)
    t.append(third(1), "pull", 1)  # sent again: changes nothing
    second = t.compact(n_files=2).version
    t.append(third(2), "pull", 2)
    parts = [t.read(v).select(F.lit(n).alias("version"), "o_orderkey", F.col("who").cast("bigint").alias("who"))
             for n, v in (("first", first), ("second", second), ("last", None))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("stream_fanout", f"SELECT {', '.join(EVENT_COLS)} FROM events")
def q_stream_fanout(spark: SparkSession, sf_dir: str):
    # One stream of pages to a table for each event type; then its batches are sent a second time.
    base = work_path(spark, "stream_fanout")
    events = table(spark, sf_dir, "events").select(*EVENT_COLS)
    land_pages(events, f"{base}/landing", ["ts", "event_id"], page_size=100)
    stream = page_stream(spark, f"{base}/landing", EVENT_RECORD)
    last = ingest_reports(stream, f"{base}/tables", "event_type", f"{base}/ckpt", "events")
    for batch in range(last + 1):
        if send_batch(events, f"{base}/tables", "event_type", "events", batch):
            raise RuntimeError("a batch that was sent twice changed a table")
    out = None
    for report, t in report_tables(spark, f"{base}/tables").items():  # one table for each event type
        rows = t.read().withColumn("event_type", F.lit(report)).select(*EVENT_COLS)
        out = rows if out is None else out.unionByName(rows)
    return events.filter("false") if out is None else out


@register("json_found", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def q_json_found(spark: SparkSession, sf_dir: str):
    # No schema is given: the fields of the property texts are found in the data.
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return normalize(events, "props", keep=["event_id"], corrupt="bad").drop("bad")


@register("pages_found",
          "SELECT conv_id AS conv_id, turn AS conv_turn, CAST(length(text) AS BIGINT) AS meta_n_chars, role, text "
          "FROM conversations")
def q_pages_found(spark: SparkSession, sf_dir: str):
    return normalize(conversation_pages(spark, sf_dir), "body", path=["data"], sep="_")


KEY_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _minimal_sql() -> str:
    sets = [s for n in (1, 2, 3) for s in combinations(KEY_COLUMNS, n)]
    rows = " UNION ALL ".join(
        f"SELECT {list(s)!r} AS ks, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM lineitem)) AS n" for s in sets)
    return (f"WITH s AS ({rows}), u AS (SELECT ks FROM s WHERE n = (SELECT count(*) FROM lineitem)) "
            "SELECT array_to_string(ks, ',') AS keys, CAST(len(ks) AS INTEGER) AS n_columns FROM u WHERE NOT EXISTS "
            "(SELECT 1 FROM u v WHERE len(v.ks) < len(u.ks) AND list_has_all(u.ks, v.ks))")


@register("minimal_keys", _minimal_sql())
def q_minimal_keys(spark: SparkSession, sf_dir: str):
    return minimal_keys(table(spark, sf_dir, "lineitem"), KEY_COLUMNS, max_size=3)
