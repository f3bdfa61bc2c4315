"""JSON parsing, record-path explode, struct flattening, positional widening and drop-last
(N1-N4, P9, J3, S5)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reportwide.operators import flatten as FL
from reportwide.operators.paging import paginate
from reportwide.plans.registry import register, table


@register("json_field",
          "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def q_json_field(spark: SparkSession, sf_dir: str):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return FL.parse_json(ev, "props", "k int").select("event_id", F.col("doc.k").alias("k"))


BROKEN = ("CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1) "
          "ELSE props END")


@register("bad_pages",
          f"SELECT event_id, CASE WHEN json_valid({BROKEN}) THEN CAST(json_extract({BROKEN}, "
          f"'$.k') AS INTEGER) END AS k, NOT json_valid({BROKEN}) AS is_corrupt FROM events")
def q_bad_pages(spark: SparkSession, sf_dir: str):
    # Some pages arrive truncated; they are flagged for quarantine, not silently lost.
    ev = table(spark, sf_dir, "events").select("event_id", F.expr(BROKEN).alias("props"))
    parsed = FL.parse_json(ev, "props", "k int", corrupt="is_corrupt")
    return parsed.select("event_id", F.col("doc.k").alias("k"), "is_corrupt")


PAGE_SIZE = 100
RECORD_SCHEMA = ("page bigint, data array<struct<conv: struct<id: bigint, turn: bigint>, "
                 "role: string, text: string, meta: struct<n_chars: bigint>>>")


def conversation_pages(spark: SparkSession, sf_dir: str):
    """Conversations landed as JSON pages {page, data: [record, ...]} of at most 100 records."""
    conv = table(spark, sf_dir, "conversations")
    paged = paginate(conv, [F.col("conv_id"), F.col("turn")], PAGE_SIZE)
    rec = F.struct(F.struct(F.col("conv_id").alias("id"), F.col("turn").alias("turn")).alias("conv"),
                   "role", "text",
                   F.struct(F.length("text").cast("bigint").alias("n_chars")).alias("meta"))
    # One group per page: bounded by the page size, not by the data. Records keep their order.
    keyed = F.struct(F.col("row_in_page").alias("pos"), rec.alias("rec"))
    pages = paged.groupBy("page").agg(
        F.transform(F.array_sort(F.collect_list(keyed)), lambda x: x["rec"]).alias("data"))
    return pages.select(F.to_json(F.struct("page", "data")).alias("body"))


@register("flatten_pages",
          "SELECT conv_id AS conv_id, turn AS conv_turn, role, text, "
          "CAST(length(text) AS BIGINT) AS meta_n_chars FROM conversations")
def q_flatten_pages(spark: SparkSession, sf_dir: str):
    pages = FL.parse_json(conversation_pages(spark, sf_dir), "body", RECORD_SCHEMA)
    records = FL.explode_path(pages.select("doc.*"), ["data"])
    return FL.flatten_struct(records, sep="_")


def _max_turns(spark: SparkSession, sf_dir: str) -> int:
    row = table(spark, sf_dir, "conversations").agg(F.max("turn").alias("m")).first()
    return int(row["m"]) + 1 if row and row["m"] is not None else 0


@register("positional_widen",
          "SELECT conv_id, " + ", ".join(
              f"max(CASE WHEN turn = {i} THEN role END) AS \"{i}_role\", "
              f"max(CASE WHEN turn = {i} THEN CAST(length(text) AS BIGINT) END) AS \"{i}_n_chars\""
              for i in range(8)) + " FROM conversations GROUP BY conv_id")
def q_positional_widen(spark: SparkSession, sf_dir: str):
    conv = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.length("text").cast("bigint").alias("n_chars"))
    return FL.widen_rows(conv, ["conv_id"], "turn", ["role", "n_chars"],
                         _max_turns(spark, sf_dir), sep="_")


LINE_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"


@register("drop_last",
          f"SELECT {LINE_COLS} FROM (SELECT {LINE_COLS}, row_number() OVER (PARTITION BY "
          "l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) "
          "AS rn FROM lineitem) WHERE rn > 1")
def q_drop_last(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return FL.drop_last_rows(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey",
                                                  "l_quantity"])


PARENT = "CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_orderkey END"


@register("drop_last_nullparent",
          f"SELECT parent, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT {PARENT} AS "
          f"parent, {LINE_COLS}, row_number() OVER (PARTITION BY {PARENT} ORDER BY l_linenumber DESC, "
          "l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn > 1")
def q_drop_last_nullparent(spark: SparkSession, sf_dir: str):
    # Rows without a parent are the children of one null parent, here a third of all rows.
    li = table(spark, sf_dir, "lineitem").select(
        F.expr(PARENT).alias("parent"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return FL.drop_last_rows(li, ["parent"], ["l_linenumber", "l_partkey", "l_suppkey",
                                              "l_quantity"])


DOC_SIZE = 5
_DOC_SQL = (f"SELECT o_orderkey, o_totalprice, (rn - 1) // {DOC_SIZE} AS page, (rn - 1) % {DOC_SIZE} AS "
            "pos FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)")


def order_documents(spark: SparkSession, sf_dir: str):
    """Orders nested in documents {page, games: [{id, price}]} of at most five."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    paged = paginate(orders, [F.col("o_orderdate"), F.col("o_orderkey")], DOC_SIZE)
    game = F.struct("row_in_page", F.struct(F.col("o_orderkey").alias("id"),
                                            F.col("o_totalprice").alias("price")).alias("g"))
    return paged.groupBy("page").agg(
        F.transform(F.array_sort(F.collect_list(game)), lambda x: x["g"]).alias("games"))


@register("widen_document",
          "SELECT page, " + ", ".join(
              f"max(CASE WHEN pos = {i} THEN o_orderkey END) AS \"{i}_id\", "
              f"max(CASE WHEN pos = {i} THEN o_totalprice END) AS \"{i}_price\""
              for i in range(DOC_SIZE)) + f" FROM ({_DOC_SQL}) GROUP BY page")
def q_widen_document(spark: SparkSession, sf_dir: str):
    # J3, N3 on an array inside a document.
    return FL.widen_array(order_documents(spark, sf_dir), "games", ["id", "price"], DOC_SIZE, sep="_")


@register("drop_last_document",
          "SELECT page, o_orderkey AS id, o_totalprice AS price FROM (SELECT *, count(*) OVER "
          f"(PARTITION BY page) AS n FROM ({_DOC_SQL})) WHERE pos < n - 1")
def q_drop_last_document(spark: SparkSession, sf_dir: str):
    # P9 on an array inside a document.
    docs = order_documents(spark, sf_dir).withColumn("games", FL.drop_last_element("games"))
    return FL.explode_path(docs, ["games"], keep=["page"])


SCHEDULE_SCHEMA = ("page bigint, dates array<struct<date: string, games: array<struct<id: bigint, "
                   "status: string, price: double>>>>")


def order_schedule_pages(spark: SparkSession, sf_dir: str):
    """Orders landed as schedule-like pages {page, dates: [{date, games: [...]}]}: pages of 100
    orders by (date, key), games grouped per date inside the page."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("d"), "o_orderstatus", "o_totalprice")
    paged = paginate(orders, [F.col("d"), F.col("o_orderkey")], PAGE_SIZE)
    game = F.struct(F.col("row_in_page").alias("pos"), F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price")).alias("g"))
    # Both groupings are per page (at most 100 rows), never per date over the whole table.
    per_date = paged.groupBy("page", "d").agg(
        F.transform(F.array_sort(F.collect_list(game)), lambda x: x["g"]).alias("games"))
    day = F.struct(F.col("d").alias("pos"), F.struct(F.date_format("d", "yyyy-MM-dd").alias("date"),
                                                       "games").alias("x"))
    pages = per_date.groupBy("page").agg(
        F.transform(F.array_sort(F.collect_list(day)), lambda x: x["x"]).alias("dates"))
    return pages.select(F.to_json(F.struct("page", "dates")).alias("body"))


@register("explode_path",
          "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price FROM orders")
def q_explode_path(spark: SparkSession, sf_dir: str):
    # N1 over a two-level record path dates[].games[]; parent fields are not carried down.
    docs = FL.parse_json(order_schedule_pages(spark, sf_dir), "body", SCHEDULE_SCHEMA)
    return FL.explode_path(docs.select("doc.*"), ["dates", "games"])


NESTED_SCHEMA = ("order struct<key: bigint, cust: struct<key: bigint, nation: int>>, "
                 "price double, status string")


@register("flatten_struct",
          "SELECT o.o_orderkey AS order_key, o.o_custkey AS order_cust_key, "
          "c.c_nationkey AS order_cust_nation, o.o_totalprice AS price, o.o_orderstatus AS status "
          "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey")
def q_flatten_struct(spark: SparkSession, sf_dir: str):
    # Nested records (as a JSON source would deliver them) flattened to a_b_c columns.
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rec = orders.join(cust, "o_custkey", "left").select(F.to_json(F.struct(
        F.struct(F.col("o_orderkey").alias("key"),
                 F.struct(F.col("o_custkey").alias("key"),
                          F.col("c_nationkey").alias("nation")).alias("cust")).alias("order"),
        F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))).alias("body"))
    parsed = FL.parse_json(rec, "body", NESTED_SCHEMA).select("doc.*")
    return FL.flatten_struct(parsed, sep="_")
