"""URL decomposition, rebuild and override over ``pages.url``."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reportwide.functions import urls as U
from reportwide.plans.registry import register, table

HEAD = "regexp_extract(url, '^([^?#]*)', 1)"
SCHEME = f"regexp_extract({HEAD}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
REST0 = f"CASE WHEN {SCHEME} = '' THEN {HEAD} ELSE substr({HEAD}, length({SCHEME}) + 2) END"
REST = f"CASE WHEN starts_with({REST0}, '//') THEN substr({REST0}, 3) ELSE {REST0} END"
BASE_SQL = f"lower({SCHEME}) || '://' || {REST}"
QUERY_SQL = "regexp_extract(url, '^[^?#]*\\?([^#]*)', 1)"


@register("url_split",
          f"SELECT page_id, {BASE_SQL} AS base, {QUERY_SQL} AS query FROM pages")
def q_url_split(spark: SparkSession, sf_dir: str):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", U.url_base("url").alias("base"), U.url_query("url").alias("query"))


def _dec(x: str) -> str:
    return f"coalesce(try(url_decode(replace({x}, '+', ' '))), replace({x}, '+', ' '))"


# One row per kept parameter piece, with its position among kept pieces.
PAIRS_SQL = (
    f"WITH s AS (SELECT page_id, url, {BASE_SQL} AS base, string_split({QUERY_SQL}, '&') AS parts "
    "FROM pages), p AS (SELECT page_id, base, unnest(parts) AS piece, "
    "generate_subscripts(parts, 1) AS ord FROM s), "
    "kv AS (SELECT page_id, base, ord, split_part(piece, '=', 1) AS rk, "
    "substr(piece, strpos(piece, '=') + 1) AS rv FROM p WHERE strpos(piece, '=') > 0), "
    f"d AS (SELECT page_id, base, ord, {_dec('rk')} AS key, {_dec('rv')} AS value FROM kv "
    "WHERE length(rv) > 0)")


@register("url_params",
          f"{PAIRS_SQL} SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY ord) "
          "- 1 AS INTEGER) AS pos, key, value FROM d")
def q_url_params(spark: SparkSession, sf_dir: str):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", F.posexplode(U.url_pairs("url")).alias("pos", "kv")).select(
        "page_id", "pos", "kv.key", "kv.value")


def _enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def _query_sql(extra: str) -> str:
    """Encoded query of each page, repeated keys grouped at their first position, plus extra."""
    return (
        f"{PAIRS_SQL}, o AS (SELECT *, min(ord) OVER (PARTITION BY page_id, key) AS first_ord "
        "FROM d), q AS (SELECT page_id, string_agg(" + _enc("key") + " || '=' || " + _enc("value")
        + ", '&' ORDER BY first_ord, ord) AS qs FROM o GROUP BY page_id) "
        f"SELECT pg.page_id, {BASE_SQL.replace('url', 'pg.url')} || '?' || {extra} AS url_out "
        "FROM pages pg LEFT JOIN q USING (page_id)")


# Fixed value: the filter text placed into the raw parameter.
PREDICATE = 'gameDate<="2000-10-31 23:59:59" and gameDate>="2000-10-01" and gameTypeId=2'


@register("url_rebuild",
          _query_sql("coalesce(qs, '') || '&" + U.RAW_PARAM + "=" + PREDICATE + "'"))
def q_url_rebuild(spark: SparkSession, sf_dir: str):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", U.replace_param("url", U.RAW_PARAM, F.lit(PREDICATE))
                        .alias("url_out"))


@register("url_override",
          _query_sql("concat_ws('&', nullif(coalesce(qs, ''), ''), 'limit=100', 'start=200')"))
def q_url_override(spark: SparkSession, sf_dir: str):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", U.alter_url("url", start=200, limit=100).alias("url_out"))


LINK_BASE = "https://stats.example.org/api/v1"


@register("url_link",
          f"SELECT page_id, '{LINK_BASE}' || regexp_extract({HEAD}, '^[a-z]+://[^/]*(.*)$', 1) "
          "|| '/stats' AS link FROM pages")
def q_url_link(spark: SparkSession, sf_dir: str):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    path = F.regexp_extract(F.regexp_extract("url", r"^([^?#]*)", 1), r"^[a-z]+://[^/]*(.*)$", 1)
    return pages.select("page_id", U.absolute_link(path, LINK_BASE, "/stats").alias("link"))
