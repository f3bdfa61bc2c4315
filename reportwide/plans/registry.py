"""Registry of named queries and their DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame``. Its oracle is ANSI SQL over the same
parquet tables (pre-registered as views of the same names). Queries whose result cannot be
stated in SQL register without an oracle and are checked against brute force in tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import every module that registers queries."""
    from reportwide.plans import (  # noqa: F401
        q_flatten, q_io, q_keys, q_paging, q_profile, q_stream, q_tables, q_urls, q_wide, q_windows)
