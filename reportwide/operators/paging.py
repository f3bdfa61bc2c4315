"""Sorting, top-k and offset/limit paging.

Paging needs a total order: callers pass key columns that break every tie (``tie_breakers``),
otherwise page edges may repeat or skip rows.

``global_row_number`` numbers rows of a whole table without a single-partition window: the
table is range-partitioned and sorted by Spark, each row gets its partition id and position
inside the partition, the sorted table is written once to the checkpoint folder (so positions
stay fixed if an executor is lost and tasks re-run), and a table of per-partition offsets -
one row per partition, a bound known before the job - is broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportwide.operators.wide import col
from reportwide.session import checkpoint_dir

# Directions of a sort specification (O2).
ASC, DESC, ASC_CI, DESC_CI = "ASC", "DESC", "ASC_CI", "DESC_CI"

# A page window [start, start + limit) up to this many rows uses Spark's top-k operator
# (TakeOrderedAndProject): every task keeps only its best start + limit rows.
TOP_K_LIMIT = 100_000


def sort_columns(spec: Sequence[tuple[str, str] | dict]) -> list[Column]:
    """Order columns from (property, direction) pairs or {property, direction} records."""
    out = []
    for item in spec:
        if isinstance(item, dict):
            prop, direction = item["property"], item.get("direction", ASC)
        else:
            prop, direction = item
        d = direction.upper()
        c = col(prop)
        if d.endswith("_CI"):
            c = F.lower(c)
        if d.startswith("DESC"):
            out.append(c.desc_nulls_last())
        elif d.startswith("ASC"):
            out.append(c.asc_nulls_first())
        else:
            raise ValueError(f"unknown sort direction {direction!r}")
    return out


def with_tie_breakers(order: Sequence[Column], keys: Sequence[str]) -> list[Column]:
    return list(order) + [col(k).asc_nulls_first() for k in keys]


def sort_by_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sort by the key columns (O1); use inside writers via ``sortWithinPartitions``."""
    return df.orderBy(*[col(k).asc_nulls_last() for k in keys])


def head(df: DataFrame, keys: Sequence[str] | Sequence[Column], n: int = 10) -> DataFrame:
    """First n rows in key order (O3); planned as a top-k, never a full sort."""
    order = [col(k) if isinstance(k, str) else k for k in keys]
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: Sequence[Column], start: int, limit: int,
         top_k_limit: int = TOP_K_LIMIT) -> DataFrame:
    """One offset/limit page (O4). Up to ``top_k_limit`` rows deep it is a top-k; deeper pages
    number the rows in parallel. Both give the same rows."""
    if start + limit <= top_k_limit:
        return df.orderBy(*order).offset(start).limit(limit)
    rn = global_row_number(df, order, "__rn")
    return rn.filter((F.col("__rn") > start) & (F.col("__rn") <= start + limit)).drop("__rn")


def write_sorted(df: DataFrame, keys: Sequence[str], path: str, n_files: int | None = None) -> str:
    """Save a table range-partitioned and sorted by its keys (nulls first), so that the files' minima
    and maxima let a seek skip files and row groups."""
    order = [col(k).asc_nulls_first() for k in keys]
    ranged = df.repartitionByRange(n_files, *order) if n_files else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.parquet(path)
    return path


def page_after(df: DataFrame, keys: Sequence[str], after: Sequence | None, limit: int) -> DataFrame:
    """The page that follows the row with the key values ``after`` (None: the first page), in key order.

    Seek instead of offset (O4): the cost does not grow with the depth of the page. ``keys`` must be a
    total order. The bound on the first key is a plain comparison, which reaches the scan; on a table
    of ``write_sorted`` it skips what lies before. Nulls come first, as in ``write_sorted``.
    """
    if after is not None:
        if len(after) != len(keys):
            raise ValueError(f"{len(after)} values for {len(keys)} keys")
        later, same = F.lit(False), F.lit(True)
        for k, v in zip(keys, after):
            c = col(k)
            later = later | (same & (c.isNotNull() if v is None else (c > F.lit(v))))
            same = same & (c.isNull() if v is None else (c == F.lit(v)))
        df = df.filter(F.coalesce(later, F.lit(False)))
        if after[0] is not None:
            df = df.filter(col(keys[0]) >= F.lit(after[0]))
    return df.orderBy(*[col(k).asc_nulls_first() for k in keys]).limit(limit)


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """1-based row number over the whole table in the given order, computed in parallel."""
    checkpoint_dir(df.sparkSession)
    tagged = (df.orderBy(*order)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__pos", F.monotonically_increasing_id()
                          .bitwiseAND(F.lit((1 << 33) - 1)))
              .checkpoint(eager=True))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(name, F.col("__off") + F.col("__pos") + 1)
            .drop("__pid", "__pos", "__off"))


def paginate(df: DataFrame, order: Sequence[Column], page_size: int) -> DataFrame:
    """Every page at once: page number and row within page for each row."""
    rn = global_row_number(df, order, "__rn")
    return (rn.withColumn("page", F.floor((F.col("__rn") - 1) / page_size).cast("bigint"))
            .withColumn("row_in_page", ((F.col("__rn") - 1) % page_size).cast("bigint"))
            .drop("__rn"))


def page_sizes(paged: DataFrame, page_size: int, first_id: str | Column,
               by: Sequence[str] = ()) -> DataFrame:
    """Rows per page, last-page flag and the id of each page's first row."""
    ident = col(first_id) if isinstance(first_id, str) else first_id
    return (paged.groupBy(*by, "page")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.min_by(ident, F.col("row_in_page")).alias("first_id"))
            .withColumn("is_last", F.col("n_rows") < F.lit(page_size)))
