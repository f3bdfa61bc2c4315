"""Column catalogue, shared columns and candidate join keys.

The catalogue is a DataFrame of (table_name, column_name, position, dtype, non_null), built
with one profiling aggregate per table, so it also says how filled each column is. Overlaps
are joins of that catalogue on the column name; its size is the number of columns, not rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportwide.operators.profile import missing
from reportwide.operators.wide import col


def column_catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = []
    for name, df in tables.items():
        fields = list(df.schema.fields)
        row = df.agg(*[F.count_if(~missing(f)).alias(f"__c{i}") for i, f in enumerate(fields)])
        items = [F.struct(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"),
                          F.lit(i).alias("position"), F.lit(f.dataType.simpleString()).alias("dtype"),
                          F.col(f"__c{i}").alias("non_null")) for i, f in enumerate(fields)]
        parts.append(row.select(F.inline(F.array(*items))))
    return reduce(DataFrame.unionByName, parts)


def schema_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, position, dtype) from the schemas alone; no table is read."""
    rows = [(name, f.name, i, f.dataType.simpleString())
            for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, position int, dtype string")


def common_columns(catalog: DataFrame, a: str, b: str) -> DataFrame:
    """Columns present in both tables (U3), with each side's non-null count."""
    left = catalog.filter(F.col("table_name") == a).select(
        "column_name", F.col("non_null").alias("non_null_a"))
    right = catalog.filter(F.col("table_name") == b).select(
        "column_name", F.col("non_null").alias("non_null_b"))
    return left.join(right, "column_name")


def column_overlap(catalog: DataFrame) -> DataFrame:
    """Every pair of tables that shares columns, with the shared names (U4).

    The pairs are over tables, whose number the caller fixes, not over rows.
    """
    a = catalog.select(F.col("table_name").alias("table_a"), "column_name")
    b = catalog.select(F.col("table_name").alias("table_b"), "column_name")
    j = a.join(b, "column_name").filter(F.col("table_a") < F.col("table_b"))
    return (j.groupBy("table_a", "table_b")
            .agg(F.count(F.lit(1)).alias("n_shared"),
                 F.array_join(F.sort_array(F.collect_set("column_name")), ",").alias("shared")))


def running_keys(columns_per_table: Sequence[tuple[str, Sequence[str]]]) -> list[tuple[str, list[str]]]:
    """Candidate keys as a running set (U5): each table is intersected with the current set;
    when nothing is shared the set is replaced by the table's columns. Returns, per table, the
    columns it shares with the set (empty when the set was replaced)."""
    keys: set[str] = set()
    out = []
    for name, cols in columns_per_table:
        shared = keys & set(cols)
        if shared:
            out.append((name, sorted(shared)))
        else:
            keys = set(cols)
            out.append((name, []))
    return out


def candidate_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """U5 plus a uniqueness check on Spark: a candidate holds when count(*) equals the number
    of distinct key tuples. Output: (table_name, keys, n_rows, n_distinct, is_unique)."""
    cands = running_keys([(n, df.columns) for n, df in tables.items()])
    parts = []
    for name, keys in cands:
        if not keys:
            continue
        df = tables[name]
        stat = (df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
                .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
                     F.count(F.lit(1)).alias("n_distinct")))
        parts.append(stat.select(F.lit(name).alias("table_name"),
                                 F.lit(",".join(keys)).alias("keys"),
                                 F.col("n_rows").cast("bigint").alias("n_rows"), "n_distinct",
                                 (F.col("n_rows") == F.col("n_distinct")).alias("is_unique")))
    if not parts:
        raise ValueError("no table shares columns with an earlier one")
    return reduce(DataFrame.unionByName, parts)


# Relative standard error of the sketches that prune the search, and how many of them an estimate
# must lie below the row count before a set is given up without an exact count.
SKETCH_ERROR = 0.02
SIGMAS = 8
# Column sets in one aggregate.
SETS_AT_ONCE = 16
# A set is looked for repeats in one of so many parts of its values before all of them are grouped.
SLICES = 64


def _repeats(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether two rows agree on all the columns; nulls agree with nulls."""
    return not df.groupBy(*[col(c) for c in columns]).count().filter("count > 1").isEmpty()


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, max_size: int = 3) -> DataFrame:
    """Minimal unique column sets of the data (U5): (keys, n_columns), names joined by commas.

    A set is unique when no two rows agree on all its columns (nulls agree with nulls); minimal when
    no proper part of it is. Sets are tried level by level: a set that holds a key is not tried, one
    whose parts have too few distinct values between them (their estimates multiplied) cannot be
    unique, and one sketch aggregate over the sets that are left gives up those whose estimate lies
    ``SIGMAS`` standard errors below the row count. Every set still standing is decided by an exact
    count, which needs one group with two rows to say no: first among the values of one hash slice, all
    rows of which are there, so that a repeat found is one; without any there, among all values. An empty table has no rows to tell apart:
    every single column is a key of it.
    """
    names = list(columns) if columns is not None else df.columns
    spark = df.sparkSession
    n = df.count()
    # The hash of a row's values is never null. It is computed in generated code below the aggregate, which
    # would evaluate a struct of the values for each row and set without it.
    value = lambda s: F.xxhash64(*[col(c) for c in s])
    low, high = 1 - SIGMAS * SKETCH_ERROR, 1 + SIGMAS * SKETCH_ERROR
    found: list[tuple[str, ...]] = []
    most: dict[tuple[str, ...], float] = {}  # upper bound of the distinct values of a set
    level: list[tuple[str, ...]] = [(c,) for c in names]
    for size in range(1, max_size + 1):
        if size > 1:
            level = [s for s in combinations(names, size)
                     if not any(set(k) <= set(s) for k in found)
                     and min(most[s[:i] + s[i + 1:]] * most[(s[i],)] for i in range(size)) >= n]
        for at in range(0, len(level), SETS_AT_ONCE):
            part = level[at:at + SETS_AT_ONCE]
            hashed = df.select(*[value(s).alias(f"h{i}") for i, s in enumerate(part)])
            row = hashed.agg(*[F.approx_count_distinct(f"h{i}", SKETCH_ERROR).alias(f"d{i}") for i in range(len(part))]).first()
            for i, s in enumerate(part):
                most[s] = row[f"d{i}"] * high
                if row[f"d{i}"] < n * low or _repeats(df.filter(F.pmod(value(s), F.lit(SLICES)) == 0), s):
                    continue
                if not _repeats(df, s):
                    found.append(s)
        for s in combinations(names, size):
            most.setdefault(s, float(n) + 1)  # not estimated: it holds a key, or was bounded away
    rows = [(",".join(s), len(s)) for s in found]
    return spark.createDataFrame(rows, "keys string, n_columns int")
