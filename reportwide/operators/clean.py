"""Key normalisation, missing values and de-duplication of report tables.

De-duplication is a hash aggregate, never a window over a group: Spark combines equal rows
map-side before the shuffle, so one value repeated across a third of the table collapses to
one row per task before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.operators.wide import check_keys, col


def keys_to_string(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cast key columns to string (P4). Null stays null, unlike a text 'nan'."""
    check_keys(df, keys)
    return df.withColumns({k: col(k).cast("string") for k in keys})


def declare_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Validate that the key columns exist (P5); Spark has no row index, keys stay columns."""
    check_keys(df, keys)
    return df


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn float NaN into null so null tests and de-duplication see one kind of missing."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    todo = [c for c in (columns or df.columns) if c in fl]
    return df.withColumns({c: F.when(F.isnan(col(c)), F.lit(None)).otherwise(col(c)) for c in todo})


def replace_with_null(df: DataFrame, columns: Sequence[str], marker: str = "NaN") -> DataFrame:
    """Replace a marker value with null (P10)."""
    return df.withColumns({c: F.when(col(c).cast("string") == F.lit(marker), F.lit(None))
                           .otherwise(col(c)) for c in columns})


def is_missing(c: str, dtype: T.DataType | None = None) -> Column:
    e = col(c).isNull()
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        e = e | F.isnan(col(c))
    return e


def rows_missing(df: DataFrame, column: str) -> DataFrame:
    """Rows where a column is missing, null or NaN."""
    return df.filter(is_missing(column, df.schema[column].dataType))


def _key_order(keys: Sequence[str]) -> Column:
    # Ascending key order with missing keys last, as a sorted row index would have them.
    parts = []
    for i, k in enumerate(keys):
        parts += [col(k).isNull().alias(f"n{i}"), col(k).alias(f"v{i}")]
    return F.struct(*parts)


def dedup_ignoring_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows on all non-key columns, keeping the lowest key of each group (A8, parity).

    This is what sorting by a row index and then dropping duplicate rows does: the index is
    not compared, so equal statistics under two different keys collapse to one row.
    """
    check_keys(df, keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    g = df.groupBy(*[col(c) for c in others]).agg(F.min(_key_order(keys)).alias("__k"))
    out = []
    for c in df.columns:
        if c in keys:
            out.append(F.col(f"__k.v{list(keys).index(c)}").alias(c))
        else:
            out.append(col(c))
    return g.select(*out)


def dedup_strict(df: DataFrame) -> DataFrame:
    """Distinct rows over all columns, keys included."""
    return df.dropDuplicates()


def clean_report(df: DataFrame, keys: Sequence[str], key_as_string: Sequence[str] = (),
                 parity: bool = True) -> DataFrame:
    """Full per-table cleaning step: key cast, NaN to null, de-duplication."""
    out = keys_to_string(df, key_as_string) if key_as_string else df
    out = nan_to_null(declare_keys(out, keys))
    return dedup_ignoring_keys(out, keys) if parity else dedup_strict(out)
