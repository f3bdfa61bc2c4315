"""Sinks: parquet files, appended tables and the landing layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, compression: str | None = "gzip",
                  mode: str = "errorifexists", sort_within: Sequence[str] = ()) -> str:
    """S6 (gzip) and S7 (``compression=None``: Spark's default codec). Keys are columns, so
    they are saved with the table."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.parquet(path)
    return path


def write_if_rows(df: DataFrame, path: str, mode: str = "append",
                  compression: str | None = "gzip") -> bool:
    """Write only when the frame has a row; returns whether it wrote."""
    if df.isEmpty():
        return False
    write_parquet(df, path, compression=compression, mode=mode)
    return True


def append_table(df: DataFrame, path: str | None = None, compression: str | None = None,
                 table_name: str | None = None) -> bool:
    """Append to the table at ``path`` (or the catalogue table ``table_name``), creating
    it when absent; empty input writes nothing."""
    if table_name is None:
        if path is None:
            raise ValueError("give a path or a table name")
        return write_if_rows(df, path, mode="append", compression=compression)
    if df.isEmpty():
        return False
    w = df.write.mode("append").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table_name)
    return True


def write_bucketed(df: DataFrame, table_name: str, keys: Sequence[str], buckets: int,
                   path: str | None = None, mode: str = "overwrite", placed: bool = False,
                   block_bytes: int | None = None) -> str:
    """Save a report table bucketed and sorted by its keys, one file for each bucket. Joining tables
    bucketed the same way on the keys needs no exchange: the wide join reads them already
    co-partitioned (under the settings ``READ_SORTED`` also without a sort).

    ``placed`` states that the rows already lie hash-partitioned on the keys in ``buckets`` parts, as
    an aggregate over a table bucketed that way leaves them: they are written without an exchange.
    ``block_bytes`` is the size of a row group, for tables that one task opens many times at once."""
    d = df if placed else df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    w = d.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if block_bytes:
        w = w.option("parquet.block.size", str(block_bytes))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table_name)
    return table_name


# With one file for each bucket, as ``write_bucketed`` leaves them, a bucket's rows come in key order.
# Spark trusts that order only when told to.
READ_SORTED = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}
# Aggregates over rows in key order run group after group, without a hash table, and leave them in that order.
GROUP_SORTED = {**READ_SORTED, "spark.sql.execution.replaceHashWithSortAgg": "true", "spark.sql.codegen.hugeMethodLimit": "8000"}


def write_landing(df: DataFrame, root: str, partition_by: Sequence[str] = ("rtype", "report",
                                                                          "window_start"),
                  compression: str | None = "gzip", files_per_partition: int = 8) -> str:
    """The <type>/<report>/<window start> layout as partition folders. Re-landing a
    (type, report, window) replaces just those partitions (dynamic partition overwrite), so a
    repeated pull never doubles rows.

    Rows are shuffled on the partition columns plus a salt taken from a hash of the whole row
    (deterministic, so a retried task rebuilds the same files): a partition holding a large
    share of the data is written by up to ``files_per_partition`` tasks, not one."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_partition))
    w = (df.repartition(*partition_by, salt).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by))
    if compression:
        w = w.option("compression", compression)
    w.parquet(root)
    return root
