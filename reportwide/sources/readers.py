"""Scans: parquet tables, format by path, recursive discovery, landed JSON pages.

File listing uses Spark's own file index (the ``binaryFile`` source with only its path
column), so the same code lists a local folder, HDFS or an object store, and the files are
rows of a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """S1."""
    return spark.read.parquet(path)


def format_for(path: str) -> str:
    """S2 rule: 'parquet' anywhere in the path, else '.csv', else '.json'; first match wins."""
    if "parquet" in path:
        return "parquet"
    if ".csv" in path:
        return "csv"
    if ".json" in path:
        return "json"
    raise ValueError(f"no reader for {path!r}")


def read_by_suffix(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   multi_line: bool = True) -> DataFrame:
    """Read with the format the path names. CSV has a header row and inferred types;
    a JSON file holds one document (an array of records or one record); pass
    ``multi_line=False`` for JSON Lines such as Spark's own JSON output."""
    fmt = format_for(path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
        return reader.csv(path)
    if fmt == "json":
        return reader.option("multiLine", multi_line).json(path)
    return reader.parquet(path)


def find_files(spark: SparkSession, root: str, contains: str | None = None,
               columns: tuple[str, ...] = ("path", "length")) -> DataFrame:
    """Files below root (recursive, hidden and marker files skipped) whose path contains
    ``contains``, one row each. Spark's own file index lists the tree (in parallel for large
    trees); file contents are read only where ``columns`` names ``content``."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    except AnalysisException:  # root does not exist
        files = spark.createDataFrame([], schema)
    if contains is not None:
        files = files.filter(F.col("path").contains(contains))
    return files.select(*columns)


def list_files(spark: SparkSession, root: str, contains: str | None = None) -> list[str]:
    """The paths of ``find_files`` as a sorted list, for callers that want the names themselves."""
    return sorted(r["path"] for r in find_files(spark, root, contains, ("path",)).collect())


def discover(spark: SparkSession, root: str, marker: str = ".parquet.gzip",
             make_df: bool = False):
    """S3: every path below ``root`` containing ``marker``.

    Spark writes a table as a folder of part files, so a marker in a folder name selects the
    whole folder. With ``make_df`` each table (folder or single file) is read on its own and a
    dict {table path: DataFrame} is returned; otherwise the list of paths. ``name=value``
    folders between ``root`` and a file become columns. For tables only the table paths reach
    the driver, not the paths of their files.
    """
    if not make_df:
        return list_files(spark, root, marker)
    # The table is the path up to the end of the first component that holds the marker.
    at = F.instr("path", marker)
    rest = F.expr("substring(path, at)")
    table = F.concat(F.expr("substring(path, 1, at - 1)"), F.substring_index(rest, "/", 1))
    tables = find_files(spark, root, marker, ("path",)).withColumn("at", at).select(table.alias("t")).distinct()
    return {r["t"]: spark.read.option("basePath", root).parquet(r["t"]) for r in tables.orderBy("t").collect()}


def read_pages(spark: SparkSession, path: str, schema: T.StructType | str,
               multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """S4 + S5: landed JSON pages with a fixed schema. Returns (pages, quarantine).

    Pages are read as text (one page per line, or one per file with ``multi_line``) and
    parsed with ``from_json``; a page that does not parse goes to the quarantine frame with
    its file name and raw text instead of being lost.
    """
    from reportwide.operators.flatten import parse_json

    reader = spark.read.option("wholetext", True) if multi_line else spark.read
    raw = reader.text(path).select(F.col("value").alias("_raw"),
                                   F.col("_metadata.file_path").alias("_file"))
    raw = raw.filter(F.length(F.trim("_raw")) > 0)
    parsed = parse_json(raw, "_raw", schema, out="_doc", corrupt="_bad")
    good = parsed.filter(~F.col("_bad")).select("_doc.*")
    bad = parsed.filter(F.col("_bad")).select("_file", F.col("_raw").alias("_corrupt_record"))
    return good, bad
