"""Footer census of a chunk folder: which schemas its parquet files have.

The files are rows. Executors open each file's footer (not its data) and give it a fingerprint of
names, logical and physical types; an aggregate leaves one row for each distinct schema, which is all
the driver gets. Spark itself then infers the schema of one file of each kind. A kind is read as one
scan: executors open the files of that kind from their rows, in batches, so no path list goes through
the driver and the number of jobs follows the number of schemas, not of files or of places where the
schema changes.

Stores that pyarrow opens by itself (local and object stores) are read by footer and by row group. Any
other store that Spark can read is read as whole files, so single files there must stay below 2 GB.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reportwide.operators.wide import col
from reportwide.session import work_path
from reportwide.sources.readers import find_files

BATCH_ROWS = 20_000
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Types of partition values, narrowest first; the first one that holds every value is taken.
PARTITION_TYPES = ("int", "bigint", "double", "date", "timestamp")


def _open(path: str, content: bytes | None) -> pq.ParquetFile:
    if content is not None:
        source = pa.BufferReader(content)
    elif path.startswith("file:"):
        source = "/" + path[len("file:"):].lstrip("/")
    else:
        store, name = pafs.FileSystem.from_uri(path)
        source = store.open_input_file(name)
    try:
        return pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
    except pa.ArrowInvalid as e:
        raise ValueError(f"cannot read {path}: {e}") from e


def _opens_by_itself(path: str) -> bool:
    scheme = path.split(":", 1)[0] if ":" in path else "file"
    return scheme in ("file", "s3", "gs", "gcs")


def fingerprint(f: pq.ParquetFile) -> str:
    physical = [f.schema.column(i).physical_type for i in range(len(f.schema.names))]
    own = (f.metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
    text = f.schema_arrow.to_string(show_field_metadata=False, show_schema_metadata=False, truncate_metadata=False)
    return hashlib.sha256("\n".join([text, *physical, own.decode()]).encode()).hexdigest()


def _contents(b: pa.RecordBatch) -> list:
    return b.column("content").to_pylist() if "content" in b.schema.names else [None] * b.num_rows


def _footers(batches) -> Iterator[pa.RecordBatch]:
    for b in batches:
        paths, prints, rows = b.column("path").to_pylist(), [], []
        for path, content in zip(paths, _contents(b)):
            f = _open(path, content)
            prints.append(fingerprint(f))
            rows.append(f.metadata.num_rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(prints, pa.string()), pa.array(rows, pa.int64())], ["path", "kind", "n_rows"])


def _rows(batches, target: pa.Schema, kind: str, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of the files of one kind, and the files' partition values as text."""
    full = pa.schema([*target, *(pa.field(k, pa.string()) for k in keys)])
    for b in batches:
        values = b.column("keys").to_pylist()
        for path, content, mine in zip(b.column("path").to_pylist(), _contents(b), values):
            f = _open(path, content)
            if content is not None and fingerprint(f) != kind:
                continue
            mine = dict(mine)
            for rows in f.iter_batches(batch_size=BATCH_ROWS, columns=target.names):
                t = pa.Table.from_batches([rows]).select(target.names).cast(target)
                for k in keys:
                    t = t.append_column(k, pa.array([mine.get(k)] * t.num_rows, pa.string()))
                yield from t.cast(full).combine_chunks().to_batches()


@dataclass
class Census:
    """``kinds``: one row for each distinct schema: kind, n_files, n_rows, example path."""

    files: DataFrame  # path, kind, keys; in other stores without the kinds, with the content
    kinds: list
    keys: list[str]
    key_types: list[str]
    by_footer: bool

    def scans(self, spark: SparkSession) -> list[DataFrame]:
        """One frame for each kind, in order of the kinds' first paths."""
        out = []
        for k in self.kinds:
            schema = T.StructType([f for f in spark.read.parquet(k["example"]).schema.fields if f.name not in self.keys])
            full = T.StructType([*schema.fields, *(T.StructField(x, T.StringType()) for x in self.keys)])
            files = self.files.filter(F.col("kind") == k["kind"]) if self.by_footer else self.files
            df = files.mapInArrow(partial(_rows, target=to_arrow_schema(schema), kind=k["kind"], keys=self.keys), full)
            out.append(df.withColumns({x: col(x).cast(t) for x, t in zip(self.keys, self.key_types)}))
        return out


def _partition_values(root: str):
    """Map of the name=value folders between ``root`` and a file."""
    below = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    inside = F.substr("path", F.instr("path", below) + len(below))
    folders = F.filter(F.split(F.regexp_replace(inside, "[^/]*$", ""), "/"), lambda x: x.contains("="))

    def entry(x):
        # Folder names are percent-encoded; a plus sign stands for itself.
        value = F.try_url_decode(F.replace(F.regexp_replace(x, "^[^=]*=", ""), F.lit("+"), F.lit("%2B")))
        return F.struct(F.substring_index(x, "=", 1).alias("k"), F.nullif(value, F.lit(NULL_PARTITION)).alias("v"))
    return F.map_from_entries(F.transform(folders, entry))


def take_census(spark: SparkSession, root: str, contains: str | None = None) -> Census | None:
    """Census of the parquet files below ``root``; None if there is no file."""
    by_footer = _opens_by_itself(root)
    listed = find_files(spark, root, contains, ("path",) if by_footer else ("path", "content"))
    listed = listed.filter(~F.substring_index("path", "/", -1).rlike("^[_.]"))
    path = work_path(spark, "census")
    listed.mapInArrow(_footers, "path string, kind string, n_rows long").write.parquet(path)
    found = spark.read.schema("path string, kind string, n_rows long").parquet(path)
    kinds = found.groupBy("kind").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"),
                                      F.min("path").alias("example")).orderBy("example").collect()
    if not kinds:
        return None
    values = found.select(F.explode(_partition_values(root)).alias("k", "v"))
    fits = [(F.count(F.expr(f"try_cast(v AS {t})")) == F.count("v")).alias(t) for t in PARTITION_TYPES]
    keys = values.groupBy("k").agg(*fits, F.count("v").alias("n")).orderBy("k").collect()
    types = [next((t for t in PARTITION_TYPES if r["n"] and r[t]), "string") for r in keys]
    files = (found if by_footer else listed).withColumn("keys", _partition_values(root))
    return Census(files, kinds, [r["k"] for r in keys], types, by_footer)
