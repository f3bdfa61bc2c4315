"""Shared helpers: tables written to the shared folder, column packing, connected components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportwide.session import bound_batches, checkpoint_dir, work_path

# Most rows of a table that is broadcast after its rows were counted.
BROADCAST_ROWS = 200_000


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared work folder and read it back: the lineage ends there.

    Arrow batches are bounded by bytes from here on."""
    bound_batches(df.sparkSession)
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, *tables: DataFrame, part: str = "") -> None:
    """Delete tables of ``materialize`` that no later plan reads, or one ``part`` folder of them."""
    jvm = spark._jvm
    for t in tables:
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(folder)
            if "/reportwide-work/" in p.toString() and p.toString().endswith(part):
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished levels now, not at some later GC."""
    gc.collect()
    spark._jvm.System.gc()


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the (already written) table has at most ``limit`` rows, else the table."""
    return F.broadcast(df) if df.count() <= limit else df


def keep_rest(df: DataFrame, used: list[str], name: str = "__rest") -> DataFrame:
    """The used columns, and all others packed in one struct that travels along unread."""
    rest = [c for c in df.columns if c not in used]
    packed = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("int")
    return df.select(*[F.col(f"`{c}`") for c in used], packed.alias(name))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge table: (node, comp), comp the smallest node.

    Alternates two star contractions: every node sends its larger neighbours, then its smaller
    ones, to the smallest neighbour. Edges stay at most as many as before, rounds grow with the
    logarithm of the longest path; each round is checkpointed. An empty table gives no rows.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter("u > v").distinct().checkpoint())
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    before = None
    while True:
        # Larger neighbours of a node to its smallest neighbour (or itself).
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u"))).toDF("n", "m")
        low = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
        e = (both.filter("m > n").join(low, "n")
             .select(F.col("m").alias("u"), F.col("low").alias("v")).filter("u > v").distinct())
        # Smaller neighbours of a node, and the node, to its smallest neighbour.
        low = e.groupBy("u").agg(F.min("v").alias("low"))
        e = (e.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("low").alias("v"))
             .filter("u > v").distinct().checkpoint())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return (e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            .union(e.select(F.col("v"), F.col("v")).distinct()))


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:8]}"
