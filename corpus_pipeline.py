"""A corpus pipeline of five stages; each takes (spark, docs, sf_dir) and returns a DataFrame.

Quality rules drop documents, the n-gram Jaccard join keeps one document of each group,
substring dedup cuts repeated passages out of texts, benchmark decontamination drops documents
that hold a window of an item, and best-fit packing returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportwide.llm import decontamination, jaccard_join, pattern_packing, quality_rules, substring_dedup
from reportwide.llm.queries import tokenizer_path
from reportwide.plans.registry import register, table
from reportwide.session import work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup.dedup_substrings(docs).select(docs.columns)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("n_hit = 0").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(docs, tokenizer_path())


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("substring_dedup", passages),
          ("benchmark_decontamination", benchmark_leaks), ("pattern_packing", packing)]

# Neither robust estimates nor similarity groups can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


register("pipeline", ORACLE_SQL)(run)
