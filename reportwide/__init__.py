"""reportwide: build, clean and profile wide tables from many keyed report tables on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark's own
DataFrame / SQL expressions, so Catalyst plans it, prunes columns, pushes filters into the
parquet scan and runs it under whole-stage codegen.
"""

from reportwide.operators.clean import clean_report, dedup_ignoring_keys, dedup_strict
from reportwide.operators.combine import compact, read_chunks, union_by_name
from reportwide.operators.profile import (all_null_columns, describe, null_counts,
                                          schema_profile, shape)
from reportwide.operators.wide import join_left, wide_join
from reportwide.plans.wide_table import wide_from_folder
from reportwide.session import apply_runtime_conf, checkpoint_dir, get_spark, work_path

__all__ = [
    "get_spark", "apply_runtime_conf", "checkpoint_dir", "work_path",
    "join_left", "wide_join", "wide_from_folder", "clean_report", "dedup_ignoring_keys",
    "dedup_strict", "union_by_name", "read_chunks", "compact", "null_counts",
    "all_null_columns", "shape", "schema_profile", "describe",
]
