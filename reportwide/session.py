"""Session settings and the shared work folder.

Scratch output (sink round trips, compaction, streaming checkpoints) goes below the folder
the cluster names in ``spark.checkpoint.dir``. A machine-local temporary folder is only used
when that setting is absent, which is the case in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes, coalesces small
# partitions and splits skewed ones. Joins are broadcast only when AQE has measured the
# shuffled build side below the adaptive threshold, never on a planner estimate; explicit
# broadcast hints are kept for tables whose size is bounded by construction.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole texts go to Python workers in batches of so many bytes, not of 10,000 rows: the
    # buffers on both sides do not follow the length of the texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.ui.enabled": "false",
    # Remove checkpoint files of lineage cuts once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Wide joins and profiles generate large classes; with the default cache of 100 entries a
    # session running many report queries keeps evicting and recompiling them (measured: a
    # 14-table wide join ran 2.5x slower after another query had run).
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def get_spark(master: str | None = None, app: str = "reportwide",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


# Settings that can change on a running session (the rest need a new SparkContext).
RUNTIME_CONF = ("spark.sql.session.timeZone", "spark.sql.autoBroadcastJoinThreshold",
                "spark.sql.execution.arrow.maxBytesPerBatch",
                "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                "spark.sql.adaptive.coalescePartitions.enabled",
                "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.adaptive.localShuffleReader.enabled")


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Apply the engine's join and time-zone settings to a session created elsewhere."""
    for k in RUNTIME_CONF:
        spark.conf.set(k, DEFAULT_CONF[k])
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. A local master without one gets a temporary folder; a
    cluster must name it, as its executors share no local folder."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="reportwide-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder for scratch tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/reportwide-work/{name}-{uuid.uuid4().hex[:12]}"


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches, for operators called on a session made elsewhere. It stays
    set, as their results are read lazily."""
    k = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(k, DEFAULT_CONF[k])


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings of the session that hold while a job is planned and run, and are put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
