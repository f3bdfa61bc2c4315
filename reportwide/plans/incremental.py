"""A wide table kept current by change sets.

Reports and wide table are versioned tables of one folder for each key bucket. A change set holds the
new rows of some keys of some reports (a key's rows in it replace all its rows there). Applying one

1. rewrites the reports' buckets that hold a touched key: the rows of other keys, and the new ones;
2. joins wide, for the touched keys alone, the reports' rows in those buckets;
3. rewrites the same buckets of the wide table likewise, and switches each table in one step.

So the work follows the touched buckets, not the history. A change set that is sent again is known by
its number in the manifests: tables that have it stay as they are, the others still get it. Buckets are
worked through by Spark, keys are joined by semi and anti joins; the driver gets bucket numbers only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportwide.operators.combine import union_by_name
from reportwide.operators.wide import check_keys, col, wide_join
from reportwide.sources.snapshots import Snapshot, VersionedTable, read_folders

BUCKETS = 64
_BUCKET = "__bucket"


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    return reduce(lambda x, y: x & y, [a[f"`{k}`"].eqNullSafe(b[f"`{k}`"]) for k in keys])


class WideTable:
    def __init__(self, spark: SparkSession, root: str, reports: Sequence[str], keys: Sequence[str], buckets: int = BUCKETS,
                 hot_share: float | None = None):
        # ``hot_share`` as in ``wide_join``: reports with one row for each key have no hot keys.
        self.spark, self.keys, self.buckets, self.hot_share = spark, list(keys), buckets, hot_share
        self.root = root.rstrip("/")
        # The first report is the anchor.
        self.reports = {r: VersionedTable(spark, f"{self.root}/reports/{r}") for r in reports}
        self.wide = VersionedTable(spark, f"{self.root}/wide")

    def _bucket(self):
        return F.pmod(F.xxhash64(*[col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    @staticmethod
    def _in(s: Snapshot, buckets: Sequence[int]) -> dict[str, str]:
        """The folders of the given buckets."""
        names = {f"{_BUCKET}={k}" for k in buckets}
        return {f: x for f, x in s.folders.items() if f.rsplit("/", 1)[1] in names}

    def _write(self, t: VersionedTable, rows: DataFrame, before: Snapshot, touched: Sequence[int], batch: int) -> None:
        """Replace the touched buckets by ``rows``; a bucket without rows is dropped."""
        folder = t.new_folder()
        # A key may hold many rows: a bucket is written by several tasks.
        salt = F.pmod(F.xxhash64(*[col(c) for c in rows.columns]), F.lit(4))
        (rows.withColumn(_BUCKET, self._bucket()).repartition(_BUCKET, salt)
         .write.option("compression", "gzip").partitionBy(_BUCKET).parquet(folder))
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = [f.getPath().getName() for f in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)]
        schema = t.schema_of(folder, rows)
        new = {f"{folder}/{n}": schema for n in names if n.startswith(f"{_BUCKET}=")}
        t.replace(self._in(before, touched), new, "changes", batch)

    def apply(self, changes: Mapping[str, DataFrame], batch: int) -> list[int]:
        """Apply the change set number ``batch`` (numbers rise): new rows by report; the touched buckets."""
        for df in changes.values():
            check_keys(df, self.keys)
        keys = reduce(DataFrame.union, [df.select(*[col(k) for k in self.keys]) for df in changes.values()]).distinct()
        touched = sorted(r[0] for r in keys.select(self._bucket()).distinct().collect())  # at most ``buckets``
        for report, df in changes.items():
            t = self.reports[report]
            before = t.snapshot()
            if before.batches.get("changes", -1) < batch:
                old = read_folders(self.spark, self._in(before, touched))
                mine = df.select(*[col(k) for k in self.keys]).distinct()
                rows = df if old is None else union_by_name([old.join(mine, _same(old, mine, self.keys), "left_anti"), df])
                self._write(t, rows, before, touched, batch)
        before = self.wide.snapshot()
        if before.batches.get("changes", -1) < batch:
            parts = [read_folders(self.spark, self._in(x.snapshot(), touched)) for x in self.reports.values()]
            if parts[0] is None:  # no row of the anchor yet
                return touched
            parts = [p.join(keys, _same(p, keys, self.keys), "left_semi") for p in parts if p is not None]
            rows = wide_join(parts, self.keys, hot_share=self.hot_share)
            old = read_folders(self.spark, self._in(before, touched))
            if old is not None:
                rows = union_by_name([old.join(keys, _same(old, keys, self.keys), "left_anti"), rows])
            self._write(self.wide, rows, before, touched, batch)
        return touched

    def read(self) -> DataFrame | None:
        """The wide table as it is now; None before the first row of the anchor."""
        return self.wide.read()
