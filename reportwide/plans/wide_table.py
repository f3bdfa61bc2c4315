"""The whole report-folder flow in one call: discover report files, clean each table, join
them wide, optionally save, and profile the result.

    discover (S3) -> key cast (P4) -> NaN to null -> de-duplicate (A8) -> wide join (J2)
    -> parquet (S7) -> null counts / all-null columns / describe (A2, A3, A6)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from reportwide.operators.clean import clean_report
from reportwide.operators.wide import wide_join
from reportwide.sources.readers import discover
from reportwide.sources.sinks import write_parquet


def table_name_of(path: str, marker: str = ".parquet.gzip", suffix: str = "_data") -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    name = name[: -len(marker)] if name.endswith(marker) else name
    return name[: -len(suffix)] if suffix and name.endswith(suffix) else name


def load_reports(spark: SparkSession, root: str, marker: str = ".parquet.gzip") -> dict[str, DataFrame]:
    """{report name: DataFrame} for every table below ``root`` whose path holds the marker."""
    return {table_name_of(p, marker): df for p, df in discover(spark, root, marker, make_df=True).items()}


def wide_from_folder(spark: SparkSession, root: str, keys: Sequence[str],
                     order: Sequence[str] | None = None, anchor: str | None = None,
                     key_as_string: Sequence[str] = (), parity: bool = True,
                     marker: str = ".parquet.gzip", out: str | None = None,
                     mode: str = "errorifexists", null_safe: bool = False) -> DataFrame:
    """Wide table of all reports below ``root``, joined in ``order`` (the first is the anchor).

    Without ``order`` the reports are taken in name order, with ``anchor`` moved to the
    front. With ``out`` the table is written there (Spark's default codec) and the written
    table is returned. With ``null_safe`` a null key meets null keys, as row labels do."""
    reports = load_reports(spark, root, marker)
    if order is not None:
        names = list(order)
    else:
        names = sorted(reports)
        if anchor is not None:
            names = [anchor] + [n for n in names if n != anchor]
    missing = [n for n in names if n not in reports]
    if missing:
        raise ValueError(f"reports not found below {root}: {missing}")
    cleaned = [clean_report(reports[n], keys, key_as_string=key_as_string, parity=parity)
               for n in names]
    wide = wide_join(cleaned, keys, null_safe=null_safe)
    if out is None:
        return wide
    write_parquet(wide, out, compression=None, mode=mode)
    return spark.read.parquet(out)


def main(argv: list[str] | None = None) -> None:
    """python -m reportwide.plans.wide_table ROOT OUT --keys gameId teamId [--anchor summary]
    [--string-keys gameId]: join every report below ROOT wide, write OUT, print its profile."""
    import argparse

    from reportwide.operators import profile as P
    from reportwide.session import get_spark

    ap = argparse.ArgumentParser()
    ap.add_argument("root")
    ap.add_argument("out")
    ap.add_argument("--keys", nargs="+", required=True)
    ap.add_argument("--anchor")
    ap.add_argument("--string-keys", nargs="*", default=[])
    ap.add_argument("--strict", action="store_true", help="de-duplicate on all columns")
    a = ap.parse_args(argv)
    spark = get_spark()
    wide = wide_from_folder(spark, a.root, a.keys, anchor=a.anchor, key_as_string=a.string_keys,
                            parity=not a.strict, out=a.out)
    P.shape(wide, exclude=a.keys).show()
    P.all_null_columns(wide, exclude=a.keys).show(truncate=False)
    P.null_counts(wide, exclude=a.keys).show(1000, truncate=False)


if __name__ == "__main__":
    main()
