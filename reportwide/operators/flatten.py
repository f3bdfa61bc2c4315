"""Nested JSON records to flat tables.

All steps are row-local (``explode``, ``inline``, struct field access, ``from_json``), except
the flat-table forms of positional widening and drop-last, which aggregate per parent with
partial aggregation so a parent with very many children is combined map-side first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.operators.wide import check_case_clash, col


def parse_json(df: DataFrame, column: str, schema: T.StructType | str, out: str = "doc",
               corrupt: str | None = None) -> DataFrame:
    """Parse a JSON text column (N4). With ``corrupt`` set, a boolean column marks rows whose
    text did not parse, so they can be routed to a quarantine table instead of vanishing."""
    if not corrupt:
        return df.withColumn(out, F.from_json(col(column), schema, {"mode": "PERMISSIVE"}))
    if isinstance(schema, T.StructType):
        full = T.StructType(list(schema.fields) + [T.StructField("__corrupt", T.StringType())])
    else:
        full = f"{schema}, __corrupt string"
    parsed = F.from_json(col(column), full, {"mode": "PERMISSIVE",
                                             "columnNameOfCorruptRecord": "__corrupt"})
    res = df.withColumn(out, parsed)
    res = res.withColumn(corrupt, F.col(out)["__corrupt"].isNotNull())
    return res.withColumn(out, F.col(out).dropFields("__corrupt"))


def render_json(df: DataFrame, columns: Sequence[str] | None = None, out: str = "json") -> DataFrame:
    """Render rows (or a subset of columns) as JSON text."""
    cols = list(columns or df.columns)
    return df.withColumn(out, F.to_json(F.struct(*[col(c) for c in cols])))


def explode_path(df: DataFrame, path: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Records found under a path of nested arrays, one row each.

    ``path`` names an array field per level, e.g. ["dates", "games"] for
    dates[].games[]. Parent fields are not carried down unless listed in ``keep``.
    """
    if not path:
        raise ValueError("empty record path")
    cur = df.select(*[col(k) for k in keep], F.explode(col(path[0])).alias("__r"))
    for level in path[1:]:
        cur = cur.select(*[col(k) for k in keep], F.explode(F.col("__r")[level]).alias("__r"))
    etype = cur.schema["__r"].dataType
    if isinstance(etype, T.StructType):
        return cur.select(*[col(k) for k in keep],
                          *[F.col("__r")[f.name].alias(f.name) for f in etype.fields])
    return cur.withColumnRenamed("__r", path[-1])


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct fields become top-level columns named a<sep>b<sep>c (N2). Arrays stay."""
    out: list[Column] = []
    names: list[str] = []

    def walk(prefix: str, c: Column, dtype: T.DataType) -> None:
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f"{prefix}{sep}{f.name}" if prefix else f.name, c[f.name], f.dataType)
        else:
            out.append(c.alias(prefix))
            names.append(prefix)

    for f in df.schema.fields:
        walk(f.name, col(f.name), f.dataType)
    check_case_clash(names)
    if len(set(names)) != len(names):
        raise ValueError(f"flattened names collide: {names}")
    return df.select(*out)


def widen_array(df: DataFrame, array_col: str, fields: Sequence[str], max_len: int,
                sep: str = ".", drop: bool = True) -> DataFrame:
    """Array of structs -> columns <i><sep><field> for i < max_len; missing positions are
    null (N3). The new columns are computed in the same projection as the row (J3). An array
    longer than ``max_len`` is an error: no element is dropped silently."""
    if max_len < 1:
        raise ValueError("max_len must be positive")
    arr = F.when(F.size(col(array_col)) > max_len, F.raise_error(F.lit(
        f"widen_array: {array_col} holds more than {max_len} elements"))).otherwise(col(array_col))
    new = [F.get(arr, i)[f].alias(f"{i}{sep}{f}") for i in range(max_len) for f in fields]
    res = df.select("*", *new)
    return res.drop(array_col) if drop else res  # P3


def widen_rows(df: DataFrame, parent: Sequence[str], position: str, fields: Sequence[str],
               max_len: int, sep: str = ".") -> DataFrame:
    """Flat form of N3: child rows (parent, position, fields) -> one row per parent with
    columns <i><sep><field>. A pivot over a fixed position list, planned as a hash aggregate
    with partial aggregation. A position that is null or outside 0 to max_len - 1 is an error, and
    so are two children at one position: no child is dropped and no two are mixed."""
    pos = col(position)
    outside = pos.isNull() | (pos < 0) | (pos >= max_len)
    df = df.withColumn(position, F.when(outside, F.raise_error(F.lit(
        f"widen_rows: {position} is null or outside 0 to {max_len - 1}"))).otherwise(pos))
    g = df.groupBy(*[col(p) for p in parent]).pivot(position, list(range(max_len)))
    res = g.agg(F.count(F.lit(1)).alias("__n"), *[F.first(col(f), ignorenulls=True).alias(f) for f in fields])
    # Counted beside the fields; with one child at each position the fields are of one record.
    twice = F.greatest(F.lit(0), F.lit(0), *[col(f"{i}___n") for i in range(max_len)]) > 1
    res = res.filter(F.when(twice, F.raise_error(F.lit(
        f"widen_rows: two children at one {position}")).cast("boolean")).otherwise(F.lit(True)))
    return res.select(*[col(p) for p in parent],
                      *[col(f"{i}_{f}").alias(f"{i}{sep}{f}") for i in range(max_len) for f in fields])


def drop_last_element(arr: str | Column) -> Column:
    """P9 on an array inside a document: everything but the last element; [] stays []."""
    a = col(arr) if isinstance(arr, str) else arr
    return F.when(F.size(a) > 0, F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(a)


def drop_last_rows(df: DataFrame, parent: Sequence[str], order: Sequence[str]) -> DataFrame:
    """P9 on a flat child table: remove the last child of every parent.

    "Last" is the greatest record in ``order`` (then the remaining columns). Equal records
    are counted with a hash aggregate and exactly one copy of the greatest is removed, so no
    window has to hold a whole parent's children in one task.
    """
    rest = [c for c in df.columns if c not in parent and c not in order]
    rec_cols = list(order) + rest
    rec = F.struct(*[col(c).alias(f"f{i}") for i, c in enumerate(rec_cols)])
    counted = (df.groupBy(*[col(p) for p in parent], rec.alias("__rec"))
               .agg(F.count(F.lit(1)).alias("__n")))
    last = counted.groupBy(*[col(p) for p in parent]).agg(F.max("__rec").alias("__last"))
    # A null parent is a parent like any other.
    last = last.select(*[col(p).alias(f"__p{i}") for i, p in enumerate(parent)], "__last")
    same = F.lit(True)
    for i, p in enumerate(parent):
        same = same & col(p).eqNullSafe(F.col(f"__p{i}"))
    j = counted.join(last, same)
    keep = F.when(F.col("__rec").eqNullSafe(F.col("__last")), F.col("__n") - 1).otherwise(F.col("__n"))
    j = j.withColumn("__k", keep).filter(F.col("__k") > 0)
    j = j.withColumn("__rep", F.explode(F.sequence(F.lit(1), F.col("__k").cast("int"))))
    return j.select(*[col(p) for p in parent],
                    *[F.col("__rec")[f"f{i}"].alias(c) for i, c in enumerate(rec_cols)]).select(
        *[col(c) for c in df.columns])
