"""Union of chunks whose schemas drift, and compaction of a chunk folder.

Chunks landed page by page do not agree on types: a column may be bigint in one chunk and
double in another, null-typed where every value was missing, or absent. Parquet schema
merging refuses bigint/double, so chunks are read per schema group and unioned by name onto
one target schema computed up front: numeric types widen, a type only seen as null takes the
other chunks' type, structs, arrays and maps merge part by part, other conflicts between plain
types fall back to string. A nested type beside a plain one is an error that names the column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.operators.census import take_census
from reportwide.operators.wide import check_case_clash, col

_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4, T.FloatType: 5,
         T.DoubleType: 6}


# Decimal digits of the whole-number types.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _decimal(t: T.DataType) -> T.DecimalType | None:
    """The decimal type that holds every value of a decimal or whole-number type."""
    if isinstance(t, T.DecimalType):
        return t
    return T.DecimalType(_DIGITS[type(t)], 0) if type(t) in _DIGITS else None


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type both a and b convert to without loss of kind."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    ra, rb = _RANK.get(type(a)), _RANK.get(type(b))
    if ra and rb:
        # A float holds 24 bits: whole numbers of 32 or 64 bits beside one need a double.
        if {T.FloatType} & {type(a), type(b)} and min(ra, rb) in (3, 4):
            return T.DoubleType()
        return a if ra >= rb else b
    if (_decimal(a) or ra) and (_decimal(b) or rb):
        da, db = _decimal(a), _decimal(b)
        if da and db:
            scale = max(da.scale, db.scale)
            whole = max(da.precision - da.scale, db.precision - db.scale)
            if whole + scale > 38:
                raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common decimal type")
            return T.DecimalType(whole + scale, scale)
        return T.DoubleType()
    if {type(a), type(b)} == {T.TimestampType, T.TimestampNTZType}:
        return T.TimestampType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _merged_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widen(a.keyType, b.keyType), widen(a.valueType, b.valueType))
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(a, nested) or isinstance(b, nested):
        raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common type")
    return T.StringType()


def _merged_struct(a: T.StructType, b: T.StructType) -> T.StructType:
    """All fields of both structs by name, in order of first sight."""
    types = {f.name: f.dataType for f in a.fields}
    for f in b.fields:
        types[f.name] = widen(types[f.name], f.dataType) if f.name in types else f.dataType
    check_case_clash(list(types))
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def convert(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column of type ``have`` as its widened type: struct fields are matched by name, those
    that ``have`` lacks are null; a null struct, array or map stays null."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        mine = {f.name: f.dataType for f in have.fields}
        parts = [(convert(c.getField(f.name), mine[f.name], f.dataType) if f.name in mine
                  else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: convert(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keys = F.transform_keys(c, lambda k, _: convert(k, have.keyType, want.keyType))
        return F.transform_values(keys, lambda _, v: convert(v, have.valueType, want.valueType))
    return c.cast(want)


def target_schema(frames: Sequence[DataFrame]) -> list[tuple[str, T.DataType]]:
    order: list[str] = []
    types: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            if f.name not in types:
                order.append(f.name)
                types[f.name] = f.dataType
            else:
                try:
                    types[f.name] = widen(types[f.name], f.dataType)
                except ValueError as e:
                    raise ValueError(f"column {f.name!r}: {e}") from e
    check_case_clash(order)
    return [(c, types[c]) for c in order]


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by column name: missing columns become null, types widen."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    target = target_schema(frames)
    aligned = []
    for df in frames:
        have = {f.name: f.dataType for f in df.schema.fields}
        aligned.append(df.select(*[
            (convert(col(c), have[c], t) if c in have else F.lit(None).cast(t)).alias(c)
            for c, t in target]))
    out = aligned[0]
    for df in aligned[1:]:
        out = out.unionByName(df)
    return out


def read_chunks(spark: SparkSession, path: str, contains: str | None = None) -> DataFrame | None:
    """Read every parquet chunk below ``path`` as one table, tolerating schema drift.

    A footer census finds the distinct schemas; each is read with one scan, and the scans are unioned
    by name onto the widened target schema (``union_by_name``). ``name=value`` folders below ``path``
    become columns.
    """
    census = take_census(spark, path, contains)
    return None if census is None else union_by_name(_null_typed_as_void(census.scans(spark)))


def _null_typed_as_void(frames: list[DataFrame]) -> list[DataFrame]:
    """A column written with a null type reads back as int. Where such an int column meets a
    non-numeric type in another group, check (one aggregate per group) whether it holds any
    value; if not, it becomes an untyped null column that takes the other groups' type."""
    kinds: dict[str, set[type]] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, set()).add(type(f.dataType))
    suspect = {c for c, ts in kinds.items()
               if T.IntegerType in ts and any(t not in _RANK and t is not T.NullType for t in ts)}
    if not suspect:
        return frames
    out = []
    for df in frames:
        cols = [f.name for f in df.schema.fields
                if f.name in suspect and isinstance(f.dataType, T.IntegerType)]
        if cols:
            counts = df.agg(*[F.count(col(c)).alias(c) for c in cols]).first()
            empty = [c for c in cols if counts[c] == 0]
            df = df.withColumns({c: F.lit(None).cast(T.NullType()) for c in empty})
        out.append(df)
    return out


def compact(spark: SparkSession, src: str, dst: str, n_files: int | None = None,
            sort_keys: Sequence[str] = (), compression: str = "gzip") -> bool:
    """Union all chunks below ``src`` into a new table at ``dst``.

    Returns False, writing nothing, when there is no chunk or no row. Writing to a new path
    and switching readers afterwards means a failed run never loses the chunks.
    """
    df = read_chunks(spark, src)
    if df is None or df.isEmpty():
        return False
    if n_files:
        df = df.repartition(n_files, *[col(k) for k in sort_keys]) if sort_keys else df.repartition(n_files)
    if sort_keys:
        df = df.sortWithinPartitions(*[col(k) for k in sort_keys])
    df.write.mode("errorifexists").option("compression", compression).parquet(dst)
    return True
