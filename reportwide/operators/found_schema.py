"""Flattening of JSON whose schema is found in the data.

Texts become VARIANT values; ``schema_of_variant_agg`` merges the schemas of all values in one mergeable
aggregate, so the driver gets one schema text. Objects then become structs of the found fields and are
flattened to columns, the fields in code-point order; a field that one row lacks is null there. A field
whose values have no common type becomes JSON text, one that is null in every row becomes a null string.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.operators.flatten import flatten_struct
from reportwide.operators.wide import col

_TOKEN = re.compile(r"\s*(`(?:[^`]|``)*`|[A-Za-z_][A-Za-z_0-9 ]*?(?=\s*[:<>,(]|$)|[0-9]+|[:<>,()])")


def spark_type(schema: str) -> T.DataType:
    """The type of a schema text of ``schema_of_variant_agg``."""
    tokens = []
    at = 0
    while at < len(schema.rstrip()):
        m = _TOKEN.match(schema, at)
        if m is None:
            raise ValueError(f"schema {schema!r}: cannot read {schema[at:at + 20]!r}")
        tokens.append(m.group(1))
        at = m.end()
    tokens.reverse()

    def take(want: str | None = None) -> str:
        t = tokens.pop()
        if want is not None and t != want:
            raise ValueError(f"schema {schema!r}: {t!r} where {want!r} is due")
        return t

    def read() -> T.DataType:
        kind = take().upper()
        if kind == "OBJECT":
            fields = []
            if tokens and tokens[-1] == "<":
                take("<")
                while tokens[-1] != ">":
                    name = take()
                    name = name[1:-1].replace("``", "`") if name.startswith("`") else name
                    take(":")
                    fields.append(T.StructField(name, read()))
                    if tokens[-1] == ",":
                        take()
                take(">")
            # An object without any field is kept as text.
            return T.StructType(fields) if fields else T.VariantType()
        if kind == "ARRAY":
            take("<")
            element = read()
            take(">")
            return T.ArrayType(element)
        if kind == "DECIMAL":
            take("(")
            p, _, q = int(take()), take(","), int(take())
            take(")")
            # JSON numbers with a point are floating-point numbers.
            return T.DoubleType() if q else T.DecimalType(p, 0)
        if kind == "VOID":
            return T.NullType()
        return T._parse_datatype_string(kind.lower())
    return read()


def _castable(t: T.DataType) -> T.DataType:
    """The type a variant is cast to: a null-typed part is read as a string."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _castable(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_castable(t.elementType))
    return T.StringType() if isinstance(t, T.NullType) else t


def _as_text(df: DataFrame) -> DataFrame:
    """Columns that stayed VARIANT (no common type) as JSON text."""
    return df.select(*[(F.to_json(col(f.name)) if isinstance(f.dataType, T.VariantType) else col(f.name)).alias(f.name)
                       for f in df.schema.fields])


def find_type(df: DataFrame, column: str) -> T.DataType:
    """The merged type of a column of JSON texts: one aggregate, one row to the driver."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(col(column))).alias("s")).first()["s"]
    return spark_type(found) if found else T.NullType()


def normalize(df: DataFrame, column: str, path: Sequence[str] = (), keep: Sequence[str] = (), sep: str = ".",
              corrupt: str | None = None) -> DataFrame:
    """Records of a column of JSON texts as flat columns, without a given schema.

    ``path`` leads through (nested) arrays to the records, as in ``explode_path``; without it every text
    is one record. ``keep`` names columns of ``df`` to carry along. With ``corrupt`` set, a boolean column
    of that name marks texts that are not JSON (they have no records); otherwise they are left out, and
    so are null texts. Columns are named by their way through the objects, joined by ``sep``.
    """
    kind = find_type(df, column)
    parsed = df.select(*[col(k) for k in keep], col(column).alias("__text"), F.try_parse_json(col(column)).alias("__v"))
    bad = F.col("__text").isNotNull() & F.col("__v").isNull()
    if corrupt is None:
        parsed = parsed.filter(F.col("__v").isNotNull())
    else:
        parsed = parsed.withColumn(corrupt, bad)
        keep = [*keep, corrupt]
    typed = parsed.select(*[col(k) for k in keep], F.col("__v").try_cast(_castable(kind)).alias("__r")
                          if isinstance(kind, (T.StructType, T.ArrayType)) else F.col("__v").alias("__r"))
    explode = F.explode_outer if corrupt is not None else F.explode
    for level in path:
        here = typed.schema["__r"].dataType
        if not isinstance(here, T.StructType) or level not in here.names:
            raise ValueError(f"no field {level!r} on the way to the records; found {here.simpleString()}")
        records = F.col("__r").getField(level)
        if not isinstance(here[level].dataType, T.ArrayType):
            raise ValueError(f"{level!r} is no array; found {here[level].dataType.simpleString()}")
        typed = typed.select(*[col(k) for k in keep], explode(records).alias("__r"))
    if isinstance(typed.schema["__r"].dataType, T.ArrayType):  # a list of records
        typed = typed.select(*[col(k) for k in keep], explode("__r").alias("__r"))
    if isinstance(typed.schema["__r"].dataType, T.StructType):
        names = typed.schema["__r"].dataType.names
        typed = typed.select(*[col(k) for k in keep], *[F.col("__r").getField(n).alias(n) for n in names])
        return _as_text(flatten_struct(typed, sep))
    return _as_text(typed.withColumnRenamed("__r", path[-1] if path else column))
