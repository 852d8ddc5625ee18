"""JSON schemas as Spark types, and parsing of text by them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIMPLE = {"integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}


def properties(schema: dict) -> dict:
    """The root's properties, whether or not the schema is wrapped."""
    return schema.get("schema_path", schema).get("properties", {})


def spark_type(schema: dict, as_text: bool = False) -> T.DataType:
    """The Spark type of a JSON schema node; as_text makes every leaf a string."""
    kind = schema.get("type")
    if kind == "object":
        required = set(schema.get("required", ()))
        return T.StructType([T.StructField(n, spark_type(s, as_text), n not in required) for n, s in schema.get("properties", {}).items()])
    if kind == "array":
        if "items" not in schema:
            raise ValueError("an array needs items")
        return T.ArrayType(spark_type(schema["items"], as_text))
    if kind == "string":
        form = None if as_text else schema.get("format")
        return T.DateType() if form == "date" else T.TimestampType() if form in ("date-time", "datetime") else T.StringType()
    if kind in _SIMPLE:
        return T.StringType() if as_text else _SIMPLE[kind]
    raise ValueError(f"unsupported JSON schema type {kind!r}")


def loose(kind: T.DataType) -> T.DataType:
    """The type with NULLs allowed everywhere, as casts need it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, loose(f.dataType), True) for f in kind])
    return T.ArrayType(loose(kind.elementType), True) if isinstance(kind, T.ArrayType) else kind


def parse_as(text: Column, kind: T.DataType) -> Column:
    """text as kind, NULL where it does not parse; structs and arrays from JSON."""
    if isinstance(kind, (T.StructType, T.ArrayType)):
        marks = ("{", "}") if isinstance(kind, T.StructType) else ("[", "]")
        bare = F.trim(text)
        return F.when(bare.startswith(marks[0]) & bare.endswith(marks[1]), F.from_json(bare, kind))
    return text.try_cast(kind)


def rebuild(column: Column, schema: dict, leaf: Callable[[Column, dict, str], Column], name: str = "", expand_null: bool = False) -> Column:
    """The column with leaf() applied to every leaf of the schema; struct fields outside it are dropped.

    A NULL struct stays NULL unless expand_null makes it a struct of NULLs.
    """
    kind = schema.get("type")
    if kind == "object":
        built = F.struct(*[rebuild(column[n], s, leaf, n, expand_null).alias(n) for n, s in schema.get("properties", {}).items()])
        return built if expand_null else F.when(column.isNotNull(), built)
    if kind == "array":
        return F.transform(column, lambda x: rebuild(x, schema["items"], leaf, name, expand_null))
    return leaf(column, schema, name)
