"""Shaping records by a schema: completing, pruning, normalising, simplifying, casting, flattening, cleaning values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import parse_as, properties, rebuild, spark_type
from ..functions.strings import correct, flatten, tidy
from .fill import source

SOURCE, DETAIL = "_extraction_source_method", "_detailed_value"
ORIGINS = ("default_value", "original_value", "calculated_value", "boat_fact_model")


def _detail_type() -> T.StructType:
    return T.StructType([T.StructField(o, T.StringType()) for o in ORIGINS])


def accepted(schema: dict) -> dict[str, T.DataType]:
    """Every column that records of the schema have, text until the cast."""
    found: dict[str, T.DataType] = {}
    for name, node in properties(schema).items():
        found |= {name: spark_type(node, True), name + SOURCE: T.StringType(), name + DETAIL: _detail_type()}
    return found


def complete(df: DataFrame, schema: dict) -> DataFrame:
    """Adds the accepted columns that are missing, as typed NULLs."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in accepted(schema).items() if n not in df.columns})


def prune(df: DataFrame, schema: dict, keep: tuple[str, ...] = ()) -> DataFrame:
    names = accepted(schema).keys() | set(keep)
    return df.select(*[c for c in df.columns if c in names])


def _reference(spec: dict, old: Column) -> Column:
    kind, value = spec.get("type", "column"), spec.get("value")
    if kind == "literal":
        return F.lit(value)
    if kind == "expr":
        return F.expr(value)
    path = str(value).split(".")
    column = old if path[0] == "old_value" else F.col(path[0])
    for step in path[1:]:
        column = column[step]
    return column


def _equivalence(spec, old: Column) -> Column:
    if "new_value" in spec:
        return F.struct(*[_reference(r, old).alias(n) for n, r in spec["new_value"].items()])
    return _reference(spec, old)


def normalize_one(column: Column, node: dict) -> Column:
    """A column by its normalize spec: the first option whose cast succeeds, else the raw value's equivalence."""
    target, spec = spark_type(node, True), node.get("normalize")
    if not spec:
        return parse_as(column, target)

    def one(value: Column) -> Column:
        tries = []
        for option in spec.get("options", []):
            parsed = parse_as(value, spark_type(option["try_cast_to"], True))
            tries.append(F.when(parsed.isNotNull(), _equivalence(option["equivalence"], parsed)))
        if "otherwise" in spec:
            tries.append(F.when(value.isNotNull(), _equivalence(spec["otherwise"]["equivalence"], value)))
        return F.coalesce(*tries) if tries else value

    if spec.get("type") == "foreach_item":
        return F.transform(parse_as(column, T.ArrayType(T.StringType())), one)
    return one(column)


def normalize(df: DataFrame, schema: dict) -> DataFrame:
    nodes, kinds = properties(schema), dict(df.dtypes)
    return df.select(*[c for c in df.columns if c not in nodes], *[(normalize_one(F.col(n), s) if kinds[n] == "string" else F.col(n)).alias(n) for n, s in nodes.items() if n in df.columns])


def simplify(df: DataFrame, schema: dict) -> DataFrame:
    """f_original_value from each field's provenance: the value its method names, else the first of calculated, original, default."""
    nodes, out = properties(schema), {}
    for name, node in nodes.items():
        detail = name + DETAIL
        if detail not in df.columns or not isinstance(df.schema[detail].dataType, T.StructType):
            out[f"{name}_original_value"] = F.col(name)
            continue
        d, method = F.col(detail), F.col(name + SOURCE)
        text = F.when(method == "calculated_value", d["calculated_value"]).when(method == "original_value", d["original_value"]).when(method == "default_value", d["default_value"])
        text = F.when(method.isNull(), F.coalesce(d["calculated_value"], d["original_value"], d["default_value"])).otherwise(text)
        target = spark_type(node, True)
        value = parse_as(text, target) if isinstance(target, (T.StructType, T.ArrayType)) else text
        out[f"{name}_original_value"] = F.coalesce(value, F.col(name).cast(target) if name in df.columns else value)
    return df.withColumns(out).drop(*[n + s for n in nodes for s in (SOURCE, DETAIL)])


def _leaf_cast(column: Column, node: dict, _: str) -> Column:
    return column.try_cast(spark_type(node))


def cast(df: DataFrame, schema: dict, expand_null: bool = False) -> DataFrame:
    """Casts the schema's columns, NULL where a value does not parse."""
    return df.withColumns({n: rebuild(F.col(n), s, _leaf_cast, n, expand_null) for n, s in properties(schema).items() if n in df.columns})


def _leaf_flatten(column: Column, node: dict, _: str) -> Column:
    spared = node.get("type") != "string" or "not_cleanable" in node.get("for_cleaning", [])
    return column if spared else flatten(column)


def flatten_strings(df: DataFrame, schema: dict) -> DataFrame:
    """Lower case without accents for all strings that may be cleaned."""
    return df.withColumns({n: rebuild(F.col(n), s, _leaf_flatten, n) for n, s in properties(schema).items() if n in df.columns and s.get("type") in ("string", "object", "array")})


def clean_values(df: DataFrame, schema: dict, mapping: dict) -> DataFrame:
    """Corrects every leaf by its field's map and its type: numbers and dates by numeric_map, strings by their tags."""
    maps = {"not_paragraph": mapping.get("not_paragraph_map", {}), "one_word": mapping.get("one_word_map", {}), "only_text": mapping.get("only_text_map", {})}

    def leaf(column: Column, node: dict, name: str) -> Column:
        if isinstance(mapping.get(name), dict):
            column = correct(column, mapping[name])
        kind = node.get("type")
        if kind in ("integer", "number") or kind == "string" and node.get("format"):
            return correct(column, mapping.get("numeric_map", {}))
        if kind != "string":
            return column
        return tidy(column, node["for_cleaning"], maps) if "for_cleaning" in node else F.regexp_replace(F.trim(column), r"[.,; \t]+$", "")

    return df.withColumns({n: rebuild(F.col(n), s, leaf, n) for n, s in properties(schema).items() if n in df.columns})


def reorder(df: DataFrame, schema: dict) -> DataFrame:
    """Struct fields in the schema's order."""
    return df.withColumns({n: rebuild(F.col(n), s, lambda c, *_: c, n) for n, s in properties(schema).items() if n in df.columns})


def decrement_date(origin: Column, amount: Column, unit: Column) -> Column:
    """A date less so many whole days or hours (the amount is floored); unknown units are days."""
    name, n = F.lower(F.trim(unit.cast("string"))), F.floor(amount.try_cast("double")).cast("int")
    by_hours = F.to_date(F.timestamp_seconds(F.unix_timestamp(origin.cast("timestamp")) - n * 3600))
    return F.when(name.isin("h", "hours", "h."), by_hours).otherwise(F.date_sub(origin.cast("date"), n))


def date_difference(final: Column, origin: Column) -> Column:
    return F.datediff(final.try_cast("date"), origin.try_cast("date"))


def calculate(df: DataFrame, schema: dict) -> DataFrame:
    """Fills NULL or missing fields by their calculable_if_null operation, in schema order. Parameters are columns, LIT(...) or {type, value}."""
    for name, node in properties(schema).items():
        spec = node.get("calculable_if_null")
        if not spec:
            continue
        p = spec.get("parameters", spec.get("params", {}))
        if spec["operation"] == "decrement_data":
            value = decrement_date(source(p.get("origin_date")).try_cast("date"), source(p.get("decrement")), source(p.get("decrement_unit")))
        elif spec["operation"] == "data_difference":
            value = date_difference(source(p.get("final_date")), source(p.get("origin_date")))
        else:
            raise ValueError(f"unknown operation {spec['operation']!r}")
        df = df.withColumn(name, F.coalesce(F.col(name), value.cast(df.schema[name].dataType)) if name in df.columns else value)
    return df
