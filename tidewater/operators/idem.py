"""Resolving "idem": values that say "the same as before"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.schema import properties

# Fixed value: what counts as idem ("id", "Id.", "idem", "Id. y id.").
IDEM = r"^\s*[Ii][dD](?:(?:\.)|(?:[Eeoa][nmMN]))?(?: +.{1,2} +[Ii][dD](?:(?:\.)|(?:[Eeoa][nmMN]))?)?\s*$"


def is_idem(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("")).rlike(IDEM)


def resolve_field(value: Column, window, otherwise: Column | None = None) -> Column:
    """An idem takes the last value before it that is neither idem nor NULL; NULL stays NULL."""
    carried = F.last(F.when(~is_idem(value), value), ignorenulls=True).over(window.rowsBetween(W.unboundedPreceding, W.currentRow))
    return F.when(is_idem(value), F.coalesce(carried, otherwise) if otherwise is not None else carried).otherwise(value)


def _resolved_items(items: Column, fields: list[str], names: list[str], seed: Column, fallback: dict[str, Column] | None = None) -> Column:
    """Items in turn, each idem field from the item before it (its resolved value), the first item's from the seed."""

    def step(done: Column, item: Column) -> Column:
        first, before = F.size(done) == 0, F.try_element_at(done, F.lit(-1))

        def one(name: str) -> Column:
            own = item[name]
            if name not in fields:
                return own.alias(name)
            later = before[name] if fallback is None else F.coalesce(before[name], fallback[name], own)
            start = F.coalesce(seed[name], *([fallback[name]] if fallback else []), own)
            return F.when(is_idem(own), F.when(first, start).otherwise(later)).otherwise(own).alias(name)

        return F.array_append(done, F.when(item.isNotNull(), F.struct(*[one(n) for n in names])))

    return F.aggregate(items, F.slice(items, 1, 0), step)


def resolve_array(items: Column, fields: list[str], names: list[str], window, chain: bool = False) -> Column:
    """Idem fields of an array of structs. The first item looks at the previous row's raw last item; with chain, at the last
    row before whose last item is not idem itself, field by field. NULL and empty arrays stay as they are."""
    last = F.try_element_at(items, F.lit(-1))
    if chain:
        seed = F.struct(*[F.last(F.when(~is_idem(last[f]), last[f]), ignorenulls=True).over(window.rowsBetween(W.unboundedPreceding, -1)).alias(f) for f in fields])
    else:
        seed = F.lag(last, 1).over(window)
    return F.when(F.size(items) > 0, _resolved_items(items, fields, names, seed)).otherwise(items)


def resolve_nested(items: Column, inner: str, fields: list[str], names: list[str], inner_names: list[str], window) -> Column:
    """Idem fields of an array inside an array of structs. An inner array's first item looks at the last resolved item of the outer item
    before it, the first outer item's at the previous row's raw last item, then at that row's last value that is not idem."""
    empty = F.slice(F.try_element_at(items, F.lit(1))[inner], 1, 0)
    flat = F.flatten(F.transform(items, lambda o: F.coalesce(o[inner], empty)))
    seed = F.lag(F.try_element_at(flat, F.lit(-1)), 1).over(window)

    def solid_one(f: str) -> Column:
        said = F.filter(F.transform(flat, lambda x: x[f]), lambda v: v.isNotNull() & ~is_idem(v))
        return F.lag(F.try_element_at(said, F.lit(-1)), 1).over(window)

    solid = {f: solid_one(f) for f in fields}

    def step(done: Column, outer: Column) -> Column:
        said = F.flatten(F.transform(done, lambda o: F.coalesce(o[inner], empty)))
        start = F.when(F.size(done) == 0, seed).otherwise(F.try_element_at(said, F.lit(-1)))
        own = outer[inner]
        fixed = F.when(F.size(own) > 0, _resolved_items(own, fields, inner_names, start, solid)).otherwise(own)
        return F.array_append(done, F.struct(*[(fixed if n == inner else outer[n]).alias(n) for n in names]))

    return F.when(F.size(items) > 0, F.aggregate(items, F.slice(items, 1, 0), step)).otherwise(items)


def resolve_idems(df: DataFrame, schema: dict, chain: bool = False) -> DataFrame:
    """Resolves all fields that the schema tags accepted_idem: root fields, arrays, then arrays inside arrays."""
    frame = schema.get("schema_path", schema).get("order_and_partitions", {})
    if not frame.get("order"):
        raise ValueError("resolving idems needs order_and_partitions.order")
    window = W.partitionBy(*frame.get("partitions", [])).orderBy(*[F.asc_nulls_first(c) for c in frame["order"]])

    def tagged(nodes: dict) -> list[str]:
        return [n for n, s in nodes.items() if "accepted_idem" in s.get("for_cleaning", [])]

    out = {}
    for name, node in properties(schema).items():
        if name not in df.columns:
            continue
        if name in tagged({name: node}) and node.get("type") == "string":
            out[name] = resolve_field(F.col(name), window, F.col(f"{name}_original_value") if f"{name}_original_value" in df.columns else None)
        elif node.get("type") == "array" and node["items"].get("type") == "object":
            inside = node["items"]["properties"]
            column = F.col(name)
            for inner, sub in inside.items():
                if sub.get("type") == "array" and sub["items"].get("type") == "object" and tagged(sub["items"]["properties"]):
                    column = resolve_nested(column, inner, tagged(sub["items"]["properties"]), list(inside), list(sub["items"]["properties"]), window)
            if tagged(inside):
                column = resolve_array(column, tagged(inside), list(inside), window, chain)
            out[name] = column
    return df.withColumns(out)
