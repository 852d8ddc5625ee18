"""Filling of fields from other fields by declared rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import loose, properties, spark_type

_OPERATORS = {"==": "eqNullSafe", "!=": "__ne__", ">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__"}


def _path(path: str) -> Column:
    root, *rest = path.split(".")
    column = F.col(root)
    for step in rest:
        column = column[step]
    return column


def _literal(text: str) -> Column:
    quoted = re.fullmatch(r"LIT\((['\"])(.*)\1\)", text)
    if quoted:
        return F.lit(quoted[2])
    bare = text[4:-1].strip()
    return F.lit({"true": True, "false": False, "null": None}.get(bare.lower(), bare))


def source(spec) -> Column:
    """What a from entry stands for: NULL, a typed reference, a path, or LIT(...)."""
    if spec is None:
        return F.lit(None)
    if isinstance(spec, dict):
        kind, value = spec.get("type"), spec.get("value")
        return F.lit(value) if kind in ("l", "literal") else F.expr(value) if kind == "expr" else _path(value)
    return _literal(spec) if spec.startswith("LIT(") and spec.endswith(")") else _path(spec)


def condition(spec) -> Column:
    """A condition from an SQL text, {expr}, {column, op, value}, {and: [...]} or {or: [...]}; anything else holds."""
    if isinstance(spec, str):
        return F.expr(spec)
    if isinstance(spec, dict):
        if "expr" in spec or "expression" in spec:
            return F.expr(spec.get("expr", spec.get("expression")))
        for word, join in (("and", lambda a, b: a & b), ("or", lambda a, b: a | b)):
            if word in spec:
                parts = [condition(s) for s in spec[word]]
                whole = parts[0] if parts else F.lit(True)
                for part in parts[1:]:
                    whole = join(whole, part)
                return whole
        if "column" in spec:
            column, op = _path(spec["column"]), spec.get("op", "==")
            if op in ("isNull", "isNotNull"):
                return getattr(column, op)()
            if op == "==":
                return column == F.lit(spec.get("value"))
            return getattr(column, _OPERATORS[op])(F.lit(spec.get("value")))
    return F.lit(True)


def roots(spec) -> set[str]:
    """Root columns that a from entry or a condition needs."""
    if spec is None or isinstance(spec, (int, float, bool)):
        return set()
    if isinstance(spec, (list, tuple)):
        return set().union(*map(roots, spec))
    if isinstance(spec, dict):
        if "column" in spec and "type" not in spec:
            return {spec["column"].split(".")[0]}
        if spec.get("type") in ("l", "literal", "expr"):
            return set()
        return set().union(*(roots(spec[k]) for k in ("and", "or", "value", "from", "condition") if k in spec and not isinstance(spec[k], (int, float, bool))))
    if spec.startswith("LIT("):
        return set()
    first = re.match(r"\s*([A-Za-z_]\w*)", spec)
    return {first[1]} if first else set()


def _item(froms: list, tos: list) -> Column:
    return F.struct(*[(F.array(_item(f["from"], f["to"])) if isinstance(f, dict) and f.get("type") == "add_array_item" else source(f["from"]) if isinstance(f, dict) and f.get("type") == "add_all_items" else source(f)).alias(t) for f, t in zip(froms, tos)])


def apply_rule(df: DataFrame, field: str, node: dict, rule: dict) -> DataFrame:
    """One rule: replace, replace_if_not_exist, add_array_item or add_all_items. Skipped if a column that it needs is missing."""
    froms, to = rule.get("from"), rule.get("to", field)
    as_list = isinstance(froms, list)
    needed = roots(froms) | roots(rule.get("condition"))
    if not needed <= set(df.columns):
        return df
    if rule.get("condition") is not None:
        holds = condition(rule["condition"])
    else:
        holds = F.lit(True)
        for part in froms if as_list else [froms]:
            if not isinstance(part, dict) or "from" not in part:
                holds = holds & source(part).isNotNull()
    kind = rule["type"]
    target = loose(df.schema[field].dataType if field in df.columns else spark_type(node, True))
    now = F.col(field) if field in df.columns else F.lit(None).cast(target)
    if kind in ("replace", "replace_if_not_exist"):
        if as_list:
            new = _item(froms, to).cast(target) if isinstance(target, T.StructType) and len(target) == len(froms) else _item(froms, to)
            value = new if kind == "replace" else F.coalesce(now, new)
        elif isinstance(to, str) and "." in to:
            branch = to.split(".", 1)[1]
            fresh = source(froms) if kind == "replace" else F.coalesce(now[branch], source(froms))
            value = now.withField(branch, fresh)
        else:
            value = source(froms).cast(target) if kind == "replace" else F.coalesce(now, source(froms).cast(target))
    elif kind == "add_array_item":
        item = (_item(froms, to) if as_list else source(froms)).cast(target.elementType)
        value = F.when(now.isNull(), F.array(item)).otherwise(F.array_append(now, item))
    elif kind == "add_all_items":
        value = F.coalesce(now, source(froms).cast(target))
    else:
        raise ValueError(f"unknown fill type {kind!r}")
    df = df.withColumn(field, F.when(holds, value).otherwise(now))
    return df.drop(*(roots(froms) - {field})) if rule.get("drop_origin") else df


def fill(df: DataFrame, schema: dict) -> DataFrame:
    """Applies every field's fill_with rules in schema order; later rules see what earlier ones wrote."""
    for name, node in properties(schema).items():
        rules = node.get("fill_with", [])
        for rule in rules if isinstance(rules, list) else [rules]:
            df = apply_rule(df, name, node, rule)
    return df
