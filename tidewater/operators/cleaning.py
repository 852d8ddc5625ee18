"""The order in which records are cleaned, and the flat forms of reviewed rows and known entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fill import fill
from .idem import resolve_idems
from .structure import calculate, cast, clean_values, complete, flatten_strings, normalize, prune, simplify

_KEY = {"type": "string", "for_cleaning": ["not_cleanable"]}
_TEXT = {"type": "string"}

# The columns of reviewed rows, in order, and which of them are text that is flattened.
REVIEWED_SHIP = (
    "temp_key", "rev_travel_departure_date", "rev_travel_duration_value", "rev_travel_duration_unit", "rev_travel_departure_port", "rev_travel_arrival_date", "rev_ship_type",
    "rev_ship_name", "rev_ship_tons_capacity", "rev_ship_tons_unit", "rev_ship_flag", "rev_master_role", "rev_master_name",
)
REVIEWED_CARGO = ("temp_key", "cargo_merchant_id", "cargo_commodity_id", "rev_cargo_merchant_name", "rev_cargo_commodity", "rev_cargo_unit")
SHIP_TEXTS = ("rev_travel_duration_unit", "rev_travel_departure_port", "rev_ship_type", "rev_ship_name", "rev_ship_tons_unit", "rev_ship_flag", "rev_master_role", "rev_master_name")
CARGO_TEXTS = ("rev_cargo_merchant_name", "rev_cargo_commodity", "rev_cargo_unit")

#: What is flattened of a known entity: all but its name.
ENTITY = {"properties": {"name": _KEY, "normalized_name": _TEXT, "voices": {"type": "array", "items": _TEXT}}}


def clean_entries(df: DataFrame, schema: dict, mapping: dict | None = None) -> DataFrame:
    """Entries in their accepted form: completed, normalised, filled, pruned, simplified, idems resolved, values corrected,
    missing ones calculated, and cast.

    Columns that order and partition the entries stay until idems are resolved, whether or not the schema has them.
    """
    frame = schema.get("schema_path", schema).get("order_and_partitions", {})
    keep = tuple(c for c in (*frame.get("partitions", []), *frame.get("order", [])) if c in df.columns)
    df = fill(normalize(complete(df, schema), schema), schema)
    df = simplify(prune(df, schema, keep), schema)
    if frame.get("order"):
        df = resolve_idems(df, schema)
    return cast(calculate(clean_values(df, schema, mapping or {}), schema), schema)


def flat_entries(df: DataFrame, schema: dict) -> DataFrame:
    """Entries with their cleanable strings in lower case without accents."""
    return flatten_strings(df, schema)


def _flat_reviewed(df: DataFrame, texts: tuple[str, ...], schema: dict | None) -> DataFrame:
    df = flatten_strings(df, {"properties": {"temp_key": _KEY, **{t: _TEXT for t in texts}}})
    return cast(df, schema) if schema else df


def flat_reviewed_ships(df: DataFrame, schema: dict | None = None) -> DataFrame:
    """Reviewed ship rows with flat texts, cast by the layer's schema if there is one."""
    return _flat_reviewed(df, SHIP_TEXTS, schema)


def flat_reviewed_cargo(df: DataFrame, schema: dict | None = None) -> DataFrame:
    """Reviewed cargo rows with flat texts, cast by the layer's schema if there is one."""
    return _flat_reviewed(df, CARGO_TEXTS, schema)


def flat_entities(df: DataFrame) -> DataFrame:
    """Known entities with their voices as they were in one text, a flat name beside the name, and flat voices."""
    return flatten_strings(df.withColumns({"voices_original_value": F.col("voices").cast("string"), "normalized_name": F.col("name").cast("string")}), ENTITY)


def reviewed_ships(df: DataFrame) -> DataFrame:
    return df.select(*REVIEWED_SHIP)


def reviewed_cargo(df: DataFrame) -> DataFrame:
    return df.select(*REVIEWED_CARGO)
