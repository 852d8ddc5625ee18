"""Citations and voices: nested records exploded into one row for each mention. Which citations there are is data."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mention:
    """origin: what field_origin says; path: array columns to explode, outermost first, each with the name of its index; value: the field of the last one (or of the entry)."""

    origin: str
    value: str
    path: tuple[tuple[str, str], ...] = ()


SINGLE = {
    "ship_types": Mention("ship_type", "ship_type"),
    "ship_tons_units": Mention("ship_tons_unit", "ship_tons_unit"),
    "ship_flags": Mention("ship_flag", "ship_flag"),
    "master_roles": Mention("master_role", "master_role"),
    "ship_agents": Mention("ship_agent_name", "ship_agent_name"),
    "brokers": Mention("broker_name", "broker_name"),
}
# What field_origin says of nested mentions; ids hold it.
CALLS, COMMODITY_AND_UNIT = "travel_port_of_call_list", "cargo_list.cargo"
NESTED = {
    "cargo_merchants": Mention("cargo_list.cargo_merchant_name", "cargo_merchant_name", (("cargo_list", "merchant_idx"),)),
    "cargo_commodities": Mention("cargo_list.cargo.cargo_commodity", "cargo_commodity", (("cargo_list", "merchant_idx"), ("cargo", "cargo_idx"))),
    "cargo_units": Mention("cargo_list.cargo.cargo_unit", "cargo_unit", (("cargo_list", "merchant_idx"), ("cargo", "cargo_idx"))),
}
ENTRY_FIELDS = ("travel_departure_port", "travel_departure_date", "travel_arrival_port", "travel_arrival_date", "ship_type", "ship_flag", "ship_tons_capacity", "ship_name", "master_role", "master_name")


def _exploded(entries: DataFrame, path: tuple[tuple[str, str], ...]) -> DataFrame:
    """The entry's keys, each index, and the last item as `item`. NULL and empty arrays give no rows."""
    rows = entries.select("entry_id", "temp_key", F.posexplode(path[0][0]).alias(path[0][1], "item"))
    seen = ["entry_id", "temp_key", path[0][1]]
    for name, index in path[1:]:
        rows = rows.select(*seen, F.posexplode(F.col("item")[name]).alias(index, "item"))
        seen.append(index)
    return rows


def _id(origin: str, *places: str) -> Column:
    """entry_id-origin-place-...; NULL if entry_id is."""
    return F.concat(F.col("entry_id"), F.lit(f"-{origin}"), *[F.concat(F.lit("-"), F.col(p).cast("string")) for p in places])


def mentions(entries: DataFrame, m: Mention) -> DataFrame:
    """id, entry_id, temp_key, field_origin, the indexes, citation."""
    if not m.path:
        return entries.select(F.col("entry_id").alias("id"), "entry_id", "temp_key", F.lit(m.origin).alias("field_origin"), F.col(m.value).alias("citation"))
    places = [i for _, i in m.path]
    return _exploded(entries, m.path).select(_id(m.origin, *places).alias("id"), "entry_id", "temp_key", F.lit(m.origin).alias("field_origin"), *places, F.col("item")[m.value].alias("citation"))


def commodities_and_units(entries: DataFrame) -> DataFrame:
    """Both parts of each cargo and `commodity-unit`, NULL if either is."""
    rows, c, u = _exploded(entries, NESTED["cargo_units"].path), F.col("item.cargo_commodity"), F.col("item.cargo_unit")
    key = _id(COMMODITY_AND_UNIT, "merchant_idx", "cargo_idx")
    return rows.select(key.alias("id"), "entry_id", "temp_key", F.lit(COMMODITY_AND_UNIT).alias("field_origin"), "merchant_idx", "cargo_idx", c.alias("cargo_commodity_citation"), u.alias("cargo_unit_citation"), F.concat(c, F.lit("-"), u).alias("citation"))


def ports(entries: DataFrame, departure: bool = True, calls: bool = True, arrival: bool = True) -> DataFrame:
    """Departure, ports of call and arrival of each entry, or some of them."""

    def one(origin: str) -> DataFrame:
        rows = entries.select("entry_id", "temp_key", F.lit(origin).alias("field_origin"), F.lit(0).alias("port_idx"), F.col(origin).alias("citation"))
        return rows.select(_id(origin, "port_idx").alias("id"), "*")

    called = Mention(CALLS, "port_of_call_place", ((CALLS, "port_idx"),))
    parts = [one("travel_departure_port")] if departure else []
    parts += [mentions(entries, called)] if calls else []
    parts += [one("travel_arrival_port")] if arrival else []
    return reduce(DataFrame.unionByName, parts)


def entry_fields(entries: DataFrame) -> DataFrame:
    """A ship's or master's entry: its ten cited fields in one row."""
    return entries.select(F.col("entry_id").alias("id"), "entry_id", "temp_key", *[F.col(f).alias(f"{f}_citation") for f in ENTRY_FIELDS], F.lit("single_ship_entry_fields").alias("field_origin"))


def voices(entities: DataFrame) -> DataFrame:
    """A row for each voice of a known entity."""
    rows = entities.select("name", "normalized_name", F.posexplode("voices").alias("voice_idx", "voice"))
    return rows.select(F.concat("name", F.lit("-"), "voice").alias("id"), "name", "normalized_name", "voice_idx", F.lit("voices").alias("field_origin"), "voice")
