"""Registered queries of the layers, the cleaning order, linkage training and the logs, and the SQL that checks them."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..layers import Cleaning, Ingestion, Layer, container
from ..lineage import Log, Traced
from ..operators import cleaning, extract, linkage, migrate, structure
from ..sources.files import raw_entries
from .catalog import _CARGO, _ENTRIES, entries, part_voices, query, store, table

# --- extraction and cleaning ------------------------------------------------------------------------------------------

_SINGLE_ENTRY = (
    "SELECT entry_id AS id, entry_id, temp_key, n_name AS travel_departure_port_citation, strftime(o_orderdate, '%Y-%m-%d') AS travel_departure_date_citation, "
    "o_orderstatus AS travel_arrival_port_citation, strftime(o_orderdate, '%Y-%m-%d') AS travel_arrival_date_citation, c_mktsegment AS ship_type_citation, "
    "n_name AS ship_flag_citation, CAST(o_totalprice AS VARCHAR) AS ship_tons_capacity_citation, c_name AS ship_name_citation, o_orderstatus AS master_role_citation, "
    f"c_name AS master_name_citation, 'single_ship_entry_fields' AS field_origin FROM {_ENTRIES}"
)
for _name in ("extract_ships", "extract_masters"):
    query(_name, _SINGLE_ENTRY)(lambda spark, d: extract.entry_fields(entries(spark, d)))


@query(
    "extract_null_ids",
    "SELECT DISTINCT CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey || '-cargo_list.cargo_merchant_name-' || merchant_idx END AS id, 't' || l_orderkey AS temp_key, "
    f"CAST(merchant_idx AS INTEGER) AS merchant_idx FROM {_CARGO}",
)
def extract_null_ids(spark, d):
    rows = entries(spark, d).withColumn("entry_id", F.when(F.col("o_orderkey") % 2 == 0, F.col("entry_id")))
    return extract.mentions(rows, extract.NESTED["cargo_merchants"]).select("id", "temp_key", "merchant_idx")


@query("extract_calls_only", f"SELECT entry_id || '-travel_port_of_call_list-' || i AS id, CASE WHEN i = 0 THEN n_name ELSE c_mktsegment END AS citation FROM {_ENTRIES}, (SELECT UNNEST([0, 1]) AS i) WHERE n_name IS NOT NULL")
def extract_calls_only(spark, d):
    return extract.ports(entries(spark, d), departure=False, arrival=False).select("id", "citation")


ENTRY_SCHEMA = {
    "properties": {
        "entry_id": {"type": "string", "for_cleaning": ["not_cleanable"]},
        "ship_type": {"type": "string", "for_cleaning": ["accepted_idem"]},
        "tons": {"type": "integer"},
        "arrival": {"type": "string", "format": "date"},
        "departure": {"type": "string", "format": "date", "calculable_if_null": {"operation": "decrement_data", "parameters": {"origin_date": "arrival", "decrement": "LIT('2.9')", "decrement_unit": {"type": "literal", "value": "d."}}}},
        "note": {"type": "string", "fill_with": {"type": "replace_if_not_exist", "from": "extra", "to": "note"}},
    },
    "order_and_partitions": {"order": ["seq"], "partitions": ["publication_name"]},
}


def raw_orders(spark, d):
    """Orders as raw entries: idems, closing marks, a misread digit, a column that no schema has."""
    said = F.when(F.col("o_orderkey") % 3 == 1, "Id.").otherwise(F.concat(F.lit(" "), "o_orderstatus", F.lit("brig.,")))
    return table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("entry_id"), F.col("o_orderpriority").alias("publication_name"), F.col("o_orderkey").alias("seq"), said.alias("ship_type"),
        F.translate(F.col("o_custkey").cast("string"), "0", "O").alias("tons"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("arrival"), F.concat(F.lit(" e-"), "o_orderstatus", F.lit(";")).alias("extra"),
    )


_CLEANED = (
    "SELECT CAST(o_orderkey AS VARCHAR) AS entry_id, CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus || 'brig' ELSE COALESCE(last_value(CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus || 'brig' END IGNORE NULLS) "
    "OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'Id.') END AS ship_type, o_custkey AS tons, CAST(o_orderdate AS DATE) AS arrival, "
    "CAST(o_orderdate AS DATE) - 2 AS departure, 'e-' || o_orderstatus AS note FROM orders"
)
_CLEAN_COLUMNS = ["entry_id", "ship_type", "tons", "arrival", "departure", "note"]


@query("clean_entries", _CLEANED)
def clean_entries(spark, d):
    return cleaning.clean_entries(raw_orders(spark, d), ENTRY_SCHEMA, {"numeric_map": {"O": "0"}}).select(*_CLEAN_COLUMNS)


@query("flat_cleaned_entries", f"SELECT entry_id, lower(ship_type) AS ship_type, note FROM ({_CLEANED})")
def flat_cleaned_entries(spark, d):
    return cleaning.flat_entries(clean_entries(spark, d), ENTRY_SCHEMA).select("entry_id", "ship_type", F.regexp_replace("note", "^e-(.)$", "e-$1").alias("note")).withColumn("note", F.concat(F.lit("e-"), F.upper(F.substring("note", 3, 1))))


@query("flat_entities", "SELECT n_name AS name, lower(n_name) AS normalized_name, '[' || n_name || ', Àb ' || n_name || ']' AS voices_original_value, 'ab ' || lower(n_name) AS second FROM nation")
def flat_entities(spark, d):
    known = table(spark, d, "nation").select(F.col("n_name").alias("name"), F.array("n_name", F.concat(F.lit("Àb "), "n_name")).alias("voices"))
    return cleaning.flat_entities(known).select("name", "normalized_name", "voices_original_value", F.col("voices")[1].alias("second"))


def reviewed_ship_rows(spark, d):
    o = table(spark, d, "orders")
    given = {"temp_key": F.concat(F.lit("T"), F.col("o_orderkey").cast("string")), "rev_ship_name": F.concat(F.lit("É-"), "o_orderpriority"), "rev_travel_departure_port": F.col("o_orderstatus"), "rev_travel_departure_date": F.date_format("o_orderdate", "yyyy-MM-dd")}
    return o.select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in cleaning.REVIEWED_SHIP], F.lit("x").alias("other"))


@query("flat_reviewed_ships", "SELECT 'T' || o_orderkey AS temp_key, CAST(o_orderdate AS DATE) AS rev_travel_departure_date, 'e-' || lower(o_orderpriority) AS rev_ship_name, lower(o_orderstatus) AS rev_travel_departure_port FROM orders")
def flat_reviewed_ships(spark, d):
    rows = cleaning.flat_reviewed_ships(cleaning.reviewed_ships(reviewed_ship_rows(spark, d)), {"properties": {"rev_travel_departure_date": {"type": "string", "format": "date"}}})
    return rows.select("temp_key", "rev_travel_departure_date", "rev_ship_name", "rev_travel_departure_port")


def reviewed_cargo_rows(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("temp_key"), F.col("o_orderkey").alias("cargo_merchant_id"), F.lit(1).alias("cargo_commodity_id"), F.col("o_orderpriority").alias("rev_cargo_merchant_name"), F.concat(F.lit("Ñ"), "o_orderstatus").alias("rev_cargo_commodity"), F.lit(None).cast("string").alias("rev_cargo_unit"))


_CARGO_ROWS = "SELECT 'T' || o_custkey AS temp_key, o_orderkey AS cargo_merchant_id, 1 AS cargo_commodity_id, o_orderpriority AS rev_cargo_merchant_name, 'Ñ' || o_orderstatus AS rev_cargo_commodity, CAST(NULL AS VARCHAR) AS rev_cargo_unit FROM orders"


@query("flat_reviewed_cargo", f"SELECT temp_key, cargo_merchant_id, lower(rev_cargo_merchant_name) AS rev_cargo_merchant_name, 'n' || lower(substr(rev_cargo_commodity, 2)) AS rev_cargo_commodity FROM ({_CARGO_ROWS})")
def flat_reviewed_cargo(spark, d):
    return cleaning.flat_reviewed_cargo(cleaning.reviewed_cargo(reviewed_cargo_rows(spark, d))).select("temp_key", "cargo_merchant_id", "rev_cargo_merchant_name", "rev_cargo_commodity")


@query("calc_hours_floored", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 24 HOUR AS DATE) AS departure FROM orders")
def calc_hours_floored(spark, d):
    spec = {"operation": "decrement_data", "parameters": {"origin_date": "o_orderdate", "decrement": "LIT('24.5')", "decrement_unit": "LIT('Hours ')"}}
    df = table(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return structure.calculate(df, {"properties": {"departure": {"type": "string", "format": "date", "calculable_if_null": spec}}}).select("o_orderkey", "departure")


@query(
    "patch_dated_ids",
    "WITH e AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'pub_' ELSE 'publication_' END || o_orderkey AS entry_id, o_orderpriority AS edition, "
    "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders) "
    "SELECT o_orderkey, CASE WHEN day IS NOT NULL AND min(length(entry_id)) OVER (PARTITION BY day, edition) < 13 "
    "THEN split_part(entry_id, '_', 1) || '_' || lpad(split_part(entry_id, '_', 2), 10, '0') ELSE entry_id END AS entry_id, "
    "CAST(year(day) AS INTEGER) AS publication_date_year, CAST(month(day) AS INTEGER) AS publication_date_month, CAST(day(day) AS INTEGER) AS publication_date_day FROM e",
)
def patch_dated_ids(spark, d):
    prefix = F.when(F.col("o_orderkey") % 3 == 0, "pub_").otherwise("publication_")
    day = F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    df = table(spark, d, "orders").select("o_orderkey", F.concat(prefix, F.col("o_orderkey").cast("string")).alias("entry_id"), day.alias("publication_date"), F.lit("n").alias("publication_name"), F.col("o_orderpriority").alias("publication_edition"))
    return migrate.pad_dated(df).select("o_orderkey", "entry_id", *(f"publication_date_{part}" for part in ("year", "month", "day")))


# --- storage ------------------------------------------------------------------------------------------------------------


@query("append_partitioned", "SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS VARCHAR) AS note FROM nation WHERE n_regionkey < 3 UNION ALL SELECT n_nationkey, n_name, n_regionkey, 'late' FROM nation WHERE n_regionkey >= 2")
def append_partitioned(spark, d):
    lake, n = store(spark), table(spark, d, "nation")
    lake.write(n.filter("n_regionkey < 3"), "nations", partition_by=["n_regionkey"])
    lake.write(n.filter("n_regionkey >= 2").withColumn("note", F.lit("late")), "nations", mode="append")
    return lake.read("nations").select("n_nationkey", "n_name", "n_regionkey", "note")


@query("merge_null_keys", "SELECT CASE WHEN n_nationkey > 0 THEN n_nationkey END AS k, CASE WHEN n_nationkey = 0 THEN 'new' ELSE n_name END AS v FROM nation")
def merge_null_keys(spark, d):
    lake, n = store(spark), table(spark, d, "nation")
    lake.write(n.select(F.when(F.col("n_nationkey") > 0, F.col("n_nationkey")).alias("k"), F.col("n_name").alias("v")), "t")
    lake.write(n.filter("n_nationkey = 0").select(F.lit(None).cast("int").alias("k"), F.lit("new").alias("v")), "t", mode="merge", key="k")
    return lake.read("t")


@query("table_detail", "SELECT * FROM (VALUES (1, 2, 'n_regionkey', 'n_nationkey,n_name,n_regionkey', true, 'append')) AS t(version, parts, partition_by, columns, is_table, last_operation)")
def table_detail(spark, d):
    lake, n = store(spark), table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    for mode in ("overwrite", "append"):
        lake.write(n, "nations", mode=mode, partition_by=["n_regionkey"])
    found = lake.detail("nations")
    row = (found["version"], found["parts"], ",".join(found["partition_by"]), ",".join(found["columns"]), lake.is_table("nations"), lake.history("nations")[0]["operation"])
    return spark.createDataFrame([row], "version int, parts int, partition_by string, columns string, is_table boolean, last_operation string")


@query("sequence_values", "SELECT * FROM (VALUES (0, 0), (1, 5), (2, 6)) AS t(call, value)")
def sequence_values(spark, d):
    lake = store(spark)
    return spark.createDataFrame([(0, lake.sequence("s", increment=5)), (1, lake.sequence("s")), (2, lake.sequence("s"))], "call int, value int")


@query("json_round_trip", "SELECT n_nationkey, n_name, true AS ended, true AS none_if_missing FROM nation")
def json_round_trip(spark, d):
    layer = Ingestion(store(spark).config, spark)
    layer.write_json(table(spark, d, "nation").select("n_nationkey", "n_name"), "json.nations")
    return layer.read_json("json", "nations").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name", F.lit(layer.is_json("json.nations")).alias("ended"), F.lit(layer.read_json("json.none") is None).alias("none_if_missing"))


@query("raw_entries_by_folder", "SELECT o_orderkey, o_orderpriority AS publication_name FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'")
def raw_entries_by_folder(spark, d):
    path = store(spark).config.path("raw", "entries")
    table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("publication_name"), F.col("o_orderstatus").alias("uploaded_by")).write.partitionBy("publication_name").json(path)
    return raw_entries(spark, path, user="O", publication_name="1-URGENT").select("o_orderkey", "publication_name")


# --- layers -------------------------------------------------------------------------------------------------------------


def _layer(spark) -> Cleaning:
    return Cleaning(store(spark).config, spark, ENTRY_SCHEMA, {"numeric_map": {"O": "0"}})


@query("read_raw_entries", "SELECT CAST(o_orderkey AS VARCHAR) AS entry_id, 'raw' AS stage FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'saved' FROM orders WHERE o_orderstatus = 'F'")
def read_raw_entries(spark, d):
    layer, o = _layer(spark), table(spark, d, "orders").withColumn("entry_id", F.col("o_orderkey").cast("string"))
    layer.store.write(o, "ship_entries", level=0)
    layer.save_entries(o.filter("o_orderstatus = 'F'"), done=True, partition_by=["o_orderpriority"])
    return layer.read_raw_entries().select("entry_id", F.lit("raw").alias("stage")).unionByName(layer.read_entries().select("entry_id", F.lit("saved").alias("stage")))


@query("read_raw_entities", "SELECT n_name AS name FROM nation WHERE n_regionkey > 1")
def read_raw_entities(spark, d):
    layer, n = _layer(spark), table(spark, d, "nation").select(F.col("n_name").alias("name"), "n_regionkey")
    layer.store.write(n, "known_entities", "port", level=0)
    layer.clean_entities("port", n.filter("n_regionkey <= 1"))
    return layer.read_raw_entities("port").select("name")


@query("read_originals", "SELECT CAST(o_orderkey AS VARCHAR) AS entry_id FROM orders WHERE o_orderstatus <> 'P'")
def read_originals(spark, d):
    layer, o = _layer(spark), table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("entry_id"), "o_orderstatus")
    layer.save_originals(o)
    layer.store.update_state(o.filter("o_orderstatus = 'P'"), "ship_entries", key="entry_id", done=True)
    return layer.read_originals().select("entry_id")


@query("reviewed_ships_state", "SELECT 'T' || o_orderkey AS temp_key FROM orders WHERE o_orderstatus <> 'F'")
def reviewed_ships_state(spark, d):
    layer, rows = _layer(spark), reviewed_ship_rows(spark, d)
    Ingestion(layer.config, spark).save_reviewed(rows)
    layer.save_reviewed(cleaning.reviewed_ships(rows).filter("rev_travel_departure_port = 'F'"), done=True)
    return layer.read_raw_reviewed().select("temp_key")


@query("reviewed_cargo_saved", f"SELECT temp_key || '_' || cargo_merchant_id || '_' || cargo_commodity_id AS id, rev_cargo_commodity FROM ({_CARGO_ROWS})")
def reviewed_cargo_saved(spark, d):
    layer, rows = _layer(spark), reviewed_cargo_rows(spark, d)
    for _ in range(2):  # rows share a temp_key, never an id
        layer.save_reviewed(rows, is_cargo=True)
    return layer.read_reviewed(is_cargo=True).select("id", "rev_cargo_commodity")


@query("reviewed_projection", f"{_CARGO_ROWS}")
def reviewed_projection(spark, d):
    layer = Ingestion(store(spark).config, spark)
    layer.save_reviewed(reviewed_cargo_rows(spark, d).withColumn("other", F.lit(1)), is_cargo=True)
    return layer.read_reviewed(is_cargo=True)


@query("known_entities", "SELECT * FROM (VALUES ('Cuba', 'cuba,kuba'), ('Lima', 'lima')) AS t(name, voices)")
def known_entities(spark, d):
    layer = Ingestion(store(spark).config, spark)
    return layer.save_entities("port", '{"names": {"Cuba": ["cuba", "kuba"], "Lima": ["lima"]}}').select("name", F.array_join("voices", ",").alias("voices"))


@query("voices_of_saved", "SELECT 'e' || p_partkey || '-' || v AS id, v AS voice FROM (SELECT *, UNNEST([p_name, p_type]) AS v FROM part)")
def voices_of_saved(spark, d):
    layer = _layer(spark)
    layer.save_entities("parts", part_voices(spark, d))
    return layer.voices("parts").select("id", "voice")


@query("container_paths", "SELECT * FROM (VALUES ('known_entities/port'), ('known_entities/flag'), ('reviewed_entries/ship_entries'), ('reviewed_entries/cargo_ship_entries/x')) AS t(path)")
def container_paths(spark, d):
    found = [container("known_entities", "port"), container("known_entities", ["known_entities", "flag"]), container("reviewed_entries", second="ship_entries"), container("reviewed_entries", "x", second="cargo_ship_entries")]
    return spark.createDataFrame([("/".join(f),) for f in found], "path string")


@query("ingest_file", "SELECT * FROM (VALUES ('bp_0000000000', 'a', 'brig', 3, 'ann', 'original_value'), ('bp_0000000001', 'b', 'calc', 4, 'ann', 'calculated_value')) AS t(entry_id, parsed_text, ship, day, uploaded_by, method)")
def ingest_file(spark, d):
    layer, name = Ingestion(store(spark).config, spark), f"{tempfile.mkdtemp()}/entries.json"
    ship = lambda o, c: {"default_value": None, "original_value": o, "calculated_value": c}
    rows = [{"publication_name": "bp", "publication_date": "1900-02-04", "parsed_text": "b", "ship": ship("x", "calc")}, {"publication_name": "bp", "publication_date": "1900-02-03", "parsed_text": "a", "ship": ship("brig", None)}]
    for _ in range(2):  # the second time nothing is new
        with open(name, "w") as f:
            json.dump(rows, f)
        found = layer.ingest("ship_entries", local_path=name, user="ann", fields=["ship"])
    os.rmdir(os.path.dirname(name))
    return found.select("entry_id", "parsed_text", "ship", F.col("publication_date_day").alias("day"), "uploaded_by", F.col("ship_extraction_source_method").alias("method"))


@query("view_and_function", "SELECT n_nationkey, n_nationkey * 2 AS twice, n_nationkey + n_regionkey AS both FROM nation")
def view_and_function(spark, d):
    layer = Layer(store(spark).config, spark)
    layer.register_function("twice", lambda v: v * 2, "long")
    layer.register_function("both", lambda a, b: a + b, "long")
    name = layer.register_view(Traced(table(spark, d, "nation"), f"nations_{uuid.uuid4().hex}", 3))
    return layer.sql(f"SELECT * FROM {name}").df.select("n_nationkey", layer.twice("n_nationkey").alias("twice"), layer.both("n_nationkey", "n_regionkey").alias("both"))


@query("frames_of_values", "SELECT * FROM (VALUES (1, 'a', 'DF(created_by_session)'), (2, 'b', 'DF(created_by_session)')) AS t(k, v, name)")
def frames_of_values(spark, d):
    frame = Layer(store(spark).config, spark).frame([(1, "a"), (2, "b")], "k int, v string")
    return frame.df.withColumn("name", F.lit(frame.name))


# --- similarity and linkage -----------------------------------------------------------------------------------------------


def _soundex_sql(text: str) -> str:
    """Soundex of ASCII text: codes from the second letter on, H and W passed over, equal neighbours once, vowels gone."""
    codes = lambda x: f"translate(regexp_replace(upper({x}), '[^A-Z]', 'A', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    said = f"replace({codes(text)}, '7', '')"
    for k in range(7):
        said = f"regexp_replace({said}, '{k}+', '{k}', 'g')"
    first = f"CASE WHEN upper(substr({text}, 1, 1)) IN ('H', 'W') THEN 1 ELSE 2 END"
    return f"upper(substr({text}, 1, 1)) || substr(replace(substr({said}, {first}), '0', '') || '000', 1, 3)"


_A, _B = _soundex_sql("p_name"), _soundex_sql("p_type")


@query("sim_soundex", f"SELECT p_partkey, a AS code, round(1 - levenshtein(a, b) / greatest(length(a), length(b), 1), 9) AS s FROM (SELECT p_partkey, {_A} AS a, {_B} AS b FROM part)")
def sim_soundex(spark, d):
    return table(spark, d, "part").select("p_partkey", F.soundex("p_name").alias("code"), F.round(sim.soundex_ratio(F.col("p_name"), F.col("p_type")), 9).alias("s"))


_CONFIG = {
    "general_config_algorithms": {"lev": {"algorithm": "levenshtein", "thresholds": [0.5, 0.25]}, "grams": {"algorithm": "ngram", "thresholds": [0.2], "params": {"n": 2}}, "sound": {"algorithm": "soundex", "thresholds": [0.75]}},
    "entity_categories": {"port": {"field_l": "citation", "field_r": "voice", "algorithms": ["lev", "sound", "grams"]}},
}


@query("linkage_settings", "SELECT comparison, position, algorithm, CAST(threshold AS DOUBLE) AS threshold FROM (VALUES ('port', 0, 'levenshtein', 0.5), ('port', 1, 'levenshtein', 0.25), ('port', 2, 'ngram', 0.2), ('port_soundex', 0, 'levenshtein', 0.75)) AS t(comparison, position, algorithm, threshold)")
def linkage_settings(spark, d):
    rows = [(c.name, i, level[0], float(level[1])) for c in linkage.settings("port", _CONFIG).comparisons for i, level in enumerate(c.levels)]
    return spark.createDataFrame(rows, "comparison string, position int, algorithm string, threshold double")


@query("linkage_prepared", "SELECT n_nationkey AS id, n_nationkey AS unique_id, n_name AS port, 'N350' AS port_soundex FROM nation")
def linkage_prepared(spark, d):
    df = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("citation"))
    return linkage.prepare(df, "citation", "port", linkage.settings("port", _CONFIG).algorithms).select("id", "unique_id", "port", "port_soundex")


@query("unique_citations", "SELECT DISTINCT o_orderpriority AS citation FROM orders")
def unique_citations(spark, d):
    return linkage.unique_citations(table(spark, d, "orders").select(F.col("o_orderpriority").alias("citation")), "citation")


@query("linkage_u_pairs", "SELECT 'port' AS comparison, g AS level, round(count(*) / (SELECT count(*) FROM nation, region), 9) AS share FROM (SELECT CASE WHEN n_name = r_name THEN 3 WHEN s >= 0.5 THEN 2 WHEN s >= 0.25 THEN 1 ELSE 0 END AS g FROM (SELECT n_name, r_name, 1 - levenshtein(n_name, r_name) / greatest(length(n_name), length(r_name), 1) AS s FROM nation, region)) GROUP BY g")
def linkage_u_pairs(spark, d):
    left = table(spark, d, "nation").select(F.col("n_nationkey").alias("unique_id"), F.col("n_name").alias("port_l"))
    right = table(spark, d, "region").select(F.col("r_regionkey").alias("unique_id"), F.col("r_name").alias("port_r"))
    comparison = linkage.Comparison("port", "port_l", "port_r", (("levenshtein", 0.5), ("levenshtein", 0.25)))
    pairs = linkage.compare(linkage.sampled_pairs(left, right, 1e6).select("port_l", "port_r"), [comparison])
    return linkage.shares(pairs, comparison).withColumn("share", F.round("share", 9))


@query("identifiers", "SELECT * FROM (VALUES ('Àrea de Port', 'area_de_port'), (' x--Y ', 'x_y')) AS t(text, name)")
def identifiers(spark, d):
    return spark.createDataFrame([(t, sim.identifier(t)) for t in ("Àrea de Port", " x--Y ")], "text string, name string")


# --- lineage ------------------------------------------------------------------------------------------------------------


@query("lineage_change_types", "SELECT * FROM (VALUES (0, 'withColumn', 'add_columns,modify_columns', 'loud,n_name'), (1, 'drop', 'remove_columns,modify_columns', 'n_regionkey'), (2, 'filter', 'modify_columns', 'n_nationkey'), (3, 'join', 'new_dataframe,modify_columns', 'n_nationkey')) AS t(position, operation, changes, columns)")
def lineage_change_types(spark, d):
    lake, n = store(spark), table(spark, d, "nation")
    log = Log(lake)
    frame = Traced(n, "nation").withColumn("loud", F.upper("n_name")).drop("n_regionkey").filter("n_nationkey > 3")
    frame = frame.join(Traced(n.select("n_nationkey"), "other"), "n_nationkey")
    log.stored(frame, "nations", lake.write(frame.df, "nations"), "overwrite")
    log.flush()
    return log.read("field_lineage").select("position", "operation", F.array_join("changes", ",").alias("changes"), F.array_join("columns", ",").alias("columns"))


@query("lineage_names", "SELECT * FROM (VALUES ('DF(nation)', 'TR(nation)', 'DF(nation_2)')) AS t(plain, changed, versioned)")
def lineage_names(spark, d):
    frame = Traced(table(spark, d, "nation"), "nation")
    return spark.createDataFrame([(frame.name, frame.drop("n_name").name, Traced(frame.df, "nation", 2).name)], "plain string, changed string, versioned string")


@query("process_log", "SELECT * FROM (VALUES ('load.outer', 'OK', 0), ('load.outer.fails', 'ERROR', 1)) AS t(process, status, errors)")
def process_log(spark, d):
    log = Log(store(spark))

    @log.transformer
    def fails(df):
        raise ValueError("no")

    @log.transformer
    def outer(df):
        try:
            fails(df)
        except ValueError:
            return df

    with log.in_block("load"):
        outer(table(spark, d, "nation"))
    log.flush()
    errors = log.read("error").groupBy("process").agg(F.count("*").cast("int").alias("errors")).withColumnRenamed("process", "p")
    return log.read("process").join(errors, F.col("process") == F.col("p"), "left").select("process", "status", F.coalesce("errors", F.lit(0)).alias("errors"))


@query("duplicates_summary", "SELECT 'bp' AS publication, 2 AS duplicates, '1900-02-03' AS day, 'm' AS edition, 2 AS records, 'a,b' AS texts")
def duplicates_summary(spark, d):
    log = Log(store(spark))
    rows = spark.createDataFrame([("e2", "BP", 1900, 2, 3, "b"), ("e1", "BP", 1900, 2, 3, "a")], "entry_id string, publication_name string, publication_date_year int, publication_date_month int, publication_date_day int, parsed_text string")
    log.found_duplicates(rows, "BP", "1900-02-03", "M")
    log.flush()
    summary, records = log.read("duplicates", duplicates=True)
    found = records.filter(summary.first()["filter"]).agg(F.count("*").cast("int").alias("records"), F.array_join(F.sort_array(F.collect_list("parsed_text")), ",").alias("texts"))
    return summary.select("publication", F.col("duplicates").cast("int").alias("duplicates"), "day", "edition").crossJoin(found)


@query("storage_log_switch", "SELECT * FROM (VALUES ('kept', 0)) AS t(path, version)")
def storage_log_switch(spark, d):
    log = Log(store(spark))
    log.stored(None, "kept", 0, "overwrite")
    log.switch("storage", False)(lambda: log.stored(None, "hidden", 0, "overwrite"))()
    log.flush()
    return log.read("storage").select("path", F.col("version").cast("int").alias("version"))
