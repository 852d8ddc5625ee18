"""The registered queries of the data-layer operators and the SQL that checks them.

The driver's tables stand in for records: an entry is an order, its cargo the order's lines by supplier, ports are nations.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions.strings import correct, flatten, tidy
from ..operators import extract, fill, idem, ingest, linkage, migrate, structure
from ..session import LakeConfig
from ..sources.store import TableStore, upsert

FLAGSHIP = "flagship_cargo_citations"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        _QUERIES[name] = function
        if sql:
            _SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- records -------------------------------------------------------------------------------------------------------

LINES = "SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_linenumber % 2 = 0 THEN 'id.' ELSE 'p' || l_partkey END AS commodity, l_linestatus AS unit FROM lineitem"


def cargo(spark: SparkSession, d: str) -> DataFrame:
    """l_orderkey and cargo_list: suppliers in order, each with its lines in order."""
    li = table(spark, d, "lineitem").withColumn("commodity", F.when(F.col("l_linenumber") % 2 == 0, "id.").otherwise(F.concat(F.lit("p"), F.col("l_partkey").cast("string"))))
    inner = li.groupBy("l_orderkey", "l_suppkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity", F.col("commodity").alias("cargo_commodity"), F.col("l_linestatus").alias("cargo_unit")))).alias("lines"))
    outer = inner.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_suppkey", "lines"))).alias("merchants"))
    lines = lambda m: F.transform(m["lines"], lambda x: F.struct(x["cargo_commodity"].alias("cargo_commodity"), x["cargo_unit"].alias("cargo_unit")))
    return outer.select("l_orderkey", F.transform("merchants", lambda m: F.struct(F.concat(F.lit("s"), m["l_suppkey"].cast("string")).alias("cargo_merchant_name"), lines(m).alias("cargo"))).alias("cargo_list"))


def entries(spark: SparkSession, d: str) -> DataFrame:
    """Orders as entries."""
    o = table(spark, d, "orders").join(cargo(spark, d), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    o = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    calls = F.when(F.col("n_name").isNotNull(), F.array(F.struct(F.col("n_name").alias("port_of_call_place")), F.struct(F.col("c_mktsegment").alias("port_of_call_place"))))
    return o.select(
        F.col("o_orderkey").cast("string").alias("entry_id"), F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("temp_key"), "o_orderkey", "o_orderpriority", "cargo_list", calls.alias("travel_port_of_call_list"),
        F.col("n_name").alias("travel_departure_port"), F.col("o_orderstatus").alias("travel_arrival_port"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("travel_departure_date"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("travel_arrival_date"),
        F.col("c_mktsegment").alias("ship_type"), F.col("n_name").alias("ship_flag"), F.col("o_totalprice").cast("string").alias("ship_tons_capacity"), F.col("o_orderpriority").alias("ship_tons_unit"), F.col("c_name").alias("ship_name"), F.col("o_orderstatus").alias("master_role"), F.col("c_name").alias("master_name"), F.col("c_mktsegment").alias("ship_agent_name"), F.col("n_name").alias("broker_name"),
    )


_ENTRIES = "(SELECT CAST(o_orderkey AS VARCHAR) entry_id, 't' || o_orderkey temp_key, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, o_orderdate, c_name, c_mktsegment, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"
_CARGO = f"(SELECT *, DENSE_RANK() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey) - 1 AS merchant_idx, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber, l_partkey, l_quantity) - 1 AS cargo_idx FROM ({LINES}) JOIN orders ON o_orderkey = l_orderkey)"


@query(FLAGSHIP, f"SELECT l_orderkey || '-cargo_list.cargo.cargo_commodity-' || merchant_idx || '-' || cargo_idx AS id, CAST(l_orderkey AS VARCHAR) AS entry_id, CAST(merchant_idx AS INTEGER) AS merchant_idx, CAST(cargo_idx AS INTEGER) AS cargo_idx, commodity AS citation FROM {_CARGO}")
def flagship(spark, d):
    schema = {"properties": {"cargo_list": CARGO_NODE}}
    df = structure.complete(entries(spark, d).select("entry_id", "temp_key", "cargo_list"), schema)
    return extract.mentions(structure.cast(df, schema), extract.NESTED["cargo_commodities"]).select("id", "entry_id", "merchant_idx", "cargo_idx", "citation")


CARGO_NODE = {"type": "array", "items": {"type": "object", "properties": {"cargo_merchant_name": {"type": "string"}, "cargo": {"type": "array", "items": {"type": "object", "properties": {"cargo_commodity": {"type": "string", "for_cleaning": ["accepted_idem"]}, "cargo_unit": {"type": "string"}}}}}}}

# --- structure and cleaning ----------------------------------------------------------------------------------------


@query("complete_structure", "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS alias, CAST(NULL AS VARCHAR) AS alias_extraction_source_method FROM customer")
def complete_structure(spark, d):
    schema = {"properties": {"c_name": {"type": "string"}, "alias": {"type": "string"}}}
    return structure.complete(table(spark, d, "customer").select("c_custkey", "c_name"), schema).select("c_custkey", "c_name", "alias", "alias_extraction_source_method")


@query("prune_fields", "SELECT c_custkey, c_name FROM customer")
def prune_fields(spark, d):
    return structure.prune(table(spark, d, "customer"), {"properties": {"c_name": {"type": "string"}}}, keep=("c_custkey",))


@query("normalize_try_cast", "SELECT event_id, COALESCE(json_extract_string(props, '$.k'), props) AS k, TRY_CAST(event_type AS BIGINT) AS type_number FROM events")
def normalize_try_cast(spark, d):
    node = {"type": "string", "normalize": {"type": "single", "options": [{"try_cast_to": {"type": "object", "properties": {"k": {"type": "string"}}}, "equivalence": {"type": "column", "value": "old_value.k"}}], "otherwise": {"equivalence": {"type": "column", "value": "old_value"}}}}
    return table(spark, d, "events").select("event_id", structure.normalize_one(F.col("props"), node).alias("k"), F.col("event_type").try_cast("long").alias("type_number"))


@query("normalize_foreach_item", "SELECT event_id, UNNEST([0, 1]) AS pos, UNNEST([json_extract_string(props, '$.k'), event_type]) AS item FROM events")
def normalize_foreach_item(spark, d):
    node = {"type": "array", "items": {"type": "object", "properties": {"k": {"type": "string"}}}, "normalize": {"type": "foreach_item", "options": [{"try_cast_to": {"type": "object", "properties": {"k": {"type": "string"}}}, "equivalence": {"new_value": {"k": {"type": "column", "value": "old_value.k"}}}}], "otherwise": {"equivalence": {"new_value": {"k": {"type": "column", "value": "old_value"}}}}}}
    df = table(spark, d, "events").select("event_id", F.concat(F.lit("["), "props", F.lit(',"'), "event_type", F.lit('"]')).alias("items"))
    return df.select("event_id", F.posexplode(structure.normalize_one(F.col("items"), node)).alias("pos", "x")).select("event_id", "pos", F.col("x.k").alias("item"))


_ORDERS_TEXT = "SELECT o_orderkey, o_orderstatus, o_orderpriority"


def _fill(spark, d, rule, node=None):
    df = table(spark, d, "orders").withColumn("note", F.when(F.col("o_orderstatus") == "P", F.lit("set")))
    return fill.fill(df, {"properties": {"note": (node or {"type": "string"}) | {"fill_with": rule}}})


@query("fill_replace", f"{_ORDERS_TEXT}, o_orderpriority AS note FROM orders")
def fill_replace(spark, d):
    return _fill(spark, d, {"type": "replace", "from": "o_orderpriority", "to": "note"}).select("o_orderkey", "o_orderstatus", "o_orderpriority", "note")


@query("fill_if_missing", f"{_ORDERS_TEXT}, CASE WHEN o_orderstatus = 'P' THEN 'set' ELSE o_orderpriority END AS note FROM orders")
def fill_if_missing(spark, d):
    return _fill(spark, d, [{"type": "replace_if_not_exist", "from": "o_orderpriority", "to": "note"}]).select("o_orderkey", "o_orderstatus", "o_orderpriority", "note")


@query("fill_condition", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND (o_totalprice > 100000 OR o_orderpriority = '1-URGENT') THEN 'flagged' WHEN o_orderstatus = 'P' THEN 'set' END AS note FROM orders")
def fill_condition(spark, d):
    when = {"and": [{"column": "o_orderstatus", "op": "==", "value": "O"}, {"or": [{"column": "o_totalprice", "op": ">", "value": 100000}, {"expr": "o_orderpriority = '1-URGENT'"}]}]}
    return _fill(spark, d, {"type": "replace", "from": "LIT('flagged')", "to": "note", "condition": when}).select("o_orderkey", "note")


@query("fill_array_item", "SELECT o_orderkey, UNNEST(['start', o_orderpriority]) AS item, UNNEST([0, 1]) AS pos FROM orders")
def fill_array_item(spark, d):
    df = table(spark, d, "orders").withColumn("marks", F.array(F.struct(F.lit("start").alias("m"))))
    node = {"type": "array", "items": {"type": "object", "properties": {"m": {"type": "string"}}}, "fill_with": {"type": "add_array_item", "from": ["o_orderpriority"], "to": ["m"]}}
    return fill.fill(df, {"properties": {"marks": node}}).select("o_orderkey", F.posexplode("marks").alias("pos", "x")).select("o_orderkey", F.col("x.m").alias("item"), "pos")


@query("fill_all_items", "SELECT o_orderkey, UNNEST(CASE WHEN o_orderstatus = 'P' THEN ['own'] ELSE [o_orderpriority, o_orderstatus] END) AS item FROM orders")
def fill_all_items(spark, d):
    df = table(spark, d, "orders").withColumn("marks", F.when(F.col("o_orderstatus") == "P", F.array(F.lit("own")))).withColumn("spare", F.array("o_orderpriority", "o_orderstatus"))
    node = {"type": "array", "items": {"type": "string"}, "fill_with": {"type": "add_all_items", "from": "spare"}}
    return fill.fill(df, {"properties": {"marks": node}}).select("o_orderkey", F.explode("marks").alias("item"))


@query("simplify_provenance", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE COALESCE(CASE WHEN o_orderstatus = 'P' THEN 'calc' END, o_orderpriority) END AS f_original_value FROM orders")
def simplify_provenance(spark, d):
    o = table(spark, d, "orders")
    calc = F.when(F.col("o_orderstatus") == "P", "calc")
    df = o.select("o_orderkey", F.lit("raw").alias("f"), F.when(F.col("o_orderstatus") == "F", "original_value").alias("f_extraction_source_method"), F.struct(F.lit("dflt").alias("default_value"), F.col("o_orderpriority").alias("original_value"), calc.alias("calculated_value"), F.lit(None).cast("string").alias("boat_fact_model")).alias("f_detailed_value"))
    return structure.simplify(df, {"properties": {"f": {"type": "string"}}}).select("o_orderkey", "f_original_value")


@query("ocr_corrections", "SELECT c_custkey, translate(regexp_replace(c_name, 'mer', 'nner', 'g'), '01#', 'Ol-') AS fixed FROM customer")
def ocr_corrections(spark, d):
    return table(spark, d, "customer").select("c_custkey", correct(F.col("c_name"), {"0": "O", "1": "l", "#": "-", "mer": "nner"}).alias("fixed"))


_TRIMMED = "trim(text, ' ')"


@query("clean_strings_tags", f"SELECT doc_id, sha256(regexp_replace({_TRIMMED}, '[.,;]+$', '')) AS plain, sha256(CASE WHEN length({_TRIMMED}) > 5 THEN regexp_replace({_TRIMMED}, '[.,;]+$', '') ELSE {_TRIMMED} END) AS abbreviated, sha256(text) AS untouched FROM documents")
def clean_strings_tags(spark, d):
    t = F.col("text")
    say = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return table(spark, d, "documents").select("doc_id", say(tidy(t, [], {})).alias("plain"), say(tidy(t, ["accepted_abbreviations"], {})).alias("abbreviated"), say(tidy(t, ["not_cleanable"], {})).alias("untouched"))


@query("clean_values", "SELECT c_custkey, regexp_replace(trim(c_name, ' '), '[.,; \t]+$', '') AS c_name, translate(CAST(c_acctbal AS VARCHAR), '.', ',') AS c_acctbal FROM customer")
def clean_values(spark, d):
    schema = {"properties": {"c_name": {"type": "string"}, "c_acctbal": {"type": "number"}}}
    df = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("string").alias("c_acctbal"))
    return structure.clean_values(df, schema, {"numeric_map": {".": ","}})


@query("calc_decrement_date", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN CAST(l_shipdate - to_hours(CAST(l_quantity AS BIGINT)) AS DATE) ELSE CAST(CAST(l_shipdate AS DATE) - CAST(floor(l_quantity) AS INTEGER) AS DATE) END AS departure FROM lineitem")
def calc_decrement_date(spark, d):
    schema = {"properties": {"departure": {"type": "string", "format": "date", "calculable_if_null": {"operation": "decrement_data", "parameters": {"origin_date": "l_shipdate", "decrement": "l_quantity", "decrement_unit": "unit"}}}}}
    df = table(spark, d, "lineitem").withColumn("unit", F.when(F.col("l_returnflag") == "A", " Hours").otherwise("d."))
    return structure.calculate(df, schema).select("l_orderkey", "l_linenumber", "l_partkey", "departure")


@query("calc_date_diff", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def calc_date_diff(spark, d):
    df = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    schema = {"properties": {"days": {"type": "integer", "calculable_if_null": {"operation": "data_difference", "params": {"final_date": "l_shipdate", "origin_date": "o_orderdate"}}}}}
    return structure.calculate(df, schema).select("l_orderkey", "l_linenumber", "l_partkey", "days")


@query("cast_by_schema", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, TRY_CAST(event_type AS DOUBLE) AS kind FROM events")
def cast_by_schema(spark, d):
    df = table(spark, d, "events").select("event_id", F.from_json("props", "k string").alias("p"), F.struct(F.col("event_type").alias("kind")).alias("q"))
    schema = {"properties": {"p": {"type": "object", "properties": {"k": {"type": "integer"}}}, "q": {"type": "object", "properties": {"kind": {"type": "number"}}}}}
    return structure.cast(df, schema).select("event_id", "p.k", "q.kind")


@query("flatten_strings", "SELECT doc_id, sha256(translate(lower(text), 'àáâãäåèéêëìíîïòóôõöùúûüýÿçñ', 'aaaaaaeeeeiiiiooooouuuuyycn')) AS flat FROM documents")
def flatten_strings(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(F.encode(flatten(F.col("text")), "UTF-8"), 256).alias("flat"))


# --- idem ------------------------------------------------------------------------------------------------------------

_IDEM_EVENTS = "SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 1 THEN 'Id. y id.' ELSE event_type END AS v FROM events"


@query("idem_root", f"SELECT event_id, CASE WHEN v = 'Id. y id.' THEN last_value(CASE WHEN v <> 'Id. y id.' THEN v END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE v END AS v FROM ({_IDEM_EVENTS})")
def idem_root(spark, d):
    df = table(spark, d, "events").withColumn("v", F.when(F.col("event_id") % 3 == 1, "Id. y id.").otherwise(F.col("event_type")))
    schema = {"properties": {"v": {"type": "string", "for_cleaning": ["accepted_idem"]}}, "order_and_partitions": {"order": ["ts", "event_id"], "partitions": ["user_id"]}}
    return idem.resolve_idems(df, schema).select("event_id", "v")


_FLAT = f"(SELECT c.*, o_orderkey % 7 AS part, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey, l_linenumber, l_partkey, l_quantity) AS pos, COUNT(*) OVER (PARTITION BY l_orderkey) AS n FROM {_CARGO} c)"
_SEEDS = f"(SELECT l_orderkey AS s_key, LAG(commodity) OVER (PARTITION BY part ORDER BY l_orderkey) AS seed FROM {_FLAT} WHERE pos = n)"
_RESOLVED = f"SELECT l_orderkey, merchant_idx, cargo_idx, pos, CASE WHEN commodity <> 'id.' THEN commodity ELSE COALESCE(last_value(CASE WHEN commodity <> 'id.' THEN commodity END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), seed, commodity) END AS commodity FROM {_FLAT} LEFT JOIN {_SEEDS} ON s_key = l_orderkey"


def _by_part(spark, d):
    return cargo(spark, d).join(table(spark, d, "orders").select("o_orderkey"), F.col("o_orderkey") == F.col("l_orderkey")).withColumn("part", F.col("l_orderkey") % 7)


@query("idem_array", f"SELECT l_orderkey, CAST(pos - 1 AS INTEGER) AS pos, commodity FROM ({_RESOLVED})")
def idem_array(spark, d):
    df = _by_part(spark, d).withColumn("items", F.flatten(F.transform("cargo_list", lambda m: m["cargo"])))
    window = W.partitionBy("part").orderBy("l_orderkey")
    df = df.select("l_orderkey", idem.resolve_array(F.col("items"), ["cargo_commodity"], ["cargo_commodity", "cargo_unit"], window).alias("items"))
    return df.select("l_orderkey", F.posexplode("items").alias("pos", "x")).select("l_orderkey", "pos", F.col("x.cargo_commodity").alias("commodity"))


@query("idem_nested", f"SELECT l_orderkey, CAST(merchant_idx AS INTEGER) AS merchant_idx, CAST(cargo_idx AS INTEGER) AS cargo_idx, commodity FROM ({_RESOLVED})")
def idem_nested(spark, d):
    schema = {"properties": {"cargo_list": CARGO_NODE}, "order_and_partitions": {"order": ["l_orderkey"], "partitions": ["part"]}}
    df = idem.resolve_idems(_by_part(spark, d), schema)
    rows = df.select("l_orderkey", F.posexplode("cargo_list").alias("merchant_idx", "m")).select("l_orderkey", "merchant_idx", F.posexplode("m.cargo").alias("cargo_idx", "x"))
    return rows.select("l_orderkey", "merchant_idx", "cargo_idx", F.col("x.cargo_commodity").alias("commodity"))


# --- extraction -------------------------------------------------------------------------------------------------------

_COLUMN = {"ship_types": "c_mktsegment", "ship_tons_units": "o_orderpriority", "ship_flags": "n_name", "master_roles": "o_orderstatus", "ship_agents": "c_mktsegment", "brokers": "n_name"}
for _name, _mention in extract.SINGLE.items():
    query(f"extract_{_name}", f"SELECT entry_id AS id, entry_id, temp_key, '{_mention.origin}' AS field_origin, {_COLUMN[_name]} AS citation FROM {_ENTRIES}")(lambda spark, d, m=_mention: extract.mentions(entries(spark, d), m))
_KEYS = "CAST(l_orderkey AS VARCHAR) AS entry_id, 't' || l_orderkey AS temp_key"
query("extract_cargo_merchants", f"SELECT DISTINCT l_orderkey || '-cargo_list.cargo_merchant_name-' || merchant_idx AS id, {_KEYS}, 'cargo_list.cargo_merchant_name' AS field_origin, CAST(merchant_idx AS INTEGER) AS merchant_idx, 's' || l_suppkey AS citation FROM {_CARGO}")(lambda spark, d: extract.mentions(entries(spark, d), extract.NESTED["cargo_merchants"]))
for _name, _value, _origin in (("cargo_commodities", "commodity", "cargo_list.cargo.cargo_commodity"), ("cargo_units", "unit", "cargo_list.cargo.cargo_unit")):
    query(f"extract_{_name}", f"SELECT l_orderkey || '-{_origin}-' || merchant_idx || '-' || cargo_idx AS id, {_KEYS}, '{_origin}' AS field_origin, CAST(merchant_idx AS INTEGER) AS merchant_idx, CAST(cargo_idx AS INTEGER) AS cargo_idx, {_value} AS citation FROM {_CARGO}")(lambda spark, d, n=_name: extract.mentions(entries(spark, d), extract.NESTED[n]))
query("extract_commodities_and_units", f"SELECT l_orderkey || '-cargo_list.cargo-' || merchant_idx || '-' || cargo_idx AS id, {_KEYS}, 'cargo_list.cargo' AS field_origin, CAST(merchant_idx AS INTEGER) AS merchant_idx, CAST(cargo_idx AS INTEGER) AS cargo_idx, commodity AS cargo_commodity_citation, unit AS cargo_unit_citation, commodity || '-' || unit AS citation FROM {_CARGO}")(lambda spark, d: extract.commodities_and_units(entries(spark, d)))
query("extract_ports", f"""SELECT entry_id || '-travel_departure_port-0' AS id, entry_id, temp_key, 'travel_departure_port' AS field_origin, 0 AS port_idx, n_name AS citation FROM {_ENTRIES}
UNION ALL SELECT entry_id || '-travel_port_of_call_list-' || i, entry_id, temp_key, 'travel_port_of_call_list', i, CASE WHEN i = 0 THEN n_name ELSE c_mktsegment END FROM {_ENTRIES}, (SELECT UNNEST([0, 1]) AS i) WHERE n_name IS NOT NULL
UNION ALL SELECT entry_id || '-travel_arrival_port-0', entry_id, temp_key, 'travel_arrival_port', 0, o_orderstatus FROM {_ENTRIES}""")(lambda spark, d: extract.ports(entries(spark, d)))


def part_voices(spark, d):
    p = table(spark, d, "part")
    return p.select(F.concat(F.lit("e"), F.col("p_partkey").cast("string")).alias("name"), F.lower("p_name").alias("normalized_name"), F.array("p_name", "p_type").alias("voices"))


@query("known_voices", "SELECT 'e' || p_partkey || '-' || v AS id, 'e' || p_partkey AS name, lower(p_name) AS normalized_name, i AS voice_idx, 'voices' AS field_origin, v AS voice FROM (SELECT *, UNNEST([p_name, p_type]) AS v, UNNEST([0, 1]) AS i FROM part)")
def known_voices(spark, d):
    return extract.voices(part_voices(spark, d))


# --- ingestion and storage ----------------------------------------------------------------------------------------------


@query("date_parts", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year, CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month, CAST(day(o_orderdate) AS INTEGER) AS o_orderdate_day FROM orders")
def date_parts(spark, d):
    return ingest.date_parts(table(spark, d, "orders"), "o_orderdate").select("o_orderkey", "o_orderdate_year", "o_orderdate_month", "o_orderdate_day")


@query("provenance_reformat", "SELECT o_orderpriority || '_' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS entry_id, strftime(o_orderdate, '%Y-%m-%d') AS publication_date, CASE WHEN o_orderstatus = 'P' THEN 'calc' ELSE o_orderstatus END AS f, CASE WHEN o_orderstatus = 'P' THEN 'calculated_value' ELSE 'original_value' END AS f_extraction_source_method FROM orders")
def provenance_reformat(spark, d):
    detail = F.struct(F.lit("dflt").alias("default_value"), F.col("o_orderstatus").alias("original_value"), F.when(F.col("o_orderstatus") == "P", "calc").alias("calculated_value"))
    millis = (F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) * 1000).cast("string")
    df = table(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("publication_name"), millis.alias("publication_date"), detail.alias("f"))
    return ingest.reformat(df, ["f"]).select("entry_id", "publication_date", "f", "f_extraction_source_method")


@query("dedup_reuse_id", """WITH old AS (SELECT text, min(doc_id) AS id FROM documents WHERE doc_id % 2 = 0 GROUP BY text), new AS (SELECT text, min(doc_id) AS id FROM documents WHERE doc_id % 2 = 1 GROUP BY text)
SELECT doc_id AS entry_id, sha256(text) AS said FROM documents WHERE doc_id % 2 = 0 AND text NOT IN (SELECT text FROM new) UNION ALL SELECT COALESCE(old.id, new.id), sha256(new.text) FROM new LEFT JOIN old ON old.text = new.text""")
def dedup_reuse_id(spark, d):
    df = table(spark, d, "documents").select(F.col("doc_id").alias("entry_id"), F.col("text").alias("parsed_text"))
    both = ingest.reuse_ids(df.filter("entry_id % 2 = 0"), df.filter("entry_id % 2 = 1"))
    return both.select("entry_id", F.sha2(F.encode("parsed_text", "UTF-8"), 256).alias("said"))


@query("duplicates_log", "SELECT doc_id AS entry_id, CASE WHEN doc_id % 2 = 0 THEN 'superseded' ELSE 'replacement' END AS duplicate_role FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(DISTINCT doc_id % 2) = 2)")
def duplicates_log(spark, d):
    df = table(spark, d, "documents").select(F.col("doc_id").alias("entry_id"), F.col("text").alias("parsed_text"))
    return ingest.duplicates(df.filter("entry_id % 2 = 0"), df.filter("entry_id % 2 = 1")).select("entry_id", "duplicate_role")


@query("missing_dates", "SELECT CAST(day AS DATE) AS day FROM (SELECT UNNEST(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS day FROM lineitem) WHERE CAST(day AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 1)")
def missing_dates(spark, d):
    li = table(spark, d, "lineitem")
    ends = li.agg(F.min(F.to_date("l_shipdate")).alias("a"), F.max(F.to_date("l_shipdate")).alias("b"))
    return ingest.missing_dates(li.filter("l_returnflag = 'A' and l_linenumber = 1"), "l_shipdate", bounds=ends)


@query("number_rows", "SELECT o_orderkey, 100 + row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS seq FROM orders")
def number_rows(spark, d):
    return ingest.number_rows(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 100).select("o_orderkey", "seq")


def store(spark) -> TableStore:
    """A store of a new lake in the shared folder; only a local session may leave that unnamed."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    base = base or "/tmp/checkpoints/tidewater"
    protocol, _, path = base.rpartition("://") if "://" in base else ("file", "", base)
    return TableStore(spark, LakeConfig(protocol=f"{protocol}://", base_path=path.removeprefix("file:"), project=f"q-{uuid.uuid4().hex}"))


@query("merge_upsert", "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer UNION ALL SELECT c_custkey + 10000000, c_name, 0.0 FROM customer WHERE c_custkey % 3 = 0")
def merge_upsert(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    fresh = c.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.lit(0.0))
    lake = store(spark)
    lake.write(c, "customers")
    lake.write(fresh.unionByName(fresh.withColumn("c_custkey", F.col("c_custkey") + 10000000)), "customers", mode="merge", key="c_custkey")
    return lake.read("customers")


@query("table_versions", "SELECT n_nationkey, n_name FROM nation")
def table_versions(spark, d):
    lake, n = store(spark), table(spark, d, "nation").select("n_nationkey", "n_name")
    lake.write(n, "nations")
    lake.write(n, "nations", mode="append")
    lake.restore("nations", version=0)
    return lake.read("nations")


@query("state_incremental", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def state_incremental(spark, d):
    lake, o = store(spark), table(spark, d, "orders")
    lake.update_state(o.filter("o_orderstatus = 'F'"), "orders", key="o_orderkey", done=True)
    return lake.pending(o.select("o_orderkey"), "orders", key="o_orderkey")


@query("upsert_plain", "SELECT s_suppkey, CASE WHEN s_nationkey < 10 THEN 'moved' ELSE s_name END AS s_name FROM supplier")
def upsert_plain(spark, d):
    s = table(spark, d, "supplier")
    return upsert(s.select("s_suppkey", "s_name"), s.filter("s_nationkey < 10").select("s_suppkey", F.lit("moved").alias("s_name")), "s_suppkey")


@query("registry_sql", "SELECT n_regionkey, count(*) AS nations FROM nation GROUP BY n_regionkey")
def registry_sql(spark, d):
    name = f"nations_{uuid.uuid4().hex}"
    table(spark, d, "nation").createOrReplaceTempView(name)
    return spark.sql(f"SELECT n_regionkey, count(*) AS nations FROM {name} GROUP BY n_regionkey")


@query("range_frame", "SELECT range AS id FROM range(5, 1005, 5)")
def range_frame(spark, d):
    return spark.range(5, 1005, 5)


@query("patch_entry_id", "SELECT o_orderkey, 'pub_' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS entry_id FROM orders")
def patch_entry_id(spark, d):
    return migrate.pad_ids(table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("pub_"), F.col("o_orderkey").cast("string")).alias("entry_id")))


@query("patch_dup_ids", "SELECT o_orderkey, CASE WHEN count(*) OVER (PARTITION BY o_custkey) > 1 THEN o_custkey || '_' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) ELSE CAST(o_custkey AS VARCHAR) END AS entry_id FROM orders")
def patch_dup_ids(spark, d):
    return migrate.split_ids(table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.col("o_custkey").cast("string").alias("entry_id")), order=("o_orderdate", "o_orderkey")).select("o_orderkey", "entry_id")


# --- similarity and linkage ---------------------------------------------------------------------------------------------

_PAIRS = "(SELECT n_name, r_name FROM nation, region)"


def pairs(spark, d):
    return linkage.pair(table(spark, d, "nation").select("n_name"), table(spark, d, "region").select("r_name"))


@query("sim_levenshtein", "SELECT p_partkey, round(1 - levenshtein(p_name, p_type) / greatest(length(p_name), length(p_type), 1), 9) AS s FROM part")
def sim_levenshtein(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(sim.levenshtein_ratio(F.col("p_name"), F.col("p_type")), 9).alias("s"))


@query("sim_jaro_winkler", "SELECT c_custkey, round(jaro_winkler_similarity(c_name, n_name), 6) AS s FROM customer JOIN nation ON c_nationkey = n_nationkey")
def sim_jaro_winkler(spark, d):
    df = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return df.select("c_custkey", F.round(sim.jaro_winkler("c_name", "n_name"), 6).alias("s"))


_GRAMS = "list_distinct(list_transform(range(1, length({0}) + 3), lambda i: substring('  ' || {0} || '  ', CAST(i AS INTEGER), 3)))"


@query("sim_ngram_jaccard", f"SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 9) AS s FROM (SELECT p_partkey, {_GRAMS.format('p_name')} AS a, {_GRAMS.format('lower(p_type)')} AS b FROM part)")
def sim_ngram_jaccard(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(sim.ngram_jaccard(F.col("p_name"), F.lower("p_type")), 9).alias("s"))


@query("sim_double_metaphone")
def sim_double_metaphone(spark, d):
    names = table(spark, d, "part").withColumn("a", sim.double_metaphone("p_name"))
    df = names.withColumn("b", sim.double_metaphone("p_type"))
    return df.select("p_partkey", F.col("a.primary").alias("primary_code"), F.col("a.secondary").alias("secondary_code"), sim.double_metaphone_similarity(F.col("a"), F.col("b")).alias("s"))


@query("sim_cosine", "SELECT a.vec_id, round(CAST(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS DOUBLE), 6) AS s FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def sim_cosine(spark, d):
    e = table(spark, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("b_id"), F.col("embedding").alias("b"))
    return e.join(b, F.col("vec_id") == F.col("b_id")).select("vec_id", F.round(sim.cosine(F.col("embedding"), F.col("b")), 6).alias("s"))


@query("distinct_enrich", "SELECT p_partkey, upper(p_name) AS loud FROM part")
def distinct_enrich(spark, d):
    return sim.enrich_distinct(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", {"loud": F.upper("p_name")}).select("p_partkey", "loud")


@query("embed_hashing")
def embed_hashing(spark, d):
    return table(spark, d, "part").select("p_partkey", sim.embedder(sim.hashing_encoder())("p_name").alias("v"))


def _reviewed(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("temp_key"), F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("#"), "o_orderpriority")).when(F.col("o_orderstatus") == "O", F.concat(F.lit("part "), (F.col("o_orderkey") % 50).cast("string"))).alias("rev_name"))


_REVIEWED = "(SELECT 't' || o_orderkey AS temp_key, 'part ' || (o_orderkey % 50) AS rev_name FROM orders WHERE o_orderstatus = 'O')"


@query("training_citations", f"SELECT entry_id AS id, temp_key, rev_name FROM {_ENTRIES} JOIN {_REVIEWED} USING (temp_key)")
def training_citations(spark, d):
    cited = extract.mentions(entries(spark, d), extract.SINGLE["ship_flags"]).select("id", "temp_key")
    return linkage.training_citations(cited, _reviewed(spark, d), "rev_name").select("id", "temp_key", "rev_name")


@query("training_pairs", f"SELECT 'citations' AS source_dataset_l, entry_id AS unique_id_l, 'voices' AS source_dataset_r, 'v' || p_partkey AS unique_id_r, 1.0::DOUBLE AS clerical_match_score FROM {_ENTRIES} JOIN {_REVIEWED} USING (temp_key) JOIN part ON rev_name = 'part ' || p_partkey")
def training_pairs(spark, d):
    cited = extract.mentions(entries(spark, d), extract.SINGLE["ship_flags"])
    voices = table(spark, d, "part").select(F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("id"), F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("normalized_name"))
    return linkage.training_pairs(_reviewed(spark, d), cited, voices, "rev_name")


COMPARISON = linkage.Comparison("name", "p_name", "type", (("levenshtein", 0.5), ("levenshtein", 0.25)))
_GAMMA = "CASE WHEN p_name = lower(p_type) THEN 3 WHEN 1 - levenshtein(p_name, lower(p_type)) / greatest(length(p_name), length(p_type), 1) >= 0.5 THEN 2 WHEN 1 - levenshtein(p_name, lower(p_type)) / greatest(length(p_name), length(p_type), 1) >= 0.25 THEN 1 ELSE 0 END"


def _compared(spark, d):
    return linkage.compare(table(spark, d, "part").withColumn("type", F.lower("p_type")), [COMPARISON])


@query("comparison_vector", f"SELECT p_partkey, {_GAMMA} AS gamma_name FROM part")
def comparison_vector(spark, d):
    return _compared(spark, d).select("p_partkey", "gamma_name")


@query("linkage_u_exact", f"SELECT 'name' AS comparison, g AS level, round(count(*) / (SELECT count(*) FROM part), 9) AS share FROM (SELECT {_GAMMA} AS g FROM part) GROUP BY g")
def linkage_u_exact(spark, d):
    return linkage.shares(_compared(spark, d), COMPARISON).withColumn("share", F.round("share", 9))


@query("linkage_m", f"SELECT 'name' AS comparison, g AS level, round(count(*) / (SELECT count(*) FROM part WHERE p_size > 25), 9) AS share FROM (SELECT {_GAMMA} AS g FROM part WHERE p_size > 25) GROUP BY g")
def linkage_m(spark, d):
    return linkage.shares(_compared(spark, d).filter("p_size > 25"), COMPARISON).withColumn("share", F.round("share", 9))


@query("linkage_em")
def linkage_em(spark, d):
    second = linkage.Comparison("size", "p_brand", "p_type")
    df = linkage.compare(_compared(spark, d), [second])
    both = [COMPARISON, second]
    u = linkage.estimate(df, both)
    m = {c.name: [(i + 1) / sum(range(1, c.size + 1)) for i in range(c.size)] for c in both}
    model, _ = linkage.maximise(df, linkage.Model(both, m, u, 0.05))
    return linkage.score(df, model).select("p_partkey", F.round("match_weight", 6).alias("match_weight"), F.round("match_probability", 6).alias("match_probability"))


@query("cartesian_pairs", f"SELECT n_name, r_name FROM {_PAIRS}")
def cartesian_pairs(spark, d):
    return pairs(spark, d)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


from . import layered  # noqa: E402, F401  registers its queries here
