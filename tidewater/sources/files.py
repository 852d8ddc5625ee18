"""Readers of raw files: JSON, YAML, XML and CSV by extension, then by content."""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_any(spark: SparkSession, path: str, row_tag: str = "row") -> DataFrame:
    """Records of a file or folder by its extension; CSV headers become lower case."""
    end = path.rsplit(".", 1)[-1].lower()
    if end in ("json", "jsonl"):
        return spark.read.option("multiLine", end == "json").json(path)
    if end == "xml":
        return spark.read.option("rowTag", row_tag).xml(path)
    if end == "csv":
        df = spark.read.option("header", True).option("multiLine", True).csv(path)
        return df.toDF(*[c.lower() for c in df.columns])
    if end in ("yaml", "yml"):
        return _records(spark, path, _yaml)
    return _records(spark, path, _sniff)


def _yaml(text: str) -> list:
    import yaml

    value = yaml.safe_load(text)
    return value if isinstance(value, list) else [value]


def _element(node):
    """An XML element as a value: its text, or its children by name (lists where a name repeats)."""
    found: dict = dict(node.attrib)
    for child in node:
        value = _element(child)
        if child.tag in found:
            found[child.tag] = [*(found[child.tag] if isinstance(found[child.tag], list) else [found[child.tag]]), value]
        else:
            found[child.tag] = value
    return found or (node.text or "").strip()


def _sniff(text: str) -> list:
    """Records of a text of unknown form: JSON, XML (the root's children), CSV with a header, else YAML."""
    try:
        value = json.loads(text)
        return value if isinstance(value, list) else [value]
    except ValueError:
        pass
    import csv
    import io

    if text.lstrip().startswith("<"):
        from xml.etree import ElementTree

        return [_element(child) for child in ElementTree.fromstring(text)]
    first = text.lstrip().split("\n", 1)[0]
    if "," in first and ":" not in first:
        return [{k.lower(): v for k, v in row.items()} for row in csv.DictReader(io.StringIO(text))]
    return _yaml(text)


def _records(spark: SparkSession, path: str, parse) -> DataFrame:
    """A JSON line for each record, file by file on the executors, then read by Spark."""
    files = spark.read.text(path, wholetext=True)

    def work(batches):
        import pandas as pd

        for frame in batches:
            yield pd.DataFrame({"line": [json.dumps(r, default=str) for text in frame["value"] for r in parse(text)]}, dtype=object)

    lines = files.mapInPandas(work, "line string")
    return spark.read.json(lines.rdd.map(lambda r: r[0]))


def known_entities(df: DataFrame, column: str = "entities") -> DataFrame:
    """name and voices from a map column {name: [voices]}."""
    return df.select(F.inline(F.map_entries(column)).alias("name", "voices")).select("name", "voices")


def raw_entries(spark: SparkSession, path: str, user: str | None = None, **parts) -> DataFrame:
    """Entries below a Hive layout publication_name=/year=/month=/day=/edition=; filters prune folders."""
    df = spark.read.json(path)
    for name, value in parts.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df if user is None else df.filter(F.col("uploaded_by") == user)
