"""Layers of a lake: named reads and writes over the table store, ingestion, cleaning and linkage at their levels."""

from __future__ import annotations

import datetime
import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lineage import Log, Traced
from .operators import cleaning, ingest, linkage
from .operators.extract import ports, voices
from .session import LEVELS, REGISTRY, LakeConfig, build_session
from .sources.files import known_entities, read_any
from .sources.store import TableStore

ENTRIES, CARGO_ENTRIES, REVIEWED, ENTITIES, ORIGINALS = "ship_entries", "cargo_ship_entries", "reviewed_entries", "known_entities", "original_data"


def file_name(extension: str) -> str:
    """A name that no other file has: date, time and a random part."""
    return f"{datetime.datetime.now(datetime.timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4().hex}.{extension}"


class Layer:
    """Frames, tables and files of one level."""

    LEVEL = 0

    def __init__(self, config: LakeConfig | None = None, spark: SparkSession | None = None):
        self.config = (config or LakeConfig()).with_level(self.LEVEL)
        self.spark = spark
        self.process_info: dict = {}
        if spark is not None:
            self.start(spark)

    def start(self, spark: SparkSession | None = None) -> Layer:
        self.spark = spark or build_session(self.config)
        self.store = TableStore(self.spark, self.config)
        self.log = Log(self.store)
        return self

    def is_started(self) -> bool:
        return self.spark is not None and self.spark._jsc is not None and not self.spark._jsc.sc().isStopped()

    def stop(self) -> None:
        if self.is_started():
            self.spark.stop()
        self.spark = None

    # frames

    def frame(self, data, schema=None, name: str | None = None, sampling_ratio: float | None = None, verify: bool = True) -> Traced:
        """A traced frame of local data."""
        return Traced(self.spark.createDataFrame(data, schema, sampling_ratio, verify), name or f"created_by_{self.log.block or 'session'}")

    def range(self, start: int, end: int | None = None, step: int = 1, partitions: int | None = None, name: str = "range") -> Traced:
        return Traced(self.spark.range(start, end, step, partitions), name)

    def sql(self, text: str, name: str = "sql") -> Traced:
        return Traced(self.spark.sql(text), name)

    @staticmethod
    def register_view(frame: DataFrame | Traced, name: str | None = None) -> str:
        """A temporary view under the given name, else under a traced frame's own name and version."""
        if not name:
            if not isinstance(frame, Traced):
                raise ValueError("a plain frame needs a name")
            name = frame.base if frame.version is None else f"{frame.base}_{frame.version}"
        (frame.df if isinstance(frame, Traced) else frame).createOrReplaceTempView(name)
        return name

    def register_function(self, name: str, function, kind: T.DataType | str) -> Column:
        """The function as a column function of any number of columns, an attribute of this layer under its name."""
        wrapped = F.udf(function, kind, useArrow=True)
        setattr(self, name, wrapped)
        return wrapped

    # files

    def read_json(self, *parts: str, level: int | None = None) -> DataFrame | None:
        """Records of a path; None if there is none."""
        try:
            return self.spark.read.json(self.config.path(*parts, level=level))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def write_json(self, df: DataFrame | Traced, *parts: str, mode: str = "overwrite", level: int | None = None) -> str:
        path = self.config.path(*parts, level=level)
        new = not self.store.exists(path)
        (df.df if isinstance(df, Traced) else df).write.mode(mode).json(path)
        self.log.stored(df, path, 0 if new else -1, mode)
        return path

    def is_json(self, *parts: str, level: int | None = None) -> bool:
        """Whether a JSON write to this path has ended."""
        return self.store.exists(f"{self.config.path(*parts, level=level)}/_SUCCESS")

    # tables

    def _raw(self, *parts: str, key: str, all_of_it: bool) -> DataFrame | None:
        """A table of the first level without the keys that are marked as cleaned; None if there is none."""
        df = self.store.read(*parts, level=0)
        return df if df is None else self.store.pending(df, *parts, key=key, all_of_it=all_of_it)

    def _save(self, df: DataFrame, *parts: str, key: str, done: bool = False, partition_by: list[str] | None = None) -> DataFrame:
        self.store.write(df.sortWithinPartitions(*partition_by) if partition_by else df, *parts, mode="merge", key=key, partition_by=partition_by)
        if done:
            self.store.update_state(df, *parts, key=key, done=True)
        return df


def container(first: str, *parts, second: str | None = None) -> tuple[str, ...]:
    """A path below `first` (and `second`), whether or not it names them, as parts or as one list."""
    names = list(parts[0]) if parts and isinstance(parts[0], (list, tuple)) else list(parts)
    if not names or not names[0].startswith(first):
        names.insert(0, first)
    if second and (len(names) < 2 or not names[1].startswith(second)):
        names.insert(1, second)
    return tuple(names)


@REGISTRY.register
class Ingestion(Layer):
    """Files to tables of the first level."""

    LEVEL = LEVELS.index("ingest")

    def copy(self, *parts: str, local_path: str, user: str | None = None, remove: bool = True) -> str:
        """Copies a local file below ingested_files under a name of its own."""
        if not os.path.exists(local_path):
            raise FileNotFoundError(local_path)
        folders = ("ingested_files", *parts, *([user] if user else []))
        target = f"{self.config.path(*folders)}/{file_name(os.path.splitext(local_path)[1][1:])}"
        self.store.copy_from_local(os.path.abspath(local_path), target, remove)
        self.log.stored(None, target, 0, "overwrite")
        return target

    def ingest(self, *parts: str, local_path: str, user: str, fields: list[str]) -> DataFrame:
        """Copies a file of records, gives them ids, dates and an uploader, and merges them without duplicates."""
        rows = read_any(self.spark, self.copy(*parts, local_path=local_path, user=user))
        start = self.store.sequence(*parts, "entries", increment=rows.count())
        rows = ingest.number_rows(rows, ["parsed_text"], start)
        rows = ingest.date_parts(ingest.reformat(rows, fields).withColumn("uploaded_by", F.lit(user))).drop("seq")
        before = self.store.read(*parts)
        within = tuple(c for c in ("publication_name", "publication_date", "publication_edition") if c in rows.columns)
        merged = ingest.reuse_ids(before, rows, within=within) if before is not None else ingest.reuse_ids(rows.limit(0), rows, within=within)
        self.store.write(merged, *parts)
        return self.store.read(*parts)

    def save_reviewed(self, df: DataFrame, is_cargo: bool = False) -> DataFrame:
        rows = cleaning.reviewed_cargo(df) if is_cargo else cleaning.reviewed_ships(df)
        self.store.write(rows, *container(REVIEWED, second=CARGO_ENTRIES if is_cargo else ENTRIES))
        return rows

    def read_reviewed(self, is_cargo: bool = False) -> DataFrame | None:
        return self.store.read(*container(REVIEWED, second=CARGO_ENTRIES if is_cargo else ENTRIES))

    def save_entities(self, entity: str, data: dict | str) -> DataFrame:
        """Names with their voices from {name: [voices]}, {"names": ...}, or the same as JSON text."""
        data = json.loads(data) if isinstance(data, str) else data
        data = data.get("names", data)
        df = self.spark.createDataFrame([(data,)], "entities map<string, array<string>>")
        self.store.write(known_entities(df), *container(ENTITIES, entity))
        return self.read_entities(entity)

    def read_entities(self, entity: str) -> DataFrame | None:
        return self.store.read(*container(ENTITIES, entity))


@REGISTRY.register
class Cleaning(Layer):
    """Raw entries to cleaned ones."""

    LEVEL = LEVELS.index("bronze")

    def __init__(self, config: LakeConfig | None = None, spark: SparkSession | None = None, schema: dict | None = None, mapping: dict | None = None):
        super().__init__(config, spark)
        self.schema, self.mapping = schema or {"properties": {}}, mapping or {}

    def clean_entries(self, df: DataFrame) -> DataFrame:
        return cleaning.clean_entries(df, self.schema, self.mapping)

    def clean_entities(self, entity: str, df: DataFrame) -> DataFrame:
        return self.save_entities(entity, df, done=True)

    def read_raw_entries(self, *parts: str, all_of_it: bool = False) -> DataFrame | None:
        return self._raw(*(parts or (ENTRIES,)), key="entry_id", all_of_it=all_of_it)

    def read_raw_entities(self, entity: str, all_of_it: bool = False) -> DataFrame | None:
        return self._raw(ENTITIES, entity, key="name", all_of_it=all_of_it)

    def read_raw_reviewed(self, is_cargo: bool = False, all_of_it: bool = False) -> DataFrame | None:
        """Reviewed rows that are not cleaned yet; cargo rows go by temp_key, merchant and commodity, in `id`."""
        parts = (REVIEWED, CARGO_ENTRIES if is_cargo else ENTRIES)
        df = self.store.read(*parts, level=0)
        if df is None:
            return None
        return self.store.pending(self.cargo_ids(df) if is_cargo else df, *parts, key="id" if is_cargo else "temp_key", all_of_it=all_of_it)

    @staticmethod
    def cargo_ids(df: DataFrame) -> DataFrame:
        return df.withColumn("id", F.concat(F.col("temp_key"), F.lit("_"), F.col("cargo_merchant_id").cast("string"), F.lit("_"), F.col("cargo_commodity_id").cast("string")))

    def read_originals(self, *parts: str, all_of_it: bool = False) -> DataFrame | None:
        """Original values of entries that are not marked as cleaned."""
        parts = parts or (ENTRIES,)
        df = self.store.read(ORIGINALS, *parts)
        return df if df is None else self.store.pending(df, *parts, key="entry_id", all_of_it=all_of_it)

    def save_originals(self, df: DataFrame, *parts: str, partition_by: list[str] | None = None) -> DataFrame:
        return self._save(df, ORIGINALS, *(parts or (ENTRIES,)), key="entry_id", partition_by=partition_by)

    def save_entries(self, df: DataFrame, *parts: str, key: str = "entry_id", done: bool = False, partition_by: list[str] | None = None) -> DataFrame:
        return self._save(df, *(parts or (ENTRIES,)), key=key, done=done, partition_by=partition_by)

    def save_entities(self, entity: str, df: DataFrame, key: str = "name", done: bool = False) -> DataFrame:
        return self._save(df, ENTITIES, entity, key=key, done=done)

    def save_reviewed(self, df: DataFrame, is_cargo: bool = False, done: bool = False) -> DataFrame:
        """Merges reviewed rows by temp_key, cargo rows by id."""
        rows = self.cargo_ids(df) if is_cargo else df
        return self._save(rows, REVIEWED, CARGO_ENTRIES if is_cargo else ENTRIES, key="id" if is_cargo else "temp_key", done=done)

    def read_entries(self, *parts: str) -> DataFrame | None:
        return self.store.read(*(parts or (ENTRIES,)))

    def read_entities(self, entity: str) -> DataFrame | None:
        return self.store.read(ENTITIES, entity)

    def read_reviewed(self, is_cargo: bool = False) -> DataFrame | None:
        return self.store.read(REVIEWED, CARGO_ENTRIES if is_cargo else ENTRIES)

    def voices(self, entity: str | None = None, df: DataFrame | None = None) -> DataFrame:
        df = self.read_entities(entity) if entity is not None else df
        if df is None:
            raise ValueError("no known entities")
        return voices(df)


@REGISTRY.register
class Linkage(Layer):
    """Training of record linkage over what the level below has cleaned."""

    LEVEL = LEVELS.index("silver")

    def read_cleaned(self, *parts: str) -> DataFrame | None:
        return self.store.read(*(parts or (ENTRIES,)), level=self.LEVEL - 1)

    def read_sample(self) -> DataFrame | None:
        return self.store.read(REVIEWED, ENTRIES, level=self.LEVEL - 1)

    def voices(self, entity: str | None = None, df: DataFrame | None = None) -> DataFrame:
        df = self.store.read(ENTITIES, entity, level=self.LEVEL - 1) if entity is not None else df
        if df is None:
            raise ValueError("no known entities")
        return voices(df)

    def train_ports(self, settings: dict, max_pairs: float = 1e6, field: str = "travel_departure_port") -> linkage.Model:
        """The model that links departure ports as cited to the voices of known ports."""
        sample, label = self.read_sample(), f"rev_{field}"
        cited = linkage.training_citations(ports(self.read_cleaned(), calls=False, arrival=False), sample.select("temp_key", label), label).drop(label)
        return linkage.train(cited, self.voices("port"), sample, label, linkage.settings("port", settings), max_pairs)
