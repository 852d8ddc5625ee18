"""Tables as immutable versions of parquet files.

A table is a folder: data/v=N holds what version N wrote, log/N.json says that N exists, what wrote it and which parts it shows, each with its
schema. A writer stages its data, then creates the next log entry exclusively, so of two writers one fails. An entry that is
not yet whole is no version, so no reader sees half a table. Parts may differ in columns and in partitioning; after PARTS appends they
are written as one.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import LakeConfig


#: Parts of a table after which an append writes them as one.
PARTS = 32


class ConflictError(RuntimeError):
    """Another writer took the version."""


class TableStore:
    def __init__(self, spark: SparkSession, config: LakeConfig):
        self.spark, self.config = spark, config

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def folders(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []

    def rename(self, source: str, target: str) -> bool:
        fs, p = self._fs(source)
        return fs.rename(p, self._fs(target)[1])

    def copy_from_local(self, source: str, target: str, delete: bool = False) -> None:
        fs, p = self._fs(target)
        fs.copyFromLocalFile(delete, self.spark._jvm.org.apache.hadoop.fs.Path(f"file://{source}"), p)

    def _root(self, parts: tuple[str, ...], level: int | None) -> str:
        return self.config.path(*parts, level=level)

    def _logged(self, root: str) -> list[tuple[int, object]]:
        """Numbers and paths of the log's files, ascending."""
        fs, p = self._fs(f"{root}/log")
        if not fs.exists(p):
            return []
        found = [(s.getPath().getName(), s.getPath()) for s in fs.listStatus(p)]
        return sorted(((int(n[:-5]), path) for n, path in found if n.endswith(".json")), key=lambda x: x[0])

    def _entry(self, path) -> dict | None:
        stream = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        except ValueError:  # its writer has not ended
            return None
        finally:
            stream.close()

    def _entries(self, root: str) -> list[dict]:
        return [e for _, path in self._logged(root) if (e := self._entry(path))]

    def _last(self, root: str) -> tuple[dict | None, int]:
        """The latest version's entry, and the number that the next one takes."""
        logged = self._logged(root)
        entry = next((e for _, path in reversed(logged) if (e := self._entry(path))), None)
        return entry, logged[-1][0] + 1 if logged else 0

    def is_table(self, *parts: str, level: int | None = None) -> bool:
        return self._last(self._root(parts, level))[0] is not None

    def history(self, *parts: str, level: int | None = None) -> list[dict]:
        """Log entries, latest first."""
        return self._entries(self._root(parts, level))[::-1]

    def history_frame(self, *parts: str, level: int | None = None) -> DataFrame:
        rows = [(e["version"], e["time"], e["operation"], "|".join(p["path"] for p in e["parts"])) for e in self.history(*parts, level=level)]
        return self.spark.createDataFrame(rows, "version long, time double, operation string, data string")

    def detail(self, *parts: str, level: int | None = None) -> dict | None:
        """What describes the latest version: path, version, number of parts, partition columns and columns; None if there is no table."""
        root = self._root(parts, level)
        entry, _ = self._last(root)
        if entry is None:
            return None
        kinds = [T.StructType.fromJson(json.loads(p["schema"])) for p in entry["parts"]]
        return {"path": root, "version": entry["version"], "parts": len(kinds), "partition_by": sorted({c for p in entry["parts"] for c in p["partition_by"]}), "columns": list(dict.fromkeys(c for k in kinds for c in k.names))}

    def _commit(self, root: str, version: int, operation: str, parts: list[dict], **more) -> None:
        fs, p = self._fs(f"{root}/log/{version:010d}.json")
        try:
            stream = fs.create(p, False)
        except Exception as error:
            raise ConflictError(f"version {version} of {root} exists") from error
        stream.write(bytearray(json.dumps({"version": version, "time": time.time(), "operation": operation, "parts": parts, **more}).encode()))
        stream.close()

    def _shown(self, entry: dict) -> DataFrame:
        frames = [self.spark.read.schema(T.StructType.fromJson(json.loads(p["schema"]))).parquet(p["path"]) for p in entry["parts"]]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def read(self, *parts: str, version: int | None = None, level: int | None = None) -> DataFrame | None:
        """The latest or the given version; None if there is no such table."""
        root = self._root(parts, level)
        if version is None:
            entry = self._last(root)[0]
        else:
            entry = next((e for n, path in self._logged(root) if n == version and (e := self._entry(path))), None)
        return self._shown(entry) if entry else None

    def write(self, df: DataFrame, *parts: str, mode: str = "overwrite", key: str | list[str] = "entry_id", partition_by: list[str] | None = None, level: int | None = None) -> int | None:
        """Writes a new version and returns its number. Modes: overwrite, append, merge (upsert by key; NULL keys are equal), error, ignore."""
        if mode not in ("overwrite", "append", "merge", "error", "ignore"):
            raise ValueError(f"unknown mode {mode!r}")
        root = self._root(parts, level)
        entry, version = self._last(root)
        if entry and mode in ("error", "ignore"):
            if mode == "error":
                raise FileExistsError(root)
            return None
        before = entry["parts"] if entry and mode == "append" else []
        if entry and mode in ("append", "merge"):
            partition_by = partition_by or entry["parts"][-1]["partition_by"]
        if entry and mode == "merge":
            df = upsert(self._shown(entry), df, key)
        elif len(before) >= PARTS:
            df, before = self._shown(entry).unionByName(df, allowMissingColumns=True), []
        data = f"{root}/data/v={version}-{uuid.uuid4().hex}"
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(data)
        self._commit(root, version, mode, [*before, {"path": data, "schema": df.schema.json(), "partition_by": list(partition_by or [])}])
        return version

    def restore(self, *parts: str, version: int, level: int | None = None) -> int:
        """A new version that shows an earlier one's data."""
        root = self._root(parts, level)
        old = next(e for e in self._entries(root) if e["version"] == version)
        after = self._last(root)[1]
        self._commit(root, after, f"restore {version}", old["parts"])
        return after

    def sequence(self, *name: str, increment: int = 1, tries: int = 20) -> int:
        """The sequence's value before the increment; the first is 0."""
        root = self.config.path("sequencer", *name, level=-1)
        for _ in range(tries):
            entry, version = self._last(root)
            now = entry["value"] if entry else 0
            try:
                self._commit(root, version, "increment", [], value=now + increment)
                return now
            except ConflictError:
                continue
        raise ConflictError(root)

    def update_state(self, df: DataFrame, *parts: str, key: str, done: bool) -> None:
        """Marks the keys of df as cleaned or not."""
        rows = df.select(key).distinct().withColumn("is_cleaned", F.lit(done))
        self.write(rows, "states", *parts, mode="merge", key=key, level=-1)

    def pending(self, df: DataFrame, *parts: str, key: str, all_of_it: bool = False) -> DataFrame:
        """The rows of df whose key is not marked as cleaned."""
        state = None if all_of_it else self.read("states", *parts, level=-1)
        return df if state is None else df.join(state.filter("is_cleaned").select(key), key, "left_anti")


def upsert(current: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    """current without the keys of new, and new. NULL keys are equal; keys that new repeats are an error."""
    keys = [key] if isinstance(key, str) else key
    again = new.groupBy(*keys).count().filter("count > 1").limit(1).take(1)
    if again:
        raise ValueError(f"key {again[0].asDict()} is repeated")
    named = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return current.join(named, same, "left_anti").unionByName(new, allowMissingColumns=True)
