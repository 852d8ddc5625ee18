"""Lineage: what was done to a frame, and a log of processes, tables, fields and errors."""

from __future__ import annotations

import functools
import re
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, GroupedData, Observation, SparkSession
from pyspark.sql import functions as F

# Operations that count as modifying columns.
CHANGING = {
    "select", "selectExpr", "drop", "withColumn", "withColumns", "withColumnRenamed", "withColumnsRenamed", "filter", "where", "orderBy", "sort", "join", "dropDuplicates",
    "distinct", "limit", "repartition", "coalesce", "sample", "union", "unionByName", "dropna", "fillna", "replace", "withWatermark", "hint", "na",
}


@dataclass
class Step:
    operation: str
    arguments: list[str]
    parents: list[str]
    added: list[str]
    removed: list[str]
    kept: list[str]

    columns: list[str] = field(default_factory=list)

    @property
    def changes(self) -> list[str]:
        """All kinds of change that the step made."""
        return [name for name, holds in (("new_dataframe", len(self.parents) > 1), ("add_columns", self.added), ("remove_columns", self.removed), ("modify_columns", self.operation in CHANGING)) if holds]


def _say(argument) -> str:
    return str(argument._jc) if isinstance(argument, Column) and hasattr(argument, "_jc") else argument.name if isinstance(argument, Traced) else repr(argument)


def referenced(argument, known: list[str]) -> list[str]:
    """Those of the known columns that an argument (a Column, a name or expression, a list, the keys of a dict) refers to."""
    if isinstance(argument, (list, tuple)):
        return list(dict.fromkeys(c for a in argument for c in referenced(a, known)))
    if isinstance(argument, dict):
        return list(dict.fromkeys([k for k in argument if k in known] + [c for v in argument.values() if isinstance(v, Column) for c in referenced(v, known)]))
    if isinstance(argument, Column):
        argument = _say(argument)
    elif not isinstance(argument, str):
        return []
    names = re.findall(r"[A-Za-z_]\w*", re.sub(r"'[^']*'", "", argument))
    return [c for c in dict.fromkeys(names) if c in known]


class Traced:
    """A DataFrame that records its steps; any DataFrame method works and gives a traced frame again."""

    def __init__(self, df: DataFrame, name: str = "frame", version: int | None = None, steps: list[Step] | None = None):
        self.df, self.base, self.version, self.steps = df, name, version, list(steps or [])

    @property
    def name(self) -> str:
        own = self.base if self.version is None else f"{self.base}_{self.version}"
        return own if "(" in own else f"{'TR' if self.steps else 'DF'}({own})"

    def __getitem__(self, item):
        return self._wrap(self.df[item], "__getitem__", (item,)) if not isinstance(item, str) else self.df[item]

    def _wrap(self, result, operation: str, args: tuple):
        if isinstance(result, GroupedData):
            return _TracedGroups(result, self, args)
        if not isinstance(result, DataFrame):
            return result
        others = [a for a in args if isinstance(a, Traced)]
        before, after = self.df.columns, result.columns
        step = Step(operation, [_say(a) for a in args], [self.name, *[o.name for o in others]], [c for c in after if c not in before], [c for c in before if c not in after], [c for c in after if c in before], referenced(args, list(dict.fromkeys([*before, *after]))))
        if others:
            return Traced(result, f"NEW_FROM({', '.join(step.parents)})", None, [*self.steps, *[s for o in others for s in o.steps], step])
        return Traced(result, self.base, self.version, [*self.steps, step])

    def __getattr__(self, name: str):
        target = getattr(self.df, name)
        if not callable(target):
            return target

        @functools.wraps(target)
        def call(*args, **kwargs):
            plain = [a.df if isinstance(a, Traced) else a for a in args]
            named = {k: v.df if isinstance(v, Traced) else v for k, v in kwargs.items()}
            return self._wrap(target(*plain, **named), name, (*args, *kwargs.values()))

        return call


class _TracedGroups:
    def __init__(self, groups: GroupedData, parent: Traced, keys: tuple):
        self._groups, self._parent, self._keys = groups, parent, keys

    def __getattr__(self, name: str):
        target = getattr(self._groups, name)
        return lambda *a, **k: self._parent._wrap(target(*a, **k), f"groupBy.{name}", (*self._keys, *a))


@dataclass
class Log:
    """Buffers of log rows, flushed once as appended versions of store tables."""

    store: object
    rows: dict[str, list[dict]] = field(default_factory=lambda: {"process": [], "storage": [], "field_lineage": [], "error": [], "duplicates": []})
    block: str = ""
    enabled: dict[str, bool] = field(default_factory=lambda: {"storage": True, "field_lineage": True})
    _stack: list[str] = field(default_factory=list)

    SCHEMAS = {
        "process": "log_id string, process string, started double, duration double, status string, num_records long",
        "storage": "log_id string, timestamp double, path string, version long, mode string, new boolean",
        "field_lineage": "log_id string, path string, position int, operation string, changes array<string>, columns array<string>, arguments array<string>, parents array<string>, added array<string>, removed array<string>",
        "error": "log_id string, timestamp double, process string, message string",
        "duplicates": "log_id string, timestamp double, publication string, ids array<string>, filter string, day string, edition string, duplicates long",
    }

    PARTITIONS = {"process": ["process"], "storage": ["path"], "field_lineage": ["log_id"], "duplicates": ["publication"]}

    def transformer(self, function):
        """A step of a process: timed, its rows counted while the frame that it gives is computed, errors logged."""

        @functools.wraps(function)
        def run(*args, **kwargs):
            name = ".".join(x for x in (self.block, *self._stack, function.__name__) if x)
            self._stack.append(function.__name__)
            row = {"log_id": uuid.uuid4().hex, "process": name, "started": time.time(), "status": "OK", "num_records": None}
            try:
                result = function(*args, **kwargs)
                if isinstance(result, (DataFrame, Traced)):
                    seen = Observation()
                    row["observation"] = seen
                    watched = (result.df if isinstance(result, Traced) else result).observe(seen, F.count(F.lit(1)).alias("n"))
                    result = Traced(watched, result.base, result.version, result.steps) if isinstance(result, Traced) else watched
                return result
            except Exception as error:
                row["status"] = "ERROR"
                self.rows["error"].append({"log_id": row["log_id"], "timestamp": time.time(), "process": name, "message": str(error)[:2000]})
                raise
            finally:
                self._stack.pop()
                row["duration"] = time.time() - row["started"]
                self.rows["process"].append(row)

        return run

    @contextmanager
    def in_block(self, name: str):
        before, self.block = self.block, name
        try:
            yield self
        finally:
            self.block = before

    @contextmanager
    def switched(self, kind: str, on: bool):
        """Storage or field lineage logging on or off for a while."""
        before, self.enabled[kind] = self.enabled[kind], on
        try:
            yield self
        finally:
            self.enabled[kind] = before

    def stored(self, frame, path: str, version: int, mode: str) -> str:
        """One storage row, and a lineage row for each step of a traced frame."""
        log_id = uuid.uuid4().hex
        if self.enabled["storage"]:
            self.rows["storage"].append({"log_id": log_id, "timestamp": time.time(), "path": path, "version": version, "mode": mode, "new": version == 0})
        if self.enabled["field_lineage"] and isinstance(frame, Traced):
            self.rows["field_lineage"] += [{"log_id": log_id, "path": path, "position": i, "operation": s.operation, "changes": s.changes, "columns": s.columns, "arguments": s.arguments, "parents": s.parents, "added": s.added, "removed": s.removed} for i, s in enumerate(frame.steps)]
        return log_id

    def found_duplicates(self, records: DataFrame, publication: str, day: str, edition: str) -> str:
        """Appends the duplicate records, partitioned as entries are, and a summary row with their ids and the filter that finds them."""
        log_id = uuid.uuid4().hex
        year, month, number = (int(x) for x in day.split("-"))
        said = f"lower(publication_name)='{publication.lower()}' AND publication_date_year={year} AND publication_date_month={month} AND publication_date_day={number}"
        parts = [c for c in ("publication_name", "publication_date_year", "publication_date_month", "publication_date_day", "publication_edition") if c in records.columns]
        self.store.write(records, "metadata", "duplicates_records", mode="append", partition_by=parts, level=-1)
        ids = [r[0] for r in records.select(F.col("entry_id").cast("string")).collect()]  # of one edition of one day
        self.rows["duplicates"].append({"log_id": log_id, "timestamp": time.time(), "publication": publication.lower(), "ids": ids, "filter": said, "day": day, "edition": edition.lower(), "duplicates": len(ids)})
        return log_id

    def failed(self, process: str, message: str) -> None:
        """A row for an error outside a transformer."""
        self.rows["error"].append({"log_id": uuid.uuid4().hex, "timestamp": time.time(), "process": process, "message": message[:2000]})

    def switch(self, kind: str, on: bool):
        """A decorator: the function, or every public method of the class, runs with that kind of logging on or off."""

        def around(target):
            if isinstance(target, type):
                for name, member in list(vars(target).items()):
                    if callable(member) and not name.startswith("_"):
                        setattr(target, name, around(member))
                return target

            @functools.wraps(target)
            def run(*args, **kwargs):
                with self.switched(kind, on):
                    return target(*args, **kwargs)

            return run

        return around

    def flush(self) -> None:
        for kind, rows in self.rows.items():
            for row in rows:
                seen = row.pop("observation", None)
                if seen is not None and getattr(seen, "_jo", None) is not None and seen._jo.future().isCompleted():
                    row["num_records"] = seen.get["n"]
            if rows:
                names = [c.strip().split()[0] for c in self.SCHEMAS[kind].split(", ")]
                spark: SparkSession = self.store.spark
                self.store.write(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], self.SCHEMAS[kind]), "metadata", kind, mode="append", partition_by=self.PARTITIONS.get(kind), level=-1)
                rows.clear()

    def read(self, kind: str, duplicates: bool = False):
        """A log in order; with duplicates, that log and the records that it counts, ordered by their text."""
        if duplicates:
            records = self.store.read("metadata", "duplicates_records", level=-1)
            return self.read("duplicates"), records if records is None or "parsed_text" not in records.columns else records.orderBy("parsed_text")
        df = self.store.read("metadata", kind, level=-1)
        order = {"process": "started", "field_lineage": "position"}.get(kind, "timestamp")
        return None if df is None else df.orderBy(order)
