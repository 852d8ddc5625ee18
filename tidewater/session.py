"""Configuration of a lake and its Spark session."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import SparkSession

#: Stages of refinement, in order; a level of -1 stands outside them.
LEVELS = ("ingest", "bronze", "silver", "gold")


@dataclass(frozen=True)
class LakeConfig:
    """Where a lake lives and how its session is built; every with_ method gives a changed copy."""

    protocol: str = "file://"
    base_path: str = "/tmp/tidewater-lake"
    project: str = "default"
    level: int = 0
    app_name: str = "tidewater"
    master: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_json(cls, path: str = "config/cfg.json") -> LakeConfig:
        """The configuration in a JSON file, the default one where there is no file. Names of fields set these; all other names, and
        those of the objects listed under "configs", are options of the session."""
        if not os.path.exists(path):
            return cls()
        with open(path) as file:
            found = json.load(file)
        listed = {k: v for part in found.pop("configs", []) for k, v in part.items()}
        own = {f.name for f in fields(cls)} - {"options"}
        options = listed | {k: v for k, v in found.items() if k not in own}
        return cls(**{k: v for k, v in found.items() if k in own}, options={k: str(v) for k, v in options.items()})

    def with_project(self, name: str) -> LakeConfig:
        return replace(self, project=name)

    def with_level(self, level: int | str) -> LakeConfig:
        return replace(self, level=LEVELS.index(level) if isinstance(level, str) else level)

    def with_option(self, key: str, value: object) -> LakeConfig:
        return replace(self, options={**self.options, key: str(value)})

    def path(self, *parts: str, level: int | None = None, has_extension: bool = False) -> str:
        """A dotted name, or several parts, below the project and level; an absolute URI stays as it is."""
        if len(parts) == 1 and re.match(r"\w+://", parts[0]):
            return parts[0]
        level = self.level if level is None else level
        names, suffix = [], ""
        for i, part in enumerate(parts):
            if has_extension and i == len(parts) - 1:
                part, _, end = part.rpartition(".")
                suffix = f".{end}"
            names += [n for n in re.split(r"[./]", part) if n]
        stage = LEVELS[level] if 0 <= level < len(LEVELS) else ""
        return f"{self.protocol}{'/'.join(p for p in (self.base_path.rstrip('/'), self.project, stage, *names) if p)}{suffix}"

    def metadata_path(self, name: str) -> str:
        return self.path("metadata", name, level=-1)


def build_session(config: LakeConfig | None = None) -> SparkSession:
    """A session with UTC times and adaptive plans."""
    config = config or LakeConfig()
    builder = SparkSession.builder.appName(config.app_name)
    if config.master:
        builder = builder.master(config.master)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.sources.partitionOverwriteMode": "dynamic"}
    return builder.config(map=defaults | config.options).getOrCreate()


class Registry:
    """Layer classes by name."""

    def __init__(self):
        self._known: dict[str, type] = {}

    def register(self, kind: type) -> type:
        self._known[kind.__name__] = kind
        return kind

    def build(self, name: str, *args, **kwargs):
        if name not in self._known:
            raise ValueError(f"unknown layer {name!r}; known: {sorted(self._known)}")
        return self._known[name](*args, **kwargs)


REGISTRY = Registry()
