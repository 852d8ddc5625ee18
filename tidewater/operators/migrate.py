"""Versioned changes of stored data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ingest import date_parts


class MigrationError(RuntimeError):
    """A step failed."""


class VersionError(MigrationError):
    """The new version could not be recorded."""


def pad_ids(df: DataFrame, key: str = "entry_id", within: tuple[str, ...] = (), shortest: int = 13) -> DataFrame:
    """prefix_number with the number in ten digits, for all rows of a group that holds a shorter id; rows with a null in `within` stay as they are."""
    parts = F.split(F.col(key), "_")
    padded = F.concat(F.get(parts, F.lit(0)), F.lit("_"), F.lpad(F.get(parts, F.lit(1)), 10, "0"))
    if not within:
        return df.withColumn(key, F.when(F.length(key) < shortest, padded).otherwise(F.col(key)))
    short = df.groupBy(*within).agg(F.max((F.length(key) < shortest).cast("int")).alias("_short"))
    return df.join(short, list(within), "left").withColumn(key, F.when(F.col("_short") == 1, padded).otherwise(F.col(key))).drop("_short")


def pad_dated(df: DataFrame, key: str = "entry_id", date: str = "publication_date", within: tuple[str, ...] = ("publication_name", "publication_edition")) -> DataFrame:
    """The date's parts anew, then padded ids, by group of `within` and day."""
    return pad_ids(date_parts(df, date), key, (*within, *(f"{date}_{part}" for part in ("year", "month", "day"))))


def split_ids(df: DataFrame, key: str = "entry_id", order: tuple[str, ...] = ("publication_date",)) -> DataFrame:
    """Every row of a repeated id gets the suffix _1, _2, ... in order."""
    own = W.partitionBy(key)
    numbered = df.withColumns({"_n": F.count("*").over(own), "_k": F.row_number().over(own.orderBy(*[F.asc_nulls_first(o) for o in order]))})
    return numbered.withColumn(key, F.when(F.col("_n") > 1, F.concat(F.col(key), F.lit("_"), F.col("_k").cast("string"))).otherwise(F.col(key))).drop("_n", "_k")


class Migrations:
    """Steps v0 -> v1 -> ...; the version is kept in the store."""

    def __init__(self, store, name: str = "data_versions"):
        self.store, self.name, self.steps = store, name, []

    def step(self, change: Callable) -> Callable:
        self.steps.append(change)
        return change

    def version(self) -> str:
        df = self.store.read(self.name, level=-1)
        return "v0" if df is None else df.first()["version"]

    def set_version(self, version: str) -> None:
        try:
            self.store.write(self.store.spark.createDataFrame([(version,)], "version string"), self.name, level=-1)
        except Exception as error:
            raise VersionError(version) from error

    def run(self) -> str:
        for i in range(int(self.version()[1:]), len(self.steps)):
            try:
                self.steps[i](self.store)
            except Exception as error:
                raise MigrationError(f"v{i} to v{i + 1}") from error
            self.set_version(f"v{i + 1}")
        return self.version()
