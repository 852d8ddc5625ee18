"""What the operators of this subpackage share: reading, shared tables, shipping of code."""

from __future__ import annotations

import os
import sys
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these six ASCII spaces (the same set as bytes.split()).
SPACES = r"[\x20\x09-\x0D]+"
#: Used where a local session names no shared folder, as in tests.
DEFAULT_SHARED = "/tmp/checkpoints/tidewater"


def ship() -> None:
    """Pickle this package's functions by value, so that workers need no copy of it on their path."""
    for name in [m for m in sys.modules if m == "tidewater" or m.startswith("tidewater.llm.")]:
        if "." in name:
            cloudpickle.register_pickle_by_value(sys.modules[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; on a cluster the session has to name it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    return named or DEFAULT_SHARED


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system of a folder, and the folder's path there."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")


def opened(path: str) -> pa.NativeFile:
    """A file of the shared folder, to read from."""
    files, place = filesystem(path)
    return files.open_input_file(place)


#: Drops a query's shuffle files as soon as it has ended.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: By thread: the tables that materialise() has written since scratch() began there.
WRITTEN: dict[int, list[str]] = {}


def materialise(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, survives lost executors, and frees the shuffle files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    WRITTEN.get(threading.get_ident(), []).append(path)
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete a table that materialise() wrote and no plan still needs."""
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, name)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Lists the tables that materialise() writes inside, in this thread, and deletes at its end those that are still listed."""
    me, tables = threading.get_ident(), []
    outer, WRITTEN[me] = WRITTEN.get(me), tables
    try:
        yield tables
    finally:
        WRITTEN.pop(me)
        if outer is not None:
            WRITTEN[me] = outer
        for folder in tables:
            delete(spark, folder)


def unused(df: DataFrame, name: str) -> str:
    """name, with underscores before it until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(df: DataFrame) -> DataFrame:
    """doc_id and text alone, a null text read as an empty one; other columns are dropped."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def code_points(column: Column) -> Column:
    return F.length(column).cast("long")
