"""Streams into versioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def upsert_stream(stream: DataFrame, store, *parts: str, key: str, order: str, checkpoint: str):
    """Merges each micro-batch by key into a table of the store, the row of greatest order for each key."""

    def merge(batch: DataFrame, _: int) -> None:
        last = batch.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))).filter("_rank = 1").drop("_rank")
        store.write(last, *parts, mode="merge", key=key)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
