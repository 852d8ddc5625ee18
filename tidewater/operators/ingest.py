"""Ingestion: provenance of values, entry ids, date parts, duplicates against what is stored, missing days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Origins of a value, strongest first, and the method name for each.
PRECEDENCE = ("stacked_value", "calculated_value", "original_value", "default_value")


def chosen(detail: Column, has_stack: bool = False) -> Column:
    """The value that counts: the last stacked one, else calculated, original, default, else ''."""
    parts = [F.try_element_at(detail["stacked_value"], F.lit(-1))] if has_stack else []
    return F.coalesce(*parts, *[detail[p] for p in PRECEDENCE[1:]], F.lit(""))


def method(detail: Column, has_stack: bool = False) -> Column:
    """Which origin chosen() took."""
    value = F.when(F.try_element_at(detail["stacked_value"], F.lit(-1)).isNotNull(), PRECEDENCE[0]) if has_stack else None
    for name in PRECEDENCE[1:]:
        value = F.when(detail[name].isNotNull(), name) if value is None else value.when(detail[name].isNotNull(), name)
    return value.otherwise("unknown_obtaining_method")


def assign(detail: Column, value: Column) -> Column:
    """A structured value on top of the stack."""
    return detail.withField("stacked_value", F.array_append(F.coalesce(detail["stacked_value"], F.array().cast("array<string>")), value))


def publication_date(text: Column) -> Column:
    """yyyy-MM-dd; numbers are milliseconds since 1970 in UTC."""
    return F.when(text.rlike(r"^[-\d]\d*\.?\d*$"), F.date_format(F.timestamp_millis(text.try_cast("double").cast("long")), "yyyy-MM-dd")).otherwise(text)


def entry_id(publication: Column, number: Column) -> Column:
    return F.format_string("%s_%010d", publication, number)


def reformat(df: DataFrame, fields: list[str], publication: str = "publication_name", number: str = "seq") -> DataFrame:
    """Each field (a struct of origins) as its value, method and detail; entry_id and date in their form."""
    out = {}
    for f in fields:
        out |= {f: chosen(F.col(f)), f"{f}_extraction_source_method": method(F.col(f)), f"{f}_detailed_value": F.col(f)}
    df = df.withColumns({**out, "entry_id": entry_id(F.col(publication), F.col(number))})
    return df.withColumn("publication_date", publication_date(F.col("publication_date").cast("string"))) if "publication_date" in df.columns else df


def date_parts(df: DataFrame, column: str = "publication_date") -> DataFrame:
    day = F.to_date(column)
    return df.withColumns({f"{column}_year": F.year(day), f"{column}_month": F.month(day), f"{column}_day": F.dayofmonth(day)})


def number_rows(df: DataFrame, order: list[str], start: int = 0, column: str = "seq") -> DataFrame:
    """Consecutive numbers in order, from start on: range partitions count for themselves, their sizes are summed before."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id())
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_mono").alias("_first"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    # a row for each partition
    return ranged.join(F.broadcast(before.select("_part", "_first", "_before")), "_part").withColumn(column, F.col("_mono") - F.col("_first") + F.col("_before") + F.lit(start)).drop("_part", "_mono", "_first", "_before")


def reuse_ids(existing: DataFrame, new: DataFrame, text: str = "parsed_text", within: tuple[str, ...] = (), key: str = "entry_id") -> DataFrame:
    """existing and new as one set: a new row whose text is known keeps the known id and replaces the old row. One row for each text and group."""
    on = [*within, text]
    once = new.groupBy(*on).agg(F.min_by(F.struct(*[c for c in new.columns if c not in on]), key).alias("_r")).select(*on, "_r.*")
    ids = existing.groupBy(*on).agg(F.min(key).alias("_old"))
    kept = once.join(ids, on, "left").withColumn(key, F.coalesce("_old", key)).drop("_old")
    return existing.join(once.select(*on), on, "left_anti").unionByName(kept, allowMissingColumns=True)


def duplicates(existing: DataFrame, new: DataFrame, text: str = "parsed_text", within: tuple[str, ...] = (), key: str = "entry_id") -> DataFrame:
    """The stored rows that new ones replace, and the new rows that replace them."""
    on = [*within, text]
    old = existing.join(new.select(*on).distinct(), on, "left_semi").withColumn("duplicate_role", F.lit("superseded"))
    fresh = new.join(existing.select(*on).distinct(), on, "left_semi").withColumn("duplicate_role", F.lit("replacement"))
    return old.unionByName(fresh, allowMissingColumns=True)


def missing_dates(df: DataFrame, column: str = "publication_date", start=None, end=None, bounds: DataFrame | None = None) -> DataFrame:
    """Days between the first and the last (or the given ones, also as a row a, b of a frame) that no row has."""
    days = df.select(F.to_date(column).alias("day")).filter("day is not null").distinct()
    if bounds is None:
        bounds = days.agg(F.coalesce(F.lit(start).cast("date"), F.min("day")).alias("a"), F.coalesce(F.lit(end).cast("date"), F.max("day")).alias("b"))
    calendar = bounds.filter("a <= b").select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))
    return calendar.join(days, "day", "left_anti")


def missing_editions(wanted: DataFrame, df: DataFrame, on: list[str]) -> DataFrame:
    """The wanted (date, edition) rows that are not there."""
    return wanted.join(df.select(*on).distinct(), on, "left_anti")
