"""The corpus pipeline: reject toxic and poor documents, drop near duplicates, cut repeated passages, pack into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is stored and read again as the next one's docs. All but the last
return the columns of documents. Null texts and ids, empty tables and repeated rows are treated as the operators' own
docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import packing, quality, simhash, suffix, toxicity
from tidewater.llm.common import delete, materialise, scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and have enough content lines."""
    return quality.reject(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of least doc_id, or the first stored where ids are missing or repeated."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of long strings that start earlier in the corpus; n_chars is that of what is left."""
    return suffix.cut_table(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in a packed sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack),
]

#: Hashes, trained models and a tokenizer have no form in SQL; tests/llm compares the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir. What a stage wrote goes when its result is stored, and that when the next one's is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        with scratch(spark) as tables:
            docs = materialise(stage(spark, docs, sf_dir))
            stored = tables.pop()
        if before:
            delete(spark, before)
        before = stored
    return STAGES[-1][1](spark, docs, sf_dir)
