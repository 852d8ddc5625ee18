"""The queries op1_ to op10_, one for each operator of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, fingerprints, packing, quality, recompression, records, simhash, suffix, toxicity

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_fingerprints": fingerprints.query,
    "op3_simhash": simhash.query,
    "op4_suffix_dedup": suffix.query,
    "op5_quality": quality.query,
    "op6_bpe": bpe.query,
    "op7_substring_dedup": recompression.query,
    "op8_records": records.query,
    "op9_packing": packing.query,
    "op10_chat": chat.query,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """None: each of these needs a hash, a trained model, a tokenizer or an ordering that DuckDB lacks; tests/llm compares them with brute force."""
    return {}
