"""Cleaning of text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and what they are flattened to.
FLATTEN_FROM = "àáâãäåèéêëìíîïòóôõöùúûüýÿçñ"
FLATTEN_TO = "aaaaaaeeeeiiiiooooouuuuyycn"


def flatten(text: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(text), FLATTEN_FROM, FLATTEN_TO)


def correct(text: Column, corrections: dict[str, str]) -> Column:
    """Replace misread characters: keys of several characters are patterns and go first, single ones are translated together last.

    NULL and the text "null" pass through. A single character with a replacement of another length is replaced as a pattern, so that it does not shift the others.
    """
    single = {k: v for k, v in corrections.items() if len(k) == 1 and len(v) == 1}
    fixed = text
    for key, value in corrections.items():
        if key not in single:
            fixed = F.regexp_replace(fixed, re.escape(key) if len(key) == 1 else key, value)
    if single:
        fixed = F.translate(fixed, "".join(single), "".join(single.values()))
    return F.when(text.isNull() | (text == "null"), text).otherwise(fixed)


def tidy(text: Column, tags: list, maps: dict[str, dict[str, str]]) -> Column:
    """Trim, strip closing marks and correct a text as its for_cleaning tags say. maps: not_paragraph, one_word, only_text."""
    names = {t for t in tags if isinstance(t, str)}
    rules = {t["algorithm"]: t.get("params") for t in tags if isinstance(t, dict)}
    spared = rules.get("avoid_changes_for_keys") or []
    maps = {n: {k: v for k, v in m.items() if k not in spared} for n, m in maps.items()}
    value = text
    if not names & {"paragraph", "not_cleanable"}:
        trimmed = F.trim(text)
        stripped = F.regexp_replace(trimmed, r"[.,;]+$", "")
        value = F.when(F.length(trimmed) > 5, stripped).otherwise(trimmed) if names & {"accepted_abbreviations", "accepted_idem"} else stripped
    if not names & {"not_cleanable", "paragraph", "one_word"}:
        value = correct(value, maps.get("not_paragraph", {}))
    if "one_word" in names:
        value = correct(value, maps.get("one_word", {}))
    if "not_digits" in names:
        value = correct(value, maps.get("only_text", {}))
    untouched = rules.get("not_cleanable_if_value_is")
    if untouched is not None:
        value = F.when(text.isin(untouched if isinstance(untouched, list) else [untouched]), text).otherwise(value)
    return value
