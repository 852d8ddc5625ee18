"""Probabilistic record linkage after Fellegi and Sunter: comparison levels, m and u, expectation maximisation, scores."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import algorithm, enrich_distinct

#: No level is ever impossible.
FLOOR = 1e-6


@dataclass(frozen=True)
class Comparison:
    """Two columns, and (algorithm, threshold, parameters) of each level below equality, best first."""

    name: str
    left: str
    right: str
    levels: tuple[tuple, ...] = ()

    @property
    def size(self) -> int:
        return len(self.levels) + 2

    def gamma(self) -> Column:
        """-1 for a NULL, the highest number for equality, then the levels in order (the first that holds), else 0."""
        a, b = F.col(self.left), F.col(self.right)
        value = F.when(a.isNull() | b.isNull(), -1).when(a == b, self.size - 1)
        for i, (name, threshold, *more) in enumerate(self.levels):
            value = value.when(algorithm(name)(a, b, threshold, **(more[0] if more else {})), self.size - 2 - i)
        return value.otherwise(0)


@dataclass
class Model:
    comparisons: list[Comparison]
    m: dict[str, list[float]] = field(default_factory=dict)
    u: dict[str, list[float]] = field(default_factory=dict)
    match_share: float = 0.01

    def to_json(self) -> str:
        return json.dumps({"lambda": self.match_share, "comparisons": [{"comparison": c.name, "levels": [{"level": i, "label": "else" if i == 0 else "exact" if i == c.size - 1 else str(c.levels[c.size - 2 - i][0]), "m": self.m[c.name][i], "u": self.u[c.name][i]} for i in range(c.size)]} for c in self.comparisons]})


#: The column that an algorithm compares, made from a text; the others compare the text itself.
DERIVED = {"soundex": ("_soundex", lambda c: F.soundex(c))}


def algorithms(output: str, entity: dict, general: dict) -> list[dict]:
    """What an entity's settings say of each of its algorithms: column, name, thresholds and parameters."""
    found = []
    for key in entity.get("algorithms", []):
        spec = general[key]
        suffix = DERIVED.get(spec["algorithm"], ("", None))[0]
        algorithm(spec["algorithm"])  # an unknown one is an error
        found.append({"column": output + suffix, "algorithm": spec["algorithm"], "thresholds": list(spec["thresholds"]), "params": spec.get("params", {})})
    return found


def grouped(found: list[dict]) -> list[Comparison]:
    """A comparison for each column: algorithms that share it add their levels in the order given."""
    levels: dict[str, list[tuple]] = {}
    for a in found:
        name = "levenshtein" if a["column"].endswith("_soundex") else a["algorithm"]
        levels.setdefault(a["column"], []).extend((name, t, a["params"]) for t in a["thresholds"])
    return [Comparison(c, f"{c}_l", f"{c}_r", tuple(v)) for c, v in levels.items()]


@dataclass
class Settings:
    """How two tables are linked: only between them, all pairs or those that agree on the blocking columns."""

    output: str
    field_l: str
    field_r: str
    algorithms: list[dict]
    comparisons: list[Comparison]
    blocking: list[tuple[str, str]] = field(default_factory=list)


def settings(output: str, config: dict) -> Settings:
    """From {general_config_algorithms: {key: {algorithm, thresholds, params}}, entity_categories: {output: {field_l, field_r, algorithms}}}."""
    entity = config["entity_categories"][output]
    found = algorithms(output, entity, config.get("general_config_algorithms", {}))
    return Settings(output, entity["field_l"], entity["field_r"], found, grouped(found), [tuple(b) for b in entity.get("blocking", [])])


def prepare(df: DataFrame, column: str, output: str, found: list[dict] = ()) -> DataFrame:
    """df with unique_id, its column under the output's name, and the columns that algorithms derive, worked out once for each
    distinct text. Unchanged if it holds comparing_data_type, the mark of prepared tables."""
    if "comparing_data_type" in df.columns:
        return df
    if "unique_id" not in df.columns:
        df = df.withColumn("unique_id", F.col("id"))
    if column in df.columns and column != output:
        df = df.withColumn(output, F.col(column)).drop(column)
    for name in dict.fromkeys(a["algorithm"] for a in found):
        if name in DERIVED and output + DERIVED[name][0] not in df.columns:
            suffix, make = DERIVED[name]
            df = enrich_distinct(df, output, {output + suffix: make(F.col(output))})
    return df


def unique_citations(df: DataFrame, column: str) -> DataFrame:
    """One row for each value of the column."""
    return df.dropDuplicates([column])


def sampled_pairs(left: DataFrame, right: DataFrame, max_pairs: float) -> DataFrame:
    """At most about max_pairs random pairs of two tables: all of them if there are no more, else those of random rows of both sides,
    so that no more pairs are made than asked for."""
    n, m = left.count(), right.count()
    if n * m > max_pairs:
        share = (max_pairs / (n * m)) ** 0.5
        pick = lambda df, part: df.filter(F.pmod(F.xxhash64("unique_id"), F.lit(1_000_003)) < F.lit(part * 1_000_003))
        right_share = max(share, min(1.0, 1000 / m))
        left, right = pick(left, max_pairs / (n * m) / right_share), pick(right, right_share)
    return left.crossJoin(right)


def train(citations: DataFrame, voices: DataFrame, sample: DataFrame, label: str, wanted: Settings, max_pairs: float = 1e6) -> Model:
    """m from the labelled pairs, u from random pairs, then expectation maximisation of m and the match share over the same pairs."""
    cited = prepare(citations, wanted.field_l, wanted.output, wanted.algorithms)
    said = prepare(voices, wanted.field_r, wanted.output, wanted.algorithms)
    names = list(dict.fromkeys(c.left.removesuffix("_l") for c in wanted.comparisons))
    left = cited.select(F.col("unique_id").alias("unique_id"), *[F.col(n).alias(f"{n}_l") for n in names], *[a for a, _ in wanted.blocking])
    right = said.select(F.col("unique_id").alias("unique_id"), *[F.col(n).alias(f"{n}_r") for n in names], *[b for _, b in wanted.blocking])
    random = compare(sampled_pairs(left, right, max_pairs), wanted.comparisons)
    known = training_pairs(sample, cited.drop("id").withColumnRenamed("unique_id", "id"), said.drop("id").withColumnRenamed("unique_id", "id"), label).select("unique_id_l", "unique_id_r")
    labelled = known.join(left.withColumnRenamed("unique_id", "unique_id_l"), "unique_id_l").join(right.withColumnRenamed("unique_id", "unique_id_r"), "unique_id_r")
    u = estimate(random, wanted.comparisons)
    m = estimate(compare(labelled, wanted.comparisons), wanted.comparisons)
    return maximise(random, Model(wanted.comparisons, m, u))[0]


def compare(pairs: DataFrame, comparisons: list[Comparison]) -> DataFrame:
    return pairs.select("*", *[c.gamma().alias(f"gamma_{c.name}") for c in comparisons])


def pair(left: DataFrame, right: DataFrame, on: list[tuple[str, str]] | None = None) -> DataFrame:
    """Pairs of two tables: by equal blocking keys if any are given (a shuffled join), else all of them."""
    if not on:
        return left.crossJoin(right)
    condition = F.lit(True)
    for a, b in on:
        condition = condition & (left[a] == right[b])
    return left.join(right, condition)


def training_citations(citations: DataFrame, reviewed: DataFrame, label: str) -> DataFrame:
    """Citations whose reviewed row says what they are: neither NULL nor a remark that begins with #."""
    known = reviewed.filter(F.col(label).isNotNull() & ~F.col(label).startswith("#"))
    return citations.join(known, "temp_key")


def training_pairs(sample: DataFrame, citations: DataFrame, voices: DataFrame, label: str) -> DataFrame:
    """Labelled pairs of a citation and a voice of the entity that it names."""
    known = sample.filter(F.col(label).isNotNull() & ~F.col(label).startswith("#")).select("temp_key", F.col(label).alias("_name"))
    cited = citations.select("temp_key", F.col("id").alias("unique_id_l")).join(known, "temp_key")
    said = voices.select(F.col("normalized_name").alias("_entity"), F.col("id").alias("unique_id_r"))
    return cited.join(said, F.col("_name") == F.col("_entity")).select(F.lit("citations").alias("source_dataset_l"), "unique_id_l", F.lit("voices").alias("source_dataset_r"), "unique_id_r", F.lit(1.0).alias("clerical_match_score"))


def shares(compared: DataFrame, comparison: Comparison) -> DataFrame:
    """comparison, level, share: how often each level occurs, NULLs apart."""
    g = f"gamma_{comparison.name}"
    counts = compared.filter(F.col(g) >= 0).groupBy(F.col(g).alias("level")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(F.lit(comparison.name).alias("comparison"), "level", (F.col("n") / F.col("total")).alias("share"))


def estimate(compared: DataFrame, comparisons: list[Comparison]) -> dict[str, list[float]]:
    """Shares of the levels of every comparison, floored."""
    found = {}
    for c in comparisons:
        by_level = {r["level"]: r["share"] for r in shares(compared, c).collect()}  # as many rows as levels
        raw = np.array([max(by_level.get(i, 0.0), FLOOR) for i in range(c.size)])
        found[c.name] = (raw / raw.sum()).tolist()
    return found


def maximise(compared: DataFrame, model: Model, rounds: int = 50, tolerance: float = 1e-6) -> tuple[Model, list[float]]:
    """Expectation maximisation of m and the match share, u fixed. The pairs are read once: rounds work on the distinct patterns of levels."""
    names = [f"gamma_{c.name}" for c in model.comparisons]
    # at most the product of the numbers of levels
    rows = compared.groupBy(*names).agg(F.count("*").alias("n")).collect()
    patterns, counts = np.array([[r[g] for g in names] for r in rows]), np.array([r["n"] for r in rows], float)
    m = {c.name: np.array(model.m[c.name]) for c in model.comparisons}
    u = {c.name: np.array(model.u[c.name]) for c in model.comparisons}
    share, history = model.match_share, []

    def likelihood(table: dict[str, np.ndarray]) -> np.ndarray:
        p = np.ones(len(patterns))
        for k, c in enumerate(model.comparisons):
            g = patterns[:, k]
            p *= np.where(g >= 0, table[c.name][np.maximum(g, 0)], 1.0)
        return p

    for _ in range(rounds):
        a, b = share * likelihood(m), (1 - share) * likelihood(u)
        history.append(float((counts * np.log(a + b)).sum()))
        weight = counts * a / (a + b)
        share = float(weight.sum() / counts.sum())
        for k, c in enumerate(model.comparisons):
            g = patterns[:, k]
            raw = np.array([max(weight[g == i].sum(), FLOOR) for i in range(c.size)])
            m[c.name] = raw / raw.sum()
        if len(history) > 1 and history[-1] - history[-2] < tolerance:
            break
    return Model(model.comparisons, {k: v.tolist() for k, v in m.items()}, model.u, share), history


def score(compared: DataFrame, model: Model) -> DataFrame:
    """Match weight (log2) and probability of each pair; an addition to what training alone gives."""
    weight = F.lit(float(np.log2(model.match_share / (1 - model.match_share))))
    for c in model.comparisons:
        g, part = F.col(f"gamma_{c.name}"), F.lit(0.0)
        for i in range(c.size):
            part = F.when(g == i, float(np.log2(model.m[c.name][i] / model.u[c.name][i]))).otherwise(part)
        weight = weight + part
    return compared.withColumn("match_weight", weight).withColumn("match_probability", 1 / (1 + F.pow(F.lit(2.0), -F.col("match_weight"))))
