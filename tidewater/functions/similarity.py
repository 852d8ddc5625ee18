"""String and vector similarities, and the table of algorithms by name."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import phonetic
from .phonetic import double_metaphone as _codes
from .phonetic import jaro_winkler as _jaro_winkler

# workers get these functions by value and need no copy of the package
cloudpickle.register_pickle_by_value(phonetic)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - distance / the longer length; NULL if either is."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else _jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")


def soundex_ratio(a: Column, b: Column) -> Column:
    return levenshtein_ratio(F.soundex(a), F.soundex(b))


@F.pandas_udf(T.StructType([T.StructField("primary", T.StringType()), T.StructField("secondary", T.StringType())]))
def double_metaphone(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_codes(t) if t is not None else (None, None) for t in text], columns=["primary", "secondary"])


def double_metaphone_similarity(a: Column, b: Column) -> Column:
    """1.0 if the codes (structs of double_metaphone) share one that is not empty, else the best Levenshtein ratio of two."""
    pairs = [(a[x], b[y]) for x in ("primary", "secondary") for y in ("primary", "secondary")]
    shared, best = F.lit(False), []
    for x, y in pairs:
        ok = (x != "") & (y != "")
        shared = shared | F.coalesce(ok & (x == y), F.lit(False))
        best.append(F.when(ok, levenshtein_ratio(x, y)))
    return F.when(shared, 1.0).otherwise(F.coalesce(F.greatest(*best), F.lit(0.0)))


def ngrams(text: Column, n: int = 3, pad: int = 2) -> Column:
    padded = F.concat(F.lit(" " * pad), text, F.lit(" " * pad))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: F.substring(padded, i, F.lit(n))))


def ngram_jaccard(a: Column, b: Column, n: int = 3) -> Column:
    x, y = ngrams(a, n), ngrams(b, n)
    return F.coalesce(F.size(F.array_intersect(x, y)) / F.nullif(F.size(F.array_union(x, y)), F.lit(0)), F.lit(0.0))


def cosine(a: Column, b: Column) -> Column:
    """0.0 for NULL or a vector without length."""
    a, b = a.cast("array<double>"), b.cast("array<double>")

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.when(norm > 0, dot(a, b) / norm), F.lit(0.0))


def embedder(load: Callable[[], Callable[[list[str]], np.ndarray]]):
    """A function text -> vector. load() runs once for each partition and gives encode(texts) -> rows of a matrix."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for texts in batches:
            yield pd.Series([row.tolist() for row in np.asarray(encode(texts.fillna("").tolist()), dtype=float).reshape(len(texts), -1)])

    return embed


def hashing_encoder(size: int = 64, n: int = 3) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """A deterministic stand-in for a language model: hashed character n-grams, normalised. Not a trained model."""

    def load() -> Callable[[list[str]], np.ndarray]:
        import zlib

        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), size))
            for row, text in zip(out, texts):
                padded = f"  {text}  "
                for i in range(len(padded) - n + 1):
                    row[zlib.crc32(padded[i : i + n].encode()) % size] += 1
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(norms > 0, norms, 1)

        return encode

    return load


def library_encoder(library: str, model: str) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """An encoder from an optional library: sentence_transformers, text2vec, fasttext, or transformers (byt5, mean over the mask, normalised)."""

    def load() -> Callable[[list[str]], np.ndarray]:
        import importlib

        module = importlib.import_module(library)
        if library == "fasttext":
            loaded = module.load_model(model)
            return lambda texts: np.stack([loaded.get_sentence_vector(t.replace("\n", " ")) for t in texts])
        if library == "transformers":
            torch = importlib.import_module("torch")
            device = "cuda" if torch.cuda.is_available() else "cpu"
            tokens, net = module.AutoTokenizer.from_pretrained(model), module.T5EncoderModel.from_pretrained(model).to(device).eval()

            def encode(texts: list[str]) -> np.ndarray:
                batch = tokens(texts, padding=True, truncation=True, return_tensors="pt").to(device)
                with torch.no_grad():
                    hidden = net(**batch).last_hidden_state
                mask = batch["attention_mask"].unsqueeze(-1)
                mean = (hidden * mask).sum(1) / mask.sum(1).clamp(min=1)
                return torch.nn.functional.normalize(mean, dim=1).cpu().numpy()

            return encode
        kind = {"sentence_transformers": "SentenceTransformer", "text2vec": "SentenceModel"}[library]
        return getattr(module, kind)(model).encode

    return load


def enrich_distinct(df: DataFrame, column: str, derived: dict[str, Column]) -> DataFrame:
    """Adds expressions of one column, computed once for each distinct value and joined back."""
    values = df.select(column).distinct().withColumns(derived).withColumnRenamed(column, "_value")
    return df.join(values, F.col(column) == F.col("_value"), "left").drop("_value")


def identifier(text: str) -> str:
    """A plain lower-case name: accents off, anything else an underscore."""
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
    return re.sub(r"\W+", "_", plain).strip("_")


#: Levels compare two columns; each algorithm gives a condition for a threshold.
ALGORITHMS: dict[str, Callable[..., Column]] = {
    "levenshtein": lambda a, b, t, **k: levenshtein_ratio(a, b) >= t,
    "jaro_winkler": lambda a, b, t, **k: jaro_winkler(a, b) >= t,
    "soundex": lambda a, b, t, **k: soundex_ratio(a, b) >= t,
    "double_metaphone": lambda a, b, t, **k: double_metaphone_similarity(double_metaphone(a), double_metaphone(b)) >= t,
    "ngram": lambda a, b, t, n=3, **k: ngram_jaccard(a, b, n) >= t,
    "cosine": lambda a, b, t, **k: cosine(a, b) >= t,
}


def algorithm(name: str) -> Callable[..., Column]:
    if name not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {name!r}; known: {sorted(ALGORITHMS)}")
    return ALGORITHMS[name]


def register_functions(spark: SparkSession) -> None:
    """The vectorised functions under their names in SQL."""
    spark.udf.register("jaro_winkler", jaro_winkler)
    spark.udf.register("double_metaphone", double_metaphone)
