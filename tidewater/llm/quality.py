"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate.

A line is described by about twenty yes-or-no features (symbols, bars, capitals, repeated words, repeated lines, length, closing
marks). Viterbi decoding finds a text's most likely sequence of marks; the document is kept if at least SHARE of
its words stand in content lines and the base rules hold (MIN_WORDS words, and at most MAX_REPEAT percent of them
in repeated 5-word windows).

Lines have no labels of their own. The field learns from documents labelled good or bad, in two steps: first a logistic
regression with each line marked as its document; then bad documents' lines that look like good ones count as
content, and the field's weights and transitions are fitted by gradient ascent on the exact likelihood. It is fitted
on at most SAMPLE labelled rows, in segments of SEGMENT lines; counts and decisions cover every document and whole texts.

Defined results: a null text is an empty one; a text without words has counts of zero and fails the base
rules; a null doc_id and repeated rows are kept one for one; without labels of both kinds all lines are content;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, table, text_of
from .tokens import own

MIN_WORDS, MAX_REPEAT, REPEAT_WINDOW = 10, 20, 5
#: The share of words in content lines from which a document is kept.
SHARE = 0.5
#: Labelled documents that the field is fitted on, at most, and the lines of a training segment.
SAMPLE, SEGMENT = 3_000, 48
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER, DIGITS = bytes(range(65, 91)), b"0123456789"
FEATURES = 20
SLICE = 256


def line_features(line: bytes, words: list[bytes], seen: bool) -> int:
    """The features of a line with words, as bits."""
    n, size = len(words), len(line)
    f = 1
    f |= 2 if n <= 2 else 4 if n <= 5 else 8 if n <= 12 else 16 if n <= 40 else 32
    odd = size - len(line.translate(None, SYMBOLS))
    if odd:
        f |= 1 << 6
        if 20 * odd > n:
            f |= 1 << 7
        if 2 * odd > n:
            f |= 1 << 8
    capitals = size - len(line.translate(None, UPPER))
    if 4 * capitals > size:
        f |= 1 << 9
    if 2 * capitals > size:
        f |= 1 << 10
    if 2 * line.count(b"!") > n:
        f |= 1 << 11
    distinct = len(set(words))
    if 10 * distinct < 8 * n:
        f |= 1 << 12
    if 2 * distinct < n:
        f |= 1 << 13
    if 5 * distinct < n:
        f |= 1 << 14
    if seen:
        f |= 1 << 15
    if line[-1:] in (b".", b"!", b"?", b":", b'"'):
        f |= 1 << 16
    if 5 * (size - len(line.translate(None, DIGITS))) > size:
        f |= 1 << 17
    if b"http" in line or b"www." in line or b"@" in line:
        f |= 1 << 18
    if size > 12 * n:
        f |= 1 << 19
    return f


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows that the text holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    if len(known) == len(words):
        return 0
    bits, key, width = len(known).bit_length(), ids, 1
    while width < window:  # join windows; name them anew where another join could overflow
        step = min(window - width, width)
        key = key[: len(key) - step] << bits | (key[step:] if step == width else key[step:])
        width += step
        if 2 * bits >= 62 or width < window:
            names, key = np.unique(key, return_inverse=True)
            bits = len(names).bit_length()
    _, name, count = np.unique(key, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[name] > 1)
    if not len(at):
        return 0
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def lines_of(raw: bytes) -> tuple[list[int], list[int], int]:
    """The features and word counts of the lines with words, and how many of them equal an earlier one."""
    features, sizes, seen, repeated = [], [], set(), 0
    for line in raw.split(b"\n"):
        words = line.split()
        if words:
            again = line in seen
            repeated += again
            seen.add(line)
            features.append(line_features(line, words, again))
            sizes.append(len(words))
    return features, sizes, repeated


class Field:
    """Weights of boilerplate against content: one for each feature, and a 2 x 2 table of transitions (content is 0)."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros(FEATURES) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves
        if weights is None:
            self.weights[0] = -1.0
        self.known: dict[int, float] = {}

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "moves": self.moves, "known": {}}

    def lean(self, features: int) -> float:
        """How far a line alone speaks for boilerplate."""
        value = self.known.get(features)
        if value is None:
            value = self.known[features] = float(sum(w for i, w in enumerate(self.weights.tolist()) if features >> i & 1))
        return value

    def decode(self, lines: list[int]) -> list[int]:
        """The most likely marks (Viterbi); content where two paths tie."""
        (cc, cb), (bc, bb) = self.moves.tolist()
        c, b, back = 0.0, 0.0, []
        for i, features in enumerate(lines):
            lean = self.lean(features)
            if i == 0:
                c, b = 0.0, lean
                continue
            from_c, from_b = c + cb > b + bb, c + cc >= b + bc
            back.append((from_b, from_c))
            c, b = (c + cc if from_b else b + bc), (c + cb if from_c else b + bb) + lean
        state = int(b > c)
        marks = [state]
        for to_c, to_b in reversed(back):
            state = int(not (to_b if state else to_c))
            marks.append(state)
        return marks[::-1] if lines else []


def fit(sequences: list[list[int]], bad: list[bool], rounds: int = 300, ridge: float = 1e-3) -> Field:
    """The field that fits the documents' lines best, given whether each document is bad."""
    parts = [(s[i : i + SEGMENT], y) for s, y in zip(sequences, bad) for i in range(0, len(s), SEGMENT)]
    if not any(y for _, y in parts) or all(y for _, y in parts):
        return Field()
    length = max(len(s) for s, _ in parts)
    bits = np.zeros((len(parts), length), np.int64)
    real = np.zeros((len(parts), length), bool)
    for i, (s, _) in enumerate(parts):
        bits[i, : len(s)], real[i, : len(s)] = s, True
    x = (bits[:, :, None] >> np.arange(FEATURES) & 1).astype(float) * real[:, :, None]
    y = np.repeat(np.array([v for _, v in parts])[:, None], length, 1) & real
    # a line of a bad document is boilerplate if it looks so by itself
    flat, target = x[real], y[real].astype(float)
    weights = _ascend(lambda w: (flat.T @ (target - 1 / (1 + np.exp(-np.clip(flat @ w, -30, 30))))) / len(flat) - ridge * w, np.zeros(FEATURES), rounds)
    y &= (x @ weights > 0) & real
    pairs = real[:, 1:]
    seen_moves = np.array([[(pairs & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
    total = real.sum()
    target = np.tensordot(y.astype(float), x, ([0, 1], [0, 1]))

    def gradient(v: np.ndarray) -> np.ndarray:
        w, moves = v[:FEATURES], v[FEATURES:].reshape(2, 2)
        lean = x @ w
        score = np.stack([np.zeros_like(lean), lean], 2)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, length):
            step = np.logaddexp(ahead[:, t - 1, 0, None] + moves[0], ahead[:, t - 1, 1, None] + moves[1]) + score[:, t]
            ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
        for t in range(length - 2, -1, -1):
            after = score[:, t + 1] + behind[:, t + 1]
            step = np.logaddexp(moves[:, 0] + after[:, 0, None], moves[:, 1] + after[:, 1, None])
            behind[:, t] = np.where(real[:, t + 1, None], step, 0)
        whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        at = np.exp(ahead + behind - whole[:, None, None])[:, :, 1] * real
        expected = np.tensordot(at, x, ([0, 1], [0, 1]))
        after = score[:, 1:] + behind[:, 1:]
        both = np.exp(ahead[:, :-1, :, None] + moves + after[:, :, None, :] - whole[:, None, None, None]) * pairs[:, :, None, None]
        return np.concatenate([target - expected, (seen_moves - both.sum((0, 1))).ravel()]) / total - ridge * v

    v = _ascend(gradient, np.concatenate([weights, np.zeros(4)]), rounds // 3)
    return Field(v[:FEATURES], v[FEATURES:].reshape(2, 2))


def _ascend(gradient, v: np.ndarray, rounds: int, rate: float = 0.1) -> np.ndarray:
    """Adam, upwards."""
    m, s = np.zeros_like(v), np.zeros_like(v)
    for k in range(1, rounds + 1):
        g = gradient(v)
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        v = v + rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)
    return v


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Fits the field on a sample of labelled documents, chosen by a hash of doc_id."""
    ship()
    known = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("quality")).filter(F.col("quality").isin(0, 1) & F.col("l_id").isNotNull())
    picked = known.groupBy("l_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("l_id"), "l_id").limit(sample)
    # at most `sample` ids of 8 bytes and a label
    texts = text_of(docs).join(F.broadcast(picked), F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "quality")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own("quality")
        for batch in batches:
            found = [lines_of(t.encode())[0] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64())), batch.column(2)], ["doc_id", "lines", "quality"])

    rows = texts.mapInArrow(work, "doc_id long, lines array<long>, quality int").toPandas().sort_values("doc_id", kind="stable")
    return fit([list(x) for x in rows["lines"]], [q == 0 for q in rows["quality"]])


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words", "base_failed", "kept"]
JUDGED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_words long, base_failed boolean, kept boolean"


def judge_text(text: str, field: Field, share: float = SHARE) -> tuple:
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    repeat = repeated_words(words)
    features, sizes, again = lines_of(raw)
    content = sum(size for size, mark in zip(sizes, field.decode(features)) if not mark)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT * n
    return n, chars, symbols, again, repeat, content, failed, not failed and content >= share * n


def judge(docs: DataFrame, field: Field, share: float = SHARE) -> DataFrame:
    """doc_id, what the rules count in each document, and whether it is kept."""
    ship()
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own("quality")
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                columns = list(zip(*(judge_text(t, shared.value, share) for t in part.column(1).to_pylist())))
                kinds = [pa.int64()] * 6 + [pa.bool_()] * 2
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], NAMES)

    return text_of(docs).mapInArrow(work, JUDGED)


def reject(docs: DataFrame, field: Field, share: float = SHARE) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    ship()
    shared, at = docs.sparkSession.sparkContext.broadcast(field), docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own("quality")
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                yield part.filter(pa.array([judge_text(t or "", shared.value, share)[-1] for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, train(docs, table(spark, sf_dir, "labels")))
