"""Byte-level BPE encoding and decoding.

A segment tree over a piece's byte positions holds, at the leaf of each live token's start, the rank of the pair that
the token forms with its right neighbour; inner nodes hold the least (rank, position), so the root is the leftmost
pair of minimum rank. A merge changes three leaves: the merged token's, its left neighbour's and the one that
vanished; each change walks up one path. A piece that is itself a token is taken whole.

Defined results: a null text is an empty one and has no tokens; rows are kept one for one, whatever their doc_id;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import ship, table, text_of
from .tokens import Chunks, kept, place

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Documents that are worked on together.
SLICE = 256
NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    shift = size.bit_length()
    place_of = (1 << shift) - 1
    tree = [NONE] * (2 * size)
    end = list(range(1, n + 1))  # of the token that starts here
    before = list(range(-1, n - 1))  # the start of the token to the left
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << shift | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def update(i: int, value: int) -> None:
        i += size
        tree[i] = value
        while i > 1:
            other = tree[i ^ 1]
            if other < value:
                value = other
            i >>= 1
            if tree[i] == value:
                return
            tree[i] = value

    while tree[1] != NONE:
        i = tree[1] & place_of
        gone = end[i]
        stop = end[i] = end[gone]
        update(gone, NONE)
        if stop < n:
            before[stop] = i
            rank = get(piece[i : end[stop]])
            update(i, NONE if rank is None else rank << shift | i)
        else:
            update(i, NONE)
        left = before[i]
        if left >= 0:
            rank = get(piece[left:stop])
            update(left, NONE if rank is None else rank << shift | left)
    found, i = [], 0
    while i < n:
        found.append(ranks[piece[i : end[i]]])
        i = end[i]
    return found


class Encoder:
    """Ids as bytes, 32 bits each, and back."""

    def __init__(self, path: str, pattern: str = PATTERN):
        self.ranks = load_ranks(path)
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.split = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.encode = Chunks(self._many, 800_000)

    def _many(self, chunks: list[str]) -> list[bytes]:
        found = []
        if len(self.pieces) > 300_000:
            self.pieces.clear()
        for chunk in chunks:
            ids = []
            for piece in self.split(chunk):
                if (got := self.pieces.get(piece)) is None:
                    got = self.pieces[piece] = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
                ids.append(got)
            found.append(b"".join(ids))
        return found

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.BinaryType())])
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and its ids as little-endian 32-bit integers."""
    ship()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(f"bpe {vocabulary}", lambda: Encoder(place(vocabulary)))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([encoder.encode(t) for t in part.column(1).to_pylist()], pa.binary())], ["doc_id", "ids"])

    return text_of(docs).mapInArrow(work, SCHEMA)


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and the bytes that its ids stand for."""
    ship()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(f"bpe {vocabulary}", lambda: Encoder(place(vocabulary)))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([encoder.decode(x or b"") for x in part.column(1).to_pylist()], pa.binary())], ["doc_id", "decoded"])

    return tokens.select("doc_id", "ids").mapInArrow(work, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Each document's token count and digests of its ids and of what they decode to, in one pass."""
    ship()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(f"bpe {vocabulary}", lambda: Encoder(place(vocabulary)))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sizes, of_ids, of_text = [], [], []
                for text in part.column(1).to_pylist():
                    ids = encoder.encode(text)
                    sizes.append(len(ids) // 4)
                    of_ids.append(hashlib.sha256(ids).hexdigest())
                    of_text.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return text_of(docs).mapInArrow(work, DIGEST)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
