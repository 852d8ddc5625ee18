"""Token sequences in files of length-delimited binary records.

A record is: the payload's length (8 bytes), the masked CRC-32 of these 8 bytes (4), the payload, the masked CRC-32 of the
payload (4); all little-endian. A payload is the document's id (8 bytes, the least value for null) and its token ids (2 bytes
each; a vocabulary that needs more is refused). Beside each file `shard-N-*.rec` stands `shard-N-*.idx`: an 8-byte
offset for each record, so that a reader can fetch records in any order. A CRC is masked by rotating it right
by 15 bits and adding a constant, so that a checksum of data that holds checksums stays strong.

Documents are dealt by ranges of doc_id, so shards are ordered among themselves and within. A task writes its shard under a
name of its own and then reports it; only reported shards count, so a task that is run again leaves no trace in the result.

Defined results: a null text is an empty one (its record holds the end id alone); rows that share a doc_id are kept,
ordered by a hash of their texts; a null doc_id sorts first; very long texts are one record; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import filesystem, materialise, shared_dir, ship, table, text_of
from .tokens import Chunks, kept, place

VOCABULARY, END_ID = "word_bpe_49k.json", 1
NO_ID = -(1 << 63)
#: The constant that masking adds.
MASK = 0xA282EAD8
SLICE = 256
#: Chunks that the tokenizer gets as one text.
TOGETHER = 64
#: Bytes of records that a reader fetches at once, at least one record.
FETCH = 8 << 20


class BadRecord(ValueError):
    """A record whose checksum or length does not hold."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data: memoryview, at: int) -> tuple[bytes, int]:
    """The payload of the record at `at`, and where the next one starts."""
    size = bytes(data[at : at + 8])
    if len(size) < 8 or struct.unpack("<I", data[at + 8 : at + 12])[0] != masked(size):
        raise BadRecord(f"length at {at}")
    n = struct.unpack("<Q", size)[0]
    payload = bytes(data[at + 12 : at + 12 + n])
    if len(payload) < n or struct.unpack("<I", data[at + 12 + n : at + 16 + n])[0] != masked(payload):
        raise BadRecord(f"payload at {at}")
    return payload, at + 16 + n


def library_encoder(vocabulary: str, mark: int | None = None) -> Chunks:
    """Ids of the tokenizers library, 16 bits each; with `mark`, that value follows each chunk that ends a sentence."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(place(vocabulary))
    # chunks are encoded together, a special token between them: the library splits there before all else
    between, sep = next((x.content, i) for i, x in tokenizer.get_added_tokens_decoder().items() if x.special)
    tail = b"" if mark is None else struct.pack("<H", mark)
    # words of letters alone need none: their first or last token shows
    vocabulary_ = tokenizer.get_vocab()
    suffix = tokenizer.model.end_of_word_suffix
    edge = np.zeros(max(vocabulary_.values()) + 1, bool)
    edge[[i for t, i in vocabulary_.items() if (t.endswith(suffix) if suffix else t[0] == "\u0120")]] = True

    def encode(texts: list[str]) -> Iterator[np.ndarray]:
        return (np.array(e.ids, "<u2") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False))

    def words(chunks: list[str]) -> list[bytes]:
        """Chunks of a space and letters."""
        groups, found = [chunks[i : i + TOGETHER] for i in range(0, len(chunks), TOGETHER)], []
        for group, ids in zip(groups, encode(["".join(g) for g in groups])):
            at = np.flatnonzero(edge[ids])
            cuts = [0, *(at + 1).tolist()] if suffix else [*at.tolist(), len(ids)]
            if len(cuts) == len(group) + 1 and cuts[0] == 0 and cuts[-1] == len(ids):
                raw = ids.tobytes()
                found.extend([raw[2 * a : 2 * b] for a, b in zip(cuts, cuts[1:])])
            else:
                found.extend(ids.tobytes() for ids in encode(group))
        return found

    def others(chunks: list[str]) -> list[bytes]:
        groups, found = [chunks[i : i + TOGETHER] for i in range(0, len(chunks), TOGETHER)], []
        for group, ids in zip(groups, encode([between.join(g) for g in groups])):
            cuts = [-1, *np.flatnonzero(ids == sep).tolist(), len(ids)]
            if len(cuts) == len(group) + 1:
                raw = ids.tobytes()
                found.extend([raw[2 * a + 2 : 2 * b] for a, b in zip(cuts, cuts[1:])])
            else:  # a chunk holds the special token itself
                found.extend(ids.tobytes() for ids in encode(group))
        return found

    def many(chunks: list[str]) -> list[bytes]:
        plain = [c[0] == " " and c[1:].isalpha() for c in chunks]
        of_words, of_others = iter(words([c for c, w in zip(chunks, plain) if w])), iter(others([c for c, w in zip(chunks, plain) if not w]))
        found = [next(of_words if w else of_others) for w in plain]
        return found if mark is None else [x + tail if c[-1] in ".!?\n" else x for x, c in zip(found, chunks)]

    if tokenizer.get_vocab_size() > 65_535:
        raise ValueError("ids of this vocabulary need more than 16 bits")
    return Chunks(many)


MANIFEST = "shard int, name string, n_docs long, n_tokens long"


def write(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Writes records and indexes to folder; gives a row for each shard, which the caller may keep."""
    ship()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept(f"records {vocabulary}", lambda: library_encoder(vocabulary))
        tail = struct.pack("<H", end_id)
        shard, store, at, docs_in, tokens_in = TaskContext.get().partitionId(), None, 0, 0, 0
        out, places = [], []
        for batch in batches:
            if store is None and batch.num_rows:
                files, root = filesystem(folder)
                files.create_dir(root, recursive=True)
                name = f"{root}/shard-{shard}-{uuid.uuid4().hex}"
                store, index = files.open_output_stream(f"{name}.rec"), files.open_output_stream(f"{name}.idx")
            for key, ids in zip(batch.column(0).to_pylist(), encode.texts(batch.column(1))):
                record = frame(b"".join((struct.pack("<q", NO_ID if key is None else key), ids, tail)))
                places.append(at)
                out.append(record)
                at += len(record)
                docs_in += 1
                tokens_in += (len(ids) + len(tail)) // 2
                if len(out) == SLICE:
                    store.write(b"".join(out))
                    index.write(np.array(places, "<u8").tobytes())
                    out, places = [], []
        if out:
            store.write(b"".join(out))
            index.write(np.array(places, "<u8").tobytes())
        if store is not None:
            store.close()
            index.close()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([name]), pa.array([docs_in], pa.int64()), pa.array([tokens_in], pa.int64())], ["shard", "name", "n_docs", "n_tokens"])

    rows = text_of(docs).withColumn("h", F.xxhash64("text"))
    return rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h").mapInArrow(work, MANIFEST)


def fetch(files: fs.FileSystem, name: str, picks: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """doc_id and ids of a shard's records, in file order or in the order of picks (record numbers)."""
    with files.open_input_file(f"{name}.idx") as f:
        places = np.frombuffer(f.read(), "<u8")
    with files.open_input_file(f"{name}.rec") as f:
        ends = np.append(places[1:], np.uint64(f.size()))
        order = np.arange(len(places)) if picks is None else picks
        i = 0
        while i < len(order):
            j = i + 1  # neighbours in the file are fetched together
            while j < len(order) and order[j] == order[j - 1] + 1 and ends[order[j]] - places[order[i]] <= FETCH:
                j += 1
            base = int(places[order[i]])
            data = memoryview(f.read_at(int(ends[order[j - 1]]) - base, base))
            for k in order[i:j]:
                payload, stop = unframe(data, int(places[k]) - base)
                if stop != int(ends[k]) - base:
                    raise BadRecord("index and records differ")
                yield struct.unpack_from("<q", payload)[0], np.frombuffer(payload, "<u2", offset=8)
            i = j


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record, in shards as the manifest lists them."""
    ship()
    starts = F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    # a row for each shard, never for each document
    shards = manifest.select("shard", "name", F.coalesce(starts, F.lit(0)).cast("long").alias("start"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = filesystem(folder)
        for batch in batches:
            for name, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows = []
                for key, ids in fetch(files, name):
                    rows.append((None if key == NO_ID else key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # a task for each shard: without the number, adaptive plans would put these few rows into one
    return shards.repartitionByRange(max(1, manifest.count()), "shard").mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
    return read(materialise(write(table(spark, sf_dir, "documents"), folder)), folder)
