"""SimHash near-duplicates: documents whose 64-bit fingerprints differ in at most 3 bits, transitively.

Every distinct fingerprint gets its distances to REFERENCES reference fingerprints. As |d(x, r) - d(y, r)| <= d(x, y) for
every reference r, a pair whose rows of this pivot table differ by more than the radius anywhere is discarded; what
survives is verified bit by bit. The table alone would have to be compared for all pairs (24 references leave none of two million random
ones, but one reference leaves 46 % and four 5 %, so it cannot be sorted or cut into cells that are small). So it decides within
buckets: of 6 blocks of bits, fingerprints at 3 or fewer differing bits
share 3 blocks at least, so each of the 20 choices of 3 blocks is a key, and no link is lost. A large bucket
is split further: the radius leaves one of 4 parts of the remaining bits unchanged. Inside a bucket the search spreads from
each fingerprint to the unreached ones, so that a dense bucket costs one pass and yields a spanning tree, not all pairs.

Defined results: a null text is an empty one; texts without words have fingerprint zero and are linked like others;
fewer than three words are one shingle; equal fingerprints are one node, whatever the number of rows; a null doc_id is kept
and never a component's id, which is null if the component has no other; an empty table gives an empty result; other
columns are ignored. Very long texts are hashed whole, a slice of texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, ship, table, text_of, unused
from .graph import components
from .repeats import has_keys
from .tokens import own

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Sizes of the blocks, of which RADIUS may differ.
BLOCKS = (11, 11, 11, 11, 10, 10)
REFERENCES = 24
#: Fingerprints that are compared without splitting their bucket further, and those of a small bucket.
LARGE, SMALL = 2048, 24
SLICE = 256


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.encode().lower().split()  # bytes: A-Z alone change case, the six ASCII spaces alone separate
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        hashes = [digest(b" ".join(words), seed)]
    else:
        hashes = [digest(b" ".join(g), seed) for g in zip(*(words[i:] for i in range(shingle)))]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(n, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(0, dtype=np.int64) > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""
    ship()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own("simhash")
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                found = np.array([fingerprint(t) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return text_of(docs).mapInArrow(work, "doc_id long, fp long")


def _references(n: int = REFERENCES) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 64, n, np.uint64, endpoint=False)


def _masks(blocks: tuple[int, ...] = BLOCKS, radius: int = RADIUS) -> list[int]:
    at, parts = 0, []
    for b in blocks:
        parts.append(((1 << b) - 1) << at)
        at += b
    return [sum(c) for c in combinations(parts, len(blocks) - radius)]


def pivot_table(fps: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Distances to the references, a row for each fingerprint."""
    return np.bitwise_count(fps[:, None] ^ references).astype(np.int8)


def _near(fps: np.ndarray, rows: np.ndarray, i: int, among: np.ndarray, radius: int) -> np.ndarray:
    """Which of `among` are within the radius of i: the pivot table first, then the bits."""
    for lo in range(0, rows.shape[1], 8):
        among = among[(np.abs(rows[among, lo : lo + 8] - rows[i, lo : lo + 8]) <= radius).all(1)]
    return among[np.bitwise_count(fps[among] ^ fps[i]) <= radius]


def spread(fps: np.ndarray, free: int, references: np.ndarray, radius: int = RADIUS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all fingerprints of a bucket that are connected within it. free: bits in which they may differ."""
    if len(fps) > LARGE and free.bit_count() >= 2 * (radius + 1):
        bits = [1 << b for b in range(64) if free >> b & 1]
        found = []
        for part in range(radius + 1):
            own = sum(bits[part :: radius + 1])
            value = fps & np.uint64(own)
            order = np.argsort(value, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(value[order])) + 1):
                if len(group) > 1:
                    found += spread(fps[group], free & ~own, references, radius)
        return found
    rows = pivot_table(fps, references)
    unreached, found = np.arange(len(fps)), []
    while len(unreached):
        edge, unreached = [unreached[0]], unreached[1:]
        while edge and len(unreached):
            i = edge.pop()
            near = _near(fps, rows, i, unreached, radius)
            if len(near):
                found.append((np.full(len(near), fps[i]), fps[near]))
                edge.extend(near.tolist())
                unreached = unreached[~np.isin(unreached, near)]
    return found


def _links_of(keys: np.ndarray, choice: np.ndarray, fps: np.ndarray, masks: list[int], references: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal (choice, key)."""
    new = np.flatnonzero((np.diff(keys) != 0) | (np.diff(choice) != 0)) + 1
    starts = np.concatenate([[0], new])
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    small = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
    if len(small):
        rows = None
        for shift in range(1, int(sizes[small].max())):
            groups = small[sizes[small] > shift]
            size = sizes[groups] - shift
            a = np.repeat(starts[groups], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            if rows is None:
                rows = pivot_table(fps, references)
            b = a + shift
            for lo in range(0, rows.shape[1], 8):
                ok = (np.abs(rows[a, lo : lo + 8] - rows[b, lo : lo + 8]) <= radius).all(1)
                a, b = a[ok], b[ok]
            ok = np.bitwise_count(fps[a] ^ fps[b]) <= radius
            yield fps[a[ok]], fps[b[ok]]
    for g in np.flatnonzero(sizes > SMALL):
        own = fps[starts[g] : starts[g] + sizes[g]]
        yield from spread(own, ((1 << 64) - 1) & ~masks[int(choice[starts[g]])], references, radius)


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """u and v: links that connect every two of the distinct fingerprints fp that a chain of near ones connects."""
    ship()
    masks, references = _masks(), _references()
    signed = [int(np.array(m, np.uint64).view(np.int64)) for m in masks]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("choice", "key"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own("simhash")
        held: list[list[np.ndarray]] = []

        def out(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for u, v in _links_of(*columns, masks, references, radius):
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(1).to_numpy(), batch.column(0).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
            same = columns[0][-1] == columns[0][0] and columns[1][-1] == columns[1][0]
            if held and same and held[-1][0][-1] == columns[0][0] and held[-1][1][-1] == columns[1][0]:
                held.append(columns)  # the bucket goes on
                continue
            # all buckets but the last one are complete
            joined = [np.concatenate(c) for c in zip(*held, columns)]
            last = np.flatnonzero((joined[0] != joined[0][-1]) | (joined[1] != joined[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield from out([c[:cut] for c in joined])
            held = [[c[cut:] for c in joined]]
        if held:
            yield from out([np.concatenate(c) for c in zip(*held)])

    dealt = keyed.select("choice", "key", "fp").repartition("choice", "key").sortWithinPartitions("choice", "key", "fp")
    return dealt.mapInArrow(work, "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id of each row of docs."""
    marked = materialise(fingerprints(docs))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = components(links(nodes.select("fp"), radius))
    labelled = materialise(nodes.join(rooted, nodes.fp == rooted.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    # stored, so that an adaptive plan can split the rows of a large component
    ids = materialise(labelled.groupBy("root").agg(F.min("first").alias("component_id")))
    labels = labelled.select(F.col("fp").alias("node"), F.col("root").alias("of")).join(ids, F.col("of") == ids.root).select("node", "component_id")
    return marked.join(labels, marked.fp == labels.node).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the one of least doc_id, nulls last, then of those with equal
    or no doc_id any one. docs must give the same rows each time it is read, as a stored table does."""
    own = text_of(docs)
    kept_ = unused(docs, "kept_row")
    if has_keys(own):
        found = near_duplicates(own).filter("component_id = doc_id").select(F.col("doc_id").alias(kept_))
        return docs.join(found, F.col("doc_id").cast("long") == F.col(kept_), "left_semi")
    row = unused(docs, "row_number")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()))  # numbered once, whatever the splits of later reads
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    owners = rows.select(F.col(row).alias("o_row"), F.col("doc_id").cast("long").alias("o_id"))
    # rows of a group in order of doc_id: the least is an aggregate, so no group is gathered
    ordered = found.join(owners, found.doc_id == owners.o_row).select("component_id", F.struct(F.col("o_id").isNull().alias("none"), "o_id", "o_row").alias("who"))
    firsts = ordered.groupBy("component_id").agg(F.min("who").alias("who")).select(F.col("who.o_row").alias(kept_))
    return rows.join(firsts, F.col(row) == F.col(kept_), "left_semi").drop(row)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
