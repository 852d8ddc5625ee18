"""Suffix-array dedup on a run-length index: removes bytes of 100-byte strings that also start earlier in the corpus.

1. Every 100-byte string chooses an anchor, the place of its least 32-byte hash, so equal strings choose alike. Anchors meet
   by name (see repeats): equal contexts settle all their strings at once; those of unique names cannot recur.
2. What is left, anchors of one name in different contexts, sends its contexts to the task of the bytes that they share.
   There a run-length index is built over them in document order: the suffix array gives the Burrows-Wheeler transform, of which
   only the runs are kept, with the suffixes sampled at both sides of each run's head and the length on which they
   agree. Streaming over the samples in text order gives matching statistics: at each place the longest match with the
   suffix that precedes it in order, and where that stands. A string with a match of 100 bytes or more and an earlier
   occurrence along these matches is marked.
3. Groups of more than INDEX bytes of contexts (a licence line in many documents) have no index: each of their strings
   becomes a row that its 100 bytes name, by two hashes. Of equal rows a task hands on the first alone, so no index and no
   task grows with the number of copies.

Strings are judged on the input, overlaps count, matches never cross documents. Removed bytes may split a character;
kept bytes that do not form UTF-8 are dropped from kept_text, never from the digest.

Defined results: a null text is an empty one; documents under 100 bytes keep everything; rows that share a doc_id, or have none, are documents of
their own, ordered by text (a null doc_id first); a very long text is one document, worked on whole; of exactly repeated rows one stays; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, release, ship, table, unused
from .repeats import ANCHORS, ODD, SPAN, Powers, anchor_rows, asked, covered, grouped, has_keys, keyed, mix, prefix_sums, ranges, resolve, sliding_min, spans_of, with_spans
from .tokens import kept

WIDTH, GRAM = 100, 32
#: Bytes of contexts in one run-length index, at most; a larger group is settled string by string.
INDEX = 1 << 19


def hashed(raw: bytes) -> tuple[Powers, np.ndarray, np.ndarray]:
    """Powers, prefix sums over the hashes of eight bytes, and a hash of the GRAM bytes from each place on."""
    x = np.frombuffer(raw, np.uint8).astype(np.uint64)
    powers = kept("suffix powers", Powers).reach(len(x))
    for k in (1, 2, 4):  # eight bytes in one word
        x = x[:-k] | x[k:] << np.uint64(8 * k)
    word = mix(x)
    h = mix(word[:-8] * ODD + word[8:])
    return powers, prefix_sums(word, powers), mix(h[:-16] * ODD + h[16:])


def anchors_of(keys: list[int], texts: list[str], width: int = WIDTH) -> pa.RecordBatch | None:
    """The anchors of some documents."""
    docs = [(k, r) for k, r in zip(keys, (t.encode() for t in texts)) if len(r) >= width]
    if not docs:
        return None
    sizes = np.array([len(r) for _, r in docs])
    starts = np.cumsum(sizes) - sizes
    raw = b"".join(r for _, r in docs) + bytes(GRAM + width)
    n = len(raw)
    powers, sums, h = hashed(raw)
    bits = np.uint64(n.bit_length())
    mask = (np.uint64(1) << bits) - np.uint64(1)
    least = sliding_min((h & ~mask) | np.arange(len(h), dtype=np.uint64), width - GRAM + 1)
    p = ranges(starts, sizes - width + 1)
    place = (least[p] & mask).astype(np.int64)
    cut = np.flatnonzero(np.diff(place)) + 1
    first, last = p[np.concatenate([[0], cut])], p[np.concatenate([cut, [len(p)]]) - 1]
    place = place[np.concatenate([[0], cut])]
    ctx = mix((sums[last + width - 7] - sums[first]) * powers.down[first] + ((place - first) << 8 | (last - first)).astype(np.uint64) * ODD)
    doc = np.searchsorted(starts, first, "right") - 1
    base = starts[doc]
    return anchor_rows(h[place], ctx, np.array([k for k, _ in docs], np.int64)[doc], first - base, last - base, place - base, width, True)


def find_anchors(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in grouped(batches, len):
            rows = anchors_of(keys, texts)
            if rows is not None:
                yield rows

    return docs.select("key", "text").mapInArrow(work, ANCHORS)


def contexts(docs: DataFrame) -> DataFrame:
    """The contexts that requests ask for, in two halves: strings that start near the anchor, and those that start far before it.

    Those of the first half share 66 bytes from the anchor on, those of the second 67 around its start: their
    hash is the group in which they can match.
    """
    half = (WIDTH - GRAM) // 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = []
                for key, text, locs, in zip(*(part.column(i).to_pylist() for i in range(3))):
                    raw = text.encode()
                    for loc in locs:
                        start, more, back = loc >> 16, loc >> 8 & 255, loc & 255
                        place, last = start + back, start + more
                        near = max(start, place - half)
                        if near <= last:
                            rows.append((b"+" + raw[place : place + WIDTH - half], key, near, raw[near : last + WIDTH]))
                        last = min(last, place - half - 1)
                        if start <= last:
                            rows.append((b"-" + raw[place - half - 1 : place + GRAM], key, start, raw[start : last + WIDTH]))
                if rows:
                    group = [int.from_bytes(hashlib.blake2b(r[0], digest_size=8).digest(), "little", signed=True) for r in rows]
                    yield pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())], ["grp", "key", "start", "said"])

    return docs.mapInArrow(work, "grp long, key long, start long, said binary")


def split(contexts_: DataFrame, index: int) -> tuple[DataFrame, DataFrame]:
    """The contexts of groups of at most `index` bytes, and those of larger groups; contexts_ is a stored table."""
    sizes = contexts_.groupBy("grp").agg(F.sum(F.length("said")).alias("n"))
    # a row for each `index` bytes of contexts at most
    large = F.broadcast(materialise(sizes.filter(F.col("n") > index).select("grp")))
    return contexts_.join(large, "grp", "left_anti"), contexts_.join(large, "grp", "left_semi")


def strings(contexts_: DataFrame) -> DataFrame:
    """Rows for resolve(): the strings of the contexts, each named by two hashes of its bytes."""

    def rows(keys: list[int], starts: list[int], said: list[bytes]) -> pa.RecordBatch:
        sizes = np.array([len(r) for r in said])
        base = np.cumsum(sizes) - sizes
        powers, sums, h = hashed(b"".join(said) + bytes(GRAM + WIDTH))
        p = ranges(base, sizes - WIDTH + 1)
        name = h[p]
        for k in (GRAM, 2 * GRAM, WIDTH - GRAM):
            name = mix(name * ODD + h[p + k])
        ctx = mix((sums[p + WIDTH - 7] - sums[p]) * powers.down[p])
        owner = np.searchsorted(base, p, "right") - 1
        start = np.array(starts, np.int64)[owner] + p - base[owner]
        return anchor_rows(name, ctx, np.array(keys, np.int64)[owner], start, start, start, WIDTH, True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], []]
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                for column, value in zip(held, row):
                    column.append(value)
                size += len(row[2])
                if size >= INDEX:
                    yield rows(*held)
                    held, size = [[], [], []], 0
        if size:
            yield rows(*held)

    return contexts_.select("key", "start", "said").mapInArrow(work, ANCHORS)


class RunIndex:
    """The run-length index of a text: for each run of its Burrows-Wheeler transform, the suffixes on both sides of the
    run's head and the length on which they agree."""

    def __init__(self, text: np.ndarray):
        """text: numbers up to 256, 0 for a separator."""
        n = len(text)
        x = np.concatenate([text.astype(np.int64), np.zeros(8, np.int64)])
        # seven symbols in one number; a separator ends them, and differs from every other separator
        packed, alive = np.zeros(n, np.int64), np.ones(n, bool)
        for j in range(7):
            alive &= x[j : j + n] != 0
            packed = packed << 9 | np.where(alive, x[j : j + n], 0)
        ranks, depth, new = [], 7, ~alive
        del alive
        while True:
            order = np.argsort(packed, kind="stable")
            sorted_ = packed[order]
            change = sorted_[1:] != sorted_[:-1]
            if new is not None:  # of equal beginnings before different separators, the earlier separator is the less
                change |= new[order][1:]
                new = None
            rank = np.empty(n, np.int32)
            rank[order] = np.concatenate([np.zeros(1, np.int32), np.cumsum(change, dtype=np.int32)])
            if change.all():
                break
            ranks.append((depth, rank))
            packed = rank.astype(np.int64) * (n + 1)
            packed[: n - depth] += rank[depth:]
            packed[: n - depth] += 1
            depth *= 2
        del packed, sorted_
        bwt = x[order - 1]  # x[-1] is 0: nothing precedes the first suffix
        heads = np.flatnonzero((bwt[1:] != bwt[:-1]) | (bwt[1:] == 0)) + 1  # separators differ
        self.n, self.runs = n, len(heads) + 1
        at, source = order[heads], order[heads - 1]
        by_place = np.argsort(at)
        self.at, self.source = at[by_place], source[by_place]
        # the length on which both agree, from the longest compared depth down
        length = np.zeros(len(heads), np.int64)
        for depth, rank in reversed(ranks):
            a, b = self.at + length, self.source + length
            ok = np.flatnonzero((a < n) & (b < n))
            ok = ok[rank[a[ok]] == rank[b[ok]]]
            length[ok] += depth
        for _ in range(6):
            a, b = self.at + length, self.source + length
            ok = np.flatnonzero((a < n) & (b < n))
            length[ok[(x[a[ok]] == x[b[ok]]) & (x[a[ok]] != 0)]] += 1
        self.length = length

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """At each place: the length of the match with the preceding suffix (0 for the first one's), and where that stands."""
        run = np.searchsorted(self.at, np.arange(self.n), "right") - 1
        known = run >= 0
        run = np.maximum(run, 0)
        past = np.arange(self.n) - self.at[run] if len(self.at) else np.zeros(self.n, np.int64)
        if not len(self.at):
            return np.zeros(self.n, np.int64), np.arange(self.n)
        length = np.where(known, np.maximum(self.length[run] - past, 0), 0)
        return length, np.where(length > 0, self.source[run] + past, np.arange(self.n))


def marked(text: np.ndarray, places: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Which of the places start a string of `width` that also starts earlier in the text; none may reach over a separator."""
    length, source = RunIndex(text).statistics()
    # along matches of the full width, every string leads to the same suffix, the first of its kind in order
    to = np.where(length >= width, source, np.arange(len(text)))
    while True:
        further = to[to]
        if (further == to).all():
            break
        to = further
    earliest = np.full(len(text), len(text), np.int64)
    np.minimum.at(earliest, to[places], places)
    return earliest[to[places]] < places


def search(contexts_: DataFrame) -> DataFrame:
    """Spans of the marked strings; no group has more than INDEX bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[list[tuple]] = []  # contexts of complete groups
        group: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            rows = [r for g in ready for r in g]
            text = np.frombuffer(b"".join(r[3] + b"\0" for r in rows), np.uint8).astype(np.int16) + 1
            lengths = np.array([len(r[3]) for r in rows])
            base = np.cumsum(lengths + 1) - lengths - 1
            text[base + lengths] = 0
            places = ranges(base, lengths - WIDTH + 1)
            places = places[marked(text, places)]
            owner = np.searchsorted(base, places, "right") - 1
            found = []
            for i in np.unique(owner):
                a, b = spans_of(places[owner == i] - base[i] + rows[i][2], WIDTH)
                found += [(rows[i][1], s, e) for s, e in zip(a.tolist(), b.tolist())]
            if found:
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array([SPAN] * len(found), pa.int32())], ["key", "a", "b", "kind"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][0] != row[0]:
                    if len(group) > 1:
                        more = sum(len(r[3]) for r in group)
                        if ready and size + more > INDEX:
                            yield from out()
                            ready, size = [], 0
                        ready.append(group)
                        size += more
                    group = []
                group.append(row)
        if len(group) > 1:
            if ready and size + sum(len(r[3]) for r in group) > INDEX:
                yield from out()
                ready = []
            ready.append(group)
        if ready:
            yield from out()

    return contexts_.repartition("grp").sortWithinPartitions("grp", "key", "start").mapInArrow(work, "key long, a long, b long, kind int")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """key, a and b: ranges of bytes to remove; docs as keyed() gives them."""
    ship()
    resolved = materialise(resolve(find_anchors(docs), WIDTH, True))
    asked_for = materialise(contexts(asked(docs, resolved)))
    small, large = split(asked_for, INDEX)
    found = materialise(search(small)).unionByName(materialise(resolve(strings(large), WIDTH, True, ask=False)))
    release(asked_for)
    return resolved.unionByName(found)


def cut(docs: DataFrame) -> DataFrame:
    """doc_id, text (what is left of it) and what was removed; docs: doc_id and text."""
    own = keyed(docs)
    rows = with_spans(own, repeated_spans(own))
    schema = "doc_id long, kept_text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = []
                for text, froms, tos in zip(*(part.column(i).to_pylist() for i in (1, 2, 3))):
                    raw = np.frombuffer(text.encode(), np.uint8)
                    gone = covered(len(raw), froms, tos)
                    kept_ = raw[~gone].tobytes()
                    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    found.append((kept_.decode(errors="ignore"), len(raw), int(gone.sum()), spans, hashlib.sha256(kept_).hexdigest()))
                columns = list(zip(*found))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(work, schema)


def cut_table(docs: DataFrame) -> DataFrame:
    """docs with all their columns, text without what cut() removes and n_chars, if there is one, of what is left.

    docs must give the same rows each time it is read, as a stored table does.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    key, froms_, tos_ = unused(docs, "doc_key"), unused(docs, "cut_froms"), unused(docs, "cut_tos")
    if has_keys(ids):
        rows = docs.withColumn(key, F.col("doc_id").cast("long"))
    else:  # the number of a stored row tells equal doc_ids apart; their order decides what is earlier
        row = unused(docs, "row_number")
        numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()))
        ordered = numbered.select(F.col("doc_id").cast("long").alias("o_id"), F.col(row).alias("o_row")).repartitionByRange("o_id", "o_row").sortWithinPartitions("o_id", "o_row")
        order = materialise(ordered.select("o_row", F.monotonically_increasing_id().alias(key)))
        rows = numbered.join(order.withColumnRenamed("o_row", unused(docs, "o_row")), F.col(row) == F.col(unused(docs, "o_row"))).select(*docs.columns, key)
    spans = repeated_spans(rows.select(F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text")))
    of = unused(docs, "cut_key")
    lists = spans.filter(F.col("kind") == SPAN).groupBy(F.col("key").alias(of)).agg(F.collect_list("a").alias(froms_), F.collect_list("b").alias(tos_))
    joined = rows.join(lists, F.col(key) == F.col(of), "left").select(*docs.columns, froms_, tos_)
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                columns = list(part.columns)
                froms, tos = columns[-2].to_pylist(), columns[-1].to_pylist()
                texts = columns[at].to_pylist()
                for i, (text, f) in enumerate(zip(texts, froms)):
                    if f:
                        raw = np.frombuffer(text.encode(), np.uint8)
                        texts[i] = raw[~covered(len(raw), f, tos[i])].tobytes().decode(errors="ignore")
                if chars is not None:
                    old = columns[chars].to_pylist()
                    columns[chars] = pa.array([len(t) if f else n for t, f, n in zip(texts, froms, old)], columns[chars].type)
                columns[at] = pa.array(texts, columns[at].type)
                yield pa.RecordBatch.from_arrays(columns[:-2], names)

    names = docs.columns
    return joined.mapInArrow(work, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(table(spark, sf_dir, "documents")).drop("kept_text")
