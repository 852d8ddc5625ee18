"""What the two operators on long repeats share: keys for documents, hashing, and finding which anchors recur.

An anchor is a place in a document that every equal passage has at the same offset. The windows (passages of the fixed length)
that choose an anchor lie in its context. An anchor's name is a hash of what stands there, its context hash
one of the whole context: with both equal, all its windows recur. Anchors of equal name but different contexts are
requests: their windows have to be compared one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_of

#: Bytes of text that a task works on together; a longer document comes alone.
FLUSH = 2 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
#: The kinds of row that resolve() takes and gives.
SPAN, ANCHOR, REQUEST = 0, 1, 2
ANCHORS = "name long, ctx long, key long, loc long, kind int"
RESOLVED = "key long, a long, b long, kind int"


def has_keys(docs: DataFrame) -> bool:
    """Whether doc_id is never null and never repeated."""
    return not docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").limit(1).take(1)


def keyed(docs: DataFrame) -> DataFrame:
    """key, doc_id and text. key orders documents as doc_id does and tells rows apart: it is doc_id if that is unique and
    not null, else a number that follows (doc_id, text), nulls first. docs must give the same rows each time they are read."""
    own = text_of(docs)
    if has_keys(own):
        return own.select(F.col("doc_id").alias("key"), "doc_id", "text")
    ordered = own.repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text")
    return materialise(ordered.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


class Powers:
    """Powers of an odd number and of its inverse, modulo 2 ** 64: a sum of x[i] * up[i], times down[start], does not depend on the start."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> Powers:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base)])) for base in (ODD, inverse))
        return self


def prefix_sums(x: np.ndarray, powers: Powers) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * powers.up[: len(x)])])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    total = np.cumsum(sizes)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - total + sizes, sizes)


def spans_of(places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Merged ranges that the windows starting at ascending places cover."""
    if not len(places):
        return places, places
    cut = np.flatnonzero(np.diff(places) > width)
    return places[np.concatenate([[0], cut + 1])], places[np.concatenate([cut, [len(places) - 1]])] + width


def grouped(batches: Iterator[pa.RecordBatch], size: Callable[[str], int]) -> Iterator[tuple[list[int], list[str]]]:
    """Keys and texts of about FLUSH bytes at a time."""
    keys, texts, total = [], [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                keys.append(key)
                texts.append(text)
                total += size(text)
                if total >= FLUSH:
                    yield keys, texts
                    keys, texts, total = [], [], 0
    if keys:
        yield keys, texts


def anchor_rows(name: np.ndarray, ctx: np.ndarray, key: np.ndarray, start: np.ndarray, last: np.ndarray, place: np.ndarray, width: int, keep_first: bool) -> pa.RecordBatch:
    """Rows for resolve(): of anchors alike in name and context the first alone, and what the others cover as spans.

    start, last: the first and last window of each anchor; place: where it stands. This is the pre-aggregation before the
    shuffle: a group of copies sends one row for each flush, whatever its size. Without keep_first the first one is covered too.
    """
    order = np.lexsort((start, key, ctx, name))
    name, ctx, key, start, last, place = (x[order] for x in (name, ctx, key, start, last, place))
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (ctx[1:] != ctx[:-1])
    loc = start << 16 | (last - start) << 8 | (place - start)
    covered = ~new
    if not keep_first:
        covered[:-1] |= covered[1:].copy()
    who = np.argsort(key[covered], kind="stable")
    k, a, b = key[covered][who], start[covered][who], last[covered][who] + width
    spread = mix(k.view(np.uint64) + a.view(np.uint64) * ODD).view(np.int64)
    n, m = int(new.sum()), len(k)
    columns = [(name[new].view(np.int64), spread), (ctx[new].view(np.int64), b), (key[new], k), (loc[new], a), (np.full(n, ANCHOR, np.int32), np.full(m, SPAN, np.int32))]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["name", "ctx", "key", "loc", "kind"])


def resolve(anchors: DataFrame, width: int, keep_first: bool, ask: bool = True) -> DataFrame:
    """Spans (a to b) that recurring anchors cover, and requests (a: loc, b: name) for the contexts of names that have several.

    keep_first: of anchors alike in name and context, the first (by key, then loc) is not covered. Rows stream in sorted order;
    the state is the row that began the current group, so a group of any size needs no memory.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the pending first row of a group: its values, whether it has a copy, whether the group before had its name
        held, copied, before = None, False, False

        def out(rows: np.ndarray, has_copy: np.ndarray, several: np.ndarray) -> Iterator[pa.RecordBatch]:
            name, _, key, loc = rows
            parts = []
            if not keep_first:
                at = np.flatnonzero(has_copy)
                parts.append((key[at], loc[at] >> 16, (loc[at] >> 16) + (loc[at] >> 8 & 255) + width, SPAN))
            if ask:
                at = np.flatnonzero(several)
                parts.append((key[at], loc[at], name[at], REQUEST))
            yield from give(parts)

        def give(parts: list) -> Iterator[pa.RecordBatch]:
            parts = [p for p in parts if len(p[0])]
            if parts:
                columns = [np.concatenate(c) for c in zip(*[p[:3] for p in parts])]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.concatenate([np.full(len(p[0]), p[3], np.int32) for p in parts]))], ["key", "a", "b", "kind"])

        for batch in batches:
            if not batch.num_rows:
                continue
            name, ctx, key, loc, kind = (c.to_numpy() for c in batch.columns)
            yield from give([(key[kind == SPAN], loc[kind == SPAN], ctx[kind == SPAN], SPAN)])
            rows = np.stack([name, ctx, key, loc])[:, kind == ANCHOR]
            if not rows.shape[1]:
                continue
            if held is not None:
                rows = np.concatenate([held, rows], 1)
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
            at = np.flatnonzero(~new)
            a = rows[3, at] >> 16
            yield from give([(rows[2, at], a, a + (rows[3, at] >> 8 & 255) + width, SPAN)])
            first = np.flatnonzero(new)
            has_copy = np.diff(np.concatenate([first, [rows.shape[1]]])) > 1
            has_copy[0] |= copied
            heads = rows[:, first]
            same = heads[0, 1:] == heads[0, :-1]
            several = np.concatenate([[before], same]) | np.concatenate([same, [False]])
            yield from out(heads[:, :-1], has_copy[:-1], several[:-1])
            held, copied, before = heads[:, -1:], bool(has_copy[-1]), bool(several[-1])
        if held is not None:
            yield from out(held, np.array([copied]), np.array([before]))

    return anchors.repartition("name").sortWithinPartitions("name", "ctx", "key", "loc").mapInArrow(work, RESOLVED)


def asked(docs: DataFrame, resolved: DataFrame) -> DataFrame:
    """key, text and the requests (locs, names) of each document that has any."""
    requests = resolved.filter(F.col("kind") == REQUEST).groupBy("key").agg(F.collect_list("a").alias("locs"), F.collect_list("b").alias("names")).withColumnRenamed("key", "r_key")
    return docs.join(requests, F.col("key") == F.col("r_key")).select("key", "text", "locs", "names")


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, text, and the ranges to remove, in any order and overlapping (null for none)."""
    lists = spans.filter(F.col("kind") == SPAN).groupBy("key").agg(F.collect_list("a").alias("froms"), F.collect_list("b").alias("tos")).withColumnRenamed("key", "s_key")
    return docs.join(lists, F.col("key") == F.col("s_key"), "left").select("doc_id", "text", "froms", "tos")


def covered(n: int, froms: list[int] | None, tos: list[int] | None) -> np.ndarray:
    """Which of n places the ranges cover."""
    change = np.zeros(n + 1, np.int32)
    if froms is not None and len(froms):
        np.add.at(change, np.asarray(froms), 1)
        np.add.at(change, np.asarray(tos), -1)
    return np.cumsum(change[:-1]) > 0
