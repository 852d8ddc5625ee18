"""Order-preserving packing of documents into sequences of bounded length.

Documents form a stream in the order in which their table stores them, each input split for itself. Cuts may fall at
document ends, at sentence ends, or at every GRID-th token of a document (so that no stretch is without a cut).
Dynamic programming chooses the cuts of least cost: the padding of each sequence, plus a penalty for a cut at a
sentence end or inside a sentence. A sequence is padded to the capacity, but one whose length is a power of two stays as it
is. So best[j] = penalty(j) + the lesser of capacity - P[j] + min(best[i] + P[i]) over the cuts i at most `capacity` tokens
before j (as that window only moves right, a monotone queue gives its minimum in constant time) and of best[i] over the
cuts i a power of two before j.

Pieces are given out as soon as all cuts that may still follow lead back to the same one, so they are those of the whole stream's
optimum. Should that not happen within LIMIT cuts, which takes a stream without any preference, the best cuts so far are taken.

Defined results: a null text is an empty one (the end id alone); rows that share a doc_id, or have none, are packed one for one;
an empty table gives an empty result; very long texts are cut like others; other columns are ignored. sequence_id is unique; it holds the number of
the input split in its upper bits.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import ship, table, text_of
from .records import library_encoder
from .tokens import kept

VOCABULARY, END_ID, CAPACITY = "byte_bpe_50k.json", 0, 1024
#: Tokens of padding that a cut at a sentence end, or inside a sentence, is worth avoiding for.
SENTENCE, INSIDE = 2, 12
#: Tokens between the cuts that are possible inside a sentence.
GRID = 32
#: Cuts after which pieces are given out, and those that may wait for it.
BLOCK, LIMIT = 20_000, 200_000
MARK = 0xFFFF
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [c.split()[0] for c in PIECES.split(", ")]


class Cuts:
    """The dynamic programme over a growing list of possible cuts; places ascend from 0, no two neighbours are further apart than capacity."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.powers = [1 << k for k in range(capacity.bit_length()) if 1 << k < capacity]
        self.places, self.best, self.last = [0], [0], [0]
        self.at = {0: 0}  # by place, of cuts within the capacity and some before
        self.queue = deque([(0, 0)])  # (best + place, cut), ascending in both

    def extend(self, places: list[int], penalties: list[int]) -> None:
        capacity, queue, powers, at = self.capacity, self.queue, self.powers, self.at
        all_places, best, last, look = self.places, self.best, self.last, self.at.get
        for p, penalty in zip(places, penalties):
            j = len(all_places)
            while p - all_places[queue[0][1]] > capacity:
                queue.popleft()
            value, i = queue[0]
            cost = value + capacity - p
            if cost:
                for size in powers:
                    k = look(p - size)
                    if k is not None and best[k] < cost:
                        cost, i = best[k], k
            cost += penalty
            all_places.append(p)
            best.append(cost)
            last.append(i)
            at[p] = j
            cost += p
            while queue and queue[-1][0] >= cost:
                queue.pop()
            queue.append((cost, j))

    def settled(self) -> int:
        """The latest cut through which every way to what may follow leads."""
        oldest = self.places[-1] - self.capacity
        open_ = [j for j in range(bisect_left(self.places, oldest), len(self.places))]
        waiting = set(open_)
        heap = [-j for j in open_]
        heapify(heap)
        while len(waiting) > 1:
            j = -heappop(heap)
            waiting.discard(j)
            i = self.last[j]
            if i not in waiting:
                waiting.add(i)
                heappush(heap, -i)
        return waiting.pop()

    def way(self, j: int) -> list[int]:
        """The places of the best cuts up to cut j."""
        found = []
        while j:
            found.append(self.places[j])
            j = self.last[j]
        return found[::-1]

    def drop(self, j: int) -> None:
        """Start anew at cut j; all that may follow leads through it."""
        origin, worth = self.places[j], self.best[j]
        self.places = [p - origin for p in self.places[j:]]
        self.best = [b - worth for b in self.best[j:]]
        self.last = [max(0, i - j) for i in self.last[j:]]
        self.queue = deque((c - worth - origin, i - j) for c, i in self.queue if i >= j)
        self.at = {p: i for i, p in enumerate(self.places)}


def choose(places: list[int], penalties: list[int], capacity: int) -> list[int]:
    """Cuts of least cost, as positions. places ascend from 0, no two neighbours are further apart than capacity; the last is a cut."""
    cuts = Cuts(capacity)
    cuts.extend(places[1:], penalties[1:])
    return cuts.way(len(places) - 1)


class Packer:
    """Takes documents in order and gives pieces: (doc_id, start, length, crc, doc_tokens, sequence_id, offset)."""

    def __init__(self, capacity: int, sequence_id: int, grid: int = GRID, block: int = BLOCK):
        self.capacity, self.sequence_id, self.grid, self.block = capacity, sequence_id, min(grid, capacity), block
        self.docs: list[tuple] = []  # (doc_id, ids, place in the stream), of those not yet packed
        self.cuts, self.origin, self.stop, self.next = Cuts(capacity), 0, 0, block

    def add(self, doc_id: int | None, ids: np.ndarray, sentences: np.ndarray) -> Iterator[tuple]:
        n = len(ids)
        penalty = np.zeros(n + 1, np.int64)
        inner = np.arange(self.grid, n, self.grid)
        penalty[inner] = INSIDE
        penalty[sentences] = SENTENCE
        at = np.unique(np.concatenate([inner, sentences[(sentences > 0) & (sentences < n)], [n]]))
        cost = penalty[at]
        cost[-1] = 0
        self.docs.append((doc_id, ids, self.stop))
        self.cuts.extend((at + (self.stop - self.origin)).tolist(), cost.tolist())
        self.stop += n
        if len(self.cuts.places) >= self.next:
            j = self.cuts.settled()
            if not j and len(self.cuts.places) >= LIMIT:
                j = self.cuts.last[-1]
            yield from self.give(j)
            self.next = len(self.cuts.places) + self.block

    def flush(self) -> Iterator[tuple]:
        """What is left of the stream."""
        yield from self.give(len(self.cuts.places) - 1)

    def give(self, j: int) -> Iterator[tuple]:
        """The pieces up to cut j."""
        d, lo = 0, self.origin
        for hi in (c + self.origin for c in self.cuts.way(j)):
            at = lo
            while at < hi:
                doc_id, ids, begin = self.docs[d]
                end = min(hi, begin + len(ids))
                piece = ids[at - begin : end - begin]
                yield doc_id, at - begin, end - at, zlib.crc32(piece.astype("<u4").tobytes()), len(ids), self.sequence_id, at - lo
                at = end
                if end == begin + len(ids):
                    d += 1
            self.sequence_id += 1
            lo = hi
        self.origin, self.docs = lo, self.docs[d:]
        self.cuts.drop(j)


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of a document in a sequence."""
    ship()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept(f"packing {vocabulary}", lambda: library_encoder(vocabulary, MARK))
        packer, rows = Packer(capacity, TaskContext.get().partitionId() << 40), []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], NAMES)

        for batch in batches:
            for key, found in zip(batch.column(0).to_pylist(), encode.texts(batch.column(1))):
                marked = np.frombuffer(found, "<u2")
                ends = np.flatnonzero(marked == MARK)
                ids = np.append(marked[marked != MARK], np.uint16(end_id))
                rows.extend(packer.add(key, ids, ends - np.arange(len(ends))))
                if len(rows) >= 4096:
                    yield out()
                    rows = []
        rows.extend(packer.flush())
        if rows:
            yield out()

    return text_of(docs).mapInArrow(work, PIECES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
