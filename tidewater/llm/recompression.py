"""Substring dedup by recompression: removes words of 35-word passages that occur more than once.

Words are the first symbols, named by a hash. Each of ROUNDS rounds names runs of one symbol, then pairs: a hash bit puts every
symbol left or right, and each left symbol followed by a right one becomes one symbol with it. A name is a hash of
what it stands for, so all tasks give equal runs and pairs the same name and Spark needs no table of names. A symbol carries the
words that its making depended on (its reach): equal words there give the same symbol, wherever they stand.

Every window of 35 words chooses, among the highest-level symbols whose reach it holds, the one of least
name (of a lower level where it holds none; words are level 0, so there is always one). Equal windows choose
alike. The chosen symbols meet by name (see repeats): what recurs with its whole context is covered at once; symbols of one name in
different contexts send their windows, which meet by one hash of their words and are verified by another, over other names of the words.

Windows are judged on the input, both occurrences count, windows never cross documents.

Defined results: a null text has no words; under 35 words nothing is removed; rows that share a doc_id, or have none, are
documents of their own; a very long text is worked on whole; exactly repeated rows count as repeats of each other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from .common import materialise, ship, table
from .repeats import ANCHORS, ODD, Powers, anchor_rows, asked, covered, grouped, keyed, mix, prefix_sums, ranges, resolve, sliding_min, with_spans
from .tokens import kept

WIDTH, ROUNDS = 35, 3
#: The words that a symbol may stand for, and the widest reach of a chosen symbol of each level.
LONGEST, REACH = 12, (1, 7, 12, 18)
#: What the second names of words differ by.
SECOND = np.uint64(0x5851F42D4C957F2D)
#: Names of words that a worker keeps.
KEPT = 800_000


def word_names(words: list[bytes]) -> np.ndarray:
    """A 64-bit name of each word."""
    names = kept("recompression names", dict)
    if len(names) > KEPT:
        names.clear()
    found = list(map(names.get, words))
    if None in found:
        digest = xxhash.xxh64_intdigest
        for w in {w for w, v in zip(words, found) if v is None}:
            names[w] = digest(w)
        found = list(map(names.__getitem__, words))
    return np.array(found, np.uint64)


class Symbols:
    """A sequence of symbols: name, words a to b, reach lo to hi. A barrier stands between documents and never joins anything."""

    def __init__(self, name, a, b, lo, hi, barrier):
        self.name, self.a, self.b, self.lo, self.hi, self.barrier = name, a, b, lo, hi, barrier

    def spread(self, left: np.ndarray, right: np.ndarray) -> None:
        """Let the marked symbols depend on their left or right neighbours."""
        lo, hi = self.lo, self.hi
        self.lo, self.hi = lo.copy(), hi.copy()
        i = np.flatnonzero(left[1:]) + 1
        self.lo[i], self.hi[i] = np.minimum(lo[i], lo[i - 1]), np.maximum(hi[i], hi[i - 1])
        i = np.flatnonzero(right[:-1])
        self.lo[i], self.hi[i] = np.minimum(self.lo[i], lo[i + 1]), np.maximum(self.hi[i], hi[i + 1])

    def joined(self, starts: np.ndarray, sizes: np.ndarray, name: np.ndarray) -> Symbols:
        """The groups of neighbours that begin at starts, under their new names."""
        ends = starts + sizes - 1
        return Symbols(name, self.a[starts], self.b[ends], np.minimum.reduceat(self.lo, starts), np.maximum.reduceat(self.hi, starts), self.barrier[starts])


def name_runs(s: Symbols) -> Symbols:
    """Runs of one symbol become one, unless they stand for more than LONGEST words."""
    equal = (s.name[1:] == s.name[:-1]) & ~s.barrier[1:] & ~s.barrier[:-1]
    starts = np.flatnonzero(np.concatenate([[True], ~equal]))
    sizes = np.diff(np.concatenate([starts, [len(s.name)]]))
    everyone = ~s.barrier
    long = s.b[starts + sizes - 1] - s.a[starts] > LONGEST
    run_lo, run_hi = np.minimum.reduceat(s.lo, starts), np.maximum.reduceat(s.hi, starts)
    s = Symbols(s.name, s.a, s.b, s.lo, s.hi, s.barrier)
    many = long & (sizes > 1)
    if many.any():  # their symbols stay, but that they stay depends on the whole run
        inside = np.repeat(many, sizes)
        s.lo, s.hi = np.where(inside, np.repeat(run_lo, sizes), s.lo), np.where(inside, np.repeat(run_hi, sizes), s.hi)
    # where a run ends depends on the neighbours
    s.spread(everyone, everyone)
    break_up = np.repeat(many, sizes)
    starts = np.flatnonzero(np.concatenate([[True], ~equal]) | break_up)
    sizes = np.diff(np.concatenate([starts, [len(s.name)]]))
    name = s.name[starts]
    run = sizes > 1
    name[run] = mix(name[run] * ODD + sizes[run].astype(np.uint64))
    return s.joined(starts, sizes, name)


def name_pairs(s: Symbols, level: int) -> Symbols:
    """A left symbol and the right one after it become one, unless they stand for more than LONGEST words."""
    right = (mix(s.name + np.uint64(level)) & np.uint64(1)).astype(bool)
    joins = ~right[:-1] & right[1:] & ~s.barrier[:-1] & ~s.barrier[1:] & (s.b[1:] - s.a[:-1] <= LONGEST)
    first, second = np.concatenate([joins, [False]]), np.concatenate([[False], joins])
    alone = ~first & ~second & ~s.barrier
    s = Symbols(s.name, s.a, s.b, s.lo, s.hi, s.barrier)
    s.spread(alone & right, alone & ~right)
    starts = np.flatnonzero(~second)
    sizes = np.where(first[starts], 2, 1)
    name = s.name[starts]
    pair = np.flatnonzero(sizes == 2)
    name[pair] = mix(mix(name[pair] * ODD) + s.name[starts[pair] + 1])
    return s.joined(starts, sizes, name)


def choices(names: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """Windows of all documents (word places), the place of each window's chosen symbol, and that symbol's name.

    names: the words of all documents, a gap of one word before the first and after each; starts, sizes: of the documents.
    """
    n = len(names)
    barrier = np.zeros(n, bool)
    barrier[0] = True
    barrier[starts + sizes] = True
    place = np.arange(n)
    s = Symbols(names, place, place + 1, place, place + 1, barrier)
    levels = [s]
    for level in range(1, ROUNDS + 1):
        s = name_pairs(name_runs(s), level)
        levels.append(s)
    windows = ranges(starts, np.maximum(sizes - width + 1, 0))
    sums, powers = _hashes(names)
    bits = np.uint64(n.bit_length())
    mask = (np.uint64(1) << bits) - np.uint64(1)
    most = np.uint64((1 << 64) - 1)
    chosen, name = np.full(len(windows), -1), np.zeros(len(windows), np.uint64)
    crossing = np.concatenate([[0], np.cumsum(barrier)])
    for level in range(ROUNDS, -1, -1):
        open_ = np.flatnonzero(chosen < 0)
        if not len(open_):
            break
        s, reach = levels[level], REACH[level]
        ok = ~s.barrier & (s.hi - s.lo <= reach) & (s.lo >= 0) & (s.hi <= n)
        lo, hi = s.lo[ok], s.hi[ok]
        inside = crossing[hi] == crossing[lo]
        lo, hi = lo[inside], hi[inside]
        # the name takes in all words of the reach: a symbol alone may stand for two words
        full = mix(s.name[ok][inside] + np.array([level], np.uint64) * ODD + (sums[hi] - sums[lo]) * powers.down[lo])
        at = np.full(n + width, most)
        np.minimum.at(at, lo, (full & ~mask) | lo.astype(np.uint64))
        least = sliding_min(at, width - reach + 1)[windows[open_]]
        found = least != most
        spots = (least[found] & mask).astype(np.int64)
        best = np.zeros(n + width, np.uint64)
        own = at[lo] == ((full & ~mask) | lo.astype(np.uint64))
        np.maximum.at(best, lo[own], full[own])
        chosen[open_[found]], name[open_[found]] = spots, best[spots]
    return windows, chosen, name


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of all words with a gap before the first document and after each, and the documents' starts and sizes."""
    split = [t.encode().split() for t in texts]
    sizes = np.array([len(w) for w in split])
    starts = np.cumsum(sizes + 1) - sizes
    names = np.zeros(int(sizes.sum() + len(sizes) + 1), np.uint64)
    if sizes.sum():
        names[ranges(starts, sizes)] = word_names([w for ws in split for w in ws])
    return names, starts, sizes


def _hashes(names: np.ndarray, second: bool = False) -> tuple[np.ndarray, Powers]:
    """Prefix sums over the words' names; the second ones are over others, so that no window that collides in one does so in both."""
    powers = kept("recompression powers", Powers).reach(len(names) + 1)
    return prefix_sums(mix(names ^ SECOND) if second else mix(names), powers), powers


def anchors_of(keys: list[int], texts: list[str], width: int = WIDTH) -> pa.RecordBatch | None:
    long = [(k, t) for k, t in zip(keys, texts) if len(t) >= 2 * width - 1]
    if not long:
        return None
    names, starts, sizes = _words([t for _, t in long])
    windows, place, name = choices(names, starts, sizes, width)
    if not len(windows):
        return None
    # a document's windows are neighbours; those that choose one symbol are, too
    cut = np.flatnonzero((np.diff(place) != 0) | (np.diff(windows) != 1) | (name[1:] != name[:-1])) + 1
    begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(windows)]]) - 1
    first, last, place, name = windows[begin], windows[end], place[begin], name[begin]
    sums, powers = _hashes(names, True)
    ctx = mix((sums[last + width] - sums[first]) * powers.down[first] + ((place - first) << 8 | (last - first)).astype(np.uint64) * ODD)
    doc = np.searchsorted(starts, first, "right") - 1
    base = starts[doc]
    return anchor_rows(name, ctx, np.array([k for k, _ in long], np.int64)[doc], first - base, last - base, place - base, width, False)


def find_anchors(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in grouped(batches, len):
            rows = anchors_of(keys, texts)
            if rows is not None:
                yield rows

    return docs.select("key", "text").mapInArrow(work, ANCHORS)


def windows_of(docs: DataFrame) -> DataFrame:
    """The windows that requests ask for, named by their words; a row for each name and batch, what repeats inside a batch as spans."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                keys, texts, locs = (part.column(i).to_pylist() for i in range(3))
                names, starts, _ = _words(texts)
                sums, powers = _hashes(names)
                others, _ = _hashes(names, True)
                loc = np.concatenate([np.array(x, np.int64) for x in locs])
                doc = np.repeat(np.arange(len(keys)), [len(x) for x in locs])
                more = (loc >> 8 & 255) + 1
                place = ranges((loc >> 16) + starts[doc], more)
                doc = np.repeat(doc, more)
                whole, other = ((x[place + WIDTH] - x[place]) * powers.down[place] for x in (sums, others))
                start = place - starts[doc]
                yield anchor_rows(mix(whole), mix(other), np.array(keys, np.int64)[doc], start, start, start, WIDTH, False)

    return docs.mapInArrow(work, ANCHORS)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """key, a and b: ranges of words to remove; docs as keyed() gives them."""
    ship()
    resolved = materialise(resolve(find_anchors(docs), WIDTH, False))
    found = materialise(resolve(windows_of(asked(docs, resolved)), WIDTH, False, ask=False))
    return resolved.unionByName(found)


def cut(docs: DataFrame) -> DataFrame:
    """doc_id, text (the kept words, one space between) and what was removed; docs: doc_id and text."""
    own = keyed(docs)
    rows = with_spans(own, repeated_spans(own))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = []
                for text, froms, tos in zip(*(part.column(i).to_pylist() for i in (1, 2, 3))):
                    words = text.encode().split()
                    if froms is not None and len(froms):
                        gone = covered(len(words), froms, tos).tolist()
                        left = [w for w, g in zip(words, gone) if not g]
                    else:
                        left = words
                    said = b" ".join(left)
                    found.append((said.decode(), len(words), len(words) - len(left), hashlib.sha256(said).hexdigest()))
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.int64(), pa.int64(), pa.string()]))], ["doc_id", "kept_text", "n_words", "n_removed", "kept_sha256"])

    return rows.mapInArrow(work, "doc_id long, kept_text string, n_words long, n_removed long, kept_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(table(spark, sf_dir, "documents")).drop("kept_text")
