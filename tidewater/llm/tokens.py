"""Encoding of whole texts by way of their distinct space-separated chunks.

A space that follows a character which is no space starts a new token in every tokenizer used here, so a text's
ids are those of its chunks, joined. Each worker process keeps the ids of chunks that it has seen, in a table of
bounded size; the tokenizer itself works on the others, in batches.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: A space after another one, of any kind.
AFTER_SPACE = "[\\x{9}-\\x{D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}] "
#: Closing marks, of which one after a letter is a token of its own.
MARKS = ".,;:!?"
#: Bytes of text whose chunks are looked up together, at least one text.
GROUP = 4 << 20
#: Chunks that a worker keeps: half of them in use, and the half that it used before.
KEPT = 1_200_000


def own(owner: str) -> dict:
    """What a worker process keeps for an operator; what another one left in it is dropped, so that stages do not add up."""
    store = sys.__dict__.setdefault("_tidewater_kept", {})
    if store.get("owner") != owner:
        held = len(store) > 1
        store.clear()
        store["owner"] = owner
        if held:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim:
                trim(0)
    return store


def kept(name: str, make: Callable):
    """A worker process makes each named thing once, whatever the number of its tasks. The name's first word tells the operator."""
    store = own(name.split(" ")[0])
    if name not in store:
        store[name] = make()
    return store[name]


def place(name: str) -> str:
    """A vocabulary file by name, or any path as it is."""
    return name if os.path.isabs(name) else public_tokenizers.path(name)


@functools.cache
def ends_a_word(letter: str) -> bool:
    """Whether a closing mark after this letter is a token of its own: also in normal form and lower case, as which some
    tokenizers read it, its last character has to be a letter."""
    return letter <= "\uffff" and letter.isalpha() and unicodedata.normalize("NFC", letter).lower()[-1].isalpha()


class Chunks:
    """Calling it gives the joined bytes of a text's chunks, which `many` makes from lists of chunks.

    The values are made of 16-bit units. A chunk that is not known yet is taken apart further where every tokenizer used here splits: at a single line end
    between two characters that are no spaces, and before one closing mark that follows a letter and ends the part.
    """

    def __init__(self, many: Callable[[list[str]], list[bytes]], limit: int = KEPT):
        self.many, self.limit = many, limit
        self.spaced: dict[str, bytes] = {}  # by chunk without its leading space
        self.bare: dict[str, bytes] = {}
        self.before: tuple[dict, dict] = {}, {}  # what the tables held before they were last renewed
        spaces = [c for c in map(chr, range(0x3001)) if c.isspace()]
        self.after_space = [c + " " for c in spaces]
        self.boundary = re.compile(r"(?<=\S)(?= )")

    @staticmethod
    def _parts(chunk: str) -> list[str]:
        """The chunk in parts: the first one as the chunk began, the others on their own."""
        lines = chunk.split("\n") if "\n" in chunk else [chunk]
        if len(lines) > 1 and not all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
            return [chunk]
        parts: list[str] = []
        for line in lines:
            if parts:
                parts.append("\n")
            if len(line) > 1 and line[-1] in MARKS and ends_a_word(line[-2]):
                parts += (line[:-1], line[-1])
            else:
                parts.append(line)
        return parts

    def _learn(self, table: dict[str, bytes], chunks: list[str], lead: str) -> None:
        old = self.before[not lead]
        if old and chunks:
            table.update((k, old[k]) for k in chunks if k in old)
            chunks = [k for k in chunks if k not in old]
        if chunks:
            table.update(zip(chunks, self.many([lead + k for k in chunks] if lead else chunks)))

    def _look(self, table: dict[str, bytes], keys: list[str], lead: str) -> list[bytes]:
        found = list(map(table.get, keys))
        if None not in found:
            return found
        bare, new, words, marked, others = self.bare, set(), [], [], []
        for i, v in enumerate(found):
            if v is None:
                key = keys[i]
                if key.isalpha():
                    words.append(i)
                    new.add(key)
                elif key[-1:] and key[-1] in MARKS and (stem := key[:-1]).isalpha() and ends_a_word(stem[-1]):
                    marked.append((i, stem, key[-1]))
                else:
                    others.append((i, self._parts(key)))
        new.update(x for _, x, _ in marked if x not in table)
        new.update(p[0] for _, p in others if p[0] not in table)
        self._learn(table, list(new), lead)
        new = {m for _, _, m in marked}
        new.update(x for _, p in others for x in p[1:])
        self._learn(bare, [x for x in new if x not in bare], "")
        for i in words:
            found[i] = table[keys[i]]
        for i, stem, mark in marked:
            found[i] = table[stem] + bare[mark]
        for i, p in others:
            found[i] = table[p[0]] if len(p) == 1 else table[p[0]] + b"".join([bare[x] for x in p[1:]])
        return found

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if len(self.spaced) + len(self.bare) > self.limit // 2:
            self.before, self.spaced, self.bare = (self.spaced, self.bare), {}, {}
        if any(pair in text for pair in self.after_space):
            return b"".join(self._look(self.bare, self.boundary.split(text), ""))
        first, *rest = text.split(" ")
        start = self._look(self.bare, [first], "") if first else []
        return b"".join(start + self._look(self.spaced, rest, " "))

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """What calling it gives for each of the texts; a chunk that recurs in a group of them is looked up once."""
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < len(texts):
            base = sizes[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, base + GROUP, "right")))
            collects = gc.isenabled()
            gc.disable()  # a group makes millions of small objects and no cycles
            try:
                found = self._group(texts.slice(lo, hi - lo).cast(pa.large_string()))
            finally:
                if collects:
                    gc.enable()
            yield from found
            lo = hi

    def _group(self, texts: pa.Array) -> list[bytes]:
        odd = pc.match_substring_regex(texts, AFTER_SPACE)
        found: list = [None] * len(texts)
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            found[i] = self(texts[i].as_py())
        rows = np.flatnonzero(~odd.to_numpy(zero_copy_only=False))
        if not len(rows):
            return found
        if len(self.spaced) + len(self.bare) > self.limit // 2:
            self.before, self.spaced, self.bare = (self.spaced, self.bare), {}, {}
        lists = pc.split_pattern(texts.take(pa.array(rows)) if len(rows) < len(texts) else texts, " ")
        flat, ends = lists.flatten(), lists.offsets.to_numpy()
        ends = ends - ends[0]
        first = ends[:-1]
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        inner = np.ones(len(codes), bool)
        inner[first] = False
        used = np.flatnonzero(np.bincount(codes[inner], minlength=len(coded.dictionary)))
        values = self._look(self.spaced, coded.dictionary.take(pa.array(used)).to_pylist(), " ")
        starts = flat.take(pa.array(first)).to_pylist()
        known = iter(self._look(self.bare, [x for x in starts if x], ""))
        number = np.zeros(len(coded.dictionary), np.int64)
        number[used] = np.arange(len(used))
        codes = number[codes]
        codes[first] = len(used) + np.arange(len(first))
        values += [next(known) if x else b"" for x in starts]
        pool = np.frombuffer(b"".join(values), "<u2")
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 2
        n = sizes[codes]
        stops = np.concatenate([[0], np.cumsum(n)])
        index = np.repeat(((np.cumsum(sizes) - sizes)[codes] - stops[:-1]).astype(np.int32), n)
        index += np.arange(len(index), dtype=np.int32)  # a group has fewer than 2^31 units, as has a text
        ids = pool[index].tobytes()
        bounds = (2 * stops[ends]).tolist()
        for i, a, b in zip(rows.tolist(), bounds, bounds[1:]):
            found[i] = ids[a:b]
        return found
