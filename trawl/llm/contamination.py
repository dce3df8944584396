"""Benchmark passages in documents, by Wu-Manber search for many strings at once.

Words are runs of digits, letters a-z after lower-casing A-Z, and code points from 128 on. A
window is 13 consecutive words of an item; an item of fewer, but not none, is one window. Texts
become their words with one space before, between and after, so that a window occurs exactly
where its string does.

Windows are searched in classes of similar length. Of each window's first m bytes, m the shortest
in its class, the shift table keeps how far from the end each block of bytes is; a position whose
block is in no window moves on by almost m bytes. Where the shift is zero, the block's hash bucket
has the windows to compare directly. Many positions of a slice of texts step side by side.

Null texts have no words, null items no windows, an item without id counts under the empty id.
Equal items both count; repeated document rows are judged alike. An empty benchmark hits nothing.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from trawl.llm.common import add_columns, ends_to_offsets, saved, utf8

WINDOW = 13
#: Bytes of item texts searched for in one pass; a longer benchmark is searched in blocks.
BLOCK_BYTES = 8 << 20
TABLE_BITS = 20
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def windows(text: bytes, size: int = WINDOW) -> set[bytes]:
    words = WORD.findall(text.lower())
    if not words:
        return set()
    return {b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))}


class Matcher:
    """Tables of one class of strings, none shorter than ``m``."""

    def __init__(self, strings: list[bytes]):
        self.m = min(map(len, strings))
        self.width = min(8, self.m)
        self.default = self.m - self.width + 1
        shift = np.full(1 << TABLE_BITS, self.default, np.int32)
        self.buckets: dict[int, list[int]] = {}
        for number, string in enumerate(strings):
            hashes = self.hashes(np.frombuffer(string[: self.m], np.uint8), np.arange(self.width - 1, self.m))
            np.minimum.at(shift, hashes, np.arange(self.default - 1, -1, -1, dtype=np.int32))
            self.buckets.setdefault(int(hashes[-1]), []).append(number)
        self.shift, self.strings = shift, strings

    def hashes(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the blocks that end at ``ends``."""
        block = np.zeros(len(ends), np.uint64)
        for k in range(self.width):
            block |= data[ends - k].astype(np.uint64) << np.uint64(8 * k)
        return (block * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, data: np.ndarray, text: bytes) -> list[tuple[int, int]]:
        """(string, first byte) of all occurrences. ``text`` is ``data`` as bytes."""
        stride = 1024
        at = np.arange(self.m - 1, len(data), stride)
        limit = np.minimum(at + stride, len(data))
        found = []
        while len(at):
            block = self.hashes(data, at)
            step = self.shift[block]
            for i in np.flatnonzero(step == 0):
                first = int(at[i]) - self.m + 1
                found += [(s, first) for s in self.buckets.get(int(block[i]), ())
                          if text.startswith(self.strings[s], first)]
            at = at + np.maximum(step, 1)
            inside = at < limit
            at, limit = at[inside], limit[inside]
        return found


class Searcher:
    """All windows of a block of items."""

    def __init__(self, items: list[tuple[str, bytes]], size: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for window in windows(text, size):
                owners.setdefault(window, set()).add(item)
        classes: dict[int, list[bytes]] = {}
        for window in owners:
            classes.setdefault(min(len(window) // 24, 3), []).append(window)
        self.owners, self.matchers = owners, [Matcher(x) for _, x in sorted(classes.items())]

    def search(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[set[str]], np.ndarray]:
        """For texts in one byte array: their numbers of words, which of all words are hit, the
        items with windows in each text, and each word's text."""
        data = _FOLD[data]
        word = _IS_WORD[data]
        # a text's end is no word byte, so that words don't run on into the next text
        first = word.copy()
        first[1:] &= ~word[:-1]
        inner = offsets[1:-1][offsets[1:-1] < len(data)]
        first[inner] = word[inner]
        owner_of_word = np.searchsorted(offsets, np.flatnonzero(first), "right") - 1
        n_words = np.bincount(owner_of_word, minlength=len(offsets) - 1)
        # each word byte moves right by the spaces before it: one for each word begun, one for each text
        # begun earlier, which follows that text's last word
        kept = np.flatnonzero(word)
        number = np.cumsum(first)[kept] - 1
        text_of = owner_of_word[number] if len(number) else number
        place = np.arange(len(kept)) + number + 1 + text_of
        size = len(kept) + len(owner_of_word) + len(offsets) + 1
        line = np.full(size, 32, np.uint8)
        line[place] = data[kept]
        starts = place[first[kept]]
        as_bytes = line.tobytes()
        hit = np.zeros(len(starts) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(len(offsets) - 1)]
        for matcher in self.matchers:
            for s, begin in matcher.find(line, as_bytes):
                window = matcher.strings[s]
                a = np.searchsorted(starts, begin + 1)
                b = np.searchsorted(starts, begin + len(window) - 1)
                hit[a] += 1
                hit[b] -= 1
                items[owner_of_word[a]] |= self.owners[window]
        return n_words, np.cumsum(hit[:-1]) > 0, items, owner_of_word


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", drop: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``item_ids`` (of
    items with occurring windows, sorted as strings), ``hit_words`` (numbers, from 0, of the hit
    words) and ``contaminated`` (at least a twentieth of the words is hit).

    Item texts reach the tasks in blocks of bounded size; each block is a pass over the rows that
    adds to what the passes before have found. A pass is written before the next block is collected, so
    driver and tasks hold one block at a time. Repeated items are held once."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"),
                             F.col(item_text).cast("binary").alias("t")).where("t IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_bytes))
    found = docs
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        last = block + 1 == blocks
        found = _add_hits(found, [(r["i"], bytes(r["t"])) for r in own.collect()], text_col, drop if last else (), block > 0)
        if not last:
            found = saved(found, "hits")
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def _add_hits(docs, items, text_col, drop, more) -> DataFrame:
    earlier = ["hit_words", "item_ids"] if more else []

    def start():
        searcher = Searcher(items)

        def step(texts: pa.Array, *before: pa.Array):
            n_words, hit, found, owner = searcher.search(*utf8(texts))
            firsts = ends_to_offsets(n_words)
            if before:
                for i, (words, ids) in enumerate(zip(before[0].to_pylist(), before[1].to_pylist())):
                    hit[firsts[i] + np.array(words, np.int64)] = True
                    found[i] |= set(ids)
            places = np.flatnonzero(hit)
            n_hit = np.bincount(owner[places], minlength=len(texts))
            numbers = places - firsts[owner[places]]
            return [
                pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                pa.ListArray.from_arrays(pa.array(ends_to_offsets(n_hit), pa.int32()), pa.array(numbers, pa.int64())),
            ]

        return step

    return add_columns(docs, [
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("hit_words", T.ArrayType(T.LongType())),
    ], [text_col, *earlier], start, drop)
