"""Token ids in files of 64-bit words: Simple-8b with escapes and block offsets.

Documents in ascending id order are tokenized and packed into segments, each a binary value in
a row of a Parquet table, so that the writer's commit protocol covers lost executors. A segment
holds, in little-endian order: magic, ids a block, documents, ids and words (8s, 4 x u8);
document ids (i8), whether an id is null (u1), ids a document (u4), the first word of each block
and the number of words (u4), and the words (u8).

A word's top 4 bits say how many ids of how many bits follow from its lowest bits up. Selector 0
is an escape: the next word is one id of over 60 bits. Blocks hold a fixed number of ids and begin
at a known word, so all blocks of a segment are packed and unpacked side by side.

Added tokens of the vocabulary (``<|endoftext|>``), spelled exactly so in a text, are one id each, as
the library has it, or are encoded like any other characters, as ``write_ids`` is told.

A null text has only the end id. Null document ids come first, equal ones in text order; each row
keeps its own entry. An empty table gives no entries. Other columns aren't stored.
"""

from __future__ import annotations

import functools
import re
import string
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from trawl.llm.common import binary, ends_to_offsets, give_back, ragged, slices

MAGIC = b"S8BIDS01"
BLOCK = 256
#: Ids a segment holds at least, but for the last of a task.
SEGMENT = 1 << 19
#: Fixed values of the coding: ids a word and bits an id, by selector; 0 is the escape.
COUNTS = (0, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
#: Runs of anything but the White_Space code points.
WORD = re.compile("[^\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+")
#: Lower-case letters that lower-casing and composing leave alone.
PLAIN = "^[a-z\xdf-\xf6\xf8-\xff]+$"
#: What a letter that such a word ends with is always cut from: nothing in it is composed or an apostrophe.
MARKS = "".join(sorted(set(string.punctuation) - {"'"}))
#: Bytes of text whose distinct words are told apart and encoded at once.
SLICE_BYTES = 16 << 20


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The words of all blocks, and the first word of each block (one more at the end). A word
    takes the selector with most ids that hold what comes next. That is found for all places at
    once; then all blocks go from word to word side by side."""
    n = len(values)
    blocks, width = -(-n // block), block + max(COUNTS)
    held = np.zeros((blocks, width), np.uint64)  # behind a block's end zeros, which fit anywhere
    held[:, :block] = np.pad(values.astype(np.uint64), (0, blocks * block - n)).reshape(blocks, block)
    level = np.zeros(held.shape, np.uint8)  # the bits of so many selectors are too few
    for bits in BITS[1:]:
        if int(held.max(initial=0)) >> bits:
            level += held >= np.uint64(1 << bits)
    chosen = np.zeros((blocks, block), np.uint8)
    most, reach = level, 1  # the highest level of ``reach`` ids from each place on
    for selector in range(15, 0, -1):
        while reach < COUNTS[selector]:
            more = min(reach, COUNTS[selector] - reach)
            most = np.maximum(most[:, :-more], most[:, more:])
            reach += more
        np.putmask(chosen, most[:, :block] < selector, selector)
    chosen, begins = chosen.ravel(), np.zeros(blocks * block, bool)
    used = np.maximum(np.array(COUNTS), 1)
    at = np.arange(0, n, block)
    ends = np.minimum(at + block, n)
    while len(at):
        begins[at] = True
        at = at + used[chosen[at]]
        more = at < ends
        at, ends = at[more], ends[more]
    at = np.flatnonzero(begins)
    owner, selector = at // block, chosen[at]
    at = at + owner * (width - block)
    escaped, held = selector == 0, held.ravel()
    place = ends_to_offsets(1 + escaped)
    words = np.zeros(place[-1], np.uint64)
    words[place[:-1][escaped] + 1] = held[at[escaped]]
    for k in range(1, 16):
        mine = np.flatnonzero(selector == k)
        if len(mine):
            word = np.full(len(mine), k << 60, np.uint64)
            for i in range(COUNTS[k] if BITS[k] else 0):
                word |= held[at[mine] + i] << np.uint64(BITS[k] * i)
            words[place[mine]] = word
    return words, place[np.searchsorted(owner, np.arange(blocks + 1))]


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids back; all words of one selector at once."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    raw[1:] = selector[:-1] == 0  # an escaped id has over 60 bits, so it is no escape itself
    count = np.where(raw, 1, np.array(COUNTS)[selector])
    before = ends_to_offsets(count)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = before[:-1] - before[offsets[:-1]][owner] + owner * block
    limit = np.minimum((owner + 1) * block, n)
    out[at[raw]] = words[raw]
    for k in range(2, 16):  # selector 1 is all zeros
        mine = np.flatnonzero((selector == k) & ~raw)
        mask = np.uint64((1 << BITS[k]) - 1)
        for i in range(COUNTS[k]):
            there = mine[at[mine] + i < limit[mine]]
            out[at[there] + i] = words[there] >> np.uint64(BITS[k] * i) & mask
    return out


def to_segment(doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = pack(ids)
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([
        struct.pack("<8s4Q", MAGIC, BLOCK, len(doc_ids), len(ids), len(words)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), nulls.tobytes(),
        np.asarray(counts, "<u4").tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes(),
    ])


def from_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, whether they are null, ids a document, and all ids."""
    magic, block, docs, n, n_words = struct.unpack_from("<8s4Q", data)
    if magic != MAGIC:
        raise ValueError("not a segment of ids")
    at = struct.calcsize("<8s4Q")

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    doc_ids, nulls, counts = take("<i8", docs), take("u1", docs).astype(bool), take("<u4", docs)
    offsets = take("<u4", -(-n // block) + 1).astype(np.int64)
    return doc_ids, nulls, counts.astype(np.int64), unpack(take("<u8", n_words), offsets, n, block)


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@functools.lru_cache(maxsize=2)
def _plain_tokenizer(path: str):
    """The same without what changes or cuts nothing in words that match ``PLAIN``, and how it spells them."""
    from tokenizers import Tokenizer, pre_tokenizers
    tokenizer = Tokenizer.from_str(_tokenizer(path).to_str())
    tokenizer.normalizer, tokenizer.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
    spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    return tokenizer, {c: spell(chr(c))[0][0] for c in range(0xDF, 0x100)}


def _runs(text: str) -> list[str]:
    text = text.encode().lower().decode()
    # split() also cuts at these four, which aren't White_Space
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return WORD.findall(text)
    return text.split()


class WordEncoder:
    """Ids of texts by the tokenizers library. The vocabulary's normalizer and splitter work on
    each run of anything but white space alone, so distinct runs are encoded once. It lower-cases
    and cuts between a letter and a full stop or comma, so A-Z are lower-cased before and what
    such marks end is encoded without them. A run of letters is one word to it, whose last token
    alone is a word end, so the library gets many of them in one text; most letters need no
    normalizer and no pattern either. Arrow cuts texts at white space and numbers runs."""

    TOGETHER = 400

    def __init__(self, path: str, added_tokens: bool = False):
        self.tokenizer, (self.plain, self.spelling) = _tokenizer(path), _plain_tokenizer(path)
        self.added, self.spelled, self.cut = {}, [], None
        if added_tokens:
            self._cut_at_added()
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _cut_at_added(self) -> None:
        """The library looks for added tokens in the raw text, before anything else, and treats what is
        between them as texts of their own. As words, they are marked with a space in front."""
        tokens = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in tokens.values()):
            raise ValueError("added tokens that aren't found exactly as spelled")
        self.added = {" " + t.content: i for i, t in tokens.items()}
        self.spelled = sorted((t.content for t in tokens.values()), key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.spelled)) + ")")

    def _words(self, text: str | None) -> list[str]:
        text = text or ""
        pieces = self.cut.split(text) if any(token in text for token in self.spelled) else [text]
        words = _runs(pieces[0])
        for token, piece in zip(pieces[1::2], pieces[2::2]):
            words.append(" " + token)
            words += _runs(piece)
        return words

    def _encode(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.int32) for e in found]

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts: all, where each part's begin and how many it has."""
        sizes, order, found, alone = np.zeros(len(parts), np.int64), [], [], []
        easy = pc.match_substring_regex(parts, PLAIN).to_numpy(zero_copy_only=False)
        parts = parts.to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(~easy).tolist()
        letters = [i for i in rest if parts[i].isalpha()]
        for which, tokenizer in ((np.flatnonzero(easy), self.plain), (np.array(letters, np.int64), self.tokenizer)):
            groups = [which[a:a + self.TOGETHER] for a in range(0, len(which), self.TOGETHER)]
            texts = [" ".join(parts[group]) for group in groups]
            if tokenizer is self.plain:
                texts = [text if text.isascii() else text.translate(self.spelling) for text in texts]
            for group, ids in zip(groups, self._encode(texts, tokenizer)):
                lasts = np.flatnonzero(self.is_end[ids])
                if len(lasts) != len(group):  # letters that normalization takes apart
                    alone += group.tolist()
                    continue
                sizes[group] = np.diff(lasts, prepend=-1)
                order.append(group)
                found.append(ids)
        marked = [i for i in rest if parts[i] in self.added]
        alone += [i for i in rest if not parts[i].isalpha() and parts[i] not in self.added]
        each = self._encode([parts[i] for i in alone]) + [np.array([self.added[parts[i]]], np.int32) for i in marked]
        alone += marked
        sizes[alone] = [len(x) for x in each]
        order = np.concatenate([*order, np.array(alone, np.int64)])
        starts = np.zeros(len(parts), np.int64)
        starts[order] = ends_to_offsets(sizes[order])[:-1]
        return np.concatenate([np.zeros(0, np.int32), *found, *each]), starts, sizes

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct words, and where each word's begin (one more at the end)."""
        stems = pc.ascii_rtrim(words, characters=MARKS)
        ending = pc.and_(pc.not_equal(stems, words), pc.match_substring_regex(stems, "[a-z]$"))
        if self.added:
            ending = pc.and_not(ending, pc.is_in(words, pa.array(list(self.added), words.type)))
        cut = np.flatnonzero(ending.to_numpy(zero_copy_only=False))
        tails = [w[len(s):] for w, s in zip(*(x.take(pa.array(cut)).to_numpy(zero_copy_only=False) for x in (words, stems)))]
        parts = pa.concat_arrays([pc.if_else(ending, stems, words), pa.array(tails, words.type)]).dictionary_encode()
        flat, starts, sizes = self._parts(parts.dictionary)
        number = parts.indices.to_numpy()
        number = np.insert(number[:len(words)], cut + 1, number[len(words):])
        own = np.ones(len(words), np.int64)
        own[cut] = 2
        return ragged(flat, starts[number], sizes[number]), ends_to_offsets(sizes[number])[ends_to_offsets(own)]

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, each as a place in a dictionary, and their number for each text."""
        # Arrow doesn't know added tokens, and cuts at the four marks of ``_runs`` too
        if any(pc.any(pc.match_substring(texts, mark)).as_py() for mark in (*self.spelled, "\x1c", "\x1d", "\x1e", "\x1f")):
            each = [self._words(text) for text in texts.to_pylist()]
            words, counts = pa.array([w for words in each for w in words], pa.string()), [len(x) for x in each]
        else:
            cut = pc.utf8_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
            words, counts = cut.flatten(), pc.list_value_length(cut).to_numpy(zero_copy_only=False)
        return words.dictionary_encode(), ends_to_offsets(counts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and their number for each text."""
        words, each = self._cut(texts)
        flat, ends = self._word_ids(words.dictionary)
        number = words.indices.to_numpy()
        begin = ends[number]
        sizes = ends[number + 1] - begin
        return ragged(flat, begin, sizes), np.diff(ends_to_offsets(sizes)[each])


def cut_at(counts: np.ndarray, ids: int) -> list[tuple[int, int]]:
    """From and to which document each run of about so many ids goes."""
    cuts = (np.flatnonzero(np.diff((np.cumsum(counts) - counts) // ids)) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(counts)]))


SCHEMA = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("before", T.LongType()),
    T.StructField("n_ids", T.LongType()), T.StructField("segment", T.BinaryType()),
])


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int,
              id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> None:
    """Tokenize ``docs``, end each document with ``end_id`` and write the ids in ascending order of
    ``id_col`` to ``path``. With ``added_tokens``, those of the vocabulary are told apart in the texts, as
    the library does unless ``encode_special_tokens`` is set. Texts are sorted before they are tokenized, so that the sort's
    sampling doesn't tokenize them a second time."""
    ordered = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t")) \
        .repartitionByRange("d").sortWithinPartitions("d", "t")

    def run(batches):
        encoder, before, part = WordEncoder(tokenizer, added_tokens), 0, TaskContext.get().partitionId()
        doc_ids, counts, parts = [], [], []

        def row():
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_pylist([{
                "part": part, "before": before, "n_ids": len(ids),
                "segment": to_segment(doc_ids, np.concatenate(counts), ids)}], schema=arrow)

        arrow = pa.schema([("part", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()), ("segment", pa.binary())])
        for batch in batches:
            for piece in slices(batch, 1, SLICE_BYTES):
                (ids, n), names = encoder.encode(piece.column(1)), piece.column(0).to_pylist()
                ends = ends_to_offsets(n)
                for a, b in cut_at(n, SEGMENT):
                    parts.append(np.insert(ids[ends[a]:ends[b]], ends[a + 1:b + 1] - ends[a], end_id))
                    counts.append(n[a:b] + 1)
                    doc_ids += names[a:b]
                    if sum(map(len, parts)) >= SEGMENT:
                        yield row()
                        before += sum(map(len, parts))
                        doc_ids, counts, parts = [], [], []
        if doc_ids:
            yield row()
        del encoder, counts, parts
        give_back()

    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row a document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (binary, little-endian unsigned 32-bit integers).

    Where a writer's task begins follows from the tasks' totals: a row a task, which is what is
    ordered in one place and broadcast."""
    files = spark.read.schema(SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    placed = files.join(F.broadcast(begins), "part").select(
        (F.col("begin") + F.col("before")).alias("start"), "segment")

    def run(batches):
        for batch in batches:
            for start, segment in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, nulls, counts, ids = from_segment(segment.as_py())
                ends = ends_to_offsets(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, mask=nulls), pa.array(start + ends[:-1]), pa.array(counts),
                    binary(ids.astype("<u4").view(np.uint8), ends * 4)], names=schema.names)

    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return placed.mapInArrow(run, schema)
