"""Byte-level BPE encoding and decoding with a public rank file.

A task numbers the distinct words of its rows. A word travels once, with the row that holds
it first, as an array of byte symbols; Spark's higher-order functions fold the ranked merges
over it, looking pairs up in a literal rank map. Each row's ids are then gathered by word
number. Nothing is shuffled, and what a task remembers is bounded by ``WORDS``.

Words are found in two steps: texts are cut before each space that something else follows,
where the tokenizer's pattern always cuts, and only distinct chunks meet the pattern.

Null texts are empty and give no ids. Rows are independent: ties, repeats and other columns
don't matter; an input column named like an output is replaced. An empty table stays empty.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trawl.llm.common import Growing, Numbers, add_columns, binary, ends_to_offsets, ragged, utf8

#: Distinct words, and chunks of text, a task remembers before it starts afresh with them.
WORDS, CHUNKS = 500_000, 150_000
#: Words with more symbols are merged with a heap instead: the fold's work grows with the square.
LONG = 512
NO_RANK = 2**31 - 1
#: Marks an element that a merge drops.
GONE = -1
#: Offsets among which left ids choose at first, the factor that spreads them, and choices before there are more.
SPREAD, MIX, TRIES = 1 << 19, 40_503, 10_000
#: The White_Space code points, which \s stands for in the tokenizer's pattern.
SPACE = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def word_pattern(pattern: str):
    """The split pattern with \\s spelt out, so that it means the same in every library."""
    return regex.compile(
        pattern.replace("[^\\s", f"[^{SPACE}").replace("\\S", f"[^{SPACE}]").replace("\\s", f"[{SPACE}]"))


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """``left id * 65536 + right id`` to the rank of the joined token."""
    out = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                out[left << 16 | right] = rank
    return out


def displaced(pairs: dict[int, int]) -> tuple[list, list]:
    """Each left id's offset, and the entries ``left id << 32 | rank`` at offset plus right id.
    The longest rows choose first among offsets that meet no taken place; a table too
    small for that is doubled."""
    rows: dict[int, list[int]] = {}
    for pair in pairs:
        rows.setdefault(pair >> 16, []).append(pair & 65_535)
    spread = SPREAD
    while True:
        offsets, taken = [None] * 65_536, np.zeros(spread + 65_536, bool)
        for left in sorted(rows, key=lambda x: (-len(rows[x]), x)):
            rights = np.array(rows[left])
            tries = (left * MIX + k * MIX for k in range(TRIES))
            offset = next((at % spread for at in tries if not taken[at % spread + rights].any()), None)
            if offset is None:
                break
            offsets[left] = offset
            taken[offset + rights] = True
        else:
            break
        spread *= 2
    table: list[int | None] = [None] * (spread + 65_536)
    for pair, rank in pairs.items():
        table[offsets[pair >> 16] + (pair & 65_535)] = pair >> 16 << 32 | rank
    return offsets, table


def with_ranks(pairs: dict[int, int], use) -> Column:
    """What ``use`` makes of the literal rank table, given to it as a function of two id Columns;
    ``NO_RANK`` where a pair has none.

    A map literal would be searched from its start, and many small maps are slow to send to
    every task, so the pairs are in one array, each at a place of its own. It is large, so the plan
    has it once, as the only element of an array that is passed to all lookups."""
    # Folded once while planning; a literal per number would take a call each.
    tables = (F.from_json(F.lit(json.dumps(x, separators=(",", ":"))), "array<bigint>") for x in displaced(pairs))

    def found(both: Column) -> Column:
        def rank(left: Column, right: Column) -> Column:
            # another left id's entry differs in its high bits, which is over any rank; least passes over null
            entry = both["table"][both["offsets"][left] + right]
            return F.least(entry.bitwiseXOR(F.shiftleft(left, 32)), F.lit(NO_RANK).cast("bigint"))

        return use(rank)

    return F.transform(F.array(F.struct(next(tables).alias("offsets"), next(tables).alias("table"))), found)[0]


class Vocabulary:
    """What encoding and decoding need of a rank file, which has at most 65,536 tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if len(ranks) > 65_536 or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a rank file has every single byte and at most 65,536 tokens")
        self.ranks, self.pattern = ranks, pattern
        self.pairs = pair_ranks(ranks)

    def token_bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        by_id = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            by_id[rank] = token
        lengths = np.array([len(t) for t in by_id], np.int64)
        return np.frombuffer(b"".join(by_id), np.uint8), np.cumsum(lengths) - lengths, lengths


@functools.lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(load_ranks(path), pattern)


def fold_merges(elements: Column, rank) -> Column:
    """The ids left of a word when the pair of lowest rank, the leftmost first, has been
    merged until no pair has a rank.

    An element holds the rank of its pair with the next one, its place in the word and its
    id, in this order of bits, so that the array's least element is the next merge and says
    where it is. A merge changes that element and the one before it, drops the one after it and
    moves the others up. All this is one pass over the array and a removal, as slices, joins
    and searches of small arrays cost several times as much."""
    def ranked(left: Column, right: Column, base: Column) -> Column:
        return F.shiftleft(rank(left, right), 32).bitwiseOR(base)

    def merge(acc: Column, least: Column, gone: Column) -> Column:
        token = F.shiftright(least, 32)  # a joined token's id is its rank
        merged = ranked(token, _token(F.get(acc, gone + 1)), least.bitwiseAND(F.lit(0xFFFF0000)).bitwiseOR(token))

        def changed(e: Column, i: Column) -> Column:
            return (F.when(i > gone, e - 0x10000).when(i == gone, F.lit(GONE)).when(e == least, merged)
                    .when(i < gone - 2, e).otherwise(ranked(_token(e), token, e.bitwiseAND(F.lit(0xFFFFFFFF)))))

        return F.array_remove(F.transform(acc, changed), F.lit(GONE))

    def after(least: Column) -> Column:
        return (F.shiftright(least, 16).bitwiseAND(F.lit(0xFFFF)) + 1).cast("int")

    def step(acc: Column, _: Column) -> Column:
        # an array of one element stands for a local name
        return F.transform(F.array(F.array_min(acc)), lambda least: F.when(least >= NO_RANK * 2**32, acc).otherwise(
            F.transform(F.array(after(least)), lambda gone: merge(acc, least, gone))[0]))[0]

    folded = F.aggregate(F.sequence(F.lit(1), F.size(elements) - 1), elements, step,
                         lambda acc: F.transform(acc, _id))
    return (F.when(F.size(elements) < 2, F.transform(elements, _id))
            .when(F.size(elements) > LONG, F.transform(elements, lambda e: -1 - _id(e))).otherwise(folded))


def _token(element: Column) -> Column:
    return element.bitwiseAND(F.lit(0xFFFF))


def _id(element: Column) -> Column:
    return _token(element).cast("int")


def heap_merges(ids: list[int], pairs: dict[int, int]) -> list[int]:
    """The same for a very long word, with a heap of candidate pairs."""
    ids, n = list(ids), len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive, heap = [True] * n, []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := pairs.get(ids[i] << 16 | ids[j])) is not None:
            heap.append((rank, i, ids[i], ids[j])) if building else heapq.heappush(heap, (rank, i, ids[i], ids[j]))

    building = True
    for i in range(n - 1):
        offer(i)
    heapq.heapify(heap)
    building = False
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or ids[i] != left or ids[j] != right:
            continue
        ids[i], alive[j] = rank, False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [x for x, live in zip(ids, alive) if live]


#: A space before anything but white space; the pattern never joins it to what stands before.
CUT = regex.compile(f" (?=[^{SPACE}])")
UNEVEN = regex.compile(f" (?:[{SPACE}]|$)")


def chunks(text: str) -> list:
    """The text cut before spaces, which are left out; the first chunk, which has no space
    before it, is a tuple to tell it from the others."""
    cut = CUT.split(text) if UNEVEN.search(text) else text.split(" ")
    cut[0] = (cut[0],)
    return cut


def _elements(data: np.ndarray, ends: np.ndarray, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What the fold starts from: each byte's id with its place and the rank of its pair."""
    rank = np.full(len(data), NO_RANK, np.int64)
    rank[:-1] = first[data[:-1], data[1:]]
    rank[ends[1:] - 1] = NO_RANK
    place = np.arange(len(data)) - np.repeat(ends[:-1], np.diff(ends))
    return rank << 32 | (place & 0xFFFF) << 16 | symbols


def _number_words(ranks: dict[bytes, int], pattern: str, words_held: int):
    one = [bytes([b]) for b in range(256)]
    symbol = np.array([ranks[b] for b in one], np.int64)
    first = np.array([[ranks.get(a + b, NO_RANK) for b in one] for a in one], np.int64)
    split = word_pattern(pattern).findall

    def start():
        words, parts, flat, ends = Numbers(), Numbers(), Growing(np.int32), Growing(np.int64)
        ends.append(np.zeros(1, np.int64))

        def places_of(text: str) -> bytes:
            nonlocal parts, flat, ends
            if len(parts) >= min(CHUNKS, words_held // 2):
                parts, flat, ends = Numbers(), Growing(np.int32), Growing(np.int64)
                ends.append(np.zeros(1, np.int64))
            numbers = parts.of(chunks(text))
            if parts.new:
                places, upto = [], []
                for chunk in parts.new:
                    places += map(words.__getitem__, split(chunk[0] if type(chunk) is tuple else " " + chunk))
                    upto.append(flat.n + len(places))
                flat.append(np.array(places, np.int32))
                ends.append(np.array(upto, np.int64))
                parts.new = []
            begin = ends.values[numbers]
            return ragged(flat.values, begin, ends.values[numbers + 1] - begin).tobytes()

        def step(texts: pa.Array):
            nonlocal words, parts, flat, ends
            places, firsts, counts, fresh = [], [], [], []
            for text in texts.to_pylist():
                fresh.append(len(words) >= words_held)
                if fresh[-1]:
                    words, parts, flat, ends = Numbers(), Numbers(), Growing(np.int32), Growing(np.int64)
                    ends.append(np.zeros(1, np.int64))
                places.append(places_of(text or ""))
                firsts += words.new
                counts.append(len(words.new))
                words.new = []
            firsts = [w.encode() for w in firsts]
            whole = np.array([ranks.get(w, -1) for w in firsts], np.int64)
            firsts = [b" " if known >= 0 else w for w, known in zip(firsts, whole)]
            ends_of = ends_to_offsets([len(w) for w in firsts])
            data = np.frombuffer(b"".join(firsts), np.uint8)
            symbols = symbol[data]
            symbols[ends_of[:-1][whole >= 0]] = whole[whole >= 0]
            inner = pa.ListArray.from_arrays(pa.array(ends_of, pa.int32()), pa.array(_elements(data, ends_of, symbols, first)))
            return [
                pa.array(places, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends_to_offsets(counts), pa.int32()), inner),
                pa.array(fresh, pa.bool_()),
            ]

        return step

    return start


def _gather_ids(ranks: dict[bytes, int], spell=None):
    def start():
        flat = starts = lengths = None
        # several times as large as the ranks, and only very long words need them
        pairs = functools.cache(lambda: pair_ranks(ranks))

        def learn(words: pa.Array) -> None:
            """The ids of the words that these rows hold first."""
            inner = words.flatten()
            ends = inner.offsets.to_numpy()[: len(inner) + 1].astype(np.int64)
            ids = inner.flatten().to_numpy(zero_copy_only=False)
            ends = ends - ends[0]
            if len(ids) and ids.min() < 0:
                each = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
                each = [np.array(heap_merges((-1 - x).tolist(), pairs())) if len(x) and x[0] < 0 else x for x in each]
                ids, ends = np.concatenate(each), ends_to_offsets([len(x) for x in each])
            starts.append(flat.n + ends[:-1])
            lengths.append(np.diff(ends))
            flat.append(ids)

        def step(places: pa.Array, words: pa.Array, fresh: pa.Array):
            nonlocal flat, starts, lengths
            begins = [i for i, x in enumerate(fresh.to_pylist()) if x]
            found, counts = [], []
            for a, b in zip([0, *begins], [*begins, len(places)]):
                if flat is None or a in begins:
                    flat, starts, lengths = Growing(np.int32), Growing(np.int64), Growing(np.int64)
                if a == b:
                    continue
                learn(words.slice(a, b - a))
                data, offsets = utf8(places.slice(a, b - a))
                number = data.view(np.int32)
                sizes = lengths.values[number]
                found.append(ragged(flat.values, starts.values[number], sizes))
                upto = ends_to_offsets(sizes)
                counts.append(np.diff(upto[offsets // 4]))
            ids = np.concatenate(found).astype("<u4") if found else np.zeros(0, "<u4")
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            ends = ends_to_offsets(n)
            spelt = [spell(ids, ends)] if spell else []
            return [binary(ids.view(np.uint8), ends * 4), pa.array(n, pa.int64()), *spelt]

        return step

    return start


def _speller(vocab: Vocabulary):
    """From ids, and where each row's ids begin, to the tokens' binary pieces joined."""
    flat, starts, lengths = vocab.token_bytes()

    def spell(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        sizes = lengths[ids]
        return binary(ragged(flat, starts[ids], sizes), ends_to_offsets(sizes)[offsets])

    return spell


def encode(
    docs: DataFrame, vocab: Vocabulary, text_col: str = "text", ids_col: str = "ids",
    count_col: str = "n_tokens", decoded_col: str | None = None, drop: tuple[str, ...] = (),
    words_held: int = WORDS,
) -> DataFrame:
    """``docs`` with each text's ids (binary: little-endian unsigned 32-bit integers) and their
    number, as the tiktoken library would give them without special tokens; with
    ``decoded_col`` also what these ids decode to."""
    numbered = add_columns(docs, [
        T.StructField("__places", T.BinaryType()),
        T.StructField("__words", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("__fresh", T.BooleanType()),
    ], [text_col], _number_words(vocab.ranks, vocab.pattern, words_held), drop)
    folded = numbered.withColumn("__words", with_ranks(
        vocab.pairs, lambda rank: F.transform("__words", lambda w: fold_merges(w, rank))))
    fields = [T.StructField(ids_col, T.BinaryType()), T.StructField(count_col, T.LongType())]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.BinaryType()))
    return add_columns(
        folded, fields, ["__places", "__words", "__fresh"],
        _gather_ids(vocab.ranks, _speller(vocab) if decoded_col else None),
        ("__places", "__words", "__fresh"), 1 << 20)


def decode(frame: DataFrame, vocab: Vocabulary, ids_col: str = "ids", out_col: str = "decoded",
           drop: tuple[str, ...] = ()) -> DataFrame:
    """``frame`` with the bytes of its ids. Null ids give empty bytes; an id that the
    vocabulary lacks is an error."""
    spell = _speller(vocab)

    def start():
        def step(ids: pa.Array):
            data, offsets = utf8(ids)
            return [spell(np.ascontiguousarray(data).view("<u4"), offsets // 4)]

        return step

    return add_columns(frame, [T.StructField(out_col, T.BinaryType())], [ids_col], start, drop, 1 << 20)
