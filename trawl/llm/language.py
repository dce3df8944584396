"""Language identification by prediction by partial matching over bytes.

Per language, a tree of byte contexts of up to three bytes has the counts of what follows. A byte
not seen in a context costs an escape and is coded by the next shorter context, among the bytes not
seen in the longer one (method C). Once learned, the counts are frozen, so what a byte costs depends
only on its longest context in the tree, and a text's exact code length under each language is a
sum of table entries. The language with the shortest code is predicted.

The tables are sparse: of each order, the costs of the bytes seen in a context and what the escape from
it costs. Languages are in blocks; a text is scored by one block after the other, of which
the shortest code and the sum of the probabilities are kept, so there may be any number of languages.

Counts are learned from a bounded sample of labelled rows, ``SAMPLE`` distinct texts a language on
average, counted in tasks. Null texts and texts without a letter are ``und`` with score 0, and so
is everything if no row is labelled. Rows are predicted alone: ties, repeats and other columns don't
matter, an input column named like an output is replaced. Empty tables stay empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from trawl.llm.common import add_columns, saved, utf8
from trawl.operators.sizing import BROADCAST_ROWS, within

#: Distinct texts a language to learn from, on average.
SAMPLE = 400
#: Languages in a block.
TOGETHER = 8
ORDERS = (0, 1, 2, 3)
UNKNOWN = "und"
PAD = 10
STEP = 1 << 18
LETTER = regex.compile(r"\p{L}")


def sample_rows(labelled: DataFrame, text_col: str, lang_col: str, sample: int = SAMPLE) -> DataFrame:
    """``lang`` and ``text`` of about ``sample`` distinct texts of each language, chosen by hash. What a
    text's chance is follows from the distinct texts of its language, so copies don't change it."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = saved(rows.select("lang", F.xxhash64("text").alias("h")).distinct()
                  .groupBy("lang").agg(F.count("*").alias("n")), "sizes")
    if within(sizes, BROADCAST_ROWS):
        sizes = F.broadcast(sizes)
    return rows.join(sizes, "lang").where(F.pmod(F.xxhash64("text"), F.col("n")) < sample).select("lang", "text").distinct()


def _before(data: np.ndarray, offsets: np.ndarray, back: int) -> np.ndarray:
    """The byte ``back`` places earlier in the same text; before its start there is padding."""
    out = np.full(len(data), PAD, np.uint8)
    out[back:] = data[: len(data) - back] if back < len(data) else out[back:]
    starts, lengths = offsets[:-1], np.diff(offsets)
    for k in range(back):
        out[starts[lengths > k] + k] = PAD
    return out


def _count_grams(rows: DataFrame) -> DataFrame:
    """``lang``, ``gram`` (three bytes and the next as a number) and ``n``."""
    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                data, offsets = utf8(batch.column(1).filter(pa.array(langs == lang)))
                gram = data.astype(np.int64)
                for back in (1, 2, 3):
                    gram |= _before(data, offsets, back).astype(np.int64) << 8 * back
                grams, n = np.unique(gram, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n, pa.int64())],
                    names=["lang", "gram", "n"])

    return rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Index:
    """Row numbers of distinct 32-bit keys, in a table with linear probing."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, (3 * len(keys)).bit_length())
        self.shift, self.last = np.uint32(32 - bits), (1 << bits) - 1
        self.keys, self.rows = np.zeros(1 << bits, np.uint32), np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            # of those that want a free place, one gets it
            free = np.flatnonzero(self.rows[at] < 0)
            places, first = np.unique(at[free], return_index=True)
            self.rows[places], self.keys[places] = left[free[first]], keys[left[free[first]]]
            left, at = np.delete(left, free[first]), np.delete(at, free[first]) + 1 & self.last

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(0x9E3779B1) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' rows, -1 for those not held."""
        at = self._home(keys)
        out = self.rows[at]
        other = np.flatnonzero((self.keys[at] != keys) & (out >= 0))
        at = at[other]
        while len(other):
            at = at + 1 & self.last
            out[other] = self.rows[at]
            more = (self.keys[at] != keys[other]) & (out[other] >= 0)
            other, at = other[more], at[more]
        return out


class Block:
    """Code lengths in bits under a few languages. ``cost`` has them for the bytes that any of the
    languages has in a context, ``escape`` what is added to the shorter context's for all others;
    the last row of both, of what isn't held, is zero."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]):
        L = len(counts)
        self.grams, self.contexts, self.cost, self.escape = [], [], [], []
        held, below = np.zeros(0, np.int64), np.zeros((0, L))
        for order in ORDERS:
            mask = (1 << 8 * (order + 1)) - 1
            own = [np.unique(grams & mask, return_inverse=True) for grams, _ in counts]
            grams = np.unique(np.concatenate([x for x, _ in own]))
            count = np.zeros((len(grams), L))
            for i, ((found, place), (_, n)) in enumerate(zip(own, counts)):
                count[np.searchsorted(grams, found), i] = np.bincount(place, n, len(found))
            contexts, place = np.unique(grams >> 8, return_inverse=True)
            # all bytes of a longer context are also held for the shorter one
            below = below[np.searchsorted(held, grams & mask >> 8)] if order else np.full((len(grams), L), 1 / 256)
            total, distinct, rest = np.zeros((3, len(contexts), L))
            np.add.at(total, place, count)
            np.add.at(distinct, place, count > 0)
            np.add.at(rest, place, below * (count > 0))
            leave = np.where(total == 0, 1, distinct / np.maximum(total + distinct, 1) / np.maximum(1 - rest, 1e-9))
            below = np.where(count > 0, count / np.maximum(total + distinct, 1)[place], leave[place] * below)
            held = grams
            self.grams.append(Index(grams.astype(np.uint32)))
            self.contexts.append(Index(contexts.astype(np.uint32)))
            self.cost.append(_bits(below))
            self.escape.append(_bits(leave))
        self.held = contexts

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Cost of bytes, each the lowest of a number that has the three before it above."""
        row = self.grams[3].find(grams)
        out = self.cost[3][row]
        left = np.flatnonzero(row < 0)
        grams = grams[left]
        for order in (3, 2, 1):
            if not len(left):
                return out
            out[left] += self.escape[order][self.contexts[order].find(grams >> np.uint32(8))]
            grams = grams & np.uint32((1 << 8 * order) - 1)
            row = self.grams[order - 1].find(grams)
            out[left] += self.cost[order - 1][row]
            left, grams = left[row < 0], grams[row < 0]
        out[left] += self.escape[0][0] + 8
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros((len(offsets) - 1, self.cost[0].shape[1]))
        for a in range(0, len(data), STEP):
            # three bytes more in front give the contexts of the first bytes
            b, lead = min(a + STEP, len(data)), max(0, a - 3)
            own = np.clip(offsets, lead, b) - lead
            part = data[lead:b]
            grams = part.astype(np.uint32)
            for back in (1, 2, 3):
                grams |= _before_cut(part, own, offsets, lead, back).astype(np.uint32) << np.uint32(8 * back)
            bits = self.bits(grams[a - lead:])
            ends = np.clip(offsets, a, b) - a
            full = np.flatnonzero(np.diff(ends) > 0)
            if len(full):
                out[full] += np.add.reduceat(bits, ends[full], axis=0, dtype=np.float64)
        return out


class Model:
    """The languages in order, and their tables in blocks."""

    A = 256

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        self.blocks = [Block([counts[lang] for lang in self.languages[a:a + TOGETHER]])
                       for a in range(0, len(self.languages), TOGETHER)]

    @property
    def bits(self) -> np.ndarray:
        """Cost of every byte in every context of three bytes, by language: a table to look at."""
        contexts = np.unique(np.concatenate([block.held for block in self.blocks])).astype(np.uint32)
        grams = (contexts[:, None] << np.uint32(8) | np.arange(self.A, dtype=np.uint32)).ravel()
        return np.concatenate([block.bits(grams) for block in self.blocks], 1)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language."""
        return np.concatenate([block.code_lengths(data, offsets) for block in self.blocks], 1)

    def best(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language of each text's shortest code, and its probability among all."""
        n = len(offsets) - 1
        least, total, place = np.full(n, np.inf), np.zeros(n), np.zeros(n, np.int64)
        for k, block in enumerate(self.blocks):
            bits = block.code_lengths(data, offsets)
            shortest = bits.min(1)
            place = np.where(shortest < least, k * TOGETHER + bits.argmin(1), place)
            now = np.minimum(least, shortest)
            total *= np.exp2(np.maximum(now - least, -1000))
            total += np.exp2(np.maximum(now[:, None] - bits, -1000)).sum(1)
            least = now
        return place, 1 / total


def _before_cut(part, own, offsets, lead, back):
    """As ``_before``, for bytes cut out of a longer array: only true text starts are padded."""
    out = np.full(len(part), PAD, np.uint8)
    if back < len(part):
        out[back:] = part[: len(part) - back]
    true = (offsets[:-1] >= lead) & (np.diff(own) > 0)
    starts, lengths = own[:-1][true], np.diff(own)[true]
    for k in range(back):
        out[starts[lengths > k] + k] = PAD
    return out


def _bits(probabilities: np.ndarray) -> np.ndarray:
    return np.concatenate([-np.log2(probabilities), np.zeros((1, probabilities.shape[1]))]).astype(np.float32)


def _in_arrays(counts: DataFrame) -> DataFrame:
    """``lang``, and ``grams`` and ``n`` as binary arrays: few rows to collect."""
    def run(batches):
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            order = np.argsort(langs.indices.to_numpy(), kind="stable")
            grams, n = (batch.column(i).to_numpy()[order] for i in (1, 2))
            cuts = np.cumsum(np.bincount(langs.indices.to_numpy(), minlength=len(langs.dictionary)))[:-1]
            yield pa.RecordBatch.from_arrays([
                langs.dictionary.cast(pa.string()), *(pa.array([x.tobytes() for x in np.split(y, cuts)], pa.binary()) for y in (grams, n))],
                names=["lang", "grams", "n"])

    return counts.mapInArrow(run, "lang string, grams binary, n binary")


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    counts: dict[str, tuple[list, list]] = {}
    for r in _in_arrays(_count_grams(sample_rows(labelled, text_col, lang_col, sample))).toLocalIterator():
        grams, n = counts.setdefault(r["lang"], ([], []))
        grams.append(np.frombuffer(r["grams"], np.int64))
        n.append(np.frombuffer(r["n"], np.int64))
    return Model({lang: (np.concatenate(grams), np.concatenate(n)) for lang, (grams, n) in counts.items()})


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score", drop: tuple[str, ...] = (), lettered_out: str | None = None) -> DataFrame:
    """``docs`` with the predicted language and its probability among the learned ones; if
    ``lettered_out`` is named, also with whether the text has a letter, learned or not."""
    fields = [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())]
    if lettered_out is not None:
        fields.append(T.StructField(lettered_out, T.BooleanType()))

    def start():
        def step(texts: pa.Array):
            lettered = np.array([t is not None and LETTER.search(t) is not None for t in texts.to_pylist()], bool)
            also = [] if lettered_out is None else [pa.array(lettered)]
            if not model.languages:
                return [pa.array([UNKNOWN] * len(texts)), pa.array(np.zeros(len(texts))), *also]
            best, share = model.best(*utf8(texts))
            return [pa.array([model.languages[i] if ok else UNKNOWN for i, ok in zip(best, lettered)], pa.string()),
                    pa.array(np.where(lettered, share, 0.0)), *also]

        return step

    return add_columns(docs, fields, [text_col], start, drop, 1 << 20)
