"""Likelihood of texts under a hidden Markov model of their words.

Tokens are the words of a text, A-Z lower-cased, and one end. A latent state emits each token and moves
on; Baum-Welch trains it: every task sums the expected counts of its documents' states, transitions and tokens by
a scaled forward-backward pass, the sums of all tasks are added up by token and give the next round's model. A text's probability
is summed over all state sequences by the scaled forward recursion, exactly.

A state emits one of up to ``WORDS`` frequent words (each counted twice at least), the end, or one of ``CLASSES``
classes of all other words, by their last two bytes. Whatever the state, a class emits its words by their counts, and an
unseen word as often as a word that was seen once. So the model broadcast is bounded, while the counts of all words
stay in a table: words outside the frequent ones meet it in a join. Every state's emissions are mixed with the shares of all training tokens,
the more the more different words it emits, so they add up to one and unseen words have a probability.

The states' first guess comes from Baum-Welch over up to ``FIRST`` distinct encoded documents, then follow
``ROUNDS`` rounds over all training documents. A training document of over ``CUT`` tokens counts as several
sequences, all of them whole; in scoring, pieces of a long text are run side by side for every
state they may begin in and then put together, which is exact.

Null texts are empty: only the end. Documents for which ``learn`` is null are learned from. Rows with equal ids, ties
and repeats count like others; other columns aren't returned. An empty table has no rows; without training
documents every token is certain (score 0), as the base formula has it then.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trawl.llm.common import add_columns, ends_to_offsets, give_back, saved, slices

STATES = 8
WORDS = 65_536
WORD_BYTES = 64
CLASSES = 1024
FIRST, FIRST_ROUNDS = 1500, 25
ROUNDS = 3
CUT = 4096
#: Distinct words a counting task holds before it sends them on.
HELD = 200_000
ENCODED_BYTES = 2 << 20


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z alone, and white space of one byte


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``n`` of all texts of the only column; the end is the empty word."""
    def run(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in slices(batch, 0):
                for text in part.column(0).cast(pa.binary()).to_pylist():
                    held.update(tokens(text or b""))
                held[b""] += len(part)
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()
        give_back()

    return texts.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def _class_of(word: Column) -> Column:
    return (F.crc32(F.substring(word, -2, 2)) % CLASSES).cast("int")


@dataclass(frozen=True)
class Lexicon:
    """``counts`` of all words; the frequent ones in order with their counts, ``ends`` the training documents, ``total``
    and ``distinct`` the N and V of all tokens, ``classes`` the tokens and the words seen once of each class of the rest."""

    counts: DataFrame
    words: list[bytes]
    n: np.ndarray
    ends: int
    total: int
    distinct: int
    classes: np.ndarray

    @classmethod
    def of(cls, texts: DataFrame, most: int = WORDS) -> Lexicon:
        counts = saved(count_words(texts), "counts")
        bin_ = F.floor(F.ln("n") * 100)
        short = (F.length("word") > 0) & (F.length("word") <= WORD_BYTES) & (F.col("n") > 1)
        sizes = counts.agg(F.sum("n").alias("total"), F.count("*").alias("distinct"),
                           F.sum(F.when(F.length("word") == 0, F.col("n"))).alias("ends")).first()
        # of the bins of frequency as many as fit, from the highest on
        bins = counts.where(short).groupBy(bin_.alias("bin")).agg(F.count("*").alias("n")).collect()
        least, room = 1 << 62, most
        for r in sorted(bins, key=lambda r: -r["bin"]):
            if r["n"] > room:
                break
            least, room = r["bin"], room - r["n"]
        frequent = short & (bin_ >= least)
        chosen = counts.where(frequent).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
        classes = np.zeros((CLASSES, 2), np.int64)
        rest = counts.where(~frequent & (F.length("word") > 0)).groupBy(_class_of(F.col("word")).alias("k"))
        for r in rest.agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("v")).collect():
            classes[r["k"]] = r["n"], r["v"]
        return cls(counts, chosen["word"].to_pylist(), chosen["n"].to_numpy().astype(np.int64), sizes["ends"] or 0,
                   sizes["total"] or 0, sizes["distinct"], classes)

    @property
    def end(self) -> int:
        return len(self.words)

    @property
    def share(self) -> np.ndarray:
        """Of all tokens, by symbol: the frequent words, the end, the classes with their unseen words."""
        n = np.concatenate([self.n, [self.ends], self.classes[:, 0] + self.unseen]).astype(np.float64)
        return n / n.sum()

    @property
    def unseen(self) -> np.ndarray:
        """By class, as how many tokens unseen words count."""
        return self.classes[:, 1] + 1 / CLASSES


ENCODED = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
           T.StructField("n_frequent", T.LongType()), T.StructField("base_frequent", T.DoubleType()),
           T.StructField("rest", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])))]


def encode(docs: DataFrame, text_col: str, lexicon: Lexicon) -> DataFrame:
    """``docs`` with symbols in place of the text: ``ids``, the sums of the base formula over frequent words and ends, and
    the words outside of them with their numbers."""
    words, end, n, ends = lexicon.words, lexicon.end, lexicon.n, lexicon.ends
    each = np.log10((np.concatenate([n, [ends]]) + 1) / (lexicon.total + lexicon.distinct + 1))
    if not lexicon.total:
        each[:] = 0

    class Symbols(dict):
        def __missing__(self, word):
            return end + 1 + word_class(word)

    def start():
        symbols = Symbols(zip(words, range(end)))

        def step(texts: pa.Array):
            all_ids, counted, base, ns, held, held_n, ends_at = [], [], [], [], [], [], [0]
            for text in texts.cast(pa.binary()).to_pylist():
                split = tokens(text or b"")
                ids = np.fromiter(map(symbols.__getitem__, split), np.int32, len(split))
                other = np.flatnonzero(ids > end)
                rest = Counter([split[i] for i in other.tolist()])
                held += rest.keys()
                held_n += rest.values()
                ends_at.append(len(held))
                plain = np.append(ids[ids < end], end)
                ns.append(len(ids) + 1)
                counted.append(len(plain) if ends else len(plain) - 1)
                base.append(each[plain].sum())
                all_ids.append(np.append(ids, np.int32(end)).tobytes())
            rest = pa.ListArray.from_arrays(pa.array(ends_at, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(held, pa.binary()), pa.array(held_n, pa.int64())], ["word", "n"]))
            return [pa.array(all_ids, pa.binary()), pa.array(ns, pa.int64()), pa.array(counted, pa.int64()), pa.array(base, pa.float64()), rest]

        return step

    return add_columns(docs, ENCODED, [text_col], start, drop=(text_col,))


@dataclass(frozen=True)
class Model:
    """Probabilities of first states, of moves and of each symbol (a row) in each state."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class Steps:
    """Sequences side by side, by time: the k-th symbols of all that have one, longest sequences first."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        self.active = np.searchsorted(-lengths, -np.arange(1, int(lengths.max(initial=0)) + 1), side="right")
        self.at = ends_to_offsets(self.active)
        flat = np.concatenate([np.zeros(0, np.int32), *sequences])
        starts = ends_to_offsets([len(s) for s in sequences])[:-1][self.order]
        row = np.arange(len(flat)) - np.repeat(self.at[:-1], self.active)
        self.row = row
        self.ids = flat[starts[row] + np.repeat(np.arange(len(self.active)), self.active)]

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        return zip(range(len(self.active)), self.at[:-1].tolist(), self.active.tolist())


def expected(model: Model, sequences: list[np.ndarray], first: np.ndarray, into: tuple[np.ndarray, ...]) -> float:
    """Add the expected counts of first states, moves and symbols to ``into``; the sum of log probabilities. ``first`` tells
    sequences that begin a document from later pieces, which begin in any state."""
    starts, moves, emissions = into
    steps = Steps(sequences)
    if not len(steps.ids):
        return 0.0
    S = len(model.start)
    move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)[steps.ids]
    share = emissions.sum(0)
    anywhere = np.full(S, 1 / S) if not share.sum() else share / share.sum()
    begin = np.where(first[steps.order][:, None], model.start, anywhere).astype(np.float32)
    state, scale = np.empty_like(emit), np.empty(len(emit), np.float32)
    before = begin
    for t, at, n in steps:
        a = (before[:n] @ move if t else before[:n]) * emit[at:at + n]
        c = a.sum(1)
        a /= c[:, None]
        state[at:at + n], scale[at:at + n], before = a, c, a
    after = np.ones((len(sequences), S), np.float32)
    back = move.T.copy()
    pairs = np.zeros((S, S))
    for t, at, n in reversed(list(steps)):
        b = after[:n]
        coming = emit[at:at + n] * b / scale[at:at + n, None]
        state[at:at + n] *= b
        if t:
            previous = steps.at[t - 1]
            pairs += state[previous:previous + n].T @ coming
            after[:n] = coming @ back
    starts += state[: steps.active[0]][first[steps.order][: steps.active[0]]].sum(0)
    moves += pairs * model.move
    for s in range(S):
        emissions[:, s] += np.bincount(steps.ids, state[:, s], len(emissions))
    return float(np.log(scale, dtype=np.float64).sum())


def pieces(ids: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    out, first = [], []
    for one in ids:
        one = np.frombuffer(one, np.int32)
        for at in range(0, len(one), CUT):
            out.append(one[at:at + CUT])
            first.append(at == 0)
    return out, np.array(first, bool)


def maximised(starts: np.ndarray, moves: np.ndarray, emissions: np.ndarray, share: np.ndarray) -> Model:
    emit = emissions + (np.minimum(emissions, 1).sum(0) + 1) * share[:, None]
    return Model((starts + 1) / (starts + 1).sum(), (moves + 1) / (moves + 1).sum(1, keepdims=True), emit / emit.sum(0))


def zeros(states: int, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states))


def first_guess(ids: list[bytes], share: np.ndarray, states: int = STATES, rounds: int = FIRST_ROUNDS, seed: int = 3) -> Model:
    """Baum-Welch over a few documents, each of which begins in a state of its own choice. Its result starts the
    rounds over all documents."""
    rng = np.random.default_rng(seed)
    starts, moves, emissions = zeros(states, len(share))
    sequences, first = pieces(ids)
    for one in sequences:
        np.add.at(emissions[:, rng.integers(states)], one, 1.0)
    moves += np.eye(states) * 100
    model = maximised(starts, moves, emissions, share)
    for _ in range(rounds):
        into = zeros(states, len(share))
        expected(model, sequences, first, into)
        model = maximised(*into, share)
    return model


def train(encoded: DataFrame, lexicon: Lexicon, states: int = STATES, rounds: int = ROUNDS) -> Model:
    share, symbols = lexicon.share, len(lexicon.share)
    h = F.xxhash64("ids")
    every = max(1, lexicon.ends // (4 * FIRST))
    some = (encoded.where((F.pmod(h, F.lit(every)) == 0) & (F.length("ids") <= 4 * CUT)).select("ids", h.alias("h"))
            .distinct().orderBy("h", "ids").limit(FIRST).collect())
    model = first_guess([bytes(r["ids"]) for r in some], share, states)
    for _ in range(rounds):
        model = maximised(*_gathered(encoded, model, symbols), share)
    return model


def _gathered(encoded: DataFrame, model: Model, symbols: int) -> tuple[np.ndarray, ...]:
    """The expected counts of all tasks. Rows after the symbols' are those of moves and of first states."""
    S = len(model.start)
    names = [f"s{s}" for s in range(S)]

    def run(batches):
        into = zeros(S, symbols)
        for batch in batches:
            for part in slices(batch, 0, ENCODED_BYTES):
                expected(model, *pieces(part.column(0).to_pylist()), into)
        starts, moves, emissions = into
        rows = np.vstack([emissions, moves, starts])
        at = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(rows[at, s].astype(np.float32)) for s in range(S))], names=["k", *names])
        give_back()

    parts = encoded.select("ids").mapInArrow(run, "k bigint, " + ", ".join(f"{c} float" for c in names))
    table = parts.groupBy("k").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    rows = np.zeros((symbols + S + 1, S))
    rows[table["k"].to_numpy()] = np.stack([table[c].to_numpy() for c in names], 1)
    return rows[-1], rows[symbols:-1], rows[:symbols]


def log_probabilities(model: Model, ids: list[bytes]) -> np.ndarray:
    """Natural logarithms. Texts of up to ``CUT`` symbols in one run; the pieces of others from every state they may begin in."""
    S, out = len(model.start), np.zeros(len(ids))
    short = [i for i, x in enumerate(ids) if len(x) <= 4 * CUT]
    steps = Steps([np.frombuffer(ids[i], np.int32) for i in short])
    emit, before = model.emit[steps.ids], model.start[None].repeat(len(short), 0)
    scale = np.empty(len(steps.ids))
    for t, at, n in steps:
        a = (before[:n] @ model.move if t else before[:n]) * emit[at:at + n]
        c = a.sum(1)
        a /= c[:, None]
        scale[at:at + n], before = c, a
    if short:
        out[np.array(short)[steps.order]] = np.bincount(steps.row, np.log(scale), len(short))
    for i in set(range(len(ids))) - set(short):
        out[i] = _long(model, np.frombuffer(ids[i], np.int32), S)
    return out


def _long(model: Model, ids: np.ndarray, S: int) -> float:
    """A run of pieces of equal length side by side. A piece's matrix has, for each state before it, the joint
    probability with each state at its end; products of such matrices are a long text's."""
    side = max(64, int(len(ids) ** 0.5))
    state = model.start * model.emit[ids[0]]
    log = np.log(state.sum())
    state /= state.sum()
    whole = (len(ids) - 1) // side
    body, rest = ids[1:1 + whole * side].reshape(whole, side), ids[1 + whole * side:]
    spread, logs = np.eye(S)[None].repeat(whole, 0), np.zeros(whole)
    for t in range(side):
        spread = spread @ model.move * model.emit[body[:, t]][:, None, :]
        c = spread.sum((1, 2))
        spread /= c[:, None, None]
        logs += np.log(c)
    for matrix in spread:
        state = state @ matrix
        log += np.log(state.sum())
        state /= state.sum()
    for symbol in rest:
        state = state @ model.move * model.emit[symbol]
        log += np.log(state.sum())
        state /= state.sum()
    return log + logs.sum()


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score`` of every document; it learns from those where ``learn``
    isn't false. Scores are log10 of probabilities."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"), F.coalesce(learn, F.lit(True)).alias("learned"))
    lexicon = Lexicon.of(rows.where("learned").select("text"))
    encoded = saved(encode(rows, "text", lexicon).withColumn("row", F.monotonically_increasing_id()), "encoded")
    model = train(encoded.where("learned"), lexicon, states, rounds) if lexicon.total else None
    scored = _forward(encoded.select("ids", "row", "doc_id", "learned", "n_tokens", "n_frequent", "base_frequent"), model)
    rest = _rest_scores(encoded, lexicon)
    out = saved(scored, "scores").join(rest, "row", "left")
    base, score = F.col("base_frequent") + F.coalesce("base_rest", F.lit(0.0)), F.col("forward") + F.coalesce("score_rest", F.lit(0.0))
    return out.select(
        "doc_id", "learned", "n_tokens", (F.col("n_frequent") + F.coalesce("n_rest", F.lit(0))).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))


def _forward(encoded: DataFrame, model: Model | None) -> DataFrame:
    def start():
        def step(ids: pa.Array):
            if model is None:
                return [pa.array(np.zeros(len(ids)))]
            return [pa.array(log_probabilities(model, ids.to_pylist()) / np.log(10))]
        return step

    return add_columns(encoded, [T.StructField("forward", T.DoubleType())], ["ids"], start, ("ids",), ENCODED_BYTES)


def _rest_scores(encoded: DataFrame, lexicon: Lexicon) -> DataFrame:
    """For each ``row`` with words outside the frequent ones: how many are known, and what all add to both scores. They
    are rare words, so no key of the join is hot for being frequent; unseen words are split by adaptive execution."""
    used = encoded.select("row", F.explode("rest").alias("w")).select("row", F.col("w.word").alias("word"), F.col("w.n").alias("times"))
    found = used.join(lexicon.counts, "word", "left")
    c = F.coalesce("n", F.lit(0))

    def of_class(values: np.ndarray) -> Column:
        return F.element_at(F.lit([float(x) for x in values]), _class_of(F.col("word")) + 1)

    if lexicon.total:
        base = F.log10((c + 1) / F.lit(float(lexicon.total + lexicon.distinct + 1)))
        score = F.log10(F.when(c > 0, c).otherwise(of_class(lexicon.unseen)) / of_class(lexicon.classes[:, 0] + lexicon.unseen))
    else:
        base = score = F.lit(0.0)
    return found.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times"))).alias("n_rest"), F.sum(F.col("times") * base).alias("base_rest"),
        F.sum(F.col("times") * score).alias("score_rest"))
