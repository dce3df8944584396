"""Document quality from supervised subword embeddings.

A word's features are the word itself and its character n-grams of 3 to 5 bytes between word marks,
a word equal to the one before has one feature more, and each text has one of its own. Features are
hashed to vectors; a text is the average of its features' vectors, and a softmax over it gives the
classes' probabilities. Vectors and output weights are learned by stochastic gradient descent in
numpy, each coordinate's rate following its past gradients.

It learns from a bounded sample: ``SAMPLE`` labelled rows, of texts up to ``SAMPLE_BYTES``. As the
output is linear, a word's features add up to one number, worked out once a task for each distinct
word. Null and empty texts have only the text's own feature; without labelled rows every score is
0.5. Rows are scored alone: ties, repeats and other columns don't matter, an input column named like
an output is replaced. Empty tables stay empty.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from trawl.llm.common import Growing, Numbers, add_columns, ends_to_offsets

SAMPLE = 4000
SAMPLE_BYTES = 1 << 15
BUCKETS = 1 << 17
DIM = 8
EPOCHS = 10
RATE = 0.5
GRAMS = (3, 4, 5)
#: Buckets of a repeated word and of the text itself.
REPEAT, TEXT = BUCKETS, BUCKETS + 1
#: Distinct words a task remembers before it starts afresh.
WORDS = 300_000


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of all words, and the word each belongs to."""
    marked = [b"<" + w + b">" for w in words]
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint32)
    ends = ends_to_offsets([len(w) for w in marked])
    owner = np.repeat(np.arange(len(words)), np.diff(ends))
    left = ends[1:][owner] - np.arange(len(data))  # bytes of the word from here on
    buckets = [np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS]
    owners = [np.arange(len(words))]
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        if not len(at):
            continue
        gram = np.full(len(at), n, np.uint32)
        for k in range(n):
            gram = (gram ^ data[at + k]) * np.uint32(16777619)
        buckets.append(((gram ^ gram >> np.uint32(15)) % np.uint32(BUCKETS)).astype(np.int64))
        owners.append(owner[at])
    return np.concatenate(buckets), np.concatenate(owners)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


class Classifier:
    """``scores`` has for each bucket what it adds to the difference of the two outputs."""

    def __init__(self, scores: np.ndarray | None):
        self.scores = scores

    @classmethod
    def fit(cls, texts: list[str], labels: list[int], seed: int = 7) -> Classifier:
        if not texts:
            return cls(None)
        rows = []
        for text in texts:
            words = split_words(text)
            buckets, _ = word_features(words) if words else (np.zeros(0, np.int64), None)
            repeats = sum(a == b for a, b in zip(words, words[1:]))
            buckets = np.concatenate([buckets, np.full(repeats, REPEAT), [TEXT]])
            found, n = np.unique(buckets, return_counts=True)
            rows.append((found.astype(np.int32), (n / len(buckets)).astype(np.float32)))
        rng = np.random.default_rng(seed)
        vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + 2, DIM)).astype(np.float32)
        output = np.zeros((2, DIM), np.float32)
        past_v, past_o = np.full(vectors.shape, 1e-8, np.float32), np.full(output.shape, 1e-8, np.float32)
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            for i in rng.permutation(len(rows)):
                found, weight = rows[i]
                hidden = weight @ vectors[found]
                z = output @ hidden
                p = np.exp(z - z.max())
                p /= p.sum()
                p[labels[i]] -= 1
                back = p @ output
                change = np.outer(p, hidden)
                past_o += change**2
                output -= rate * change / np.sqrt(past_o)
                change = weight[:, None] * back
                past_v[found] += change**2
                vectors[found] -= rate * change / np.sqrt(past_v[found])
        return cls(vectors.astype(np.float64) @ (output[1] - output[0]).astype(np.float64))


class WordScores:
    """What distinct words add to a text, remembered for a task."""

    def __init__(self, classifier: Classifier):
        self.classifier = classifier
        self.restart()

    def restart(self) -> None:
        self.numbers, self.sums, self.counts = Numbers(), Growing(np.float64), Growing(np.int64)

    def score(self, texts: list[str | None]) -> np.ndarray:
        scores = self.classifier.scores
        if scores is None:
            return np.full(len(texts), 0.5)
        if len(self.numbers) >= WORDS:
            self.restart()
        each = [self.numbers.of(split_words(t)) for t in texts]
        new, self.numbers.new = self.numbers.new, []
        if new:
            buckets, owner = word_features(new)
            self.sums.append(np.bincount(owner, scores[buckets], len(new)))
            self.counts.append(np.bincount(owner, minlength=len(new)))
        ends = ends_to_offsets([len(x) for x in each])
        number = np.concatenate([np.zeros(0, np.int32), *each])
        repeat = np.zeros(len(number), bool)
        repeat[1:] = number[1:] == number[:-1]
        repeat[ends[:-1][np.diff(ends) > 0]] = False
        added = np.concatenate([[0.0], np.cumsum(self.sums.values[number] + repeat * scores[REPEAT])])
        counted = ends_to_offsets(self.counts.values[number] + repeat)
        total = np.diff(added[ends]) + scores[TEXT]
        return 1 / (1 + np.exp(-np.clip(total / (np.diff(counted[ends]) + 1), -700, 700)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Classifier:
    """Learn from up to ``sample`` rows of ``labels``, chosen by a hash of the id. That bounded
    number of ids is what is broadcast to find their texts, of which each id has one, that of the least
    hash."""
    chosen = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("y")).dropDuplicates(["__id"]) \
        .orderBy(F.xxhash64("__id"), "__id").limit(sample)
    rows = docs.where(F.octet_length(text_col) <= SAMPLE_BYTES).select(F.col(id_col).alias("__id"), F.col(text_col).alias("t")) \
        .join(F.broadcast(chosen), "__id") \
        .groupBy("__id").agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t", "y")).alias("least")).select("least.t", "least.y")
    rows = sorted(rows.collect(), key=lambda r: (zlib.crc32(r["t"].encode()), r["t"], r["y"]))
    return Classifier.fit([r["t"] for r in rows], [r["y"] for r in rows])


def with_scores(docs: DataFrame, classifier: Classifier, text_col: str = "text", out_col: str = "score",
                drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the probability of label 1."""
    def start():
        words = WordScores(classifier)

        def step(texts: pa.Array):
            return [pa.array(words.score(texts.to_pylist()))]

        return step

    return add_columns(docs, [T.StructField(out_col, T.DoubleType())], [text_col], start, drop, 1 << 20)
