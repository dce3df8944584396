"""The hidden Markov language model against sums over all paths, plain recursions and counting by hand."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import hmm, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids int, row string, word int"
TEXTS = [None, "", "  \n\t ", "One two three four", "One two three four", "x", "the cat sat on the mat " * 30, "Ünï ñandú 日本語 \x1cA",
         "unseen words only", "le chat dort sur le lit " * 30] + [f"the cat number {i} sat on mat {i % 7}" for i in range(30)]


def docs(spark, texts=TEXTS, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", None, 1, 5, "r", 3) for i, t in zip(ids, texts)], SCHEMA)


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [""]


def model(states=3, symbols=5, seed=0):
    rng = np.random.default_rng(seed)
    part = lambda *shape: (x := rng.random(shape)) / x.sum(-1, keepdims=True)
    return hmm.Model(part(states), part(states, states), part(states, symbols).T.copy())


def paths(m, ids):
    """Joint probability of the symbols and each state sequence."""
    for z in itertools.product(range(len(m.start)), repeat=len(ids)):
        p = m.start[z[0]] * m.emit[ids[0], z[0]]
        for a, b, i in zip(z, z[1:], ids[1:]):
            p *= m.move[a, b] * m.emit[i, b]
        yield z, p


def test_likelihood_is_the_sum_over_all_paths(monkeypatch):
    m, rng = model(), np.random.default_rng(1)
    texts = [rng.integers(5, size=n).astype(np.int32) for n in (1, 2, 7, 5, 1, 6)]
    want = [math.log(sum(p for _, p in paths(m, x))) for x in texts]
    assert np.allclose(hmm.log_probabilities(m, [x.tobytes() for x in texts]), want, rtol=1e-12)
    # pieces side by side give the same as one run
    long = rng.integers(5, size=30_000).astype(np.int32).tobytes()
    pieced = hmm.log_probabilities(m, [long, texts[2].tobytes()])
    monkeypatch.setattr(hmm, "CUT", 1 << 20)
    assert np.allclose(pieced, hmm.log_probabilities(m, [long, texts[2].tobytes()]), rtol=1e-11)
    assert hmm.log_probabilities(m, []).shape == (0,)


def test_expected_counts_are_those_of_all_paths():
    m, rng = model(), np.random.default_rng(2)
    texts = [rng.integers(5, size=n).astype(np.int32) for n in (3, 6, 1, 4)]
    into = hmm.zeros(3, 5)
    log = hmm.expected(m, texts, np.ones(4, bool), into)
    starts, moves, emissions = hmm.zeros(3, 5)
    total = 0
    for x in texts:
        each = list(paths(m, x))
        whole = sum(p for _, p in each)
        total += math.log(whole)
        for z, p in each:
            starts[z[0]] += p / whole
            for a, b in zip(z, z[1:]):
                moves[a, b] += p / whole
            for i, a in zip(x, z):
                emissions[i, a] += p / whole
    assert abs(log - total) < 1e-4
    for got, want in zip(into, (starts, moves, emissions)):
        assert np.allclose(got, want, atol=1e-4)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(3)
    source = model(4, 30, 5)
    texts = []
    for _ in range(200):
        z, out = rng.choice(4, p=source.start), []
        for _ in range(20):
            out.append(rng.choice(30, p=source.emit[:, z]))
            z = rng.choice(4, p=source.move[z])
        texts.append(np.array(out, np.int32))
    share = np.full(30, 1 / 30)
    m, logs = hmm.maximised(rng.random(4), rng.random((4, 4)), rng.random((30, 4)) * 100, share), []
    for _ in range(12):
        into = hmm.zeros(4, 30)
        logs.append(hmm.expected(m, texts, np.ones(200, bool), into))
        m = hmm.maximised(*into, share)
    assert logs[-1] > logs[0] + 50
    for p in (m.start.sum(), m.move.sum(1), m.emit.sum(0)):
        assert np.allclose(p, 1)


@pytest.mark.parametrize("words", [65_536, 6, 0])
def test_scores_against_counting(spark, monkeypatch, words):
    """Base scores and known tokens by the formula, scores by a plain forward recursion over the trained model."""
    learned = [i for i in range(len(TEXTS)) if i % 5 != 3]
    counts = Counter(t for i in learned for t in tokens(TEXTS[i]))
    total, distinct = sum(counts.values()), len(counts)
    kept = {}
    train = hmm.train
    monkeypatch.setattr(hmm, "WORDS", words)
    monkeypatch.setattr(hmm.Lexicon.of.__func__, "__defaults__", (words,))
    monkeypatch.setattr(hmm, "train", lambda encoded, lexicon, *a: kept.setdefault("m", (train(encoded, lexicon, *a), lexicon))[0])
    out = hmm.score_texts(docs(spark), F.col("doc_id") % 5 != 3, rounds=1).collect()
    assert len(out) == len(TEXTS)
    m, lexicon = kept["m"]
    assert len(lexicon.words) <= words and np.allclose(m.emit.sum(0), 1)
    symbol = {w.decode(): i for i, w in enumerate(lexicon.words)} | {"": lexicon.end}
    rest, once = Counter(), Counter()
    for w, c in counts.items():
        if w not in symbol:
            rest[hmm.word_class(w.encode())] += c
            once[hmm.word_class(w.encode())] += c == 1
    for r in out:
        own = tokens(TEXTS[r["doc_id"]])
        assert (r["learned"], r["n_tokens"], r["train_tokens"]) == (r["doc_id"] % 5 != 3, len(own), total)
        assert r["n_known"] == sum(w in counts for w in own)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own), rel_tol=1e-9)
        state, log = m.start, 0.0
        for t, w in enumerate(own):
            k = hmm.word_class(w.encode())
            new = once[k] + 1 / hmm.CLASSES
            state = (state @ m.move if t else state) * m.emit[symbol.get(w, lexicon.end + 1 + k)]
            log += math.log10(state.sum()) + (0 if w in symbol else math.log10((counts[w] or new) / (rest[k] + new)))
            state = state / state.sum()
        assert math.isclose(r["score"], log, rel_tol=1e-8, abs_tol=1e-9)


def test_words_of_a_class_and_an_unseen_one_add_up():
    share = hmm.Lexicon(None, [b"a"], np.array([3]), 2, 6, 3, np.array([[1, 1]] + [[0, 0]] * (hmm.CLASSES - 1))).share
    assert np.isclose(share.sum(), 1) and np.isclose(share[2] / share[0], (2 + 1 / hmm.CLASSES) / 3)
    assert hmm.word_class(b"word") == zlib.crc32(b"rd") % hmm.CLASSES


def test_odd_tables(spark):
    assert hmm.score_texts(docs(spark).limit(0), F.col("doc_id") > 0).count() == 0
    none = hmm.score_texts(docs(spark), F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in none} == {(0, 0, 0.0, 0.0)}
    same = hmm.score_texts(docs(spark, ids=[7] * len(TEXTS)).unionByName(docs(spark, [None, "a b"], [None, None])), F.col("doc_id") % 5 != 3, rounds=1)
    assert len(same.collect()) == len(TEXTS) + 2
    long = docs(spark, ["word " * 300_000, "a" * 3_000_000, "a b c d"] * 2)
    out = {r["doc_id"]: r for r in hmm.score_texts(long, F.col("doc_id") < 3, rounds=1).collect()}
    assert out[0]["n_tokens"] == 300_001 and all(abs(out[i]["score"] - out[i + 3]["score"]) < 1e-6 for i in range(3))
    assert -300_000 < out[0]["score"] < 0


def test_model_beats_the_base_on_held_out_texts(spark):
    out = queries.QUERIES["op11_hmm_scores"](spark, SF).collect()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in out if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
