"""The training-data operators against brute force on small fixtures."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F, types as T

import corpus_pipeline
from trawl.llm import bpe, common, contamination, idfiles, language, lines, pii, quality, queries, shards, simhash, sketches
from trawl.operators import sizing
from trawl.operators.sizing import scratch_folder

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "word " * 3000 + "a" * 3000
TEXTS = [
    None, "", "  \n\t ", "One two three four five six", "One two three four five six", "x", LONG,
    "Ünïcode ñandú 日本語 🎉!! it's  we'll\n\n  end ", "a@b.co; +1 (234) 555-0101; 10.0.0.1; 4111 1111 1111 1111",
    "1234567 !!! 99", "line that is longer than forty characters, shared\nown line",
]


def rows(spark, texts=TEXTS, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", None, 1) for i, t in zip(ids, texts)], SCHEMA)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def test_bpe_is_tiktoken(spark, vocab):
    import tiktoken
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    letters = "abcé ñ日\n\t  '’s1२!.🎉 　x\x1cZ"
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    # a small memory makes tasks start afresh often
    out = bpe.encode(rows(spark, texts), vocab, decoded_col="n_chars", words_held=40)
    out = bpe.decode(out, vocab).collect()
    for r in out:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert ids == library.encode_ordinary(r["text"] or ""), r["text"]
        assert bytes(r["decoded"]) == bytes(r["n_chars"]) == (r["text"] or "").encode() and r["n_tokens"] == len(ids)
    assert len(out) == len(texts)
    assert bpe.encode(rows(spark, []), vocab).count() == 0


def test_simple8b_round_trip():
    rng = np.random.default_rng(3)
    for values in ([], [0] * 700, [2**63, 1, 2**60, 2**60 - 1, 0], list(range(600)),
                   (rng.integers(0, 2**63, 3000, dtype=np.uint64) >> rng.integers(0, 63, 3000).astype(np.uint64))):
        values = np.array(values, np.uint64)
        words, offsets = idfiles.pack(values)
        assert (idfiles.unpack(words, offsets, len(values)) == values).all()


def test_id_files(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = TEXTS + ["Hello, WORLD. İstanbul क़ x̸, a.b.c, É.", "a\x1cb <|endoftext|> ΑΣ. Σ"]
    where = scratch_folder(spark, "ids")
    idfiles.write_ids(rows(spark, texts).repartition(3), where, path, 1)
    out = {r["doc_id"]: r for r in idfiles.read_ids(spark, where).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(bytes(out[i]["ids"]), "<u4").tolist() == ids
        assert (out[i]["start"], out[i]["n_tokens"]) == (start, len(ids))
        start += len(ids)
    empty = scratch_folder(spark, "ids")
    idfiles.write_ids(rows(spark, []), empty, path, 1)
    assert idfiles.read_ids(spark, empty).count() == 0


def test_id_files_hold_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(6)
    pieces = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "|>", "<", " ", "Foo", "bar.", "É", "e", "\u0301", "ΑΣ", ","]
    texts = TEXTS + ["foo <|endoftext|> bar", "a.<|endoftext|>.", "<|startoftext|><|endoftext|>", "<|EndOfText|>"]
    texts += ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(200)]
    rows(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    out = {r["doc_id"]: r for r in queries.QUERIES["op2_simple8b_ids"](spark, str(tmp_path)).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        got = (out[i]["start"], out[i]["n_tokens"], out[i]["ids_crc32"])
        assert got == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text
        start += len(ids)


def test_sketches(spark):
    texts = TEXTS + [" ".join(f"w{i}" for i in range(2000))]
    got = sketches.edited_with_next(rows(spark, texts), parts=3)
    got = got.withColumn("e", sketches.sketch(F.col("edited"))).select(
        "doc_id", "n_chars", "edited", "sketch", sketches.resemblance(F.col("sketch"), F.col("e")).alias("near"),
        sketches.containment(F.col("e"), F.col("sketch")).alias("inside"),
        sketches.distinct_shingles(F.col("sketch")).alias("distinct")).collect()
    got = {r["doc_id"]: r for r in got}

    def shingles(text):
        w = [x for x in re.split("[ \t-\r]+", lower(text)) if x]
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    for i, text in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b = shingles(text), shingles(edited)
        assert got[i]["n_chars"] == len(text) and got[i]["edited"] == edited
        assert abs(got[i]["near"] - (len(a & b) / len(a | b) if a | b else 1)) < 0.15
        assert 0 <= got[i]["inside"] <= 1
        assert abs(got[i]["distinct"] - len(a)) <= 0.3 * len(a)
    assert got[3]["sketch"] == got[4]["sketch"] and got[0]["sketch"] == []
    assert sketches.edited_with_next(rows(spark, [])).count() == 0


def brute_hits(text, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = word.findall(lower(text or ""))
    hit, found = set(), set()
    for item, own in items:
        w = word.findall(lower(own or ""))
        for k in range(max(1, len(w) - 12)) if w else ():
            window = w[k:k + 13]
            for j in range(len(words) - len(window) + 1):
                if words[j:j + len(window)] == window:
                    hit |= set(range(j, j + len(window)))
                    found.add("" if item is None else str(item))
    return len(words), sorted(hit), sorted(found)


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_contamination(spark, block):
    rng = random.Random(5)
    word = lambda: rng.choice(["ab", "abab", "Ü", "7", "the", "a"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 13, 14, 30, 40])] + [(6, None), (7, "--"), (None, "the ab")]
    texts = TEXTS + [", ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += ["Start " + items[5][1].upper() + " end", items[4][1][:-1] + "q"]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = contamination.find_contamination(rows(spark, texts), bench, block_bytes=block).collect()
    assert len(out) == len(texts)
    for r in out:
        n, hit, found = brute_hits(r["text"], items)
        assert (r["n_words"], r["hit_words"], r["item_ids"]) == (n, hit, found), r["text"]
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= n)
    none = contamination.find_contamination(rows(spark), bench.limit(0))
    assert none.agg(F.sum("n_hit")).first()[0] == 0


def test_contamination_holds_one_block_at_a_time(spark, monkeypatch):
    repeated = [(1, "one repeated item of some words")] * 50
    items = repeated + [(i, f"item {i} of some length, number {i}") for i in range(2, 12)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    held, add_hits = [], contamination._add_hits

    def watched(docs, own, *rest):
        plan = docs._jdf.queryExecution().optimizedPlan().toString()
        held.append((sorted(own), plan.count("MapInArrow")))
        return add_hits(docs, own, *rest)

    monkeypatch.setattr(contamination, "_add_hits", watched)
    docs = rows(spark, ["a one repeated item of some words b", "item 7 of some length, number 7", "none"])
    out = {r["doc_id"]: r["item_ids"] for r in contamination.find_contamination(docs, bench, block_bytes=100).collect()}
    assert out == {0: ["1"], 1: ["7"], 2: []}
    assert len(held) > 1 and all(steps == 0 for _, steps in held)  # each begins with what was written
    assert sorted(x for own, _ in held for x in own) == sorted({(str(i), t.encode()) for i, t in items})


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 50)}" for _ in range(400)]
    texts = TEXTS + ["\v".join(base[:k] + ["new"] + base[k + 1:]) for k in range(0, 400, 9)] + [" ".join(base)] * 5
    ids = [3 * i + 1 for i in range(len(texts))]
    out = {r["doc_id"]: r for r in simhash.near_duplicates(rows(spark, texts, ids)).collect()}
    prints = [brute_fingerprint(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        label = [min(label[j] for j in range(len(texts)) if bin(prints[i] ^ prints[j]).count("1") <= 3) for i in range(len(texts))]
    for i, doc in enumerate(ids):
        assert out[doc]["fingerprint"] & (2**64 - 1) == prints[i]
        assert out[doc]["component_id"] == ids[label[i]]
    kept = simhash.drop_near_duplicates(rows(spark, texts, ids)).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted({ids[x] for x in label})
    assert simhash.near_duplicates(rows(spark, [])).count() == 0
    assert simhash.near_duplicates(rows(spark, ["a", "a"], [None, 5])).where("doc_id IS NULL AND component_id IS NULL").count() == 1


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    got = {r["id"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_joins_of_many_rows_are_not_broadcast(spark, monkeypatch):
    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    nodes = simhash.saved(spark.createDataFrame([(7, 1), (7 << 40, 2), (5, 3)], "fp bigint, id bigint"), "nodes")
    found = simhash.links(nodes)  # 66 rows a node, of which Spark's estimate knows nothing
    assert "Broadcast" not in plan(found) and [tuple(r) for r in found.collect()] == [(1, 3)]
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 2)
    joined = nodes.join(sizing.unless_few(nodes.select("fp"), nodes), "fp")
    assert "Broadcast" not in plan(joined) and joined.count() == 3
    assert "Broadcast" in plan(nodes.join(sizing.unless_few(nodes.select("fp"), nodes.limit(2)), "fp"))
    texts = ["same line of forty characters or some more\n" + x for x in "abcdef"]
    found = lines.drop_repeated_lines(rows(spark, texts, range(6)))
    assert sorted((r["doc_id"], r["n_dropped"]) for r in found.collect()) == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 0)]
    edges = spark.createDataFrame([(i, i + 1) for i in range(9)], "a bigint, b bigint")
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}


def brute_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    def luhn(d):
        return sum(sum(map(int, str(int(c) * (1 + k % 2)))) for k, c in enumerate(reversed(d))) % 10 == 0

    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_personal_data(spark):
    filler = [f"member code: ZX-{i:05d}q is here" for i in range(20)]
    seeds = [f"please mail reach: user{i}@mail.example.com now" for i in range(30)] + ["please mail reach: user77-at-host9 now"]
    texts = TEXTS + ["999.1.1.1 1.2.3.4.5 a@b@c.d 123 +123456789012345 + 4111-1111-1111-1112", *filler, *seeds]
    out = {r["doc_id"]: r for r in pii.find_personal_data(rows(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert [tuple(x) for x in out[i]["base"]] == brute_spans(text or "")
    assert [x["kind"] for x in out[8]["base"]] == ["email", "phone", "ip", "card"]
    last = len(texts) - 1  # the same context as thirty addresses
    assert [(s["kind"], texts[last][s["start"]:s["end"]]) for s in out[last]["more"]] == [("email", "user77-at-host9")]
    assert all(not out[i]["more"] for i in range(len(texts) - 1))
    assert pii.find_personal_data(rows(spark, [])).count() == 0


def test_personal_data_of_a_text_of_very_many_addresses():
    text = " ".join(f"mail user{i}@mail.example.com or ask ID-{i:06d} +1 (234) 555-0101x" for i in range(100_000))
    start = time.monotonic()
    spans = pii.base_spans(text)
    found = pii.candidates(text, spans)
    assert time.monotonic() - start < 60
    assert sum(s[0] == "email" for s in spans) == 100_000 and len(found) >= 200_000
    part = text[:20_000]
    spans = pii.base_spans(part)
    free = [(c["start"], c["end"]) for c in pii.candidates(part, spans) if c["seed"] is None]
    assert free and all(b <= x or y <= a for a, b in free for _, x, y in spans)


def test_shards(spark):
    texts = TEXTS + ["y" * (i % 50) for i in range(500)]
    out = shards.shard(rows(spark, texts).repartition(5), shards=8, parts=6).orderBy("doc_id").collect()
    total = sum(r["size"] for r in out)
    by = {}
    for r, text in zip(out, texts):
        data = (text or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
        by.setdefault(r["shard"], []).append(r)
    assert [r["shard"] for r in out] == sorted(r["shard"] for r in out)
    for own in by.values():
        assert [r["slot"] for r in own] == list(range(len(own)))
        assert sum(r["size"] for r in own) <= total / 8 + max(r["size"] for r in out)
    assert shards.shard(rows(spark, [])).count() == 0
    assert shards.shard(rows(spark, ["a", "a"], [None, None])).count() == 2


def test_line_runs(spark):
    rng = random.Random(4)
    shared = [f"Shared line number {k} with more than forty characters" for k in range(5)]
    texts = TEXTS + ["\n".join(rng.choice([s, " " + s.upper() + "\t", "own " + str(i)]) for s in shared) for i in range(40)]
    docs = rows(spark, texts).unionByName(rows(spark, [shared[0]], [None]))
    seen = {}
    key = lambda l: lower(l.strip(" \t\n\x0b\x0c\r"))
    for i, text in enumerate(texts):
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                seen.setdefault(key(line), set()).add(i)
    top = {k: max(v) for k, v in seen.items() if len(v) >= 5}
    for batches in (1, 7):
        for r in lines.drop_repeated_lines(docs, batches=batches).collect():
            split = (r["text"] or "").split("\n")
            kept = [l for l in split if r["doc_id"] is None or top.get(key(l), r["doc_id"]) == r["doc_id"]]
            assert (r["kept"], r["n_lines"], r["n_dropped"]) == ("\n".join(kept), len(split), len(split) - len(kept))
    assert lines.drop_repeated_lines(rows(spark, [])).count() == 0


def test_line_runs_of_a_text_of_very_many_lines(spark):
    shared = [f"shared line {k} that is longer than forty characters" for k in range(50_000)]
    own = [f"own line {k} that is longer than forty characters" for k in range(100_000)]
    texts = ["\n".join(own + shared + shared)] + ["\n".join(shared)] * 4
    start = time.monotonic()
    out = {r["doc_id"]: r for r in lines.drop_repeated_lines(rows(spark, texts)).collect()}
    assert time.monotonic() - start < 60
    assert (out[0]["kept"], out[0]["n_lines"], out[0]["n_dropped"]) == ("\n".join(own), 200_000, 100_000)
    assert [out[i]["n_dropped"] for i in range(1, 5)] == [50_000] * 3 + [0] and out[4]["kept"] == texts[4]


def test_line_runs_of_repeated_ids(spark):
    line = "a line that is certainly longer than forty characters"
    texts = [line] * 5 + ["x\n" + line, line, line + "\ny", line]
    out = lines.drop_repeated_lines(rows(spark, texts, [0, 1, 2, 3, 4, 4, 1, 1, 1])).collect()
    got = sorted((r["doc_id"], r["text"], r["kept"]) for r in out)
    assert got == sorted((i, t, t if i == 4 else "\n".join(x for x in t.split("\n") if x != line))
                         for i, t in zip([0, 1, 2, 3, 4, 4, 1, 1, 1], texts))


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = docs.where("doc_id % 3 <> 1")
    model = language.train(learned)
    out = language.identify(docs, model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out if r["doc_id"] % 3 == 1]) > 0.95
    odd = language.identify(rows(spark), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in odd][:3] == ["und"] * 3 and odd[9]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 for r in odd)
    # a text's code length is the sum of its bytes' conditional costs, whatever the chunking
    data = np.frombuffer(("abc the der les " * 40).encode(), np.uint8)
    whole = model.code_lengths(data, np.array([0, len(data)]))
    step, language.STEP = language.STEP, 7
    try:
        assert np.allclose(model.code_lengths(data, np.array([0, len(data)])), whole, rtol=1e-5)
    finally:
        language.STEP = step
    # in every context the bytes' probabilities add up to about one
    sums = np.exp2(-model.bits.reshape(-1, model.A, len(model.languages)).astype(float)).sum(1)
    assert sums.min() > 0.3 and sums.max() < 1.01
    empty = language.train(learned.limit(0))
    assert {r["lang_pred"] for r in language.identify(rows(spark), empty).collect()} == {"und"}


def test_language_sample_counts_distinct_texts(spark):
    copied = [(f"copied text {i % 20} of it", "aa") for i in range(10_000)]
    large = [(f"text number {i}", "bb") for i in range(3000)]
    docs = spark.createDataFrame(copied + large, "text string, lang string")
    n = {r["lang"]: r["count"] for r in language.sample_rows(docs, "text", "lang").groupBy("lang").count().collect()}
    assert n["aa"] == 20 and 300 < n["bb"] < 500
    assert language.train(docs).languages == ["aa", "bb"]


def test_language_of_many_labels(spark):
    letters = "abcdefghijklmnop"
    words = {f"l{k:03}": [f"{letters[k // 16]}{letters[k % 16]}{c}{letters[k % 16]}" for c in letters] for k in range(100)}
    rng = random.Random(9)
    texts = [(lang, " ".join(rng.choices(own, k=60))) for lang, own in words.items() for _ in range(6)]
    docs = spark.createDataFrame([(i, t, lang, None, 1) for i, (lang, t) in enumerate(texts)], SCHEMA)
    model = language.train(docs.where("doc_id % 6 <> 0"))
    assert model.languages == sorted(words)
    out = language.identify(docs.where("doc_id % 6 = 0"), model).collect()
    assert len(out) == 100 and all(r["lang"] == r["lang_pred"] for r in out)
    # one block after the other gives what all code lengths together give
    data, offsets = language.utf8(language.pa.array([t for _, t in texts[::7]] + ["", "Ж!", "abca" * 90]))
    bits = model.code_lengths(data, offsets)
    best, share = model.best(data, offsets)
    assert bits.shape[1] == 100 and (best == bits.argmin(1)).all()
    assert np.allclose(share, 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1))


def test_language_keeps_all_contexts():
    def counts(text, times):
        data, offsets = language.utf8(language.pa.array([text]))
        gram = data.astype(np.int64)
        for back in (1, 2, 3):
            gram |= language._before(data, offsets, back).astype(np.int64) << 8 * back
        grams, n = np.unique(gram, return_counts=True)
        return grams, n * times

    rng = random.Random(8)
    large = counts("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60_000)), 100)
    small = "Ünï ñandú, 日本語 και Жук " * 3
    alone, both = language.Model({"small": counts(small, 1)}), language.Model({"large": large, "small": counts(small, 1)})
    data, offsets = language.utf8(language.pa.array([small]))
    assert np.allclose(both.code_lengths(data, offsets)[:, 1], alone.code_lengths(data, offsets)[:, 0], rtol=1e-5)


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    good = ["plain words go here and on and on", "some other plain text to read"] * 30
    bad = ["BUY!!! NOW!!! $$$ ###", "win*** big### cash%%%"] * 30
    own = rows(spark, good + bad)
    marks = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)], "doc_id bigint, quality int, toxic int")
    classifier = quality.train(own, marks)
    out = {r["doc_id"]: r["score"] for r in quality.with_scores(own, classifier).collect()}
    assert min(out[i] for i in range(60)) > max(out[i] for i in range(60, 120))
    odd = quality.with_scores(rows(spark), classifier).collect()
    assert all(0 <= r["score"] <= 1 for r in odd) and len(odd) == len(TEXTS)
    assert {r["score"] for r in quality.with_scores(docs, quality.train(docs, labels.limit(0))).collect()} == {0.5}


def test_quality_learns_one_row_an_id(spark, monkeypatch):
    learned = []
    monkeypatch.setattr(quality.Classifier, "fit", classmethod(lambda cls, texts, labels: learned.extend(zip(texts, labels)) or cls(None)))
    docs = rows(spark, [f"copy {i % 3}" for i in range(300)] + ["other", None], [1] * 300 + [2, 3])
    marks = spark.createDataFrame([(i, i % 2, 0) for i in (1, 2, 3)], "doc_id bigint, quality int, toxic int")
    quality.train(docs, marks)
    least = min(("copy 0", "copy 1", "copy 2"), key=lambda t: xxhash.xxh64_intdigest(t, 42) - (1 << 64) * (xxhash.xxh64_intdigest(t, 42) >> 63))
    assert sorted(learned) == sorted([(least, 1), ("other", 0)])


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and all(r["round_trip"] for r in out)
    assert len({r["doc_id"] for r in out}) == len(out)
    docs = rows(spark, TEXTS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, SF)
        assert done.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    kept = corpus_pipeline.keep_known_languages(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert kept.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("lang", [None, "und"])
def test_lettered_documents_stay_without_labels(spark, lang):
    docs = rows(spark, TEXTS).withColumn("lang", F.lit(lang).cast("string"))
    kept = corpus_pipeline.keep_known_languages(spark, docs, SF)
    assert kept.columns == docs.columns
    lettered = {i for i, t in enumerate(TEXTS) if t and re.search("[A-Za-z]", t)}
    assert {r["doc_id"] for r in kept.collect()} == lettered


def test_queries_are_whole(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op3_bottom_k_sketch", "op4_wu_manber", "op6_bootstrapped_pii"):
        assert queries.QUERIES[name](spark, SF).count() == n


def test_rank_table_has_a_place_for_each_pair(vocab):
    offsets, table = bpe.displaced(vocab.pairs)
    for pair, rank in vocab.pairs.items():
        assert table[offsets[pair >> 16] + (pair & 65_535)] == pair >> 16 << 32 | rank
    assert sum(entry is not None for entry in table) == len(vocab.pairs)


def test_pipeline_encodes_without_a_second_copy_of_the_texts(spark, monkeypatch):
    read_by, add_columns = [], bpe.add_columns
    monkeypatch.setattr(bpe, "add_columns", lambda frame, *rest: read_by.append(frame.columns) or add_columns(frame, *rest))
    out = corpus_pipeline.encode(spark, rows(spark, TEXTS), SF)
    assert "text" in read_by[0] and "text" not in read_by[1]
    assert [r["round_trip"] for r in out.collect()] == [True] * len(TEXTS)


def test_python_gets_batches_of_bounded_bytes(spark):
    # a slice's buffer is the whole batch's
    def start():
        def step(texts):
            return [pa.array([texts.buffers()[2].size] * len(texts), pa.int64())]

        return step

    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("0123456789"), 1000).alias("text"))
    held = common.add_columns(texts, [T.StructField("held", T.LongType())], ["text"], start).agg(F.max("held"), F.count("*")).first()
    assert held[0] <= 2 * common.BATCH_BYTES and held[1] == 3000


def test_bpe_plan_holds_the_rank_table_once(spark, vocab):
    encoded = bpe.encode(rows(spark), vocab, decoded_col="decoded")
    plan = encoded._jdf.queryExecution().logical().toString()
    assert plan.count("from_json") <= 2


def test_words_are_encoded_as_by_the_library():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), idfiles.WordEncoder(path, added_tokens=True)
    letters = "abz\xdf\xe9\xf6\xf7\xf8\xffAZ\xc9\xd7\xaa\xb5̸́İΣи日" + "1१'.,$%<=>|_-*&^`~\xb4"
    rng = random.Random(8)
    words = ["".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(4000)] + ["caf\xe9$$$", "re%%%'s", "it's...", "<|endoftext|>"]
    texts = [None, "", " \n", "\x1cone"] + [" ".join(words[a:a + 5]) + rng.choice(["", " ", " "]) for a in range(0, len(words), 5)]
    for part in (texts[4:-1], texts):  # with and without what Arrow can't cut
        ids, counts = encoder.encode(pa.array(part))
        each = np.split(ids, np.cumsum(counts)[:-1])
        for text, got in zip(part, each, strict=True):
            assert got.tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def test_words_that_end_with_marks_go_together(monkeypatch):
    encoder = idfiles.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), added_tokens=True)
    given, encode = [], encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda texts, *rest: given.extend(texts) or encode(texts, *rest))
    words = ["".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(4000)]
    encoder.encode(pa.array([" ".join(w + rest for w, rest in zip(words, ["$$$", "!", ")", "\xe9", ""] * 800))]))
    assert len(given) <= 20  # one by one before


def test_packing_takes_no_step_for_each_selector_and_word(monkeypatch):
    ids = np.random.default_rng(4).integers(0, 49_000, 1 << 16)
    calls, flatnonzero = [], np.flatnonzero
    monkeypatch.setattr(idfiles.np, "flatnonzero", lambda x: calls.append(len(x)) or flatnonzero(x))
    words, offsets = idfiles.pack(ids)
    monkeypatch.undo()
    assert len(calls) <= 16  # before, for each selector of each word of a block
    assert (idfiles.unpack(words, offsets, len(ids)) == ids).all()


def test_segments_are_cut_inside_a_slice(spark):
    assert [b - a for a, b in idfiles.cut_at(np.full(4000, 5), 1000)] == [200] * 20
    assert idfiles.cut_at(np.array([7, 3000, 0, 1]), 1000) == [(0, 2), (2, 4)]
    where = scratch_folder(spark, "ids")
    texts = ["a b c d e f g h " * 20_000] * 10
    idfiles.write_ids(rows(spark, texts).coalesce(1), where, public_tokenizers.path("word_bpe_49k.json"), 1)
    assert spark.read.parquet(where).agg(F.max("n_ids")).first()[0] < 2 * idfiles.SEGMENT
    assert [r["n_tokens"] for r in idfiles.read_ids(spark, where).collect()] == [160_001] * 10
