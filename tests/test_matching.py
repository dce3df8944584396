"""Matching on small corpora against brute force."""

import fnmatch
import math
import random

import pytest
from pyspark.sql import functions as F

from trawl.operators import lookups as L
from trawl.operators import matching as M
from trawl.operators import postings as P
from trawl.operators import ranking as R
from trawl.operators import results
from trawl.operators import sizing, store
from trawl.operators.criteria import MISSING, PRESENT, Range
from trawl.operators.search import search

TEXTS = [
    "the quick brown fox", "quick brown dogs jump", "Wi-Fi router for the quick fox",
    "brown quick fox", "lazy dog", "fire engine", "firefly at night", "wifi cafe",
    "quick quick quick", "on fire",
]
Q = M.SearchQuery


def corpus(spark, texts=TEXTS, **columns):
    rows = [(i, t, "en" if i % 2 else None, i * 10) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, size long")
    return store.build(docs.drop("text"), [P.TextSource("_text", docs.select("doc_id", "text"))])


def found(result):
    return sorted(r.doc_id for r in result.matches.collect())


EXPECTED = {
    "quick": [0, 1, 2, 3, 8],
    "quick fox": [0, 2, 3],
    '"quick brown"': [0, 1],
    '"brown quick" fox': [3],
    "wi-fi": [2],
    "wifi": [2, 7],
    "fire*": [5, 6, 9],
    "*fly": [6],
    "f?re": [5, 9],
    "the": [],
    "absent quick": [],
}


def as_batch(result):
    rows = result.matches.collect()
    return {text: sorted(r.doc_id for r in rows if r.query_id == text) for text in EXPECTED}


def test_terms_as_one_batch(spark):
    queries = [Q(text).add_search_term(text) for text in EXPECTED]
    assert as_batch(search(corpus(spark), queries)) == EXPECTED


def test_single_query(spark):
    assert found(search(corpus(spark), [Q().add_search_term("quick fox")])) == [0, 2, 3]


def test_fuzzy(spark):
    assert found(search(corpus(spark), [Q().add_fuzzy_search_term("quikc")])) == [0, 1, 2, 3, 8]


def test_score_is_the_documented_formula(spark):
    hits = {r.doc_id: r.score for r in search(corpus(spark), [Q().add_search_term("quick")]).matches.collect()}
    idf = 1 + math.log(len(TEXTS) / (5 + 1))
    assert hits[8] == pytest.approx(math.sqrt(3) * idf**2 / math.sqrt(3), abs=1e-6)
    assert hits[3] == pytest.approx(idf**2 / math.sqrt(3), abs=1e-6)


def test_filters_never_change_the_score(spark):
    index = corpus(spark)
    plain = {r.doc_id: r.score for r in search(index, [Q().add_search_term("quick")]).matches.collect()}
    q = Q().add_search_term("quick").add_filter("lang", ["en", MISSING]).add_exclude("size", [Range(80, None)])
    some = {r.doc_id: r.score for r in search(index, [q]).matches.collect()}
    assert some == {k: v for k, v in plain.items() if k < 8}


def test_batch_with_own_filters(spark):
    queries = [
        Q("a").add_search_term("quick"), Q("b").add_search_term("quick").add_filter("lang", "en"),
        Q("c").add_filter("size", Range(80, 90)),
    ]
    result = search(corpus(spark), queries)
    rows = {(r.query_id, r.doc_id) for r in result.matches.collect()}
    assert rows == {("a", d) for d in (0, 1, 2, 3, 8)} | {("b", 1), ("b", 3), ("c", 8), ("c", 9)}
    assert {r.query_id: r.num_found for r in result.num_found.collect()} == {"a": 5, "b": 2, "c": 2}


def test_published_index_gives_the_same(spark, tmp_path):
    lazy = corpus(spark)
    disk = store.publish(lazy, str(tmp_path), 1)
    queries = [Q(text).add_search_term(text) for text in EXPECTED]
    rows = [sorted(search(i, queries).matches.collect()) for i in (lazy, disk)]
    assert rows[0] == rows[1]
    again = store.load(spark, f"{tmp_path}/gen=1")
    assert again.postings.count() == lazy.postings.count()


def test_changes_reach_a_published_index(spark, tmp_path):
    """Two generations of changes, one of them empty, give what a full rebuild gives."""
    def texts(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        return docs.drop("text"), [P.TextSource("_text", docs)]

    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "doc_id long")

    disk = store.publish(store.build(*texts(list(enumerate(TEXTS)))), str(tmp_path), 1)
    disk = store.publish_changes(
        disk, *texts([(0, "a slow wolf"), (20, "quick quick fox"), (21, None)]), ids(1, 2, 99), str(tmp_path), 2)
    disk = store.publish_changes(disk, *texts([]), ids(), str(tmp_path), 3)
    disk = store.publish_changes(disk, *texts([(1, "brown again"), (20, "fire drill")]), ids(20, 5), str(tmp_path), 4)
    now = dict(enumerate(TEXTS)) | {0: "a slow wolf", 1: "brown again", 20: "fire drill", 21: None}
    whole = store.build(*texts([(k, v) for k, v in now.items() if k not in (2, 5)]))
    queries = [Q(text).add_search_term(text) for text in EXPECTED] + [Q("near").add_fuzzy_search_term("quikc")]
    merged = store.publish(disk, str(tmp_path), 5)
    assert len(merged.roots) == 1
    for index in (disk, merged, store.load(spark, disk.roots)):
        assert sorted(search(index, queries).matches.collect()) == sorted(search(whole, queries).matches.collect())
        assert sorted(index.documents.collect()) == sorted(whole.documents.collect())
        rows = {(r.term, r.df) for r in index.vocab.collect()}
        assert rows == {(r.term, r.df) for r in whole.vocab.collect()}
    with pytest.raises(ValueError):
        store.publish_changes(whole, *texts([]), ids(1), str(tmp_path), 6)


def scans(frame):
    """The filters of the plan's scans, those on partitions and those pushed down."""
    frame.collect()
    lines = [x for x in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    return tuple(" ".join(x.split(name)[1].split("]")[0] for x in lines) for name in ("PartitionFilters", "PushedFilters"))


def test_lookups_of_a_published_index_are_pruned(spark, tmp_path):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("bcdfghk") for _ in range(rng.randint(2, 9))) for _ in range(600)})
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    index = store.publish(store.build(docs.drop("text"), [P.TextSource("_text", docs)]), str(tmp_path), 1)
    gone = spark.createDataFrame([(i,) for i in range(0, 600, 7)], "doc_id long")
    index = store.publish_changes(index, docs.limit(0).drop("text"), [P.TextSource("_text", docs.limit(0))], gone, str(tmp_path), 2)
    left = [w for i, w in enumerate(words) if i % 7]
    held = {r.term for r in index.vocab.collect()}
    assert held == set(left)
    for pattern in ("bc*", "*bc", "*bcd*", "b?d*", "*b*h", "?", "b*", "*g?"):
        asked = spark.createDataFrame([("_text", pattern)], "field string, term string")
        found = L.matching(asked, index.rotations)
        assert {r.term for r in found.collect()} & held == {w for w in left if fnmatch.fnmatchcase(w, pattern)}
        partitions, pushed = scans(found)
        assert "StringStartsWith(key" in pushed and ("bucket" in partitions or pattern in ("?", "*b*h", "*g?"))
    asked = spark.createDataFrame([("_text", words[8]), ("_text", "bcdfkg")], "field string, term string")
    found = L.near(asked, index.pieces)
    assert {(r.word, r.term) for r in found.collect() if r.term in held} == {
        (a, w) for a in (words[8], "bcdfkg") for w in left if distance(a, w) <= 2}
    partitions, pushed = scans(found)
    assert "In(key" in pushed and "bucket" in partitions
    some = spark.createDataFrame([(5,), (6,)], "doc_id long")
    found = store.forward_of(index, some)
    assert {(r.doc_id, r.term) for r in found.collect()} == {(5, words[5]), (6, words[6])}
    partitions, pushed = scans(found)
    assert "In(doc_id" in pushed and "bucket" in partitions


def test_postings_are_grouped_and_written_in_place(spark, tmp_path, monkeypatch):
    """Values of their own need no shuffle of postings, neither to be grouped nor to be published."""
    texts = ["a b a Wi-Fi's a", "", " the ", None, "b wi-fi2 b 2", "x"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "b a")], "doc_id long, text string")
    sources = [P.TextSource("_text", docs), P.TextSource("rev", docs, "text_rev")]
    index = store.build(docs.drop("text"), sources)
    plan = index.postings._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "hashpartitioning" not in plan

    def rows(frame):
        columns = ("field", "term", "source", "doc_id", "val_no", "tf", "positions", "n_terms")
        return sorted(map(tuple, frame.select(*columns).collect()), key=repr)

    assert rows(index.postings) == rows(P.postings(P.explode_terms(P.analysed(sources)))) != []
    twice = [P.TextSource("_text", docs.union(docs))]  # the same value in two rows is one posting
    found = rows(store.build(docs.drop("text"), twice).postings)
    assert found == rows(P.postings(P.explode_terms(P.analysed(twice)))) and {r[5] % 2 for r in found} == {0}
    few = store.publish(index, str(tmp_path), 1)
    for name in ("SMALL_BYTES", "SMALL_TERMS"):
        monkeypatch.setattr(store, name, 0)
    many = store.publish(index, str(tmp_path), 2)
    for table in ("postings", "vocab", "forward", "pieces", "rotations"):
        a, b = (getattr(x.tables, table) for x in (few, many))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect())) != []


def test_many_words_are_marked_as_few_are(spark):
    """A wildcard's words grow with the vocabulary; those a text doesn't have change nothing and cost one hash each."""
    texts = ["Wi-Fi wi-fi2 WIFI x", "(Éa-b) éa thane'S 12.5 a1-b\nab", "", None, "FooBar fooBar-BAZ foobarbaz", "œuvre _ab_ a\u0301b 1-2-3"]
    some = ["wifi", "ea", "eab", "thane", "125", "foo", "bar", "foobar", "foobarbaz", "oeuvre", "ab", "123", "b"]
    docs = spark.createDataFrame([(t, some, some + [f"zz{i}" for i in range(4000)], None) for t in texts * 50],
                                 "t string, few array<string>, many array<string>, none array<string>")
    marked = docs.select(*[results.mark_terms(F.col("t"), F.col(c)).alias(c) for c in ("few", "many", "none")], "t")
    rows = marked.collect()
    assert all(r.few == r.many and r.none == r.t for r in rows) and rows[0].few == "<em>Wi-Fi</em> <em>wi-fi</em>2 <em>WIFI</em> x"
    assert "array_intersect" in marked._jdf.queryExecution().executedPlan().toString()


def test_many_keys_are_looked_up_by_joins(spark, monkeypatch):
    vocab = spark.createDataFrame([("f", w, 1) for w in ("alpha", "alpine", "beta", "ab")], "field string, term string, df long")
    wanted = spark.createDataFrame([("f", w) for w in ("alp*", "*a", "b*", "*")], "field string, term string")
    few = sorted(L.matching(wanted, L.rotations(vocab)).collect())
    monkeypatch.setattr(L, "LITERAL_BEGINNINGS", 1)
    assert sorted(L.matching(wanted, L.rotations(vocab)).collect()) == few
    monkeypatch.setattr(L, "LITERAL_KEYS", 1)
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 1)
    assert sorted(L.matching(wanted, L.rotations(vocab)).collect()) == few and len(few) == 9
    near = L.near(wanted.limit(0).unionByName(spark.createDataFrame([("f", "alpa")], wanted.schema)), L.pieces(vocab))
    assert {r.term for r in near.collect()} == {"alpha"}


def test_values_are_filtered_by_joins(spark, tmp_path):
    """Every filter of many values against a plain scan, on a lazy, a published and a changed index."""
    rng = random.Random(6)
    rows = {i: [(f, rng.choice(["1", "2.0", "30", "x", "007"])) for f in "abb" for _ in range(rng.randint(0, 2))] for i in range(60)}

    def parts(rows):
        docs = spark.createDataFrame([(i, "word") for i in rows], "doc_id long, text string")
        values = spark.createDataFrame([(i, f, v) for i, own in rows.items() for f, v in own], "doc_id long, field string, value string")
        return docs.drop("text"), [P.TextSource("_text", docs)], values

    lazy = store.build(*parts(rows))
    disk = store.publish(lazy, str(tmp_path), 1)
    new = {i: [("a", "x"), ("b", "2.0")] for i in range(5)} | {70: [("b", "1")], 71: []}
    docs, sources, values = parts(new)
    gone = spark.createDataFrame([(9,), (10,)], "doc_id long")
    changed = store.publish_changes(disk, docs, sources, gone, str(tmp_path), 2, values)
    now = {i: own for i, own in (rows | new).items() if i not in (9, 10)}

    def number(v):
        try:
            return float(v)
        except ValueError:
            return None

    tests = {
        "x": lambda v: v == "x", 2: lambda v: number(v) == 2, Range(2, 40): lambda v: number(v) is not None and 2 <= number(v) <= 40,
        Range("2", None): lambda v: v >= "2", PRESENT: lambda v: True,
    }
    cases = {
        "one": ({"a": ["x"]}, {}), "two": ({"a": ["x", 2], "b": [Range(2, 40)]}, {}), "none": ({"a": [MISSING]}, {}),
        "either": ({"b": [MISSING, "x"]}, {}), "not": ({}, {"a": ["x", Range("2", None)]}), "has": ({"a": [PRESENT]}, {"b": [2]}),
        "must": ({}, {"a": [MISSING, 2]}), "free": ({}, {}), "all": ({"b": [MISSING, PRESENT]}, {}),
    }

    def holds(own, field, values):
        held = [v for f, v in own if f == field]
        return any((not held) if t is MISSING else any(tests[t](v) for v in held) for t in values)

    queries = []
    for name, (required, excluded) in cases.items():
        q = Q(name).add_search_term("word") if name != "two" else Q(name)
        for f, v in required.items():
            q.add_filter(f, v)
        for f, v in excluded.items():
            q.add_exclude(f, v)
        queries.append(q)
    for index, held in ((lazy, rows), (disk, rows), (changed, now)):
        got = {(r.query_id, r.doc_id) for r in search(index, queries).matches.collect()}
        assert got == {(n, i) for n, (req, exc) in cases.items() for i, own in held.items()
                       if all(holds(own, f, v) for f, v in req.items()) and not any(holds(own, f, v) for f, v in exc.items())}


def test_equal_filters_of_a_batch_are_one(spark):
    queries = [Q(f"q{i}").add_search_term("quick").add_filter("lang", "en") for i in range(40)]
    queries += [Q(f"r{i}").add_search_term("quick").add_filter("size", Range(0, 15)) for i in range(40)] + [Q("free").add_search_term("quick")]
    result = search(corpus(spark), queries).matches
    rows = {(r.query_id, r.doc_id) for r in result.collect()}
    assert rows == {(f"q{i}", d) for i in range(40) for d in (1, 3)} | {(f"r{i}", d) for i in range(40) for d in (0, 1)} | {
        ("free", d) for d in (0, 1, 2, 3, 8)}
    assert result._jdf.queryExecution().optimizedPlan().toString().count("__filter#") < 20


def test_an_empty_index_is_published(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    disk = store.publish(store.build(docs.drop("text"), [P.TextSource("_text", docs)]), str(tmp_path), 1)
    assert search(disk, [Q().add_search_term("quick")]).matches.collect() == []


def test_a_frequent_term_is_spread_over_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "FILE_ROWS", 100)
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("everywhere").alias("text"))
    disk = store.publish(store.build(docs.drop("text"), [P.TextSource("_text", docs)]), str(tmp_path), 1)
    files = disk.postings.groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 10 and max(r["count"] for r in files) <= 100


def test_expanded_and_folded_words_are_marked(spark):
    index = corpus(spark, ["Café PowerShot, firefly-FIRE 4x4", None, "fire"])
    got = search(index, [Q().add_search_term("fire* cafe power 4")])
    words = results.highlight_terms(got.terms)
    text = F.lit("Café PowerShot, firefly-FIRE 4x4 cafés")
    row = got.matches.join(words, "query_id").select(results.mark_terms(text, F.col("words")).alias("m")).first()
    assert row.m == ("<em>Café</em> <em>Power</em>Shot, <em>firefly-FIRE</em> "
                     "<em>4</em>x<em>4</em> cafés")


def test_joined_runs_and_html_are_marked(spark):
    words = F.array(*map(F.lit, ("wifi", "fire", "44", "cafe", "powershot", "ab")))
    cases = {
        "Wi-Fi and WI - FI": "<em>Wi-Fi</em> and WI - FI", "(wi.fi)": "(<em>wi.fi</em>)", "wifi's Power_Shot2": "<em>wifi</em>'s <em>Power_Shot</em>2",
        "4.4 4x4 a-b": "<em>4.4</em> 4x4 <em>a-b</em>", "fire-fly Fire/fire": "<em>fire</em>-fly <em>Fire</em>/<em>fire</em>", "": "", "-": "-",
    }
    html = {
        "<p class='fire'>Fire <b>wi</b>fi Wi-<i>Fi</i></p>": "<p class='fire'><em>Fire</em> <b>wi</b>fi Wi-<i>Fi</i></p>",
        "<!-- fire --><script>fire</script>caf&eacute; &amp; x&lt;fire": "<!-- fire --><script>fire</script><em>caf&eacute;</em> &amp; x&lt;<em>fire</em>",
        "a < fire, AT&T wi-fi": "a < <em>fire</em>, AT&T <em>wi-fi</em>", "": "", "Caf&#233;s (caf&#233;)": "Caf&#233;s (<em>caf&#233;</em>)",
    }
    for given, fn in ((cases, results.mark_terms), (html, results.mark_html)):
        rows = spark.createDataFrame([(t,) for t in given], "t string").select("t", fn(F.col("t"), words).alias("m")).collect()
        assert {r.t: r.m for r in rows} == given


def test_order_pins_and_facets_of_a_search(spark):
    rules = spark.createDataFrame(
        [("quick", 9, False, 1), ("quick", 3, True, None), ("other", 4, False, 1)],
        "text string, doc_id long, excluded boolean, pin int")
    got = search(corpus(spark), [Q().add_search_term("quick")], order=[R.sort_key("size", True)], pins=rules,
                 facets=["lang"])
    assert [r.doc_id for r in got.hits.orderBy("rank").collect()] == [9, 8, 2, 1, 0]
    assert [(r.value, r["count"]) for r in got.facets.collect()] == [("en", 2)]


def test_lookup_of_many_terms_joins(spark, monkeypatch):
    """Beyond the literal and broadcast bounds the result is the same."""
    index = corpus(spark)
    q = [Q().add_search_term("quick fox")]
    few = sorted(search(index, q).matches.collect())
    monkeypatch.setattr(store, "LITERAL_KEYS", 1)
    monkeypatch.setattr(store, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 1)
    assert sorted(search(corpus(spark), q).matches.collect()) == few


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def test_near_terms_is_exact(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(300)})
    asked = words[::9] + ["abcabcabcab", "x", "xy"]
    vocab = spark.createDataFrame([("f", w, 1) for w in words], "field string, term string, df long")
    wanted = spark.createDataFrame([("f", w) for w in asked], "field string, term string")
    got = {(r.word, r.term, r.distance) for r in L.near(wanted, L.pieces(vocab)).collect()}
    expected = {(a, w, distance(a, w)) for a in asked for w in words if distance(a, w) <= 2}
    assert got == expected


def test_wildcards_are_exact(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab%_") for _ in range(rng.randint(1, 6))) for _ in range(200)})
    asked = ["a*", "*a", "*ab*", "a?b*", "?", "*", "ab", "*%*", "_*", "??a*b", "*b?"]
    vocab = spark.createDataFrame([("f", w, 1) for w in words], "field string, term string, df long")
    wanted = spark.createDataFrame([("f", w) for w in asked], "field string, term string")
    got = {(r.word, r.term) for r in L.matching(wanted, L.rotations(vocab)).collect()}
    assert got == {(a, w) for a in asked for w in words if fnmatch.fnmatchcase(w, a)}


def test_fields_boosts_and_best_field(spark):
    rows = [(1, "alpha", "beta"), (2, "beta", "alpha"), (3, "gamma", "gamma")]
    docs = spark.createDataFrame(rows, "doc_id long, title string, body string")
    sources = [
        P.TextSource("Title", docs.select("doc_id", F.col("title").alias("text"))),
        P.TextSource("Body", docs.select("doc_id", F.col("body").alias("text"))),
        P.TextSource("_text", docs.select("doc_id", F.col("title").alias("text")), source="Title"),
        P.TextSource("_text", docs.select("doc_id", F.col("body").alias("text")), source="Body"),
    ]
    index = store.build(docs.select("doc_id"), sources)
    assert found(search(index, [Q().add_search_term("alpha", ["Title"])])) == [1]
    assert found(search(index, [Q().add_search_term("alpha beta")])) == [1, 2]
    boosted = search(index, [Q().add_search_term("alpha", boost={"Title": 3.0, "Body": 1.0})])
    assert [r.doc_id for r in boosted.hits.orderBy("rank").collect()] == [1, 2]
    best = search(index, [Q().add_search_term("alpha")], {"Title": 2.0, "_text": 1.0})
    scores = {r.doc_id: r.score for r in best.matches.collect()}
    idf = 1 + math.log(3 / 2)
    assert scores[1] == pytest.approx(2 * idf**2, abs=1e-6)
    # the default field of both documents has two terms
    idf_text = 1 + math.log(3 / 3)
    assert scores[2] == pytest.approx(idf_text**2 / math.sqrt(2), abs=1e-6)


def test_phrase_does_not_cross_values(spark):
    turns = spark.createDataFrame(
        [(1, 0, "quick"), (1, 1, "brown fox"), (2, 0, "quick brown")],
        "doc_id long, val_no long, text string",
    )
    index = store.build(
        turns.select("doc_id").distinct(), [P.TextSource("_text", turns, "text", multi=True)]
    )
    assert found(search(index, [Q().add_search_term('"quick brown"')])) == [2]
    assert found(search(index, [Q().add_search_term("quick brown")])) == [1, 2]
    lengths = {(r.doc_id, r.term): r.n_terms for r in index.postings.collect()}
    assert lengths[(1, "quick")] == 3


def test_pages_and_deep_pages(spark):
    hits = spark.range(3000).select(F.lit("q").alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 7).cast("double").alias("score"))
    assert R.page_bounds() == (1, 10)
    assert R.page_bounds(20, 5) == (21, 25)
    assert R.page_bounds(20, 5, offset=0, length=2) == (1, 2)
    whole = [r.doc_id for r in hits.orderBy(*R.by_score()).collect()]
    deep = R.page(hits, start=1500, limit=20).orderBy("rank").collect()
    assert [r.doc_id for r in deep] == whole[1500:1520]
    assert [r["rank"] for r in deep] == list(range(1501, 1521))


def test_elevation(spark):
    hits = spark.createDataFrame([("q", "a", 3.0), ("q", "b", 2.0), ("q", "c", 1.0)], "query_id string, doc_id string, score double")
    docs = spark.createDataFrame([(x,) for x in "abcd"], "doc_id string")
    rules = spark.createDataFrame(
        [("foo", "d", False, 0), ("foo", "c", False, 1), ("foo", "a", True, 2), ("foo", "zz", False, 3)],
        "text string, doc_id string, excluded boolean, pin int",
    )
    queries = spark.createDataFrame([("q", " foo")], "query_id string, text string")
    out = R.ranked(R.elevate(hits, docs, rules, queries), R.by_elevation(), 1, 10)
    assert [r.doc_id for r in out.orderBy("rank").collect()] == ["d", "c", "b"]


def test_spelling(spark):
    index = corpus(spark)
    wanted = M.wanted_terms(M.query_rows(spark, [Q().add_search_term("quikc brown foxx")]))
    fixed = results.suggestions(wanted, index)
    assert {r.word: r.suggestion for r in fixed.collect()} == {"quikc": "quick", "foxx": "fox"}
    collation = results.collate(wanted, fixed).first().collation
    assert collation == "+quick +brown +fox"
    row = spark.createDataFrame([(collation,)], "c string").select(
        results.nice(F.col("c")).alias("n"), results.query_string(F.col("c")).alias("u"),
        results.first_suggestion(F.array("c", F.lit("x"))).alias("f"),
    ).first()
    assert (row.n, row.u, row.f) == ("quick brown fox", "quick+brown+fox", collation)


def test_highlight_and_excerpt(spark):
    df = spark.createDataFrame([("one two three four five Fox six c++ seven &#65533;", ["fox", "c++"])], "t string, w array<string>")
    row = df.select(
        results.mark(F.col("t"), F.array(F.lit("fox"))).alias("m"),
        results.excerpt([results.snippet(F.col("t"), F.array(F.lit("fox")), 2),
                         results.snippet(F.col("t"), F.array(F.lit("none"))), F.lit("&#65533;x")]).alias("e"),
    ).first()
    assert row.m == "one two three four five <em>Fox</em> six c++ seven &#65533;"
    assert row.e == "four five <em>Fox</em> six c++ ... x"


def test_facet_counts_add_up(spark):
    index = corpus(spark)
    result = search(index, [Q().add_search_term("quick")])
    counts = results.facets(result.matches, index.documents, ["size"])
    assert sum(r["count"] for r in counts.collect()) == result.num_found.first().num_found


def test_batch_pages_counts_and_ids(spark):
    docs = spark.createDataFrame([(i, f"word{i % 2} common", i) for i in range(20)], "doc_id long, text string, size long")
    index = store.build(docs.drop("text"), [P.TextSource("_text", docs.select("doc_id", "text"))])
    queries = [M.SearchQuery("a").add_search_term("common").set_limit(1),
               M.SearchQuery("b").add_search_term("comm*").set_page_size(1),
               M.SearchQuery("c").add_search_term("absent")]
    result = search(index, queries)
    counts = {r["query_id"]: r["num_found"] for r in result.num_found.collect()}
    assert counts == {"a": 20, "b": 20, "c": 0}
    ranks = sorted((r["query_id"], r["rank"]) for r in result.hits.collect())
    assert ranks == [("a", 1)] + [("b", r) for r in range(11, 21)]
    with pytest.raises(ValueError):
        search(index, [queries[0], queries[0]])


def test_many_filtered_queries(spark):
    docs = spark.createDataFrame([(i, "common", i) for i in range(8)], "doc_id long, text string, size long")
    index = store.build(docs.drop("text"), [P.TextSource("_text", docs.select("doc_id", "text"))])
    queries = [M.SearchQuery(f"q{i}").add_search_term("common").add_filter("size", i % 8) for i in range(300)]
    found = search(index, queries).num_found.collect()
    assert len(found) == 300 and {r["num_found"] for r in found} == {1}
