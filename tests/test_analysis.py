"""Analyzer steps on single words and short texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from porter import STEP2, STEP3, STEP4, porter_stem
from trawl.functions import analysis as A
from trawl.functions.folding import ascii_fold
from trawl.functions.markup import strip_html
from trawl.functions.profiles import PROFILES
from trawl.functions.stemming import stem, stem_table
from trawl.operators.postings import term_count
from trawl.sources import rulefiles


def run(spark, step, text):
    row = spark.createDataFrame([(text,)], "t string").select(step(F.col("t")).alias("s")).first()
    return [s.split(A.ALT) for s in row.s]


def text_index(spark, text):
    return run(spark, PROFILES["text"].index, text)


@pytest.mark.parametrize("text, expected", [
    ("Wi-Fi", [["wi"], ["fi", "wifi"]]),
    ("PowerShot", [["power"], ["shot", "powershot"]]),
    ("SD500", [["sd"], ["500"]]),
    ("pdp-11-22", [["pdp"], ["11"], ["22", "1122"]]),
    ("O'Neil's", [["o"], ["neil", "oneil"]]),
    ("A1", [["a"], ["1"]]),
    ("the cat", [[""], ["cat"]]),
    ("the, cat", [["the"], ["cat"]]),
    ("HTMLparser", [["htmlparser"]]),
    ("*** cat", [["cat"]]),
    ("Café Straße", [["cafe"], ["strasse"]]),
    ("   ", []),
])
def test_text_index(spark, text, expected):
    assert text_index(spark, text) == expected


def test_query_side_does_not_catenate(spark):
    assert run(spark, PROFILES["text"].query, "Wi-Fi") == [["wi"], ["fi"]]


def test_query_synonyms_expand(spark):
    assert run(spark, PROFILES["text"].query, "a TV") == [
        [""], ["television", "televisions", "tv", "tvs"]
    ]
    assert run(spark, PROFILES["text"].query, "pixima") == [["pixma"]]
    assert run(spark, PROFILES["text"].query, "bbbfoo") == [["bbbfoo", "bbbbar"]]


def test_tight_reduces_and_stems(spark):
    assert run(spark, PROFILES["textTight"].index, "Wi-Fi Ponies TVs") == [
        ["wifi"], ["pony"], ["television"]
    ]


@pytest.mark.parametrize("word, stem", [
    ("ponies", "pony"), ("queries", "query"), ("zombies", "zomby"), ("toes", "toes"),
    ("buses", "buse"), ("cats", "cat"), ("glass", "glass"), ("bus", "bus"), ("as", "as"),
    ("trees", "trees"), ("dontstems", "dontstems"),
])
def test_minimal_stem(spark, word, stem):
    assert run(spark, A.chain(A.keyword, A.minimal_stem()), word) == [[stem]]


def test_reversed_copies(spark):
    assert run(spark, PROFILES["text_rev"].index, "the fire") == [[""], ["fire", "\u0001erif"]]


def test_paths(spark):
    assert run(spark, PROFILES["text_path"].index, "/a/b/c") == [["/a", "/a/b", "/a/b/c"]]


def test_payloads(spark):
    row = spark.createDataFrame([("foo|1.5 bar baz|x",)], "t string").select(
        A.payloads(F.col("t")).alias("p")
    ).first()
    assert [(p.term, p.weight) for p in row.p] == [("foo", 1.5), ("bar", None), ("baz", None)]


@pytest.mark.parametrize("html, text", [
    ("<p>Fish &amp; chips</p>", "Fish & chips"),
    ("a<script>var x = '<b>';</script>b", "a b"),
    ("a<style type='x'>p{}</style >b<!-- no -->c", "a b c"),
    ("caf&#233; &#xE9; &#0; &#99999999;", "café é  &#99999999;"),
    ("1 < 2 and &lt;b&gt;", "1 < 2 and <b>"),
    ("&amp;lt;", "&lt;"),
    ("&aacute;&iacute;&times;&Omega;&frac12;&apos;&nbsp;.", "áí×Ω½' ."),
    ("&unknown; &b c; AT&T; &#38;lt;", "&unknown; &b c; AT&T; &lt;"),
])
def test_strip_html(spark, html, text):
    row = spark.createDataFrame([(html,)], "t string").select(strip_html(F.col("t")).alias("x")).first()
    assert re.sub(r"\s+", " ", row.x).strip() == re.sub(r"\s+", " ", text).strip()


@pytest.mark.parametrize("text, folded", [
    ("Café Ærø Łódź Straße", "Cafe AEro Lodz Strasse"),
    ("ﬁne ﬂow oﬃce ﬆ", "fine flow office st"),
    ("Ｆｕｌｌ　ｗｉｄｔｈ２", "Full　width2"),
    ("x² H₂O ①Ⓐ⑫ ǆ Ŀl ŉ", "x2 H2O 1A12 dz Ll 'n"),
    ("日本 Ω plain", "日本 Ω plain"),
    ("", ""),
])
def test_ascii_fold(spark, text, folded):
    row = spark.createDataFrame([(text,)], "t string").select(ascii_fold(F.col("t")).alias("x")).first()
    assert row.x == folded


def test_phonetic_of_terms_beyond_letters(spark):
    rows = spark.createDataFrame([("robert",), ("r2d2",), ("7up",), ("o'hara",)], "t string").select(
        A.phonetic(F.array("t")).alias("x")).collect()
    assert [r.x[0] for r in rows] == ["R163", "R300", "7up", "O600"]


def test_term_count_counts_shared_positions(spark):
    row = spark.createDataFrame([("the Wi-Fi cat",)], "t string").select(
        term_count(PROFILES["text"].index(F.col("t"))).alias("n")
    ).first()
    assert row.n == 4


@pytest.mark.parametrize("word, stem", [
    # examples of the published algorithm
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("cats", "cat"), ("feed", "feed"),
    ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"),
    ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"), ("sized", "size"),
    ("hopping", "hop"), ("falling", "fall"), ("hissing", "hiss"), ("failing", "fail"),
    ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"),
    ("conditional", "condit"), ("rational", "ration"), ("digitizer", "digit"),
    ("vietnamization", "vietnam"), ("predication", "predic"), ("operator", "oper"),
    ("feudalism", "feudal"), ("decisiveness", "decis"), ("hopefulness", "hope"),
    ("formaliti", "formal"), ("sensibiliti", "sensibl"), ("triplicate", "triplic"),
    ("formative", "form"), ("electrical", "electr"), ("hopeful", "hope"), ("goodness", "good"),
    ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"), ("airliner", "airlin"),
    ("adjustable", "adjust"), ("defensible", "defens"), ("irritant", "irrit"),
    ("replacement", "replac"), ("adjustment", "adjust"), ("dependent", "depend"),
    ("adoption", "adopt"), ("communism", "commun"), ("effective", "effect"), ("probate", "probat"),
    ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("roll", "roll"),
])
def test_porter(word, stem):
    assert porter_stem(word) == stem


def test_stems_agree_with_the_algorithm_word_by_word(spark):
    """Every suffix behind stems of every shape, and words of few letters."""
    rng = random.Random(3)
    suffixes = [e.partition(":")[0] for e in f"{STEP2} {STEP3} {STEP4}".split()]
    suffixes += ["s", "sses", "ies", "ed", "ing", "eed", "y", "e", "ll", "tting", "lling", "yying", "ated", ""]
    words = {"".join(rng.choices("abeilnstxyy", k=rng.randint(0, 5))) + s + rng.choice(["", "", "s", "ly"])
             for s in suffixes for _ in range(60)}
    words |= {"".join(rng.choices("aeyylsz1é", k=rng.randint(1, 7))) for _ in range(2000)}
    rows = spark.createDataFrame([(w,) for w in sorted(words)], "w string").select("w", stem(F.col("w")).alias("s"))
    wrong = [(r.w, r.s, porter_stem(r.w)) for r in rows.collect() if r.s != porter_stem(r.w)]
    assert not wrong, wrong[:10]


def test_stem_table_and_profile(spark):
    vocab = spark.createDataFrame([("running", 2), ("dontstems", 1), (None, 1)], "term string, df long")
    stems = {r.term: r.stem for r in stem_table(vocab).collect()}
    assert stems == {"running": "run", "dontstems": "dontstems", None: None}
    assert run(spark, PROFILES["text_stem"].index, "Wi-Fis the Trees") == [["wi"], ["fi", "wifi"], [""], ["tree"]]
    assert run(spark, PROFILES["text_stem"].query, "tvs running") == [["televis", "tv"], ["run"]]


def test_rule_files(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("# comment\n\nfoo\nBar \n")
    (tmp_path / "syn.txt").write_text("#x\na, b\nc => d\n")
    (tmp_path / "pins.xml").write_text(
        '<elevate><query text="foo bar"><doc id="1"/><doc id="2" exclude="true"/></query>'
        '<query text="x"><doc id="3"/></query></elevate>'
    )
    words = rulefiles.read_words(spark, str(tmp_path / "stop.txt"))
    assert sorted(words) == ["Bar", "foo"]
    assert run(spark, A.chain(A.whitespace, A.stop(words)), "FOO x bar") == [[""], ["x"], [""]]
    rules = rulefiles.read_synonyms(spark, str(tmp_path / "syn.txt"))
    assert run(spark, A.chain(A.whitespace, A.synonyms(rules)), "A c z") == [["a", "b"], ["d"], ["z"]]
    pins = rulefiles.read_elevation(spark, str(tmp_path / "pins.xml")).collect()
    assert sorted((r.text, r.doc_id, r.excluded, r.pin) for r in pins) == [
        ("foo bar", "1", False, 0), ("foo bar", "2", True, 1), ("x", "3", False, 0)
    ]


def slow_parts(token):
    """Character-wise splitting, as a check of the regular expression."""
    parts, last = [], None
    for ch in token:
        kind = "d" if ch.isdigit() else "u" if ch.isupper() else "l" if ch.isalpha() else None
        if kind is None:
            last = None
        elif last is None or (kind == "d") != (last == "d") or (last == "l" and kind == "u"):
            parts.append(ch)
            last = kind
        else:
            parts[-1] += ch
            last = kind
    return parts


def test_word_delimiter_against_characters(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abAB12-_.'") for _ in range(rng.randint(1, 12))) for _ in range(400)]
    words = [w for w in words if "'s" not in w.lower()]
    step = A.chain(A.keyword, A.word_delimiter(catenate=False))
    rows = spark.createDataFrame([(w,) for w in words], "t string").select(
        "t", step(F.col("t")).alias("s")
    ).collect()
    for row in rows:
        assert list(row.s) == slow_parts(row.t), row.t
