"""Synonyms of several words against a plain loop over tokens."""

import random

from pyspark.sql import functions as F

from trawl.functions import analysis as A
from trawl.functions.phrases import phrase_rules, phrase_synonyms, slots_of
from trawl.sources import rulefiles

RULES = """
# a rule, a group and right sides of several lengths
new york => nyc, big apple town
new york city => metropolis
usa, united states, united states of america
york city => wrong
x => y z
gone =>
"""


def plain(tokens, rules):
    out, i = [], 0
    while i < len(tokens):
        for n in range(4, 0, -1):
            key = " ".join(t.lower() for t in tokens[i:i + n])
            if i + n <= len(tokens) and key in rules:
                out += slots_of(rules[key])
                i += n
                break
        else:
            out.append(tokens[i])
            i += 1
    return out


def run(spark, texts, step):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.s for r in rows.select("i", step(F.col("t")).alias("s")).orderBy("i").collect()]


def test_rules_are_read():
    rules = phrase_rules(RULES)
    assert rules["new york"] == [["nyc"], ["big", "apple", "town"]] and "gone" not in rules
    assert rules["usa"] == rules["united states"] == [["usa"], ["united", "states"], ["united", "states", "of", "america"]]
    assert phrase_rules(RULES, False)["united states of america"] == [["usa"]]
    assert slots_of(rules["new york"]) == [f"nyc{A.ALT}big", "apple", "town"]


def test_longest_match_wins(spark):
    rng = random.Random(2)
    words = "new york City united STATES of america usa x other gone".split()
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(150)] + ["", "x", "new", "New York City", None]
    for expand in (True, False):
        step = A.chain(A.whitespace, phrase_synonyms(RULES, expand))
        want = [None if t is None else plain(t.split(), phrase_rules(RULES, expand)) for t in texts]
        assert run(spark, texts, step) == want
    assert run(spark, ["a b"], A.chain(A.whitespace, phrase_synonyms(""))) == [["a", "b"]]


def test_long_texts_and_many_rules(spark, tmp_path):
    lines = [f"w{i} w{i + 1} => p{i} q{i}" for i in range(20_000)]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(str(tmp_path / "rules"))
    text = rulefiles.read_synonyms(spark, str(tmp_path / "rules"))
    assert sorted(text.splitlines()) == sorted(lines)
    long = " ".join(f"w{i % 19_000}" for i in range(100_000))
    step = A.chain(A.whitespace, phrase_synonyms(text))
    assert run(spark, [long], step) == [plain(long.split(), phrase_rules(text))]
