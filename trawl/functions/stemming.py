"""Porter stemming as Column steps (M. Porter, "An algorithm for suffix stripping", 1980).

A word is worked on with every consonant ``y`` replaced by a mark, so that vowels are a
character class and the measure of a stem is a pattern. Each step is bound once to a lambda
variable, so the expression grows with the number of steps and not with their product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from trawl.functions import rules
from trawl.functions.analysis import Step, each_term

# The published suffix tables of steps 2 to 4, longest match first.
STEP2 = """ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent
eli:e ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful
ousness:ous aliti:al iviti:ive biliti:ble logi:log"""
STEP3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
STEP4 = """al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"""

#: A consonant y.
MARK = "\u0003"
V, C = "[aeiouy]", "[^aeiouy]"
OVER_0 = f"^{C}*{V}+{C}"
ONE = f"^{C}*{V}+{C}+{V}*$"
OVER_1 = f"^{C}*{V}+{C}+{V}+{C}"
#: Consonant, vowel, consonant at the end, the last not w, x or y.
CVC = f"{C}{V}[^aeiouywx{MARK}]$"
DOUBLE = f"([^aeiouylsz{MARK}])\\1$|y{MARK}$"


def _less(word: Column, n: int | Column) -> Column:
    return F.left(word, F.length(word) - n)


def _plural(w: Column) -> Column:
    return (
        F.when(w.rlike("(?:sses|ies)$"), _less(w, 2)).when(w.rlike("[^s]s$"), _less(w, 1)).otherwise(w)
    )


def _past(w: Column) -> Column:
    cut = F.when(w.rlike(f"{V}.*ed$"), _less(w, 2)).when(w.rlike(f"{V}.*ing$"), _less(w, 3))

    def mended(stem: Column) -> Column:
        return (
            F.when(stem.rlike("(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
            .when(stem.rlike(DOUBLE), _less(stem, 1))
            .when(stem.rlike(ONE) & stem.rlike(CVC), F.concat(stem, F.lit("e")))
            .otherwise(stem)
        )

    return (
        F.when(w.endswith("eed"), F.when(_less(w, 3).rlike(OVER_0), _less(w, 1)).otherwise(w))
        .otherwise(F.coalesce(_bound(cut, mended), w))
    )


def _last_y(w: Column) -> Column:
    return F.when(w.rlike(f"{V}.*[y{MARK}]$"), F.concat(_less(w, 1), F.lit("i"))).otherwise(w)


def _suffixes(table: str, least: str) -> Callable[[Column], Column]:
    """The longest suffix of a table replaced if the stem before it is long enough. A search
    finds the leftmost match, which is the longest suffix."""
    pairs = [entry.partition(":")[::2] for entry in table.split()]
    pattern = "(?:" + "|".join(suffix for suffix, _ in pairs) + ")$"

    def step(w: Column) -> Column:
        return _bound(F.regexp_extract(w, pattern, 0), lambda suffix: replaced(w, suffix))

    def replaced(w: Column, suffix: Column) -> Column:
        to = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
        stem = _less(w, F.length(suffix))
        enough = stem.rlike(least) & ((suffix != "ion") | stem.rlike("[st]$"))
        return F.when((suffix != "") & enough, F.concat(stem, F.try_element_at(to, suffix))).otherwise(w)

    return step


def _last_e(w: Column) -> Column:
    stem = _less(w, 1)
    enough = stem.rlike(OVER_1) | (stem.rlike(ONE) & ~stem.rlike(CVC))
    return F.when(w.endswith("e") & enough, stem).otherwise(w)


def _last_l(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(OVER_1), _less(w, 1)).otherwise(w)


STEPS = (
    lambda w: F.regexp_replace(w, "(^|[aeiouy])y", f"$1{MARK}"),
    _plural, _past, _last_y, _suffixes(STEP2, OVER_0), _suffixes(STEP3, OVER_0), _suffixes(STEP4, OVER_1),
    _last_e, _last_l,
    lambda w: F.translate(w, MARK, "y"),
)


def _bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def stem(word: Column, protected: Iterable[str] = rules.PROTECTED) -> Column:
    """The stem of a lower-case word; short and protected words are their own."""
    def whole(w: Column) -> Column:
        out = w
        for step in STEPS:
            out = _bound(out, step)
        return F.when((F.length(w) <= 2) | w.isin(list(protected)), w).otherwise(out)

    return _bound(word, whole)


def porter(protected: Iterable[str] = rules.PROTECTED) -> Step:
    """Analysis step: every term replaced by its stem."""
    kept = list(protected)
    return lambda slots: each_term(slots, lambda t: stem(t, kept))


def stem_table(vocab: DataFrame, protected: Iterable[str] = rules.PROTECTED) -> DataFrame:
    """``vocab`` plus ``stem``."""
    return vocab.withColumn("stem", stem(F.col("term"), list(protected)))
