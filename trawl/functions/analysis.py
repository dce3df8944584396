"""Text analysis as Column expressions.

A *tokenizer* maps text to an array of slots; a *step* maps slots to slots. The
index of a slot is the token position. A slot normally holds one term; terms
that share a position are separated by ``ALT``, and an empty slot is the gap a
removed stop word leaves behind. No step leaves the JVM or shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

from trawl.functions import rules
from trawl.functions.folding import ascii_fold

Step = Callable[[Column], Column]

ALT = "\u0002"
GLUE = "\u0001"
GAP = ""

# Word parts: an upper-to-lower change does not split, lower-to-upper does.
PARTS_CASE = r"[\p{Lu}\p{Lt}]+[\p{Ll}\p{Lm}\p{Lo}\p{M}]*|[\p{Ll}\p{Lm}\p{Lo}\p{M}]+|\p{N}+"
PARTS_PLAIN = r"[\p{L}\p{M}]+|\p{N}+"
POSSESSIVE = r"(\p{L})'[sS]($|[^\p{L}\p{N}])"
STANDARD = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{N}]+)*"


def each_term(slots: Column, fn: Callable[[Column], Column]) -> Column:
    """Apply a one-string function inside every slot, alternatives included."""
    def one(slot: Column) -> Column:
        several = F.array_join(F.transform(F.split(slot, ALT), fn), ALT)
        return F.when(F.contains(slot, F.lit(ALT)), several).otherwise(fn(slot))
    return F.transform(slots, one)


# Tokenizers ---------------------------------------------------------------

def whitespace(text: Column) -> Column:
    return F.filter(F.split(text, f"[{rules.WHITESPACE}]+"), lambda t: t != "")


def standard(text: Column) -> Column:
    """Unicode word runs; an approximation of the UAX #29 word break."""
    return F.regexp_extract_all(text, F.lit(STANDARD), F.lit(0))


def keyword(text: Column) -> Column:
    return F.array(text)


def path_hierarchy(text: Column) -> Column:
    """``/a/b/c`` to ``/a``, ``/a/b``, ``/a/b/c`` (all at one position)."""
    parts = F.filter(F.split(text, "/"), lambda p: p != "")
    root = F.when(text.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    prefixes = F.transform(
        parts, lambda _, i: F.concat(root, F.array_join(F.slice(parts, 1, i + 1), "/"))
    )
    return F.when(F.size(prefixes) > 0, F.array(F.array_join(prefixes, ALT))).otherwise(
        F.array().cast("array<string>")
    )


# Steps --------------------------------------------------------------------

def stop(words: Iterable[str] = rules.STOPWORDS) -> Step:
    """Empty the slots that hold a stop word; positions are kept."""
    listed = [w.lower() for w in words]
    return lambda slots: F.transform(
        slots, lambda t: F.when(F.lower(t).isin(listed), F.lit(GAP)).otherwise(t)
    )


def word_delimiter(parts: bool = True, catenate: bool = True, split_case: bool = True) -> Step:
    """Split tokens at punctuation, letter/digit and lower-to-upper changes.

    ``catenate`` also emits adjacent letter (or digit) parts joined, at the
    position of the last of them; without ``parts`` only the joined runs remain.
    """
    pattern = PARTS_CASE if split_case else PARTS_PLAIN

    def pieces(token: Column) -> Column:
        bare = F.when(
            F.contains(token, F.lit("'")), F.regexp_replace(token, POSSESSIVE, "$1$2")
        ).otherwise(token)
        return F.when(token == GAP, F.array(F.lit(GAP))).otherwise(
            F.regexp_extract_all(bare, F.lit(pattern), F.lit(0))
        )

    def runs(found: Column) -> Column:
        glued = F.array_join(found, GLUE)
        kind_change = f"(?<=\\p{{N}}){GLUE}(?!\\p{{N}})|(?<!\\p{{N}}){GLUE}(?=\\p{{N}})"
        return F.split(glued, kind_change)

    def with_joined(run: Column) -> Column:
        joined = F.replace(run, F.lit(GLUE), F.lit(""))
        return F.when(
            F.contains(run, F.lit(GLUE)), F.concat(run, F.lit(ALT), joined)
        ).otherwise(run)

    def expand(found: Column) -> Column:
        if not catenate:
            return found
        if parts:
            rich = F.flatten(
                F.transform(runs(found), lambda r: F.split(with_joined(r), GLUE))
            )
        else:
            rich = F.transform(runs(found), lambda r: F.replace(r, F.lit(GLUE), F.lit("")))
        return F.when(F.size(found) > 1, rich).otherwise(found)

    return lambda slots: F.flatten(F.transform(F.transform(slots, pieces), expand))


def lower(slots: Column) -> Column:
    return F.transform(slots, F.lower)


def fold(slots: Column) -> Column:
    return F.transform(slots, ascii_fold)


def trim(slots: Column) -> Column:
    return F.transform(slots, F.trim)


def pattern_replace(pattern: str, replacement: str = "") -> Step:
    return lambda slots: F.transform(
        slots, lambda t: F.regexp_replace(t, pattern, replacement)
    )


def length_between(shortest: int, longest: int) -> Step:
    return lambda slots: F.transform(
        slots,
        lambda t: F.when(F.length(t).between(shortest, longest), t).otherwise(F.lit(GAP)),
    )


def keyword_repeat(slots: Column) -> Column:
    """Every token twice at its position, as a protected and a plain copy."""
    return F.transform(
        slots, lambda t: F.when(t == GAP, t).otherwise(F.concat(t, F.lit(ALT), t))
    )


def remove_duplicates(slots: Column) -> Column:
    return F.transform(
        slots,
        lambda t: F.when(
            F.contains(t, F.lit(ALT)), F.array_join(F.array_distinct(F.split(t, ALT)), ALT)
        ).otherwise(t),
    )


def synonyms(text: str = rules.SYNONYMS, expand: bool = True) -> Step:
    """Replace a term by its rule's terms, all at the same position."""
    table = rules.synonym_map(text, expand)
    pairs = [x for word, terms in table.items() for x in (word, ALT.join(terms))]

    def run(slots: Column) -> Column:
        lookup = F.create_map(*map(F.lit, pairs))
        replaced = each_term(
            slots, lambda t: F.coalesce(F.try_element_at(lookup, F.lower(t)), t)
        )
        return remove_duplicates(replaced)

    return run


def minimal_stem(protected: Iterable[str] = rules.PROTECTED) -> Step:
    """Light English plural stemmer."""
    kept = list(protected)

    def one(t: Column) -> Column:
        n = F.length(t)
        before_last = F.substring(t, -2, 1)
        third_last = F.substring(t, -3, 1)
        fourth_last = F.substring(t, -4, 1)
        ies = (before_last == "e") & (third_last == "i") & (n > 3)
        return (
            F.when((n < 3) | ~t.endswith("s") | t.isin(kept), t)
            .when(before_last.isin("u", "s"), t)
            .when(ies & ~fourth_last.isin("a", "e"), F.concat(t.substr(F.lit(1), n - 3), F.lit("y")))
            .when((before_last == "e") & third_last.isin("i", "a", "o", "e"), t)
            .otherwise(t.substr(F.lit(1), n - 1))
        )

    return lambda slots: each_term(slots, one)


def reverse_copies(slots: Column) -> Column:
    """Index every term together with its reversed form (marked with U+0001)."""
    def one(t: Column) -> Column:
        return F.when(t == GAP, t).otherwise(
            F.concat(t, F.lit(ALT), F.lit("\u0001"), F.reverse(t))
        )
    return each_term(slots, one)


def phonetic(slots: Column) -> Column:
    return F.transform(slots, lambda t: F.when(t == GAP, t).otherwise(F.soundex(t)))


# Running a chain ----------------------------------------------------------

def chain(tokenizer: Step, *steps: Step, char_filter: Step | None = None) -> Step:
    """One Column function out of a tokenizer and its filters, applied in order."""
    def run(text: Column) -> Column:
        slots = tokenizer(char_filter(text) if char_filter else text)
        for step in steps:
            slots = step(slots)
        return slots
    return run


def payloads(text: Column) -> Column:
    """``term|1.4`` tokens as an array of (term, weight); the weight may be null."""
    return F.transform(
        whitespace(text),
        lambda t: F.struct(
            F.substring_index(t, "|", 1).alias("term"),
            F.when(
                F.contains(t, F.lit("|")),
                F.substring_index(t, "|", -1).try_cast("float"),
            ).alias("weight"),
        ),
    )
