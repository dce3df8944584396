"""Synonyms of several words: the longest rule at each position, its right side at following positions.

Rules are looked up in literal tables by hash, so that their number doesn't decide what a token costs. Matches
are found for all tokens at once; of those that overlap the first counts, chosen by a fold over the
matches alone in blocks of the square root of their number. Nothing leaves the row or the JVM.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from trawl.functions import rules
from trawl.functions.analysis import ALT, Step


def phrase_rules(text: str, expand: bool = True) -> dict[str, list[list[str]]]:
    """Left side, its words in lower case and joined by blanks, to the word lists it becomes.

    ``a b => c d, e`` has two right sides. A group without an arrow stands for all of its
    members, without ``expand`` for its first. Rules of one left side add up.
    """
    out: dict[str, list[list[str]]] = {}
    for line in text.splitlines():
        left, arrow, right = line.split("#", 1)[0].partition("=>")
        names, targets = ([side.split() for side in part.lower().split(",") if side.strip()] for part in (left, right))
        if not arrow:
            targets = names if expand else names[:1]
        for name in names:
            known = out.setdefault(" ".join(name), [])
            known += [t for t in targets if t not in known]
    return {k: v for k, v in out.items() if v}


def slots_of(sides: list[list[str]]) -> list[str]:
    """The k-th words of all right sides share the k-th position."""
    return [ALT.join(dict.fromkeys(s[k] for s in sides if len(s) > k)) for k in range(max(map(len, sides)))]


def _table(values: dict, kind: str) -> Callable[[Column], Column]:
    """A literal table of strings to values: small maps, found by a hash of the key."""
    size = 1 << max(0, (len(values) - 1).bit_length())
    places: list[dict | None] = [None] * size
    for key, value in values.items():
        place = zlib.crc32(key.encode()) % size
        places[place] = {**(places[place] or {}), key: value}
    # folded once while planning
    maps = F.from_json(F.lit(json.dumps(places)), f"array<map<string,{kind}>>")
    return lambda key: F.try_element_at(F.get(maps, (F.crc32(key.cast("binary")) % size).cast("int")), key)


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def phrase_synonyms(text: str = rules.SYNONYMS, expand: bool = True) -> Step:
    """Replace runs of tokens by their rules' right sides. Case is ignored on the left; a slot with
    alternatives, or one that was emptied, is part of no match."""
    known = phrase_rules(text, expand)
    if not known:
        return lambda slots: slots
    reach: dict[str, int] = {}
    for left in known:
        words = left.split(" ")
        reach[words[0]] = max(len(words), reach.get(words[0], 0))
    longest = max(reach.values())
    right, reaches = _table({k: slots_of(v) for k, v in known.items()}, "array<string>"), _table(reach, "int")

    def match(low: Column, at: Column, far: Column) -> Column:
        """The longest rule whose left side begins at a token."""
        tried = []
        for n in range(longest, 0, -1):
            found = right(F.array_join(F.slice(low, at + 1, F.lit(n)), " "))
            tried.append(F.when((far >= n) & (at + n <= F.size(low)), _let(found, lambda slots: F.when(  # noqa: B023
                slots.isNotNull(), F.struct(at.alias("at"), (at + n).alias("end"), slots.alias("slots"))))))  # noqa: B023
        return F.coalesce(*tried)

    def matches(low: Column) -> Column:
        return F.filter(F.transform(low, lambda t, i: _let(
            reaches(t), lambda far: F.when(far.isNotNull(), match(low, i, far)))), F.isnotnull)

    def first_of_overlapping(all_: Column) -> Column:
        none = F.slice(all_, 1, 0)

        def take(state: Column, m: Column) -> Column:
            return F.when(m["at"] < state["free"], state).otherwise(
                F.struct(m["end"].alias("free"), F.concat(state["out"], F.array(m)).alias("out")))

        def block(state: Column, b: Column, width: Column) -> Column:
            own = F.aggregate(F.slice(all_, b * width + 1, width), F.struct(state["free"].alias("free"), none.alias("out")), take)
            return _let(own, lambda x: F.struct(x["free"].alias("free"), F.concat(state["out"], x["out"]).alias("out")))

        def fold(width: Column) -> Column:
            blocks = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / width).cast("int"))
            return F.aggregate(blocks, F.struct(F.lit(0).alias("free"), none.alias("out")), lambda s, b: block(s, b, width))["out"]

        return _let(F.greatest(F.ceil(F.sqrt(F.size(all_).cast("double"))).cast("int"), F.lit(1)), fold)

    def replaced(slots: Column, chosen: Column) -> Column:
        def upto(m: Column, k: Column) -> Column:
            begin = F.when(k == 0, F.lit(0)).otherwise(F.get(chosen, k - 1)["end"])
            return F.concat(F.slice(slots, begin + 1, m["at"] - begin), m["slots"])
        rest = F.element_at(chosen, -1)["end"]
        return F.concat(F.flatten(F.transform(chosen, upto)), F.slice(slots, rest + 1, F.size(slots) - rest))

    def run(slots: Column) -> Column:
        def of(s: Column) -> Column:
            every = _let(F.transform(s, F.lower), matches)
            only = every if longest == 1 else _let(every, lambda m: F.when(F.size(m) > 0, first_of_overlapping(m)).otherwise(m))
            return _let(only, lambda chosen: F.when(F.size(chosen) > 0, replaced(s, chosen)).otherwise(s))
        return _let(slots, of)

    return run
