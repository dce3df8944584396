"""Porter stemming word by word, to hold the Column steps against."""

from __future__ import annotations

import re

# The published suffix tables of steps 2 to 4, longest match first.
STEP2 = """ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent
eli:e ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful
ousness:ous aliti:al iviti:ive biliti:ble logi:log"""
STEP3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
STEP4 = """al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"""


def _pairs(table: str) -> list[tuple[str, str]]:
    entries = [tuple(e.partition(":")[::2]) for e in table.split()]
    return sorted(entries, key=lambda e: -len(e[0]))


_STEP2, _STEP3, _STEP4 = _pairs(STEP2), _pairs(STEP3), _pairs(STEP4)


def _shape(word: str) -> str:
    """The word as a string of v (vowel) and c (consonant)."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _ends_cvc(stem: str) -> bool:
    return _shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _double_consonant(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _suffix(word: str, table: list[tuple[str, str]], least: int) -> str:
    for suffix, new in table:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) > least else word
    return word


def porter_stem(word: str) -> str:
    if len(word) <= 2:
        return word
    # plurals
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # past tenses
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            stem = word[: -len(suffix)]
            if word.endswith(suffix) and "v" in _shape(stem):
                word = stem
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif _double_consonant(word) and word[-1] not in "lsz":
                    word = word[:-1]
                elif _measure(word) == 1 and _ends_cvc(word):
                    word += "e"
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _suffix(word, _STEP2, 0)
    word = _suffix(word, _STEP3, 0)
    for suffix, _ in _STEP4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                word = stem
            break
    if word.endswith("e"):
        stem = word[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _ends_cvc(stem)):
            word = stem
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word
