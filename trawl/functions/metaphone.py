"""Double metaphone: the two codes of a word, by a table of letters in their context.

A rule is what stands before, the letters it consumes, what follows, and the two codes. At each
place the first rule that fits applies, and the next place is behind its letters. All rules together
are one regular expression, whose alternatives capture their code from a list appended to the word:
one ``regexp_replace`` a code turns a word into it, inside generated code and without Python.
"""

from __future__ import annotations

import re
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import Column, functions as F

from trawl.functions.analysis import ALT, GAP, each_term

END = "~"
#: Properties of a whole word, one character each behind ``END``: Slavic or Germanic spelling, and how it begins.
FLAGS = (("S", "W|K|CZ"), ("G", "^SCH"), ("M", "^MC"), ("A", "^[DRM]ANGER"))
CODE_CHARS = 4


class Rule(NamedTuple):
    before: str  # a pattern right before the letters; "!" in front denies it
    letters: str
    after: str  # a pattern right behind them, ``END`` at the word's end; "!" denies it
    flag: str  # a property the word must have; "!" denies it
    primary: str
    secondary: str


# The published rules of double metaphone, "before | letters | after | flag | codes". One code
# stands for both; "-" is no code; "_" is a blank.
RULES = """
^ | [GKP] | N | | -
^ | P | S | | -
^ | W | R | | -
^ | [AEIOUY] | | | A
 | [AEIOUY] | | | -
 | BB? | | | P
 | Ç | | | S
 | CH | IA | | K
[^AEIOUY]A | CH | !IE | | K
[BM]A | CH | ER | | K
^ | CA | ESAR | | S
. | CH | AE | | K X
^ | CH | ARAC|ARIS|YM|IA|EM | | K
^ | CH | OR[^E] | | K
 | CH | | G | K
OR | CH | ES|ID | | K
AR | CH | IT | | K
 | CH | [TS] | | K
^|[AOUE] | CH | [LRNMBHFVW~] | | K
. | CH | | M | K
^M | CH | | | K
. | CH | | | X K
 | CH | | | X
!WI | CZ | | | S X
 | CCI | A | | X
^A | CC[IE] | | | KS
^A | CCH | !U | | KS
U | CCE | [ES] | | KS
!^M | CC[IE] | | | X
!^M | CCH | !U | | X
!^M | CC | | | K
 | C[KGQ] | | | K
 | CI | [OEA] | | S X
 | C[IEY] | | | S
 | CC | !EI | | K
 | C | | | K
 | DG[IEY] | | | J
 | DG | | | TK
 | D[TD]? | | | T
 | FF? | | | F
[^AEIOUY] | GH | | | K
^ | GH | I | | J
^ | GH | | | K
[BHD].|[BHD]..|[BH]... | GH | | | -
[CGLRT].U | GH | | | F
[^I] | GH | | | K
 | GH | | | -
^[AEIOUY] | GN | | !S | KN N
 | GN | EY | | KN
 | GN | | !S | N KN
 | GN | | | KN
 | GL | I | !S | KL L
^ | GY | | | K J
^ | GE | [SPBLYIR] | | K J
^ | GI | [BLNE] | | K J
!EIRO | GY | | !A | K J
!EI | GE | R | !A | K J
 | G[EIY] | | G | K
[AO] | GG | I | G | K
 | GE | T | | K
 | GI | ER | | J
 | G[EIY] | | | J K
[AO] | GG | I | | J K
 | GG? | | | K
^|[AEIOUY] | H[AEIOUY] | | | H
 | H | | | -
^ | J | OSE~ | | H
 | J | OSE | | J H
^ | JJ? | | | J A
[AEIOUY] | J | [AO] | !S | J H
 | J | ~ | | J _
!SKL | JJ? | !LTKSNMBZ | | J
 | JJ? | | | -
 | KK? | | | K
I | LL | [OA]~ | | L -
A | LL | E~ | | L -
A | LL | E[^~]*(?:AS|OS|A|O)~ | | L -
 | LL? | | | L
U | MB | ~|ER | | M
 | MM? | | | M
 | NN? | | | N
 | Ñ | | | N
 | PH | | | F
 | P[PB]? | | | P
 | QQ? | | | K
M[EA]IE | R | ~ | | R
IE | R | ~ | !S | - R
 | RR? | | | R
[IY] | S | L | | -
^ | S | UGAR | | X S
 | SH | EIM|OEK|OLM|OLZ | | S
 | SH | | | X
 | SI[OA] | | S | S
 | SI[OA] | | | S X
^ | S | [MNLW] | | S X
 | SZ | | | S X
 | SCH | E[RN] | | X SK
 | SCH | OO|UY|E[DM] | | SK
^ | SCH | !AEIOUYW | | X S
 | SCH | | | X
 | SC[IEY] | | | S
 | SC[^~]? | | | SK
[AO]I | S | ~ | | - S
 | S[SZ]? | | | S
 | TIO | N | | X
 | TIA|TCH | | | X
 | TH | [OA]M | | T
 | TH | | G | T
 | TT | H | G | T
 | TH | | | 0 T
 | TT | H | | 0 T
 | T[TD]? | | | T
 | VV? | | | F
 | WR | | | R
^ | W | [AEIOUY] | | A F
^ | W | H | | A
[AEIOUY] | W | ~ | | - F
[EO] | W | SK[IY] | | - F
 | W | | G | - F
 | WI[CT]Z | | | TS FX
 | W | | | -
^ | X | | | S
[AO]U | X | ~ | | -
 | X[CX]? | | | KS
 | ZH | | | J
 | ZZ | [OIA] | | S TS
[^T] | ZZ? | | S | S TS
 | ZZ? | | | S
 | [^~] | | | -
"""


def rules(text: str = RULES) -> list[Rule]:
    """The table's rows. Columns are set apart by `` | ``, which no pattern holds."""
    out = []
    for line in text.strip("\n").splitlines():
        before, letters, after, flag, codes = (part.strip() for part in re.split(r" \|(?= |$)", line))
        primary, *other = codes.replace("_", " ").split(" ", 1) if "_" in codes else codes.split()
        out.append(Rule(before, letters, after, flag, *(("" if c == "-" else c) for c in (primary, *(other or [primary])))))
    return out


TABLE = rules()
CODES = "".join(f"<{c}>" for c in sorted({c for r in TABLE for c in (r.primary, r.secondary) if c}))


def _denied(pattern: str) -> tuple[bool, str]:
    """``!EI`` denies a class of letters, ``!WI`` and ``!^M`` one string."""
    if not pattern.startswith("!"):
        return False, pattern
    bare = pattern[1:]
    return True, bare if bare in ("WI", "^M") else f"[{bare}]"


def flag_pattern(flag: str) -> str:
    """What the properties behind ``END`` look like for a rule's flag."""
    denied, name = flag.startswith("!"), flag.lstrip("!")
    place = [f for f, _ in FLAGS].index(name)
    return "." * place + ("-" if denied else name)


def _alternative(rule: Rule, code: str) -> str:
    out = ""
    if rule.before:
        denied, pattern = _denied(rule.before)
        out += f"(?<{'!' if denied else '='}{pattern})"
    out += f"(?:{rule.letters})"
    if rule.after:
        denied, pattern = _denied(rule.after)
        out += f"(?{'!' if denied else '='}{pattern})"
    if rule.flag:
        out += f"(?=[^{END}]*{END}{flag_pattern(rule.flag)})"
    return out + (f"(?=.*<({re.escape(code)})>)" if code else "")


def _encoder(codes: list[str]) -> tuple[str, str]:
    by_letter = []  # rules of one letter are tried at that letter only
    for letter, own in groupby(zip(TABLE, codes), lambda pair: pair[0].letters[0]):
        tried = "|".join(_alternative(*pair) for pair in own)
        by_letter.append(tried if letter == "[" else f"(?={letter})(?:{tried})")
    pattern = "|".join(by_letter) + f"|{END}.*"
    return pattern, "".join(f"${i}" for i in range(1, sum(map(bool, codes)) + 1))


PRIMARY, SECONDARY = _encoder([r.primary for r in TABLE]), _encoder([r.secondary for r in TABLE])


def prepared(word: Column) -> Column:
    """The word in upper case with its properties and the list of codes behind it."""
    upper = F.translate(F.upper(word), "~<>\n", "____")
    flags = [F.when(upper.rlike(pattern), name).otherwise("-") for name, pattern in FLAGS]
    return F.concat(upper, F.lit(END), *flags, F.lit(CODES))


def double_metaphone(word: Column) -> Column:
    """A struct of ``primary`` and ``secondary``, of four characters at most; null for null, empty
    codes for a word without any sounding letter."""
    given = prepared(word)
    return F.struct(*(
        F.substring(F.regexp_replace(given, pattern, codes), 1, CODE_CHARS).alias(name)
        for name, (pattern, codes) in (("primary", PRIMARY), ("secondary", SECONDARY))
    ))


def phonetic_codes(slots: Column) -> Column:
    """Each term replaced by its codes, both at its position; a term without a code stays."""
    def one(term: Column) -> Column:
        codes = double_metaphone(term)
        found = F.filter(F.array_distinct(F.array(codes["primary"], codes["secondary"])), lambda c: c != "")
        return F.when((term == GAP) | (F.size(found) == 0), term).otherwise(F.array_join(found, ALT))
    return each_term(slots, one)
