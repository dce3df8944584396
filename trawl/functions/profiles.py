"""Named analyzer chains, one for indexing and one for queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column

from trawl.functions import analysis as A
from trawl.functions.markup import strip_html
from trawl.functions.metaphone import phonetic_codes
from trawl.functions.stemming import porter


@dataclass(frozen=True)
class Profile:
    index: A.Step
    query: A.Step


_TEXT_INDEX = (A.stop(), A.word_delimiter(), A.lower, A.fold)
_TEXT_QUERY = (
    A.fold, A.keyword_repeat, A.remove_duplicates, A.stop(),
    A.word_delimiter(catenate=False), A.lower, A.remove_duplicates, A.synonyms(),
)
_GEN_INDEX = (A.stop(), A.word_delimiter(split_case=False), A.lower)
_GEN_QUERY = (A.stop(), A.word_delimiter(catenate=False, split_case=False), A.lower, A.synonyms())
_TIGHT = (
    A.stop(), A.word_delimiter(parts=False), A.lower, A.minimal_stem(),
    A.remove_duplicates, A.synonyms(expand=False),
)
_STEM_INDEX = (A.stop(), A.word_delimiter(), A.lower, porter())
_STEM_QUERY = (A.stop(), A.word_delimiter(catenate=False), A.lower, A.synonyms(), porter(), A.remove_duplicates)
_SPELL = (A.stop(), A.length_between(4, 20), A.lower, A.remove_duplicates)


def _same(step: A.Step) -> Profile:
    return Profile(step, step)


TEXT_QUERY = A.chain(A.whitespace, *_TEXT_QUERY)
STEM_QUERY = A.chain(A.whitespace, *_STEM_QUERY)

PROFILES: dict[str, Profile] = {
    "text": Profile(A.chain(A.whitespace, *_TEXT_INDEX), TEXT_QUERY),
    "htmltext": Profile(A.chain(A.whitespace, *_TEXT_INDEX, char_filter=strip_html), TEXT_QUERY),
    "text_stem": Profile(A.chain(A.whitespace, *_STEM_INDEX), STEM_QUERY),
    "htmltext_stem": Profile(A.chain(A.whitespace, *_STEM_INDEX, char_filter=strip_html), STEM_QUERY),
    "text_ws": _same(A.chain(A.whitespace)),
    "textgen": Profile(A.chain(A.whitespace, *_GEN_INDEX), A.chain(A.whitespace, *_GEN_QUERY)),
    "text_rev": Profile(
        A.chain(A.whitespace, *_GEN_INDEX, A.reverse_copies), A.chain(A.whitespace, *_GEN_QUERY)
    ),
    "textTight": _same(A.chain(A.whitespace, *_TIGHT)),
    "textSpell": _same(A.chain(A.standard, *_SPELL)),
    "textSpellHtml": _same(A.chain(A.standard, *_SPELL, char_filter=strip_html)),
    "lowercase": _same(A.chain(A.keyword, A.lower)),
    "alphaOnlySort": _same(A.chain(A.keyword, A.lower, A.trim, A.pattern_replace("[^a-z]"))),
    "phonetic": _same(A.chain(A.standard, phonetic_codes)),
    "text_path": _same(A.chain(A.path_hierarchy)),
    "string": _same(A.chain(A.keyword)),
}


def index_slots(text: Column, profile: str = "text") -> Column:
    return PROFILES[profile].index(text)


def query_slots(text: Column, profile: str = "text") -> Column:
    return PROFILES[profile].query(text)
