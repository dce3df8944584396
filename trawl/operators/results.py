"""Facets, highlighting, excerpts and spelling suggestions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trawl.functions.analysis import PARTS_CASE
from trawl.functions.folding import ascii_fold
from trawl.functions.markup import strip_html
from trawl.operators import lookups as L
from trawl.operators.postings import named
from trawl.operators.sizing import materialised
from trawl.operators.store import TextIndex, Wanted

TOKEN = r"[\p{L}\p{M}\p{N}]+"
TOKENS = rf"{TOKEN}|[^\p{{L}}\p{{M}}\p{{N}}]+"
PUNCTUATION = r"[^\p{L}\p{M}\p{N}\s]"
#: Runs joined over punctuation, and those of one kind within them.
TOKENS_JOINED = rf"{TOKEN}(?:{PUNCTUATION}+{TOKEN})*|[^\p{{L}}\p{{M}}\p{{N}}]+"
KINDS = rf"[\p{{L}}\p{{M}}]+(?:{PUNCTUATION}+[\p{{L}}\p{{M}}]+)*|\p{{N}}+(?:{PUNCTUATION}+\p{{N}}+)*|{PUNCTUATION}+"
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,7});"
WITH_REFERENCES = rf"(?:{TOKEN})?(?:{REFERENCE}(?:{TOKEN})?)+"
# punctuation in front of a reference doesn't take it along
TOKENS_HTML = rf"{WITH_REFERENCES}|{TOKEN}(?:[^\p{{L}}\p{{M}}\p{{N}}\s&]+{TOKEN})*|[^\p{{L}}\p{{M}}\p{{N}}&]+|&"
MARKUP = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[!/]?[a-zA-Z][^>]*>"
EMPHASIS = ("<em>", "</em>")
#: A run that is its own only part and compared as it is; the most common ones are.
PLAIN = r"^[a-z]+\z"
#: Up to so many words are compared one by one with each run of a text.
FEW_WORDS = 256


def facets(hits: DataFrame, documents: DataFrame, fields: Sequence[str],
           values: DataFrame | None = None) -> DataFrame:
    """``query_id, field, value, count`` over all matches.

    Several fields are counted in one pass: the matches are joined to the
    documents once and each row gives one (field, value) pair per field. ``values``
    adds multi-valued fields (``doc_id, field, value``), each value counted.
    """
    pairs = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields
    ])
    single = (
        hits.join(documents.select("doc_id", *fields), "doc_id")
        .select("query_id", F.explode(pairs).alias("p")).select("query_id", "p.field", "p.value")
    )
    if values is not None:
        many = hits.join(values, "doc_id").select("query_id", "field", "value")
        single = single.unionByName(many)
    return (
        single.where(F.col("value").isNotNull())
        .groupBy("query_id", "field", "value").agg(F.count("*").alias("count"))
    )


# Highlighting -------------------------------------------------------------

def highlight_terms(wanted: DataFrame) -> DataFrame:
    """``query_id, words``: the words a query wants marked (bounded by its text)."""
    return wanted.groupBy("query_id").agg(F.array_sort(F.collect_set("term")).alias("words"))


def highlight_query(parts: DataFrame) -> DataFrame:
    """``query_id, hl_query``: plain parts without fields and boosts, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("part", "raw")))
    return parts.groupBy("query_id").agg(F.array_join(ordered.getField("raw"), " ").alias("hl_query"))


def _quoted(words: Column) -> Column:
    escaped = F.transform(words, lambda w: F.regexp_replace(w, r"([^\p{L}\p{N}])", r"\\$1"))
    return F.array_join(escaped, "|")


def mark(text: Column, words: Column) -> Column:
    """Wrap whole-word, case-insensitive occurrences of any of the words."""
    pattern = F.concat(F.lit(r"(?i)\b("), _quoted(words), F.lit(r")\b"))
    return F.regexp_replace(text, pattern, F.lit(f"{EMPHASIS[0]}$1{EMPHASIS[1]}"))


def mark_terms(text: Column, words: Column) -> Column:
    """Wrap whatever the analysis of plain text makes one of ``words``, compared folded and in lower case:
    whole runs of letters and digits, their parts at changes of case or to digits, and parts of one kind
    that the analysis joins over punctuation (``Wi-Fi`` for ``wifi``), from the first to the last.

    Of many words, those that the text has are found first, by hashing all that is compared: a wildcard
    stands for more words the larger the vocabulary is."""
    def one(t: Column, here: Column) -> Column:
        plain = F.coalesce(F.when(F.array_contains(here, t), _emphasised(t)), t)
        return F.when(t.rlike(PLAIN), plain).when(t.rlike(TOKEN), _chunk(t, here)).otherwise(t)

    here = F.when(F.size(words) > FEW_WORDS, F.array_intersect(words, _compared(text))).otherwise(words)
    return named(here, lambda own: _each(text, TOKENS_JOINED, lambda t: one(t, own)))


def _compared(text: Column) -> Column:
    """What ``mark_terms`` compares of a text: runs, their parts, and runs of one kind joined over punctuation."""
    runs, parts, joined = (F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in (TOKEN, PARTS_CASE, KINDS))
    joined = F.transform(joined, lambda k: F.regexp_replace(k, PUNCTUATION, ""))
    return F.transform(F.array_distinct(F.concat(runs, parts, joined)), lambda t: ascii_fold(F.lower(t)))


def mark_html(html: Column, words: Column) -> Column:
    """The same in the text of an HTML page: tags, comments, scripts and styles stay as they are, and what they
    part is never one word. A word with references (``caf&eacute;``) is compared decoded as a whole, else by what
    is between them."""
    def word(t: Column) -> Column:
        apart = _each(t, f"{REFERENCE}|[^&]+|&", lambda p: F.when(F.startswith(p, F.lit("&")), p).otherwise(_chunk(p, words)))
        with_references = F.coalesce(_marked(t, strip_html(t), words), apart)
        return F.when(F.contains(t, F.lit("&")), with_references).when(t.rlike(TOKEN), _chunk(t, words)).otherwise(t)

    def segment(s: Column) -> Column:
        return F.when(F.startswith(s, F.lit("<")), s).otherwise(_each(s, TOKENS_HTML, word))

    return _each(html, f"{MARKUP}|[^<]+|<", segment)


def _each(text: Column, pattern: str, fn) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), fn), "")


def _marked(shown: Column, compared: Column, words: Column) -> Column:
    found = F.array_contains(words, ascii_fold(F.lower(compared)))
    return F.when(found, _emphasised(shown))


def _emphasised(shown: Column) -> Column:
    return F.concat(F.lit(EMPHASIS[0]), shown, F.lit(EMPHASIS[1]))


def _run(token: Column, words: Column) -> Column:
    """A run of letters and digits, or its parts."""
    parts = _each(token, f"{PARTS_CASE}|.", lambda p: F.coalesce(_marked(p, p, words), p))
    return F.coalesce(_marked(token, token, words), parts)


def _chunk(chunk: Column, words: Column) -> Column:
    """Runs with punctuation between them: parts of one kind that follow each other are also compared joined."""
    def kind(k: Column) -> Column:
        joined = _marked(k, F.regexp_replace(k, PUNCTUATION, ""), words)
        apart = _each(k, TOKENS, lambda t: F.when(t.rlike(TOKEN), _run(t, words)).otherwise(t))
        return F.coalesce(F.when(k.rlike(TOKEN), joined), apart)

    return F.when(chunk.rlike(PUNCTUATION), _each(chunk, KINDS, kind)).otherwise(_run(chunk, words))


def snippet(text: Column, words: Column, around: int = 5) -> Column:
    """Up to ``around`` words on both sides of the first match, marked; null if none."""
    reach = f"{{0,{around}}}"
    pattern = F.concat(
        F.lit(rf"(?i)((?:\S+\s+){reach}\S*\b(?:"), _quoted(words),
        F.lit(rf")\b\S*(?:\s+\S+){reach})"),
    )
    found = F.call_function("regexp_extract", text, pattern, F.lit(1))
    return F.when(found != "", mark(found, words))


def excerpt(snippets: Iterable[Column]) -> Column:
    """All snippets joined by `` ... ``, without encoded replacement characters."""
    joined = F.concat_ws(" ... ", *snippets)
    return F.replace(joined, F.lit("&#65533;"), F.lit(""))


# Spelling -----------------------------------------------------------------

def suggestions(wanted: DataFrame, index: TextIndex) -> DataFrame:
    """Best correction of each query word the vocabulary lacks.

    Ordered by distance, then document frequency, then the term itself. Returns
    ``field, word, suggestion, distance, df``. Of a published index only the rows of the
    words and of their candidates are read, of any other the vocabulary is made once.
    """
    vocab = index.vocab if index.tables else materialised(index.vocab)
    pieces = index.pieces if index.tables else L.pieces(vocab)
    words = Wanted.of(wanted.select("field", "term").distinct())
    unknown = words.frame.join(words.cut(vocab), ["field", "term"], "left_anti")
    near = Wanted.of(L.near(unknown, pieces), derived=True)
    counted = near.frame.join(near.cut(vocab).select("field", "term", "df"), ["field", "term"])
    best = F.min_by(
        F.struct("term", "distance", "df"), F.struct("distance", -F.col("df"), "term")
    )
    return (
        counted.groupBy("field", "word").agg(best.alias("b"))
        .select("field", "word", F.col("b.term").alias("suggestion"), "b.distance", "b.df")
    )


def collate(wanted: DataFrame, corrected: DataFrame, prefix: str = "+") -> DataFrame:
    """``query_id, collation``: the query with corrected words, parts in order.

    Queries without any correction have no collation.
    """
    rows = wanted.join(
        corrected.select("field", F.col("word").alias("term"), "suggestion"),
        ["field", "term"], "left",
    )
    ordered = F.array_sort(F.collect_set(F.struct(
        "part", "idx", F.concat(F.lit(prefix), F.coalesce("suggestion", "term")).alias("word")
    )))
    return (
        rows.groupBy("query_id")
        .agg(F.array_join(ordered.getField("word"), " ").alias("collation"),
             F.count("suggestion").alias("n"))
        .where(F.col("n") > 0).drop("n")
    )


def first_suggestion(collations: Column) -> Column:
    """A collation may be one string or several corrections; the first one wins."""
    return F.coalesce(F.try_element_at(collations, F.lit(1)), F.lit(""))


def nice(collation: Column) -> Column:
    """Without the leading ``+`` of each word, for display."""
    return F.regexp_replace(collation, r"(^| )\++", "$1")


def query_string(collation: Column) -> Column:
    return F.replace(nice(collation), F.lit(" "), F.lit("+"))
