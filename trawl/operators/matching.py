"""From queries to matching documents.

A query is a row, so one job answers a batch. Query text is cut into *parts*;
each part becomes wanted terms, which meet the postings in an equi-join. The
wanted side is normally tiny and Spark broadcasts it by its own size estimate;
when it is not, the join shuffles and adaptive execution splits hot terms.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trawl.functions.analysis import ALT, GAP
from trawl.functions.folding import ascii_fold
from trawl.functions.profiles import PROFILES, query_slots
from trawl.operators import lookups as L
from trawl.operators.spec import DEFAULT_FIELD
from trawl.operators.store import TextIndex, Wanted

PART = r'"[^"]*"|\S+'
QUERY_SCHEMA = (
    "query_id string, call int, text string, fuzzy boolean,"
    " fields array<string>, boosts map<string,double>"
)


@dataclass
class SearchQuery:
    """Terms, filters and page of one search; methods chain."""

    query_id: str = "q"
    terms: list[tuple] = field(default_factory=list)
    classes: list[tuple[str, bool]] = field(default_factory=list)
    required: dict[str, list] = field(default_factory=dict)
    excluded: dict[str, list] = field(default_factory=dict)
    criteria: list = field(default_factory=list)
    start: int = 0
    limit: int = -1

    def add_search_term(self, text: str, fields: Sequence[str] = (),
                        boost: dict[str, float] | None = None, fuzzy: bool = False) -> SearchQuery:
        names = list(dict.fromkeys([*fields, *(boost or {})]))
        weights = {k: float(v) for k, v in (boost or {}).items()}
        self.terms.append((self.query_id, len(self.terms), text, fuzzy, names, weights))
        return self

    def add_fuzzy_search_term(self, text: str, fields: Sequence[str] = (),
                              boost: dict[str, float] | None = None) -> SearchQuery:
        return self.add_search_term(text, fields, boost, fuzzy=True)

    def add_class_filter(self, name: str, include_subclasses: bool = True) -> SearchQuery:
        self.classes.append((name, include_subclasses))
        return self

    def add_filter(self, name: str, values) -> SearchQuery:
        values = list(values) if isinstance(values, (list, tuple)) else [values]
        self.required.setdefault(name, []).extend(values)
        return self

    def add_exclude(self, name: str, values) -> SearchQuery:
        values = list(values) if isinstance(values, (list, tuple)) else [values]
        self.excluded.setdefault(name, []).extend(values)
        return self

    def filter_by(self, criteria) -> SearchQuery:
        self.criteria.append(criteria)
        return self

    def set_start(self, start: int) -> SearchQuery:
        self.start = start
        return self

    def set_limit(self, limit: int) -> SearchQuery:
        self.limit = limit
        return self

    def set_page_size(self, page: int) -> SearchQuery:
        """Ten hits from page number ``page`` on, counted from 0."""
        return self.set_start(page * 10).set_limit(10)


def query_rows(spark: SparkSession, queries: Sequence[SearchQuery]) -> DataFrame:
    return spark.createDataFrame([t for q in queries for t in q.terms], QUERY_SCHEMA)


def split_query(text: Column) -> Column:
    """Quoted phrases and runs of non-blanks."""
    return F.regexp_extract_all(text, F.lit(PART), F.lit(0))


def parts(queries: DataFrame) -> DataFrame:
    """One row per required part: ``query_id, part, raw, quoted, fuzzy, fields, boosts``."""
    return (
        queries.select("*", F.posexplode(split_query(F.col("text"))).alias("part_no", "raw"))
        .select(
            "query_id", (F.col("call").cast("long") * 2**32 + F.col("part_no")).alias("part"),
            F.replace("raw", F.lit('"'), F.lit("")).alias("raw"),
            F.col("raw").startswith('"').alias("quoted"),
            "fuzzy", "fields", "boosts",
        )
    )


SINGLE = re.compile(r"\W*(?:[A-Z]*[a-z]*|[0-9]*)\W*")


def may_have_phrases(texts: Iterable[str]) -> bool:
    """False only when no part can be quoted or split by the analyzer."""
    return any(
        not SINGLE.fullmatch(part) or part.startswith('"')
        for text in texts for part in re.findall(PART, text)
    )


def wanted_terms(queries: DataFrame, default_fields: dict[str, float] | None = None,
                 analyzers: dict[str, str] | None = None) -> DataFrame:
    """Analysed parts per field: ``query_id, part, field, weight, idx, n_idx, term, kind``.

    ``analyzers`` names the profile of fields that are not analysed as plain text.

    ``idx`` is the offset inside a phrase (gaps of removed stop words counted); a
    part with one position has ``n_idx`` 1. Parts left without terms are dropped.
    """
    defaults = default_fields or {DEFAULT_FIELD: 1.0}
    fallback = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv])
    named = F.transform(
        F.col("fields"),
        lambda f: F.struct(f.alias("key"), F.coalesce(F.try_element_at("boosts", f), F.lit(1.0)).alias("value")),
    )
    fielded = parts(queries).select(
        "query_id", "part", "raw", "quoted", "fuzzy",
        F.explode(
            F.when(F.size("fields") > 0, named).otherwise(F.map_entries(fallback))
        ).alias("f"),
    )
    wildcard = ~F.col("quoted") & F.col("raw").rlike(r"[*?]")
    kind = (
        F.when(wildcard, F.lit("wildcard"))
        .when(F.col("fuzzy") & ~F.col("quoted"), F.lit("fuzzy")).otherwise(F.lit("term"))
    )
    slots = F.when(wildcard, F.array(ascii_fold(F.lower("raw"))))
    by_chain: dict = {}
    for name, profile in (analyzers or {}).items():
        by_chain.setdefault(PROFILES[profile].query, []).append(name)
    by_chain.pop(PROFILES["text"].query, None)
    for chain, names in by_chain.items():
        slots = slots.when(F.col("f.key").isin(names), chain(F.col("raw")))
    slots = slots.otherwise(query_slots(F.col("raw")))
    spread = (
        fielded.select(
            "query_id", "part", F.col("f.key").alias("field"),
            F.col("f.value").cast("double").alias("weight"), kind.alias("kind"),
            F.array_size(F.filter(slots, lambda s: s != GAP)).alias("n_idx"),
            F.posexplode_outer(slots).alias("idx", "slot"),
        )
        .where(F.col("slot") != GAP)
    )
    return spread.select(
        "query_id", "part", "field", "weight", "kind", "n_idx", "idx",
        F.explode(F.split("slot", ALT)).alias("term"),
    )


# Vocabulary expansion -------------------------------------------------------

TERM = ["query_id", "part", "field", "weight", "n_idx", "idx", "term"]


def expanded(wanted: DataFrame, index: TextIndex, kind: str) -> DataFrame:
    """Wanted terms with fuzzy and wildcard words replaced by vocabulary terms."""
    if kind == "term":
        return wanted.where(F.col("kind") == "term").select(*TERM)
    some = wanted.where(F.col("kind") == kind).withColumnRenamed("term", "word")
    words = some.select("field", F.col("word").alias("term"))
    found = L.near(words, index.pieces) if kind == "fuzzy" else L.matching(words, index.rotations)
    return some.join(found.select("field", "word", "term"), ["field", "word"]).select(*TERM)


def all_expanded(wanted: DataFrame, index: TextIndex, kinds: Sequence[str]) -> DataFrame:
    """The terms of every kind of word that a batch holds, looked up in the vocabulary of ``index``."""
    return reduce(DataFrame.unionByName, (expanded(wanted, index, k) for k in kinds))


# Matching and scoring -------------------------------------------------------

def idf(df: Column, total: Column) -> Column:
    return F.lit(1.0) + F.log(total.cast("double") / (df + 1).cast("double"))


HIT = ("query_id", "doc_id", "part", "field")


def _term_scores(found: DataFrame, weight: Column) -> DataFrame:
    rows = (
        found.groupBy(*HIT, "term")
        .agg(F.sum("tf").alias("tf"), F.max(weight).alias("idf"),
             F.max("n_terms").alias("n_terms"), F.max("weight").alias("weight"))
    )
    return rows.select(*HIT, "tf", "idf", "n_terms", "weight")


def _phrase_scores(found: DataFrame, weight: Column) -> DataFrame:
    """Phrases: every offset must be met from one start position of one value."""
    starts = found.select(
        *HIT, "source", "val_no", "idx", "n_idx", "n_terms", "weight", weight.alias("idf"),
        F.explode("positions").alias("pos"),
    ).withColumn("start", F.col("pos") - F.col("idx"))
    met = (
        starts.groupBy(*HIT, "source", "val_no", "start")
        .agg(F.collect_set(F.struct("idx", "idf")).alias("seen"), F.max("n_idx").alias("n_idx"),
             F.max("n_terms").alias("n_terms"), F.max("weight").alias("weight"))
        .where(F.size(F.array_distinct(F.col("seen.idx"))) == F.col("n_idx"))
    )
    idf_sum = F.aggregate(F.array_sort("seen.idf"), F.lit(0.0), lambda total, x: total + x)
    return met.groupBy(*HIT).agg(
        F.count("*").alias("tf"), F.max(idf_sum).alias("idf"),
        F.max("n_terms").alias("n_terms"), F.max("weight").alias("weight"),
    )


def part_hits(index: TextIndex, wanted: Wanted, phrases: bool = True) -> DataFrame:
    """Score of every (query, document, part, field) and term or phrase that matches.

    The terms have been counted first; postings are cut down to them before any join.
    Frequencies are put on the wanted terms, at most one each, so postings are joined once,
    with something no larger than what was counted. Terms are then reduced before their
    shuffle; phrases are hashed by value, so that a document of many values is many groups.
    """
    postings, frequencies = index.matched(wanted)
    weight = idf(F.col("df"), index.total())

    def found(which: Column) -> DataFrame:
        rows = frequencies.join(wanted.hinted(wanted.frame.where(which)), ["field", "term"])
        return postings.join(wanted.hinted(rows), ["field", "term"])

    hits = _term_scores(found(F.col("n_idx") == 1), weight)
    if phrases:
        values = found(F.col("n_idx") > 1).repartition("query_id", "doc_id", "source", "val_no")
        hits = hits.unionByName(_phrase_scores(values, weight))
    score = (
        F.col("weight") * F.sqrt(F.col("tf").cast("double")) * F.col("idf") * F.col("idf")
        / F.sqrt(F.col("n_terms").cast("double"))
    )
    return hits.select(*HIT, score.alias("score"))


def match(index: TextIndex, wanted: DataFrame, kinds: Sequence[str] = ("term", "fuzzy", "wildcard"),
          phrases: bool = True, best_field: bool = False,
          expand_with: TextIndex | None = None, terms: Wanted | None = None) -> DataFrame:
    """``query_id, doc_id, score``: documents in which every part of a query matches.

    ``kinds`` names the kinds of words the batch holds; a caller that knows some are
    absent leaves them out, so that a plan has no branch it does not need. A part scores the sum over its fields, or the best of
    them with ``best_field``. Fuzzy and wildcard words are looked up in the
    vocabulary of ``expand_with``, normally the fields that have such words; ``terms`` are
    those that were looked up before.
    """
    needed = wanted.groupBy("query_id").agg(F.count_distinct("part").alias("n_parts"))
    if terms is None:
        terms = Wanted.of(all_expanded(wanted, expand_with or index, kinds), derived=set(kinds) != {"term"})
    hits = part_hits(index, terms, phrases)
    over_fields = F.max("score") if best_field else F.sum("score")
    # one shuffle for the three groupings; a document has a row a part, field and term by now
    per_document = (
        hits.repartition("query_id", "doc_id").groupBy(*HIT).agg(F.sum("score").alias("score"))
        .groupBy("query_id", "doc_id", "part").agg(over_fields.alias("score"))
        .groupBy("query_id", "doc_id").agg(F.count("*").alias("n"), F.sum("score").alias("score"))
    )
    return (
        per_document.join(needed, "query_id").where(F.col("n") == F.col("n_parts"))
        .select("query_id", "doc_id", F.round("score", 6).alias("score"))
    )


def match_all(documents: DataFrame, query_ids: Sequence[str]) -> DataFrame:
    """Queries without terms match every document with score 1."""
    ids = F.array(*map(F.lit, query_ids))
    return documents.select(
        F.explode(ids).alias("query_id"), "doc_id", F.lit(1.0).alias("score")
    )


def only(hits: DataFrame, documents: DataFrame, predicate: Column) -> DataFrame:
    """Hits whose document passes a filter; filters never change the score.

    An inner join on the unique document key, so that a small hit list can be the
    broadcast side; the filter itself is pushed to the document scan.
    """
    allowed = documents.where(predicate).select("doc_id")
    return hits.join(allowed, "doc_id")


def boosted(hits: DataFrame, documents: DataFrame, boosts: Sequence[tuple[Column, float | Column]]) -> DataFrame:
    """Add a weight to the score of documents that meet a predicate. A weight may also be a function
    of the documents' fields; where it has no value it adds nothing."""
    def of(weight: float | Column) -> Column:
        return F.coalesce(weight.cast("double"), F.lit(0.0)) if isinstance(weight, Column) else F.lit(float(weight))

    extra = reduce(
        lambda a, b: a + b,
        (F.when(p, of(w)).otherwise(F.lit(0.0)) for p, w in boosts),
    )
    added = documents.select("doc_id", extra.alias("extra"))
    return hits.join(added, "doc_id").select(
        "query_id", "doc_id", F.round(F.col("score") + F.col("extra"), 6).alias("score")
    )
