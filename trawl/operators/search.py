"""A batch of searches from query objects to pages of hits."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from trawl.operators import criteria as C
from trawl.operators import matching as M
from trawl.operators import ranking as R
from trawl.operators import results as D
from trawl.operators.spec import DEFAULT_FIELD
from trawl.operators.store import TextIndex, Wanted
from trawl.operators.valuefilters import by_values, on_values
from trawl.operators.variants import with_states


@dataclass(frozen=True)
class SearchResult:
    """``hits``: the pages (``query_id, rank, doc_id, score``); ``matches``: all of
    them; ``num_found``: per query, counted before paging and visibility; ``wanted``:
    the words asked for; ``terms``: with fuzzy and wildcard words looked up, for
    highlighting; ``facets``: value counts over all matches."""

    hits: DataFrame
    matches: DataFrame
    num_found: DataFrame
    wanted: DataFrame
    terms: DataFrame | None = None
    facets: DataFrame | None = None


def predicate(query: M.SearchQuery, current: dict[str, str] | None = None,
              multi: Iterable[str] = (), columns: Iterable[str] | None = None) -> Column | None:
    """A query's filters on the documents' own columns, all of them if ``columns`` isn't given, as one Column; None
    when it has none."""
    required, excluded = with_states(query.required, current or {}), query.excluded
    if columns is not None:
        required, excluded = ({n: v for n, v in f.items() if n in columns} for f in (required, excluded))
    clauses = []
    if query.classes:
        clauses.append(C.classes(query.classes))
    if required:
        clauses.append(C.require(required, multi))
    if excluded:
        clauses.append(C.exclude(excluded, multi))
    clauses += [c.column() for c in query.criteria]
    return reduce(lambda a, b: a & b, clauses) if clauses else None


def filtered(matches: DataFrame, index: TextIndex, queries: Sequence[M.SearchQuery],
             current: dict[str, str] | None = None, multi: Iterable[str] = ()) -> DataFrame:
    """Apply every query's filters. Those on fields of the values table are joins with it. Of those on documents, a
    predicate that all queries share reaches the document scan; in a batch equal predicates are one, chosen by
    its number after a single join."""
    documents = index.documents
    matches = by_values(matches, index.values, on_values(queries, documents.columns, current or {}))
    columns = None if index.values is None else documents.columns
    groups: dict[str, list[M.SearchQuery]] = {}
    for q in queries:
        groups.setdefault(repr((q.classes, q.required, q.excluded, q.criteria)), []).append(q)
    numbered = [(predicate(own[0], current, multi, columns), own) for own in groups.values()]
    active = [(p, own) for p, own in numbered if p is not None]
    if not active:
        return matches
    if len(numbered) == 1:
        return M.only(matches, documents, active[0][0])
    rows = [(q.query_id, i) for i, (_, own) in enumerate(active) for q in own]
    of_query = matches.sparkSession.createDataFrame(rows, "query_id string, __filter int")
    chosen = _any([F.col("__filter").isNull(), *((F.col("__filter") == i) & p for i, (p, _) in enumerate(active))])
    return (matches.join(F.broadcast(of_query), "query_id", "left").join(documents, "doc_id")
            .where(chosen).select(*matches.columns))


def _any(clauses: list[Column]) -> Column:
    """Their disjunction as a balanced tree, as deep as the logarithm of their number."""
    while len(clauses) > 1:
        pairs = [clauses[i] | clauses[i + 1] for i in range(0, len(clauses) - 1, 2)]
        clauses = pairs + clauses[len(pairs) * 2:]
    return clauses[0]


def paged(matches: DataFrame, queries: Sequence[M.SearchQuery], offset: int = -1, limit: int = -1,
          order: Sequence[Column] = ()) -> DataFrame:
    """Every query's own page."""
    order = [*order] or R.by_score()
    bounds = {q.query_id: R.page_bounds(q.start, q.limit, offset, limit) for q in queries}
    pages = set(bounds.values())
    if len(pages) == 1:
        first, last = pages.pop()
        return R.ranked(matches, order, first, last)
    ranked = R.ranked(matches, order, 1, max(last for _, last in bounds.values()))
    rows = matches.sparkSession.createDataFrame(
        [(k, *b) for k, b in bounds.items()], "query_id string, __first long, __last long")
    return ranked.join(rows, "query_id").where("rank BETWEEN __first AND __last").select(*ranked.columns)


def search(index: TextIndex, queries: Sequence[M.SearchQuery],
           query_fields: dict[str, float] | None = None,
           current: dict[str, str] | None = None, multi: Iterable[str] = (),
           offset: int = -1, limit: int = -1,
           boosts: Sequence[tuple[Column, float | Column]] = (),
           order: Sequence[Column] = (), pins: DataFrame | None = None, facets: Sequence[str] = (),
           hook: Callable[[DataFrame], DataFrame] | None = None) -> SearchResult:
    """Search for a batch of queries with distinct ids, each with its own page and filters.

    ``query_fields`` are boosted fields searched instead of the default field,
    each part scoring its best field. ``boosts`` add to the score of documents
    that meet a predicate. ``order`` sorts by columns of the documents instead of the
    score, with ties in id order; ``pins`` are elevation rules (see ``ranking.elevate``) that
    come before it. ``facets`` names document columns to count. ``hook`` may rework the page
    of hits, such as by a gate.
    """
    ids = [q.query_id for q in queries]
    if len(set(ids)) < len(ids):
        raise ValueError("queries of a batch need distinct ids")
    spark = index.documents.sparkSession
    worded = [q for q in queries if q.terms]
    rows = M.query_rows(spark, worded)
    wanted = M.wanted_terms(rows, query_fields, dict(index.analyzers))
    matches = terms = None
    if worded:
        fuzzy = any(t[3] for q in worded for t in q.terms)
        wild = any(c in t[2] for q in worded for t in q.terms for c in "*?")
        kinds = ["term"] + ["fuzzy"] * fuzzy + ["wildcard"] * wild
        default = list(query_fields or [DEFAULT_FIELD])
        calls = [(t[2], t[3] or "*" in t[2] or "?" in t[2], t[4] or default)
                 for q in worded for t in q.terms]
        used = index.only_fields({f for _, _, fields in calls for f in fields})
        vocab = index.only_fields({f for _, expand, fields in calls if expand for f in fields})
        phrases = M.may_have_phrases(text for text, _, _ in calls)
        found = Wanted.of(M.all_expanded(wanted, vocab, kinds), derived=kinds != ["term"])
        terms = found.frame
        matches = M.match(used, wanted, kinds, phrases, best_field=bool(query_fields), terms=found)
    blank = [q.query_id for q in queries if not q.terms]
    if blank:
        every = M.match_all(index.documents, blank)
        matches = every if matches is None else matches.unionByName(every)
    matches = filtered(matches, index, queries, current, multi)
    if boosts:
        matches = M.boosted(matches, index.documents, boosts)
    listed, keys = matches, [*order, F.col("doc_id").asc()] if order else R.by_score()
    if pins is not None:
        texts = spark.createDataFrame(
            [(q.query_id, " ".join(t[2] for t in q.terms)) for q in queries], "query_id string, text string")
        listed, keys = R.elevate(matches, index.documents, pins, texts), [F.col("pin").asc_nulls_last(), *keys]
    shown = listed.columns
    if order:
        others = [c for c in index.documents.columns if c not in shown]
        listed = listed.join(index.documents.select("doc_id", *others), "doc_id")
    hits = paged(listed, queries, offset, limit, keys).select(*shown, "rank")
    counts = D.facets(matches, index.documents, facets) if facets else None
    return SearchResult(
        hook(hits) if hook else hits, matches, R.num_found(matches, ids), wanted, terms, counts)
