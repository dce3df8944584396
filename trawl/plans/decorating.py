"""Registered queries: facets, highlights, excerpts and spelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trawl.operators import matching as M
from trawl.operators import results as D
from trawl.operators.search import search
from trawl.plans import sqltext as S
from trawl.plans.registry import query
from trawl.plans.sample import document_index, read
from trawl.plans.searching import PAGE, Q, TEXT, WORDS, all_matches, item_queries, words_sql


@query("facet_field", f"""WITH {words_sql()}
SELECT 'q' AS query_id, 'source' AS field, source AS value, count(*) AS count
FROM hits JOIN documents USING (doc_id) GROUP BY source""")
def facet_field(spark: SparkSession, sf: str) -> DataFrame:
    query_ = Q("q").add_search_term(WORDS)
    return search(document_index(spark, sf), [query_], facets=["source"]).facets


@query("facet_multi", """SELECT 'q' AS query_id, field, value, count(*) AS count FROM (
  SELECT 'c_mktsegment' AS field, c_mktsegment AS value FROM customer
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT 'Customer_Orders_o_orderpriority', o_orderpriority
    FROM customer JOIN orders ON o_custkey = c_custkey) AS x GROUP BY field, value""")
def facet_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Two single-valued fields and one multi-valued one, over all customers."""
    from trawl.operators import documents as B
    from trawl.operators.spec import IndexSpec
    from trawl.plans.sample import tree
    spec = IndexSpec(tree(spark, sf, "Party", "Customer", "Nation", "Order")).add_class("Customer")
    spec.add_filter_field("Orders.o_orderpriority")
    values = B.build_values(spec).select(F.col("ID").alias("doc_id"), "field", "value")
    docs = read(spark, sf, "customer").withColumnRenamed("c_custkey", "doc_id")
    every = M.match_all(docs, ["q"])
    return D.facets(every, docs, ["c_mktsegment", "c_nationkey"], values)


MARKED = r"regexp_replace(text, '(?i)\b(anea|thon)\b', '<em>\1</em>', 'g')"


@query("highlight", f"""WITH {words_sql()}, {PAGE}
SELECT doc_id, rank, {MARKED} AS marked FROM ranked JOIN documents USING (doc_id) WHERE rank <= 10""")
def highlight(spark: SparkSession, sf: str) -> DataFrame:
    """Matched words marked in the whole text of the page's documents."""
    found = search(document_index(spark, sf), [Q("q").add_search_term(WORDS)])
    words = D.highlight_terms(found.wanted)
    page = found.hits.join(read(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return page.join(words, "query_id").select(
        "doc_id", "rank", D.mark(F.col("text"), F.col("words")).alias("marked")
    )


@query("highlight_expanded", rf"""WITH {S.terms(TEXT)},
want AS (SELECT list(DISTINCT term) AS words FROM terms WHERE term LIKE 'thane%' OR term = 'anea'),
hits AS (SELECT doc_id FROM terms GROUP BY 1
  HAVING bool_or(term LIKE 'thane%') AND bool_or(term = 'anea')),
runs AS (SELECT doc_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS i FROM (
  SELECT doc_id, regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{N}}]+|[^\p{{L}}\p{{M}}\p{{N}}]+') AS ts
  FROM hits JOIN documents USING (doc_id)) AS x),
pieces AS (SELECT doc_id, i, unnest(ps) AS p, generate_subscripts(ps, 1) AS j FROM (
  SELECT doc_id, i, CASE WHEN list_contains(words, {S.fold('lower(t)')}) OR NOT regexp_matches(t, '[\p{{L}}\p{{N}}]') THEN [t]
    ELSE regexp_extract_all(t, '{S.PARTS_CASE}|.') END AS ps FROM runs, want) AS y)
SELECT doc_id, string_agg(CASE WHEN list_contains(words, {S.fold('lower(p)')}) THEN '<em>' || p || '</em>' ELSE p END,
  '' ORDER BY i, j) AS marked FROM pieces, want GROUP BY 1""")
def highlight_expanded(spark: SparkSession, sf: str) -> DataFrame:
    """What a wildcard stands for is marked, in the whole texts of all matches."""
    found = search(document_index(spark, sf), [Q("q").add_search_term("thane* anea")])
    docs = read(spark, sf, "documents").select("doc_id", "text")
    rows = found.matches.join(docs, "doc_id").join(D.highlight_terms(found.terms), "query_id")
    return rows.select("doc_id", D.mark_terms(F.col("text"), F.col("words")).alias("marked"))


@query("highlight_html", rf"""WITH cut AS (
  SELECT page_id, regexp_extract_all(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[!/]?[a-zA-Z][^>]*>|[^<]+|<') AS ss
  FROM pages),
segments AS (SELECT page_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM cut),
runs AS (SELECT page_id, i, s, unnest(ts) AS t, generate_subscripts(ts, 1) AS j FROM (
  SELECT *, CASE WHEN s LIKE '<%' THEN [s] ELSE regexp_extract_all(s,
    '&(?:#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|[a-zA-Z][a-zA-Z0-9]{{1,7}});|[\p{{L}}\p{{M}}\p{{N}}]+|[^\p{{L}}\p{{M}}\p{{N}}&]+|&') END AS ts FROM segments) AS x),
pieces AS (SELECT page_id, i, j, s LIKE '<%' AS tag, unnest(ps) AS p, generate_subscripts(ps, 1) AS k FROM (
  SELECT *, CASE WHEN s LIKE '<%' OR t LIKE '&%' OR {S.fold('lower(t)')} IN ('anea', 'thon', 'de', 'la') THEN [t]
    ELSE regexp_extract_all(t, '(?s){S.PARTS_CASE}|.') END AS ps FROM runs) AS y),
shown AS (SELECT *, CASE WHEN NOT tag AND {S.fold('lower(p)')} IN ('anea', 'thon', 'de', 'la') THEN '<em>' || p || '</em>' ELSE p END AS m FROM pieces)
SELECT page_id, string_agg(m, '' ORDER BY i, j, k) AS marked FROM shown GROUP BY 1""")
def highlight_html(spark: SparkSession, sf: str) -> DataFrame:
    """Words marked in the text of all pages, their markup and references untouched."""
    words = F.array(*map(F.lit, ("anea", "thon", "de", "la")))
    return read(spark, sf, "pages").select("page_id", D.mark_html(F.col("html"), words).alias("marked"))


@query("highlight_query", r"""WITH p AS (
  SELECT item_id, regexp_extract_all(text, '"[^"]*"|\S+') AS ps FROM benchmark)
SELECT CAST(item_id AS VARCHAR) AS query_id, array_to_string(ps, ' ') AS hl_query FROM p""")
def highlight_query(spark: SparkSession, sf: str) -> DataFrame:
    return D.highlight_query(M.parts(item_queries(spark, sf)))


SNIPPET = r"regexp_extract(text, '(?i)((?:\S+\s+){0,5}\S*\b(?:anea|thon)\b\S*(?:\s+\S+){0,5})', 1)"


@query("excerpt", rf"""WITH {words_sql()}, {PAGE}
SELECT doc_id, rank, replace(
  regexp_replace({SNIPPET}, '(?i)\b(anea|thon)\b', '<em>\1</em>', 'g') || ' ... ' || source, '&#65533;', '') AS excerpt
FROM ranked JOIN documents USING (doc_id) WHERE rank <= 10""")
def excerpt(spark: SparkSession, sf: str) -> DataFrame:
    """A window of words around the first match, joined with another field."""
    found = search(document_index(spark, sf), [Q("q").add_search_term(WORDS)])
    words = D.highlight_terms(found.wanted)
    docs = read(spark, sf, "documents").select("doc_id", "text", "source")
    page = found.hits.join(docs, "doc_id").join(words, "query_id")
    return page.select("doc_id", "rank", D.excerpt(
        [D.snippet(F.col("text"), F.col("words")), F.col("source")]
    ).alias("excerpt"))


# Spelling -------------------------------------------------------------------

MISSPELT = "aneaa thon erinrr thanedbel"
SPELL = f"""{S.terms(TEXT)},
vocab AS (SELECT term, count(DISTINCT doc_id) AS df FROM terms GROUP BY 1),
asked(part, word) AS (VALUES (0, 'aneaa'), (1, 'thon'), (2, 'erinrr'), (3, 'thanedbel')),
near AS (
  SELECT part, word, term, df, levenshtein(word, term) AS distance FROM asked, vocab
  WHERE word NOT IN (SELECT term FROM vocab) AND levenshtein(word, term) <= 2),
best AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY distance, df DESC, term) AS r FROM near),
fixed AS (SELECT part, word, term AS suggestion, distance, df FROM best WHERE r = 1),
collated AS (
  SELECT string_agg('+' || coalesce(suggestion, a.word), ' ' ORDER BY a.part) AS "collation"
  FROM asked a LEFT JOIN fixed f ON f.part = a.part)"""


def corrected(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    wanted = M.wanted_terms(M.query_rows(spark, [Q("q").add_search_term(MISSPELT)]))
    return wanted, D.suggestions(wanted, document_index(spark, sf))


@query("spell_suggest", f"WITH {SPELL} SELECT '_text' AS field, word, suggestion, distance, df FROM fixed")
def spell_suggest(spark: SparkSession, sf: str) -> DataFrame:
    return corrected(spark, sf)[1]


@query("spell_collate", f"""WITH {SPELL} SELECT 'q' AS query_id, "collation" FROM collated""")
def spell_collate(spark: SparkSession, sf: str) -> DataFrame:
    return D.collate(*corrected(spark, sf))


@query("spell_nice", f"""WITH {SPELL}
SELECT 'q' AS query_id, replace("collation", '+', '') AS nice FROM collated""")
def spell_nice(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.collate(*corrected(spark, sf))
    return rows.select("query_id", D.nice(F.col("collation")).alias("nice"))


@query("spell_query_string", f"""WITH {SPELL}
SELECT 'q' AS query_id, replace(replace("collation", '+', ''), ' ', '+') AS query_string FROM collated""")
def spell_query_string(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.collate(*corrected(spark, sf))
    return rows.select("query_id", D.query_string(F.col("collation")).alias("query_string"))
