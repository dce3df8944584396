"""Registered queries: text matching, scoring, ranking and paging."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from trawl.operators import gates as G
from trawl.operators import matching as M
from trawl.operators import ranking as R
from trawl.operators.search import search
from trawl.plans import sqltext as S
from trawl.plans.analysis import EXPANDED
from trawl.plans.registry import query
from trawl.plans.sample import content_index, document_index, read
from trawl.plans.states import ACL, acl

Q = M.SearchQuery
WORDS = "anea thon"
TEXT = "SELECT '_text' AS field, doc_id, 0 AS val_no, text FROM documents"
STRIPPED = S.strip_html("text")
CONTENT_TEXT = f"""SELECT 'Document_text' AS field, doc_id * 2 AS doc_id, 0 AS val_no, text FROM documents
UNION ALL SELECT '_text', doc_id * 2, 0, {STRIPPED} FROM documents
UNION ALL SELECT 'Page_html', page_id * 2 + 1, 0, {S.strip_html('html')} FROM pages
UNION ALL SELECT '_text', page_id * 2 + 1, 0, {S.strip_html('html')} FROM pages"""
DOC_TOTAL = "total AS (SELECT count(*) AS n FROM documents)"
CONTENT_TOTAL = "total AS (SELECT (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages) AS n)"


def doc_hits(parts: list) -> str:
    """CTEs that score parts of alternative (term, weight) pairs on the documents."""
    alternatives = [[("_text", t, w) for t, w in part] for part in parts]
    return f"{S.terms(TEXT)}, {DOC_TOTAL}, {S.scored(alternatives)}"


def words_sql(words: str = WORDS) -> str:
    return doc_hits([[(w, 1.0)] for w in words.split()])


def content_hits(parts: list) -> str:
    return f"{S.terms(CONTENT_TEXT)}, {CONTENT_TOTAL}, {S.scored(parts)}"


def all_matches(spark: SparkSession, sf: str, words: str = WORDS) -> DataFrame:
    index = document_index(spark, sf)
    return search(index, [Q("q").add_search_term(words)]).matches


HITS = "SELECT 'q' AS query_id, doc_id, score FROM hits"


# Queries as rows ------------------------------------------------------------

@query("query_split", r"""WITH q AS (
  SELECT item_id, '"' || replace(text, '. ', '" ') AS text FROM benchmark),
p AS (SELECT item_id, regexp_extract_all(text, '"[^"]*"|\S+') AS ps FROM q)
SELECT item_id, unnest(ps) AS part, generate_subscripts(ps, 1) - 1 AS pos FROM p""")
def query_split(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark texts as queries whose first sentence is a phrase."""
    text = F.concat(F.lit('"'), F.replace("text", F.lit(". "), F.lit('" ')))
    return read(spark, sf, "benchmark").select(
        "item_id", F.posexplode(M.split_query(text)).alias("pos", "part")
    )


def item_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark text is a query: all of its words must occur."""
    return read(spark, sf, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"), F.lit(0).alias("call"), "text",
        F.lit(False).alias("fuzzy"), F.array().cast("array<string>").alias("fields"),
        F.create_map().cast("map<string,double>").alias("boosts"),
    )


FOLDED = f"SELECT 'q' AS field, item_id AS doc_id, 0 AS val_no, {S.fold('text')} AS text FROM benchmark"
BATCH = f"""{S.terms(TEXT)}, {DOC_TOTAL},
{S.terms(FOLDED, name='asked', catenate=False, finish='lower')},
part_of AS (
  SELECT a.doc_id AS query_id, a.pos AS part, unnest({EXPANDED}) AS term FROM asked a),
want AS (SELECT query_id || '/' || part AS part, '_text' AS field, term, 1.0::DOUBLE AS weight FROM part_of),
{S.SCORING.format(name='terms')},
needed AS (SELECT query_id, count(DISTINCT part) AS n FROM part_of GROUP BY 1),
hits AS (
  SELECT split_part(part, '/', 1) AS query_id, doc_id, round(sum(s), 6) AS score,
         count(DISTINCT part) AS n FROM piece GROUP BY 1, 2),
matched AS (SELECT h.query_id, doc_id, score FROM hits h JOIN needed d
  ON CAST(d.query_id AS VARCHAR) = h.query_id AND d.n = h.n)"""


@query("score_tfidf", f"WITH {BATCH} SELECT query_id, doc_id, score FROM matched")
def score_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    """A table of queries answered in one job."""
    index = document_index(spark, sf)
    return M.match(index, M.wanted_terms(item_queries(spark, sf)))


@query("search_term", f"WITH {words_sql()} {HITS}")
def search_term(spark: SparkSession, sf: str) -> DataFrame:
    return all_matches(spark, sf)


@query("search_filtered_top", f"""WITH {words_sql()}
SELECT 'q' AS query_id, doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank
FROM hits JOIN documents USING (doc_id) WHERE lang = 'en'
ORDER BY score DESC, doc_id LIMIT 10""")
def search_filtered_top(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: the best ten English documents for two words."""
    q = Q("q").add_search_term(WORDS).add_filter("lang", "en")
    hits = search(document_index(spark, sf), [q]).hits
    return hits.select("query_id", "doc_id", "score", "rank").orderBy("rank")


FIELDS = ["Document_text", "Page_html"]


@query("search_field", f"""WITH {content_hits([[(f, w, 1.0) for f in FIELDS] for w in WORDS.split()])} {HITS}""")
def search_field(spark: SparkSession, sf: str) -> DataFrame:
    q = Q("q").add_search_term(WORDS, FIELDS)
    return search(content_index(spark, sf), [q]).matches


BOOST = {"Page_html": 3.0, "Document_text": 0.5}


@query("search_boost", f"""WITH {content_hits(
    [[('_text', w, 1.0)] + [(f, w, b) for f, b in BOOST.items()] for w in WORDS.split()])} {HITS}""")
def search_boost(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted fields join the field set; a field named twice counts once."""
    q = Q("q").add_search_term(WORDS, ["_text", "Page_html"], BOOST)
    return search(content_index(spark, sf), [q]).matches


QUERY_FIELDS = {"Page_html": 2.0, "Document_text": 1.5, "_text": 1.0}


@query("search_field_boost", f"""WITH {content_hits(
    [[(f, w, b) for f, b in QUERY_FIELDS.items()] for w in WORDS.split()])},
per_field AS (SELECT doc_id, part, field, sum(s) AS s FROM piece GROUP BY 1, 2, 3),
best AS (SELECT doc_id, part, max(s) AS s FROM per_field GROUP BY 1, 2)
SELECT 'q' AS query_id, doc_id, round(sum(s), 6) AS score FROM best
GROUP BY doc_id HAVING count(*) = {len(WORDS.split())}""")
def search_field_boost(spark: SparkSession, sf: str) -> DataFrame:
    """Index-time boosts: each part scores its best field, the default one included."""
    from trawl.plans.sample import content_spec
    spec = content_spec(spark, sf)
    spec.add_boosted_field("html").set_field_boosting("Document_text", 1.5)
    return search(
        content_index(spark, sf), [Q("q").add_search_term(WORDS)], spec.query_fields()
    ).matches


@query("search_boost_query", f"""WITH {words_sql()}
SELECT 'q' AS query_id, doc_id, round(score + CASE WHEN lang = 'en' THEN 2.5 ELSE 0.0 END
  + CASE WHEN n_chars > 2000 THEN 1.0 ELSE 0.0 END, 6) AS score FROM hits JOIN documents USING (doc_id)""")
def search_boost_query(spark: SparkSession, sf: str) -> DataFrame:
    boosts = [(F.col("lang") == "en", 2.5), (F.col("n_chars") > 2000, 1.0)]
    q = Q("q").add_search_term(WORDS)
    return search(document_index(spark, sf), [q], boosts=boosts).matches


@query("search_boost_value", f"""WITH {words_sql()}
SELECT 'q' AS query_id, doc_id, round(score + coalesce(CASE WHEN n_chars > 0 THEN ln(n_chars) / 10 END, 0.0)
  + CASE WHEN lang = 'en' THEN n_chars / 100000.0::DOUBLE ELSE 0.0 END, 6) AS score FROM hits JOIN documents USING (doc_id)""")
def search_boost_value(spark: SparkSession, sf: str) -> DataFrame:
    """A field's value adds to the score, for all documents and for some."""
    boosts = [(F.lit(True), F.when(F.col("n_chars") > 0, F.ln("n_chars") / 10)), (F.col("lang") == "en", F.col("n_chars") / 100000.0)]
    return search(document_index(spark, sf), [Q("q").add_search_term(WORDS)], boosts=boosts).matches


@query("search_match_all", "SELECT 'q' AS query_id, doc_id, 1.0 AS score FROM documents WHERE lang <> 'es'")
def search_match_all(spark: SparkSession, sf: str) -> DataFrame:
    q = Q("q").add_exclude("lang", "es")
    return search(document_index(spark, sf), [q]).matches


def expanding(conditions: list[str]) -> str:
    """CTEs whose parts are all vocabulary terms that meet a condition."""
    wants = " UNION ALL ".join(
        f"SELECT {n} AS part, '_text' AS field, term, 1.0::DOUBLE AS weight FROM vocab WHERE {c}"
        for n, c in enumerate(conditions)
    )
    return f"""{S.terms(TEXT)}, {DOC_TOTAL}, vocab AS (SELECT DISTINCT term FROM terms),
want AS ({wants}),
{S.SCORING.format(name='terms')},
hits AS (SELECT doc_id, round(sum(s), 6) AS score FROM piece
  GROUP BY doc_id HAVING count(DISTINCT part) = {len(conditions)})"""


@query("search_fuzzy", f"""WITH {expanding(["levenshtein(term, 'thanedbel') <= 2", "levenshtein(term, 'erinr') <= 2"])} {HITS}""")
def search_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    q = Q("q").add_fuzzy_search_term("thanedbel erinr")
    return search(document_index(spark, sf), [q]).matches


@query("search_wildcard", f"""WITH {expanding(["term LIKE 'thane%'", "term LIKE 'er_ner'", "term LIKE '%ntio%'"])} {HITS}""")
def search_wildcard(spark: SparkSession, sf: str) -> DataFrame:
    q = Q("q").add_search_term("thane* er?ner *ntio*")
    return search(document_index(spark, sf), [q]).matches


@query("wildcard_leading", f"""WITH {expanding(["term LIKE '%nedble'"])} {HITS}""")
def wildcard_leading(spark: SparkSession, sf: str) -> DataFrame:
    """A leading wildcard is looked up by the term's end."""
    q = Q("q").add_search_term("*nedble")
    return search(document_index(spark, sf), [q]).matches


def phrase_sql(words: list[str]) -> str:
    """CTEs for one phrase of consecutive terms."""
    listed = ", ".join(f"({i}, '{w}')" for i, w in enumerate(words))
    return f"""{S.terms(TEXT)}, {DOC_TOTAL},
want(idx, term) AS (VALUES {listed}),
size AS (SELECT doc_id, count(*) AS n_terms FROM terms GROUP BY 1),
met AS (
  SELECT doc_id, pos - idx AS start FROM terms JOIN want USING (term)
  GROUP BY 1, 2 HAVING count(DISTINCT idx) = {len(words)}),
freq AS (SELECT doc_id, count(*) AS tf FROM met GROUP BY 1),
weights AS (
  SELECT idx, 1 + ln(total.n::DOUBLE / (count(DISTINCT doc_id) + 1)) AS idf
  FROM want JOIN terms USING (term), total GROUP BY idx, total.n),
hits AS (
  SELECT doc_id, round(sqrt(tf) * w.s * w.s / sqrt(n_terms), 6) AS score
  FROM freq JOIN size USING (doc_id), (SELECT sum(idf) AS s FROM weights) AS w)"""


@query("search_phrase", f"WITH {phrase_sql(['anea', 'eriner', 'thanea'])} {HITS}")
def search_phrase(spark: SparkSession, sf: str) -> DataFrame:
    return all_matches(spark, sf, '"Anea. Eriner thanea"')


@query("search_auto_phrase", f"WITH {phrase_sql(['example', 'com'])} {HITS}")
def search_auto_phrase(spark: SparkSession, sf: str) -> DataFrame:
    """A part the analyzer splits becomes a phrase."""
    return all_matches(spark, sf, "example.com")


@query("search_multi_term", f"""WITH {S.terms(CONTENT_TEXT)}, {CONTENT_TOTAL},
want AS (
  SELECT 0 AS part, '_text' AS field, 'anea' AS term, 1.0::DOUBLE AS weight
  UNION ALL SELECT DISTINCT 1, field, term, 1.0::DOUBLE FROM terms
    WHERE field = 'Document_text' AND levenshtein(term, 'thonn') <= 2
  UNION ALL SELECT 2, '_text', 'the', 1.0::DOUBLE
  UNION ALL SELECT 2, 'Page_html', 'the', 2.0::DOUBLE),
{S.SCORING.format(name='terms')},
hits AS (SELECT doc_id, round(sum(s), 6) AS score FROM piece GROUP BY 1 HAVING count(DISTINCT part) = 3)
{HITS}""")
def search_multi_term(spark: SparkSession, sf: str) -> DataFrame:
    """Several calls with their own options; the parts of all must match."""
    q = Q("q").add_search_term("anea").add_fuzzy_search_term("thonn", ["Document_text"])
    # a stop word would be dropped, its punctuated form survives the stop filter
    q.add_search_term("the,", ["_text"], {"Page_html": 2.0})
    return search(content_index(spark, sf), [q]).matches


# Ranking --------------------------------------------------------------------

@query("num_found", f"WITH {words_sql()} SELECT 'q' AS query_id, count(*) AS num_found FROM hits")
def num_found(spark: SparkSession, sf: str) -> DataFrame:
    return R.num_found(all_matches(spark, sf))


@query("top_k", f"""WITH {BATCH} SELECT query_id, doc_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM matched) AS x
WHERE rank <= 3""")
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The best three documents of every query of a batch."""
    return R.ranked(score_tfidf(spark, sf), R.by_score(), 1, 3)


@query("paging", f"""WITH {words_sql('en')} SELECT 'q' AS query_id, page, doc_id, score, rank FROM (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM hits) AS x,
  (VALUES ('default', 1, 10), ('second', 11, 20), ('override', 6, 8)) AS p(page, first, last)
WHERE rank BETWEEN first AND last""")
def paging(spark: SparkSession, sf: str) -> DataFrame:
    matches = all_matches(spark, sf, "en")
    pages = {
        "default": R.page(matches), "second": R.page(matches, start=10, limit=10),
        "override": R.page(matches, start=10, limit=10, offset=5, length=3),
    }
    frames = [p.withColumn("page", F.lit(name)) for name, p in pages.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("sort_field", f"""WITH {words_sql()},
sized AS (SELECT hits.*, CASE WHEN lang = 'en' THEN source END AS site FROM hits JOIN documents USING (doc_id))
SELECT 'q' AS query_id, direction, doc_id, site, rank FROM (
  SELECT 'asc' AS direction, doc_id, site, row_number() OVER (ORDER BY site ASC NULLS LAST, doc_id) AS rank FROM sized
  UNION ALL
  SELECT 'desc', doc_id, site, row_number() OVER (ORDER BY site DESC NULLS LAST, doc_id) FROM sized) AS x
WHERE rank <= 10""")
def sort_field(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted by a field that some matches lack: those come last both ways."""
    site = F.when(F.col("lang") == "en", F.col("source"))
    index = document_index(spark, sf)
    index = replace(index, documents=index.documents.withColumn("site", site))

    def sorted_page(direction: str) -> DataFrame:
        key = R.sort_key("site", descending=direction == "desc")
        hits = search(index, [Q("q").add_search_term(WORDS)], order=[key]).hits
        return hits.join(index.documents.select("doc_id", "site"), "doc_id").select(
            "query_id", F.lit(direction).alias("direction"), "doc_id", "site", "rank")

    return sorted_page("asc").unionByName(sorted_page("desc"))


@query("sort_random", f"""WITH {words_sql()}
SELECT 'q' AS query_id, doc_id, md5(doc_id || ':seed_1') AS sort_key FROM hits""")
def sort_random(spark: SparkSession, sf: str) -> DataFrame:
    """All matches of a query in an order that a seed fixes."""
    matches = all_matches(spark, sf)
    key = R.random_key("seed_1")
    return matches.select("query_id", "doc_id", key.alias("sort_key")).orderBy("query_id", "sort_key", "doc_id")


RULES = """rules AS (
  SELECT doc_id, toxic = 1 AS excluded, doc_id AS pin
  FROM labels WHERE (toxic = 1 OR quality = 0) AND quality <> toxic)"""


@query("elevate", f"""WITH {words_sql()}, {RULES},
pins AS (SELECT doc_id, pin FROM rules JOIN documents USING (doc_id) WHERE NOT excluded)
SELECT 'q' AS query_id, doc_id, coalesce(score, 0.0) AS score, pin,
  row_number() OVER (ORDER BY pin NULLS LAST, coalesce(score, 0.0) DESC, doc_id) AS rank
FROM hits FULL JOIN pins USING (doc_id)
WHERE doc_id NOT IN (SELECT doc_id FROM rules WHERE excluded)
ORDER BY rank LIMIT 100""")
def elevate(spark: SparkSession, sf: str) -> DataFrame:
    """Some documents pinned for the query text, some excluded, some rules for another text."""
    rules = read(spark, sf, "labels").where("toxic = 1 OR quality = 0").select(
        F.when(F.col("quality") == F.col("toxic"), F.lit("other words")).otherwise(F.lit(WORDS)).alias("text"),
        "doc_id", (F.col("toxic") == 1).alias("excluded"),
        F.col("doc_id").alias("pin"),
    )
    pinned = Q("q").add_search_term(WORDS).set_limit(100)
    return search(document_index(spark, sf), [pinned], pins=rules).hits


PAGE = """ranked AS (
  SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM hits)"""


@query("page_visible", f"""WITH {words_sql()}, {ACL}, {PAGE}
SELECT 'q' AS query_id, doc_id, score, rank FROM ranked
WHERE rank <= 25 AND doc_id * 2 IN (SELECT ID FROM acl WHERE principal = 'en')""")
def page_visible(spark: SparkSession, sf: str) -> DataFrame:
    """Hits the principal may not see leave the page, which then is short."""
    def gate(hits: DataFrame) -> DataFrame:
        return G.viewable(hits.withColumn("ID", F.col("doc_id") * 2), None, "en", acl(spark, sf)).drop("ID")

    return search(document_index(spark, sf), [Q("q").add_search_term(WORDS).set_limit(25)], hook=gate).hits


@query("hydrate_hits", f"""WITH {words_sql()}, {PAGE}
SELECT 'q' AS query_id, rank, doc_id, score, lang, source, n_chars FROM ranked
JOIN documents USING (doc_id) LEFT JOIN labels USING (doc_id)
WHERE rank <= 50 AND coalesce(quality, 1) = 1""")
def hydrate_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Live rows of a page; documents of low quality have vanished since."""
    live = read(spark, sf, "documents").join(
        read(spark, sf, "labels").where("quality = 0").select("doc_id"), "doc_id", "left_anti"
    ).select("doc_id", "lang", "source", "n_chars")
    return R.hydrate(R.page(all_matches(spark, sf), limit=50), live, ["doc_id"])
