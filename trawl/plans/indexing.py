"""Registered queries: postings, vocabulary, norms and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trawl.functions import analysis as A, metaphone
from trawl.functions.stemming import stem_table
from trawl.operators import postings as P
from trawl.operators import store
from trawl.operators.indexes import index_of
from trawl.operators.sizing import scratch_folder
from trawl.plans import sqltext as S
from trawl.plans.registry import query
from trawl.plans.sample import content_spec, document_index, read
from trawl.operators.search import search
from trawl.plans.searching import CONTENT_TEXT, HITS, Q, TEXT, WORDS


@query("index_postings", f"""WITH {S.terms(TEXT)}
SELECT field, term, doc_id, count(*) AS tf, string_agg(pos, ' ' ORDER BY pos) AS positions
FROM terms GROUP BY 1, 2, 3""")
def index_postings(spark: SparkSession, sf: str) -> DataFrame:
    return document_index(spark, sf).postings.select(
        "field", "term", "doc_id", F.col("tf").cast("long").alias("tf"),
        F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions"),
    )


@query("index_vocab", f"""WITH {S.terms(CONTENT_TEXT)}
SELECT field, term, count(DISTINCT doc_id) AS df, length(term) AS len FROM terms GROUP BY 1, 2""")
def index_vocab(spark: SparkSession, sf: str) -> DataFrame:
    from trawl.plans.sample import content_index
    return content_index(spark, sf).vocab.select("field", "term", "df", "len")


@query("index_norms", f"""WITH {S.terms(CONTENT_TEXT)}
SELECT field, doc_id, count(*) AS n_terms, round(1 / sqrt(count(*)), 9) AS norm FROM terms GROUP BY 1, 2""")
def index_norms(spark: SparkSession, sf: str) -> DataFrame:
    from trawl.plans.sample import content_index
    return P.field_stats(content_index(spark, sf).analysed).withColumn("norm", F.round("norm", 9))


TURNS = "SELECT 'text' AS field, conv_id AS doc_id, turn AS val_no, text FROM conversations"


def turn_source(spark: SparkSession, sf: str) -> P.TextSource:
    turns = read(spark, sf, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("val_no"), "text"
    )
    return P.TextSource("text", turns, A.whitespace, multi=True)


@query("index_position_gap", f"""WITH {S.words(TURNS)},
sized AS (SELECT conv_id AS doc_id, turn AS val_no,
  (SELECT count(*) FROM tok t WHERE t.doc_id = conv_id AND t.val_no = turn) AS n_slots FROM conversations)
SELECT doc_id, val_no, n_slots,
  coalesce(sum(n_slots) OVER (PARTITION BY doc_id ORDER BY val_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  + 100 * val_no AS "offset" FROM sized""")
def index_position_gap(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of a conversation as values of one field, 100 positions apart."""
    rows = P.global_positions(P.analysed([turn_source(spark, sf)]))
    return rows.select("doc_id", "val_no", F.col("n_slots").cast("long").alias("n_slots"), "offset")


@query("search_values", f"""WITH {S.terms(TURNS)},
met AS (
  SELECT a.doc_id, a.val_no, a.pos FROM terms a JOIN terms b
    ON a.doc_id = b.doc_id AND a.val_no = b.val_no AND b.pos = a.pos + 1
  WHERE a.term = 'de' AND b.term = 'la'),
size AS (SELECT doc_id, count(*) AS n_terms FROM terms GROUP BY 1)
SELECT doc_id, count(*) AS tf, any_value(n_terms) AS n_terms FROM met JOIN size USING (doc_id) GROUP BY 1""")
def search_values(spark: SparkSession, sf: str) -> DataFrame:
    """A phrase in a multi-valued field: never across two values, length over all."""
    turns = turn_source(spark, sf).frame
    index = store.build(
        turns.select("doc_id").distinct(), [P.TextSource("text", turns, "text", multi=True)]
    )
    rows = index.postings.where(F.col("term").isin("de", "la"))
    starts = rows.select(
        "doc_id", "val_no", "n_terms", "term",
        F.explode("positions").alias("pos"),
    ).withColumn("start", F.when(F.col("term") == "la", F.col("pos") - 1).otherwise(F.col("pos")))
    met = (
        starts.groupBy("doc_id", "val_no", "start")
        .agg(F.count_distinct("term").alias("n"), F.max("n_terms").alias("n_terms"))
        .where("n = 2")
    )
    return met.groupBy("doc_id").agg(
        F.count("*").alias("tf"), F.max("n_terms").cast("long").alias("n_terms")
    )


@query("analyze_stem_v3", f"""WITH {S.terms(TEXT)}, {S.stems('terms')}
SELECT term, count(DISTINCT doc_id) AS df, any_value(stem) AS stem FROM terms JOIN stems USING (term) GROUP BY 1""")
def analyze_stem_v3(spark: SparkSession, sf: str) -> DataFrame:
    """Stems of the vocabulary, with the document frequency of each term."""
    vocab = document_index(spark, sf).vocab
    return stem_table(vocab.select("term", "df"))


@query("analyze_phonetic", f"""WITH {S.terms(TEXT)},
vocab AS (SELECT term, count(DISTINCT doc_id) AS df FROM terms GROUP BY 1),
letters AS (
  SELECT term, df, unnest(string_split(term, '')) AS c, generate_subscripts(string_split(term, ''), 1) AS i FROM vocab),
coded AS (
  SELECT term, df, i, c, CASE WHEN c IN ('h', 'w') THEN NULL
    WHEN NOT regexp_full_match(c, '[a-z]') THEN '0' ELSE translate(c, 'aeiouybfpvcgjkqsxzdtlmnr', '000000111122222222334556') END AS code FROM letters),
heard AS (SELECT *, lag(code) OVER (PARTITION BY term ORDER BY i) AS before FROM coded WHERE code IS NOT NULL OR i = 1)
SELECT term, df, CASE WHEN NOT regexp_matches(term, '^[a-z]') THEN term ELSE rpad(substr(upper(any_value(substr(term, 1, 1))) ||
  string_agg(CASE WHEN i > 1 AND code <> '0' AND code IS DISTINCT FROM before THEN code ELSE '' END, '' ORDER BY i), 1, 4), 4, '0') END AS code
FROM heard GROUP BY 1, 2""")
def analyze_phonetic(spark: SparkSession, sf: str) -> DataFrame:
    """Phonetic code of every vocabulary term; one that starts with no letter is its own code."""
    vocab = document_index(spark, sf).vocab
    code = F.try_element_at(A.phonetic(F.array("term")), F.lit(1))
    return vocab.select("term", "df", code.alias("code"))


def _metaphone_place() -> str:
    """What the rules say of a place in a word: its codes and how many letters they use up."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def denied(pattern: str) -> bool:
        return pattern.startswith("!")

    by_letter = ""
    for rule in metaphone.TABLE:
        tests = []
        if rule.before:
            given = rule.before.lstrip("!")
            given = f"[{given}]" if denied(rule.before) and given not in ("WI", "^M") else given
            tests.append(f"{'NOT ' if denied(rule.before) else ''}regexp_matches(before, {quoted(f'(?:{given})$')})")
        after = f"[^{rule.after[1:]}]" if denied(rule.after) else rule.after
        here = quoted(f"^({rule.letters})(?:{after})")
        tests.append(f"regexp_matches(rest, {here})")
        if rule.flag:
            tests.append(f"{'NOT ' if denied(rule.flag) else ''}has_{rule.flag.lstrip('!')}")
        by_letter += (f"WHEN {' AND '.join(tests)} THEN {{'p': {quoted(rule.primary)}, 's': {quoted(rule.secondary)}, "
                      f"'k': length(regexp_extract(rest, {here}, 1))}}\n")
    return f"CASE {by_letter} END"


@query("analyze_double_metaphone", f"""WITH RECURSIVE {S.terms(TEXT)},
vocab AS (SELECT term, count(DISTINCT doc_id) AS df FROM terms GROUP BY 1),
words AS (SELECT term, upper(term) AS w, {", ".join(f"regexp_matches(upper(term), '{pattern}') AS has_{flag}" for flag, pattern in metaphone.FLAGS)} FROM vocab),
places AS (SELECT *, substr(w, 1, i - 1) AS before, substr(w, i) || '~' AS rest FROM (SELECT *, unnest(range(1, length(w) + 1)) AS i FROM words) AS x),
ruled AS (SELECT term, i, {_metaphone_place()} AS x FROM places),
walk AS (SELECT term, i, x FROM ruled WHERE i = 1
  UNION ALL SELECT r.term, r.i, r.x FROM walk w JOIN ruled r ON r.term = w.term AND r.i = w.i + w.x.k),
codes AS (SELECT term, substr(string_agg(x.p, '' ORDER BY i), 1, 4) AS p, substr(string_agg(x.s, '' ORDER BY i), 1, 4) AS s FROM walk GROUP BY 1)
SELECT term, df, CASE WHEN p = '' AND s = '' THEN term WHEN p = '' OR p = s THEN s WHEN s = '' THEN p ELSE p || ' ' || s END AS codes
FROM vocab JOIN codes USING (term)""")
def analyze_double_metaphone(spark: SparkSession, sf: str) -> DataFrame:
    """Both double metaphone codes of every vocabulary term; a term without one is its own."""
    vocab = document_index(spark, sf).vocab
    slot = F.try_element_at(metaphone.phonetic_codes(F.array("term")), F.lit(1))
    return vocab.select("term", "df", F.replace(slot, F.lit(A.ALT), F.lit(" ")).alias("codes"))


@query("index_publish", f"""WITH {S.terms(TEXT)}
SELECT 'documents' AS "table", count(*) AS n FROM documents
UNION ALL SELECT 'postings', count(*) FROM (SELECT DISTINCT term, doc_id FROM terms) AS p
UNION ALL SELECT 'vocab', count(DISTINCT term) FROM terms""")
def index_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Write a generation of the tables and read it back."""
    index = store.publish(document_index(spark, sf), scratch_folder(spark, "published"), 1)
    tables = {"documents": index.documents, "postings": index.postings, "vocab": index.vocab}
    frames = [t.agg(F.count("*").alias("n")).select(F.lit(n).alias("table"), "n") for n, t in tables.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


# Changes: toxic documents are deleted, poor ones rewritten, benchmark texts are new.
CHANGED = """SELECT '_text' AS field, doc_id, 0 AS val_no,
  CASE WHEN quality = 0 THEN 'thon ' || text ELSE text END AS text
FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(toxic, 0) = 0
UNION ALL SELECT '_text', -1 - item_id, 0, text FROM benchmark"""


def changed_index(spark: SparkSession, sf: str) -> store.TextIndex:
    """A published index and a second generation with what changed since."""
    folder = scratch_folder(spark, "published")
    base = store.publish(document_index(spark, sf), folder, 1)
    labelled = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id")
    rewritten = labelled.where("quality = 0 AND coalesce(toxic, 0) = 0").select(
        "doc_id", F.concat(F.lit("thon "), "text").alias("text"), "lang", "source", "n_chars")
    added = read(spark, sf, "benchmark").select((-1 - F.col("item_id")).alias("doc_id"), "text")
    texts = rewritten.unionByName(added, allowMissingColumns=True)
    return store.publish_changes(
        base, texts.drop("text"), [P.TextSource("_text", texts.select("doc_id", "text"))],
        labelled.where("toxic = 1"), folder, 2)


@query("index_incremental", f"""WITH {S.terms(CHANGED)},
vocab AS (SELECT field, term, count(DISTINCT doc_id) AS df FROM terms GROUP BY 1, 2)
SELECT field, term, doc_id, count(*) AS tf, string_agg(pos, ' ' ORDER BY pos) AS positions, any_value(df) AS df
FROM terms JOIN vocab USING (field, term) GROUP BY 1, 2, 3""")
def index_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Postings and frequencies after deletes, updates and inserts are those of a full rebuild."""
    index = changed_index(spark, sf)
    return index.postings.join(index.vocab.select("field", "term", "df"), ["field", "term"]).select(
        "field", "term", "doc_id", F.col("tf").cast("long").alias("tf"),
        F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions"), "df",
    )


@query("search_incremental", f"""WITH {S.terms(CHANGED)},
total AS (SELECT count(*) AS n FROM ({CHANGED}) AS c),
{S.scored([[('_text', w, 1.0)] for w in WORDS.split()])} {HITS}""")
def search_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Deleted documents are found no more, changed and new ones by their new text."""
    return search(changed_index(spark, sf), [Q("q").add_search_term(WORDS)]).matches


@query("search_stemmed", f"""WITH {S.terms(TEXT, name='raw', finish='lower')}, {S.stems('raw')},
terms AS (SELECT field, doc_id, val_no, pos, stem AS term FROM raw JOIN stems USING (term)),
total AS (SELECT count(*) AS n FROM documents),
{S.scored([[('_text', w, 1.0)] for w in WORDS.split()])} {HITS}""")
def search_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    """Texts and search words meet in their stems."""
    documents = read(spark, sf, "documents")
    text = P.TextSource("_text", documents.select("doc_id", "text"), "text_stem")
    index = store.build(documents.drop("text"), [text])
    return search(index, [Q("q").add_search_term("aneas thons")]).matches


REVERSED = "SELECT 'Document_text' AS field, doc_id * 2 AS doc_id, 0 AS val_no, text FROM documents"
CLEAN = f"""SELECT 'x' AS field, doc_id * 2 AS doc_id, 0 AS val_no, {S.strip_html('text')} AS text FROM documents
UNION ALL SELECT 'x', page_id * 2 + 1, 0, {S.strip_html('html')} FROM pages"""


@query("index_of_spec", f"""WITH {S.words(REVERSED, 'own')}, {S.terms(CLEAN)},
{S.terms("SELECT 'y' AS field, page_id * 2 + 1 AS doc_id, 0 AS val_no, " + S.strip_html('html') + " AS text FROM pages", name='html')},
every AS (
  SELECT 'Document_text' AS field, doc_id, reverse(lower(w)) AS term FROM own
  UNION ALL SELECT 'Page_html', doc_id, term FROM html
  UNION ALL SELECT '_text', doc_id, term FROM terms UNION ALL SELECT 'everything', doc_id, term FROM terms WHERE doc_id % 2 = 1)
SELECT field, term, doc_id || '-Content-[]' AS doc_id, count(*) AS tf FROM every GROUP BY 1, 2, 3""")
def index_of_spec(spark: SparkSession, sf: str) -> DataFrame:
    """All postings of a specification: an analyzer of its own, an HTML field, default and explicit copies."""
    spec = content_spec(spark, sf)
    spec.add_analyzer("text", A.chain(A.whitespace, A.lower, lambda slots: F.transform(slots, F.reverse)))
    spec.add_copy_field("Page_html", "everything")
    rows = index_of(spec).postings
    return rows.groupBy("field", "term", "doc_id").agg(F.sum("tf").alias("tf"))


@query("search_of_spec", f"""WITH {S.terms(CONTENT_TEXT)},
total AS (SELECT (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages) AS n),
{S.scored([[('_text', w, 1.0)] for w in WORDS.split()])}
SELECT 'q' AS query_id, doc_id || '-Content-[]' AS doc_id, score FROM hits JOIN documents d ON d.doc_id * 2 = hits.doc_id
WHERE lang = 'en'""".replace("SELECT 'q' AS query_id, doc_id ||", "SELECT 'q' AS query_id, hits.doc_id ||"))
def search_of_spec(spark: SparkSession, sf: str) -> DataFrame:
    """A search of an index built from a specification alone, filtered by one of its fields."""
    asked = Q("q").add_search_term(WORDS).add_filter("Document_lang", "en")
    return search(index_of(content_spec(spark, sf)), [asked]).matches
