"""Registered queries: text analysis over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trawl.functions import analysis as A
from trawl.functions.phrases import phrase_synonyms
from trawl.functions.profiles import PROFILES
from trawl.operators.postings import in_parallel, term_count
from trawl.operators.sizing import materialised, scratch_folder
from trawl.plans import sqltext as S
from trawl.plans.registry import query
from trawl.plans.sample import read
from trawl.sources.rulefiles import read_synonyms


def shown(slots: Column) -> Column:
    """Slots as ``position:term`` pairs in one string."""
    def in_slot(slot: Column, pos: Column) -> Column:
        terms = F.array_sort(F.split(slot, A.ALT))
        numbered = F.transform(terms, lambda t: F.concat(pos.cast("string"), F.lit(":"), t))
        return F.when(slot == A.GAP, F.array().cast("array<string>")).otherwise(numbered)
    return F.array_join(F.flatten(F.transform(slots, in_slot)), " ")


def listing(frame: DataFrame, key: str, slots: Column) -> DataFrame:
    return in_parallel(frame).select(F.col(key).alias("doc_id"), slots.alias("slots")).select(
        "doc_id", term_count(F.col("slots")).cast("long").alias("n_terms"),
        shown(F.col("slots")).alias("terms"),
    )


def over_documents(step: A.Step):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return listing(read(spark, sf, "documents"), "doc_id", step(F.col("text")))
    return run


def over_pages(step: A.Step, column: str = "html"):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return listing(read(spark, sf, "pages"), "page_id", step(F.col(column)))
    return run


def over_benchmark(step: A.Step):
    """Query-side chains run over the query texts, the benchmark table."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return listing(read(spark, sf, "benchmark"), "item_id", step(F.col("text")))
    return run


ITEMS = "SELECT 'text' AS field, item_id AS doc_id, 0 AS val_no, text FROM benchmark"


def _chain(source: str, **options) -> str:
    return f"WITH {S.terms(source, **options)} {S.listing(source)}"


def _words(source: str, term: str, keep: str = "true", splitter: str | None = None) -> str:
    """Every word is a position; ``keep`` filters, ``term`` rewrites."""
    return f"""WITH {S.words(source, 'tok', splitter)},
terms AS (SELECT doc_id, i - 1 AS pos, {term} AS term FROM tok WHERE {keep})
{S.listing(source)}"""


NOT_STOP = f"lower(w) NOT IN ({S.STOPS})"
STANDARD = "regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+(?:[''’.][\\p{L}\\p{N}]+)*')"

query("analyze_whitespace", _words(S.DOCUMENTS, "w"))(over_documents(A.whitespace))
query("analyze_stop", _words(S.DOCUMENTS, "w", NOT_STOP))(
    over_documents(A.chain(A.whitespace, A.stop()))
)
query("analyze_word_delimiter", _chain(S.DOCUMENTS, finish="none", stop=False))(
    over_documents(A.chain(A.whitespace, A.word_delimiter()))
)
query("analyze_ascii_fold", _words(S.DOCUMENTS, S.fold("w")))(
    over_documents(A.chain(A.whitespace, A.fold))
)
query("analyze_text", _chain(S.DOCUMENTS))(over_documents(PROFILES["text"].index))
query("analyze_html", _chain(S.PAGES))(over_pages(PROFILES["htmltext"].index))
query("analyze_textgen", _chain(S.DOCUMENTS, case=False, finish="lower"))(
    over_documents(PROFILES["textgen"].index)
)
query("analyze_lowercase", _words(
    "SELECT 'text' AS field, doc_id, 0 AS val_no, text FROM documents", "lower(w)", splitter="[text]"
))(over_documents(PROFILES["lowercase"].index))
query("analyze_custom", _words(
    S.DOCUMENTS, "reverse(lower(w))", f"{NOT_STOP} AND length(w) BETWEEN 3 AND 12",
))(over_documents(A.chain(
    A.whitespace, A.stop(), A.length_between(3, 12), A.lower,
    lambda slots: F.transform(slots, F.reverse),
)))
query("analyze_spell", _words(
    S.DOCUMENTS, "lower(w)", f"{NOT_STOP} AND length(w) BETWEEN 4 AND 20", STANDARD,
))(over_documents(PROFILES["textSpell"].index))

SPELL_PAGES = _words(
    S.PAGES, "lower(w)", f"{NOT_STOP} AND length(w) BETWEEN 4 AND 20", STANDARD,
)
query("analyze_spell_html", SPELL_PAGES)(over_pages(PROFILES["textSpellHtml"].index))

# the light plural stemmer, on lower-cased runs
STEM = """CASE
  WHEN length(term) < 3 OR term NOT LIKE '%s' OR term IN ('dontstems', 'zwhacky') THEN term
  WHEN substr(term, -2, 1) IN ('u', 's') THEN term
  WHEN length(term) > 3 AND term LIKE '%ies' AND substr(term, -4, 1) NOT IN ('a', 'e')
    THEN substr(term, 1, length(term) - 3) || 'y'
  WHEN substr(term, -2, 1) = 'e' AND substr(term, -3, 1) IN ('i', 'a', 'o', 'e') THEN term
  ELSE substr(term, 1, length(term) - 1) END"""
REDUCED = """CASE term WHEN 'fooaaa' THEN ['fooaaa'] WHEN 'baraaa' THEN ['fooaaa']
  WHEN 'bazaaa' THEN ['fooaaa'] WHEN 'gb' THEN ['gb'] WHEN 'gib' THEN ['gb']
  WHEN 'gigabyte' THEN ['gb'] WHEN 'gigabytes' THEN ['gb'] WHEN 'mb' THEN ['mb']
  WHEN 'mib' THEN ['mb'] WHEN 'megabyte' THEN ['mb'] WHEN 'megabytes' THEN ['mb']
  WHEN 'television' THEN ['television'] WHEN 'televisions' THEN ['television']
  WHEN 'tv' THEN ['television'] WHEN 'tvs' THEN ['television']
  WHEN 'aaafoo' THEN ['aaabar'] WHEN 'bbbfoo' THEN ['bbbfoo', 'bbbbar']
  WHEN 'cccfoo' THEN ['cccbar', 'cccbaz'] WHEN 'pixima' THEN ['pixma'] ELSE [term] END"""
query("analyze_text_tight", f"""WITH {S.terms(S.DOCUMENTS, name='runs', parts=False, finish='lower')},
stemmed AS (SELECT doc_id, pos, {STEM} AS term FROM runs),
terms AS (SELECT doc_id, pos, unnest({REDUCED}) AS term FROM stemmed)
{S.listing(S.DOCUMENTS)}""")(over_documents(PROFILES["textTight"].index))

# the query chain folds before it splits
FOLDED_ITEMS = f"SELECT 'text' AS field, item_id AS doc_id, 0 AS val_no, {S.fold('text')} AS text FROM benchmark"
EXPANDED = """CASE term WHEN 'fooaaa' THEN ['fooaaa', 'baraaa', 'bazaaa']
  WHEN 'baraaa' THEN ['fooaaa', 'baraaa', 'bazaaa'] WHEN 'bazaaa' THEN ['fooaaa', 'baraaa', 'bazaaa']
  WHEN 'gb' THEN ['gb', 'gib', 'gigabyte', 'gigabytes'] WHEN 'gib' THEN ['gb', 'gib', 'gigabyte', 'gigabytes']
  WHEN 'gigabyte' THEN ['gb', 'gib', 'gigabyte', 'gigabytes']
  WHEN 'gigabytes' THEN ['gb', 'gib', 'gigabyte', 'gigabytes']
  WHEN 'mb' THEN ['mb', 'mib', 'megabyte', 'megabytes'] WHEN 'mib' THEN ['mb', 'mib', 'megabyte', 'megabytes']
  WHEN 'megabyte' THEN ['mb', 'mib', 'megabyte', 'megabytes']
  WHEN 'megabytes' THEN ['mb', 'mib', 'megabyte', 'megabytes']
  WHEN 'television' THEN ['television', 'televisions', 'tv', 'tvs']
  WHEN 'televisions' THEN ['television', 'televisions', 'tv', 'tvs']
  WHEN 'tv' THEN ['television', 'televisions', 'tv', 'tvs']
  WHEN 'tvs' THEN ['television', 'televisions', 'tv', 'tvs']
  WHEN 'aaafoo' THEN ['aaabar'] WHEN 'bbbfoo' THEN ['bbbfoo', 'bbbbar']
  WHEN 'cccfoo' THEN ['cccbar', 'cccbaz'] WHEN 'pixima' THEN ['pixma'] ELSE [term] END"""
query("analyze_query_text", f"""WITH {S.terms(FOLDED_ITEMS, name='plain', catenate=False, finish='lower')},
terms AS (SELECT doc_id, pos, unnest({EXPANDED}) AS term FROM plain)
{S.listing(ITEMS)}""")(over_benchmark(PROFILES["text"].query))

# The rules' words do not occur in the tables, so words that do are given rules:
# one group, one replacement, one rule with two targets.
SAMPLE_RULES = "Der,die,das\ncon => with\nles => le la"


def _sample_rules(expand: bool) -> str:
    group = "['der', 'die', 'das']" if expand else "['der']"
    return f"""CASE WHEN lower(w) IN ('der', 'die', 'das') THEN {group}
      WHEN lower(w) = 'con' THEN ['with'] WHEN lower(w) = 'les' THEN ['le', 'la'] ELSE [w] END"""


for _name, _expand in (("analyze_synonyms", True), ("analyze_synonyms_reduce", False)):
    query(_name, f"""WITH {S.words(S.DOCUMENTS)},
terms AS (SELECT doc_id, i - 1 AS pos, unnest({_sample_rules(_expand)}) AS term FROM tok)
{S.listing(S.DOCUMENTS)}""")(
        over_documents(A.chain(A.whitespace, A.synonyms(SAMPLE_RULES, _expand)))
    )


RULE_PAIRS, RULE_WORDS = 9000, 1000
LOW = f"""{S.words(S.DOCUMENTS)},
low AS (SELECT doc_id, i, lower(w) AS w, lead(lower(w)) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM tok),
pairs AS (SELECT DISTINCT w, following FROM low WHERE regexp_full_match(w, '[a-m][a-z]*')
  AND regexp_full_match(following, '[n-z][a-z]*') ORDER BY w, following LIMIT {RULE_PAIRS}),
single AS (SELECT DISTINCT w FROM pairs ORDER BY w LIMIT {RULE_WORDS})"""


def synonym_file(spark: SparkSession, sf: str) -> str:
    """Rules made of the documents' own words: pairs become three words, some words that begin them one other."""
    low = F.transform(A.whitespace(F.col("text")), F.lower)
    two = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.struct(
        F.element_at("w", i).alias("w"), F.element_at("w", i + 1).alias("following")))
    pairs = (
        read(spark, sf, "documents").select(low.alias("w")).where(F.size("w") > 1).select(F.explode(two).alias("p")).select("p.*")
        .where(F.col("w").rlike("^[a-m][a-z]*$") & F.col("following").rlike("^[n-z][a-z]*$")).distinct()
        .orderBy("w", "following").limit(RULE_PAIRS)
    )
    pairs = materialised(pairs)
    lines = pairs.select(F.concat_ws(" ", "w", "following", F.lit("=>"), F.reverse("w"), F.lit("mid"), F.reverse("following")).alias("value"))
    words = pairs.select("w").distinct().orderBy("w").limit(RULE_WORDS)
    path = scratch_folder(spark, "rules")
    lines.unionByName(words.select(F.concat("w", F.lit(" => only")).alias("value"))).write.text(path)
    return path


@query("analyze_synonyms_file", f"""WITH {LOW},
marked AS (SELECT l.*, p.w IS NOT NULL AS two, s.w IS NOT NULL AS one FROM low l
  LEFT JOIN pairs p ON l.w = p.w AND l.following = p.following LEFT JOIN single s ON l.w = s.w),
sides AS (SELECT doc_id, i, CASE WHEN coalesce(lag(two) OVER (PARTITION BY doc_id ORDER BY i), false) THEN []
  WHEN two THEN [reverse(w), 'mid', reverse(following)] WHEN one THEN ['only'] ELSE [w] END AS side FROM marked),
placed AS (SELECT *, coalesce(sum(len(side)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
  FROM sides),
terms AS (SELECT doc_id, begin + generate_subscripts(side, 1) - 1 AS pos, unnest(side) AS term FROM placed)
{S.listing(S.DOCUMENTS)}""")
def analyze_synonyms_file(spark: SparkSession, sf: str) -> DataFrame:
    """Ten thousand rules of one and of two words, read from a file: the longest match, and where its words stand."""
    rules_text = read_synonyms(spark, synonym_file(spark, sf))
    return over_documents(A.chain(A.whitespace, A.lower, phrase_synonyms(rules_text)))(spark, sf)


@query("analyze_path", """WITH parts AS (
  SELECT page_id AS doc_id, url,
         list_filter(string_split(url, '/'), lambda p: p <> '') AS ps FROM pages),
prefixes AS (
  SELECT doc_id, CASE WHEN url LIKE '/%' THEN '/' ELSE '' END ||
         array_to_string(ps[1:n], '/') AS term
  FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS n FROM parts) AS x)
SELECT doc_id, count(*) AS n_terms, string_agg('0:' || term, ' ' ORDER BY term) AS terms
FROM prefixes GROUP BY doc_id""")
def analyze_path(spark: SparkSession, sf: str) -> DataFrame:
    return over_pages(A.path_hierarchy, "url")(spark, sf)


@query("analyze_payload", """WITH given AS (
  SELECT l_orderkey AS doc_id, p_brand || '|' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5' AS token
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT split_part(token, '|', 1) AS term, count(*) AS n,
       CAST(sum(CAST(split_part(token, '|', 2) AS FLOAT)) AS DOUBLE) AS weight
FROM given GROUP BY 1""")
def analyze_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Brands weighted by quantity: tokens ``brand|17.5`` written by one side, parsed here."""
    token = F.concat_ws(
        "|", F.replace("p_brand", F.lit(" "), F.lit("_")),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".5")),
    )
    given = read(spark, sf, "lineitem").join(
        read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).select(token.alias("token"))
    parsed = given.select(F.explode(A.payloads(F.col("token"))).alias("p"))
    return parsed.groupBy("p.term").agg(
        F.count("*").alias("n"), F.sum(F.col("p.weight").cast("double")).alias("weight")
    )


@query("sort_alpha_only", """SELECT p_partkey, p_name,
  regexp_replace(trim(lower(p_name)), '[^a-z]', '', 'g') AS sort_key FROM part""")
def sort_alpha_only(spark: SparkSession, sf: str) -> DataFrame:
    key = F.try_element_at(PROFILES["alphaOnlySort"].index(F.col("p_name")), F.lit(1))
    rows = read(spark, sf, "part").select("p_partkey", "p_name", key.alias("sort_key"))
    return rows.orderBy("sort_key", "p_partkey")
