"""Registered queries: filters and criteria over documents, orders and parts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trawl.operators import criteria as C
from trawl.operators import documents as D
from trawl.plans.fields import CONTENT
from trawl.plans.registry import query
from trawl.plans.sample import content_spec, read

MISSING, PRESENT, Range = C.MISSING, C.PRESENT, C.Range


def _filter(name: str, condition: str, make, sql_source: str = f"WITH {CONTENT} SELECT ID, ClassName FROM content"):
    """Register a filter over the documents of the content index."""
    @query(name, f"{sql_source} WHERE {condition}")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        docs = D.build_documents(content_spec(spark, sf))
        return docs.where(make()).select("ID", "ClassName")
    return run


_filter("filter_class", "ClassName = 'Page' OR ClassName IN ('Document')",
        lambda: C.classes([("Page", False), ("Document", True)]))
_filter("filter_require", "lang IN ('fr', 'de') AND source IN ('src1', 'src2', 'src3')",
        lambda: C.require({"Document_lang": ["fr", "de"], "Document_source": ["src1", "src2", "src3"]}))
_filter("filter_missing", "lang IS NULL", lambda: C.require({"Document_lang": [MISSING]}))
_filter("filter_present", "html IS NOT NULL", lambda: C.require({"Page_html": [PRESENT]}))
_filter("filter_range", "n_chars BETWEEN 500 AND 3000 AND lang >= 'en'",
        lambda: C.require({"Document_n_chars": [Range(500, 3000)], "Document_lang": [Range("en", None)]}))
_filter("filter_exclude",
        "NOT coalesce(lang = 'en' OR lang = 'fr', false) AND NOT coalesce(n_chars >= 2000, false)",
        lambda: C.exclude({"Document_lang": ["en", "fr"], "Document_n_chars": [Range(2000, None)]}))
_filter("filter_exclude_missing", "lang IS NOT NULL AND NOT coalesce(lang = 'es', false)",
        lambda: C.exclude({"Document_lang": [MISSING, "es"]}))


@query("filter_open_date", """SELECT c_custkey, last_order FROM (
  SELECT c_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS last_order
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) AS x
WHERE NOT coalesce(last_order >= TIMESTAMP '2000-06-01', false)""")
def filter_open_date(spark: SparkSession, sf: str) -> DataFrame:
    """Undated customers stay: the opposite range is excluded."""
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    dated = read(spark, sf, "customer").join(
        read(spark, sf, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left"
    ).groupBy("c_custkey").agg(F.max(closed).alias("last_order"))
    since = datetime.datetime(2000, 6, 1)
    return dated.where(C.exclude({"last_order": [Range(since, None)]}))


@query("filter_multi_valued", """SELECT c_custkey FROM customer WHERE EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority IN ('1-URGENT', '2-HIGH'))
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice >= 450000)""")
def filter_multi_valued(spark: SparkSession, sf: str) -> DataFrame:
    """Any value of a multi-valued field may match; the values stay long."""
    orders = read(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    urgent = orders.where(C.any_of("o_orderpriority", ["1-URGENT", "2-HIGH"]))
    large = orders.where(C.any_of("o_totalprice", [Range(450000, None)]))
    return (
        read(spark, sf, "customer").join(urgent, "c_custkey", "left_semi")
        .join(large, "c_custkey", "left_anti").select("c_custkey")
    )


# Criteria -------------------------------------------------------------------

def _criteria(name: str, condition: str, make, table: str = "part", key: str = "p_partkey"):
    @query(name, f"SELECT {key} FROM {table} WHERE {condition}")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        predicate: Column = make()
        return read(spark, sf, table).where(predicate).select(key)
    return run


def _one(target, value=None, comparison=C.EQUAL, writer=None):
    return lambda: C.Criteria.of(target, value, comparison, writer).column()


_criteria("crit_equal", "p_type = 'ECONOMY'", _one("p_type", "ECONOMY"))
_criteria("crit_not_equal", "p_type <> 'ECONOMY'", _one("p_type", "ECONOMY", C.NOT_EQUAL))
_criteria("crit_in", "p_size IN (1, 2, 3)", _one("p_size", [1, 2, 3], C.IN))
_criteria("crit_not_in", "p_size NOT IN (1, 2, 3)", _one("p_size", [1, 2, 3], C.NOT_IN))
_criteria("crit_ge", "p_size >= 25", _one("p_size", 25, C.GREATER_EQUAL))
_criteria("crit_le", "p_size <= 25", _one("p_size", 25, C.LESS_EQUAL))
_criteria("crit_gt", "p_size > 25", _one("p_size", 25, C.GREATER_THAN))
_criteria("crit_lt", "p_size < 25", _one("p_size", 25, C.LESS_THAN))
_criteria("crit_custom", "p_name LIKE '%ring' AND length(p_name) >= 9", lambda: C.Criteria.of(
    "p_name", "ring", C.CUSTOM,
    lambda c: F.col(c.target).endswith(c.value) & (F.length("p_name") >= 9),
).column())
_criteria("crit_and", "p_type = 'ECONOMY' AND p_size >= 10 AND p_retailprice < 1000", lambda: (
    C.Criteria.of("p_type", "ECONOMY").and_("p_size", 10, C.GREATER_EQUAL)
    .and_("p_retailprice", 1000, C.LESS_THAN).column()
))
_criteria("crit_or", "p_type = 'ECONOMY' OR p_size = 7 OR p_retailprice >= 1050", lambda: (
    C.Criteria.of("p_type", "ECONOMY").or_("p_size", 7)
    .or_("p_retailprice", 1050, C.GREATER_EQUAL).column()
))


def _nested() -> Column:
    cheap = C.Criteria.of("p_type", ["ECONOMY", "SMALL"], C.IN).and_(
        "p_brand", ["Brand#1", "Brand#2", "Brand#3"], C.IN
    ).and_("p_size", 20, C.GREATER_EQUAL)
    large = C.Criteria.of("p_type", ["LARGE", "PROMO"], C.IN).and_("p_size", 5, C.LESS_THAN)
    return C.Criteria.of(cheap).or_(large).column()


_criteria("crit_nested", """(p_type IN ('ECONOMY', 'SMALL') AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')
  AND p_size >= 20) OR (p_type IN ('LARGE', 'PROMO') AND p_size < 5)""", _nested)


def _nested_negative() -> Column:
    small = C.Criteria.of("p_type", ["ECONOMY", "SMALL"], C.NOT_IN).and_("p_size", 20, C.LESS_EQUAL)
    brand = C.Criteria.of("p_brand", ["Brand#1", "Brand#2"], C.NOT_IN).and_("p_size", 8, C.LESS_EQUAL)
    return C.Criteria.of(small).or_(brand).column()


_criteria("crit_nested_negative", """(p_type NOT IN ('ECONOMY', 'SMALL') AND p_size <= 20)
  OR (p_brand NOT IN ('Brand#1', 'Brand#2') AND p_size <= 8)""", _nested_negative)

_filter("crit_isnull", "lang IS NULL", lambda: C.Criteria.of("Document_lang", None, C.ISNULL).column())
_filter("crit_isnotnull", "lang IS NOT NULL",
        lambda: C.Criteria.of("Document_lang", None, C.ISNOTNULL).column())
_filter("crit_multi", "(lang = 'en' OR lang IS NULL) AND NOT coalesce(n_chars > 5000, false)", lambda: (
    C.Criteria.of("Document_lang", "en").or_("Document_lang", None, C.ISNULL).column()
    & C.Criteria.of(C.Criterion("Document_n_chars", 5000, C.GREATER_THAN, lambda c: C.negate(
        F.col(c.target) > c.value))).column()
))
