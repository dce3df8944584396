"""Registered queries: variants and visibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trawl.operators import criteria as C
from trawl.operators import documents as D
from trawl.operators import gates as G
from trawl.operators import variants as V
from trawl.operators.variants import STAGE, SUBSITE
from trawl.plans.fields import CONTENT, STATED
from trawl.plans.registry import query
from trawl.plans.sample import (
    anyone_can_view, content_spec, document_rows, page_rows, read,
    show_in_search, site_variant, stage_variant, tree,
)
from trawl.sources import changes as X


def stated_documents(spark: SparkSession, sf: str, keep=()) -> DataFrame:
    return D.build_documents(
        content_spec(spark, sf), [stage_variant(), site_variant()], keep=list(keep)
    )


@query("variant_states", """WITH sites AS (SELECT '0' AS site UNION ALL
  SELECT CAST(list_position(['de', 'en', 'es', 'fr'], lang) AS VARCHAR) FROM (SELECT DISTINCT lang FROM documents) AS d),
stages(stage, least) AS (VALUES ('Stage', 0), ('Live', 400))
SELECT stage AS _versionedstage, site AS _subsite,
  (SELECT count(*) FROM documents WHERE n_chars >= least
     AND CAST(list_position(['de', 'en', 'es', 'fr'], lang) AS VARCHAR) = site) AS n_documents
FROM sites, stages""")
def variant_states(spark: SparkSession, sf: str) -> DataFrame:
    """Every combination of stage and site, with the documents that exist in it."""
    states = V.combinations([stage_variant(), V.Variant("_none", (), ("Document",)), site_variant()])
    listed = spark.createDataFrame([(s[STAGE], s[SUBSITE]) for s in states], f"{STAGE} string, {SUBSITE} string")
    counts = stated_documents(spark, sf).groupBy(STAGE, SUBSITE).agg(F.count("*").alias("n"))
    return listed.join(counts, [STAGE, SUBSITE], "left").select(
        STAGE, SUBSITE, F.coalesce("n", F.lit(0)).alias("n_documents")
    )


@query("variant_applies", f"""WITH {CONTENT}
SELECT v.variant, ClassName, count(*) AS n, bool_or(ClassName = 'Document') AS own,
  true AS in_subclasses, true AS common
FROM content, (VALUES ('_versionedstage'), ('_subsite')) AS v(variant) GROUP BY 1, 2""")
def variant_applies(spark: SparkSession, sf: str) -> DataFrame:
    """Which variants concern which rows: the class itself, its subclasses, the index."""
    classes = tree(spark, sf, "Content", "Document", "Page")
    variants = [stage_variant(), site_variant(), V.Variant("_off", ("x",), ("Page",), enabled=False)]
    shared = {v.column for v in V.common(variants, classes, {"Content": True})}
    entries = F.array(*[
        F.struct(F.lit(v.column).alias("variant"), F.lit(c).alias("cls"),
                 F.lit(v.applies_to(classes, c, children=False)).alias("own"),
                 F.lit(v.applies_to(classes, "Content")).alias("in_subclasses"),
                 F.lit(v.column in shared).alias("common"))
        for v in variants if v.enabled for c in ("Document", "Page")
    ])
    return (
        classes.rows("Content").select("ClassName", F.explode(entries).alias("e"))
        .where(F.col("e.cls") == F.col("ClassName"))
        .groupBy("e.variant", "ClassName").agg(
            F.count("*").alias("n"), F.bool_or("e.own").alias("own"),
            F.bool_or("e.in_subclasses").alias("in_subclasses"), F.bool_or("e.common").alias("common"),
        )
    )


@query("variant_stage_filter", f"""WITH {STATED}
SELECT _documentid FROM keyed WHERE _versionedstage = 'Live' OR _versionedstage IS NULL""")
def variant_stage_filter(spark: SparkSession, sf: str) -> DataFrame:
    return stated_documents(spark, sf).where(V.state_filter(STAGE, "Live")).select("_documentid")


@query("variant_subsite_filter", f"""WITH {STATED}
SELECT 'injected' AS mode, _documentid FROM keyed WHERE _subsite = '2' OR _subsite IS NULL
UNION ALL SELECT 'user filter', _documentid FROM keyed WHERE _subsite IN ('1', '4')""")
def variant_subsite_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The current site is added unless the query already filters the site."""
    from trawl.operators.variants import with_states
    docs = stated_documents(spark, sf)
    current = {SUBSITE: "2"}
    injected = docs.where(C.require(with_states({}, current)))
    own = docs.where(C.require(with_states({SUBSITE: ["1", "4"]}, current)))
    return injected.select(F.lit("injected").alias("mode"), "_documentid").unionByName(
        own.select(F.lit("user filter").alias("mode"), "_documentid")
    )


@query("variant_write_stage", """SELECT seq, class, stage FROM (
  SELECT event_id AS seq, 'Customer' AS class,
    CASE WHEN event_type IN ('purchase', 'error') THEN 'Live' ELSE 'Stage' END AS stage FROM events) AS x""")
def variant_write_stage(spark: SparkSession, sf: str) -> DataFrame:
    table = F.when(F.col("event_type").isin("purchase", "error"), F.lit("Customer_Live")).otherwise(
        F.lit("Customer")
    )
    return read(spark, sf, "events").select(
        F.col("event_id").alias("seq"), X.table_class(table).alias("class"),
        X.table_stage(table).alias("stage"),
    )


@query("variant_write_fanout", """WITH writes AS (
  SELECT event_id AS seq, event_type, CAST(user_id % 4 AS VARCHAR) AS site FROM events)
SELECT seq, unnest(CASE event_type
  WHEN 'view' THEN [site]
  WHEN 'click' THEN CASE WHEN site <> '0' THEN [site] ELSE ['0', '1', '2', '3'] END
  ELSE ['0', '1', '2', '3'] END) AS site FROM writes""")
def variant_write_fanout(spark: SparkSession, sf: str) -> DataFrame:
    """Views write pages, clicks write files, other events say nothing of a site."""
    site = (F.col("user_id") % 4).cast("string")
    fields = (
        F.when(F.col("event_type") == "view", F.create_map(F.lit("Page:SubsiteID"), site))
        .when(F.col("event_type") == "click", F.create_map(F.lit("File:SubsiteID"), site))
        .otherwise(F.create_map().cast("map<string,string>"))
    )
    sites = X.write_sites(F.col("fields"), "Page:SubsiteID", "File:SubsiteID", ["0", "1", "2", "3"])
    return (
        read(spark, sf, "events").select(F.col("event_id").alias("seq"), fields.alias("fields"))
        .select("seq", F.explode(sites).alias("site"))
    )


@query("variant_excluded", f"""WITH {STATED}
SELECT _documentid FROM keyed WHERE NOT (
  (_versionedstage IS NOT NULL AND _versionedstage = 'Live' AND _subsite = '1')
  OR coalesce(_subsite = '3', false))""")
def variant_excluded(spark: SparkSession, sf: str) -> DataFrame:
    """Excluded: the live German site, and the Spanish site altogether."""
    rules = [{STAGE: "Live", SUBSITE: "1"}, {SUBSITE: "3"}]
    docs = stated_documents(spark, sf)
    return docs.where(~V.state_excluded(rules, draft=False)).select("_documentid")


@query("variant_draft_excluded", f"""WITH {STATED}
SELECT _documentid FROM keyed WHERE _versionedstage IS DISTINCT FROM 'Stage'""")
def variant_draft_excluded(spark: SparkSession, sf: str) -> DataFrame:
    return stated_documents(spark, sf).where(~V.state_excluded([])).select("_documentid")


# Visibility -----------------------------------------------------------------

def _content(spark: SparkSession, sf: str) -> DataFrame:
    return tree(spark, sf, "Content", "Document", "Page").rows("Content")


@query("gate_indexable", f"""WITH {CONTENT} SELECT ID, ClassName FROM content
WHERE ID <> 0 AND coalesce(quality = 1, true) AND coalesce(toxic, 0) = 0""")
def gate_indexable(spark: SparkSession, sf: str) -> DataFrame:
    gate = G.indexable(show_in_search(), anyone_can_view())
    return _content(spark, sf).where(gate).select("ID", "ClassName")


@query("gate_class_skip", f"""WITH {CONTENT} SELECT ID, ClassName FROM content
WHERE ID <> 0 AND coalesce(quality = 1, true)""")
def gate_class_skip(spark: SparkSession, sf: str) -> DataFrame:
    """Neither documents nor pages are asked who may view them: the skip covers subclasses."""
    gate = G.indexable(show_in_search(), anyone_can_view(), skip_classes=["Content"])
    return _content(spark, sf).where(gate).select("ID", "ClassName")


@query("gate_override", f"""WITH {CONTENT} SELECT ID, ClassName FROM content WHERE ID <> 0 AND
  CASE WHEN ClassName = 'Page' THEN url LIKE 'https:%'
  ELSE coalesce(quality = 1, true) AND coalesce(toxic, 0) = 0 END""")
def gate_override(spark: SparkSession, sf: str) -> DataFrame:
    """A hook has the last word: of the pages only those served over https."""
    def secure_pages(verdict):
        return F.when(F.col("ClassName") == "Page", F.col("url").startswith("https:")).otherwise(verdict)
    gate = G.indexable(show_in_search(), anyone_can_view(), override=secure_pages)
    return _content(spark, sf).where(gate).select("ID", "ClassName")


# A principal of a site may see the documents in its language; toxic ones no one.
ACL = """acl AS (
  SELECT DISTINCT doc_id * 2 AS ID, lang AS principal FROM documents LEFT JOIN labels USING (doc_id)
  WHERE coalesce(toxic, 0) = 0
  UNION SELECT page_id * 2 + 1, 'en' FROM pages)"""


def acl(spark: SparkSession, sf: str) -> DataFrame:
    docs = document_rows(spark, sf).where(anyone_can_view()).select("ID", F.col("lang").alias("principal"))
    pages = page_rows(spark, sf).select("ID", F.lit("en").alias("principal"))
    return docs.unionByName(pages)


@query("gate_viewable", f"""WITH {CONTENT}, {ACL} SELECT ID, ClassName FROM content
WHERE ID <> 0 AND coalesce(quality = 1, true)
  AND ID IN (SELECT ID FROM acl WHERE principal = 'en')""")
def gate_viewable(spark: SparkSession, sf: str) -> DataFrame:
    rows = G.viewable(_content(spark, sf), show_in_search(), "en", acl(spark, sf))
    return rows.select("ID", "ClassName")
