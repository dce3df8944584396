"""Registered queries: class scans, field resolution and document building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trawl.functions import values as V
from trawl.operators import documents as D
from trawl.operators import store
from trawl.operators.sizing import scratch_folder
from trawl.operators.spec import IndexSpec
from trawl.operators.variants import LIVE, STAGE, SUBSITE, state_json
from trawl.plans.registry import query
from trawl.plans.sample import (
    content_spec, read, show_in_search, site_variant, stage_variant, tree,
)
from trawl.sources.classes import class_is

CONTENT = """content AS (
  SELECT doc_id * 2 AS ID, 'Document' AS ClassName, text, lang, source, n_chars,
         quality, toxic, NULL AS url, NULL AS html
  FROM documents LEFT JOIN labels USING (doc_id)
  UNION ALL
  SELECT page_id * 2 + 1, 'Page', NULL, NULL, NULL, NULL, NULL, NULL, url, html FROM pages)"""

# documents once per stage they exist in, with the site of their language
STATED = f"""{CONTENT},
stated AS (
  SELECT content.*, stage AS _versionedstage,
         CAST(list_position(['de', 'en', 'es', 'fr'], lang) AS VARCHAR) AS _subsite
  FROM content, (VALUES ('Stage'), ('Live')) AS st(stage)
  WHERE ClassName = 'Document' AND (stage = 'Stage' OR n_chars >= 400)
  UNION ALL
  SELECT *, NULL, NULL FROM content WHERE ClassName = 'Page'),
keyed AS (
  SELECT *, ID || '-Content-' || CASE WHEN _subsite IS NULL THEN '[]' ELSE
    '{{"_subsite":"' || _subsite || '","_versionedstage":"' || _versionedstage || '"}}' END
    AS _documentid FROM stated)""".replace("{{", "{").replace("}}", "}")


# Scans ----------------------------------------------------------------------

@query("class_scan", f"""WITH {CONTENT}
SELECT 'with children' AS scan, ID, ClassName, coalesce(text, html) AS body FROM content
UNION ALL SELECT 'exact', ID, ClassName, html FROM content WHERE ClassName = 'Page'""")
def class_scan(spark: SparkSession, sf: str) -> DataFrame:
    classes = tree(spark, sf, "Content", "Document", "Page")
    whole = classes.rows("Content").select(
        F.lit("with children").alias("scan"), "ID", "ClassName", F.coalesce("text", "html").alias("body")
    )
    exact = classes.rows("Page", children=False).select(
        F.lit("exact").alias("scan"), "ID", "ClassName", F.col("html").alias("body")
    )
    return whole.unionByName(exact)


@query("class_hierarchy", """WITH party AS (
  SELECT 'Customer' AS cls, c_acctbal AS bal FROM customer
  UNION ALL SELECT 'Supplier', s_acctbal FROM supplier)
SELECT ancestor, count(*) AS n, round(sum(bal), 2) AS balance FROM (
  SELECT unnest(['Party', cls]) AS ancestor, bal FROM party) AS x GROUP BY 1""")
def class_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and balance of every class, subclasses counted in their ancestors."""
    parties = tree(spark, sf, "Party", "Customer", "Supplier", "Nation", "Order").rows("Party")
    balance = F.coalesce("c_acctbal", "s_acctbal")
    return (
        parties.select(F.explode("ClassHierarchy").alias("ancestor"), balance.alias("bal"))
        .groupBy("ancestor").agg(F.count("*").alias("n"), F.round(F.sum("bal"), 2).alias("balance"))
    )


@query("class_min_cover", """WITH listed AS (
  SELECT DISTINCT CASE event_type WHEN 'signup' THEN 'Party' WHEN 'purchase' THEN 'Customer'
    WHEN 'click' THEN 'Page' WHEN 'view' THEN 'Document' ELSE 'Supplier' END AS class FROM events),
up(class, ancestor) AS (VALUES ('Customer', 'Party'), ('Supplier', 'Party'),
  ('Page', 'Content'), ('Document', 'Content'))
SELECT class FROM listed WHERE NOT EXISTS (
  SELECT 1 FROM up JOIN listed l2 ON l2.class = up.ancestor WHERE up.class = listed.class)""")
def class_min_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Classes named by the feed, without those an ancestor of which is named too."""
    named = F.create_map(*[F.lit(x) for x in (
        "signup", "Party", "purchase", "Customer", "click", "Page", "view", "Document",
        "error", "Supplier",
    )])
    listed = read(spark, sf, "events").select(F.try_element_at(named, F.col("event_type")).alias("class")).distinct()
    classes = tree(spark, sf, "Content", "Document", "Page", "Party", "Customer", "Supplier")
    above = classes.as_frame(spark).select(
        "class", F.explode(F.slice("ancestors", F.lit(1), F.col("depth") - 1)).alias("ancestor")
    )
    covered = above.join(listed.select(F.col("class").alias("ancestor")), "ancestor").select("class")
    return listed.join(covered, "class", "left_anti")


# Fields ---------------------------------------------------------------------

@query("field_direct", f"""WITH {CONTENT}
SELECT ID, ClassName, text AS Document_text, lang AS Document_lang, n_chars AS Document_n_chars
FROM content""")
def field_direct(spark: SparkSession, sf: str) -> DataFrame:
    spec = IndexSpec(tree(spark, sf, "Content", "Document", "Page")).add_class("Content")
    spec.add_fulltext_field("text").add_filter_field("lang").add_sort_field("n_chars")
    return D.build_documents(spec).select(
        "ID", "ClassName", "Document_text", "Document_lang", "Document_n_chars"
    )


@query("field_computed", """SELECT p_partkey AS ID,
  upper(p_brand) || ' ' || p_name AS Part_Label, p_retailprice * p_size AS Part_Worth FROM part""")
def field_computed(spark: SparkSession, sf: str) -> DataFrame:
    from dataclasses import replace
    classes = tree(spark, sf, "Part", "Party", "Supplier", "Nation")
    classes.classes["Part"] = replace(classes.classes["Part"], computed={
        "Label": lambda: F.concat_ws(" ", F.upper("p_brand"), F.col("p_name")),
        "Worth": lambda: F.col("p_retailprice") * F.col("p_size"),
    })
    spec = IndexSpec(classes).add_class("Part")
    spec.add_fulltext_field("Label").add_filter_field("Worth", "Double")
    return D.build_documents(spec).select("ID", "Part_Label", "Part_Worth")


@query("field_has_one", """SELECT o_orderkey AS ID, c_name AS Order_Customer_c_name,
  c_mktsegment AS Order_Customer_c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def field_has_one(spark: SparkSession, sf: str) -> DataFrame:
    spec = IndexSpec(tree(spark, sf, "Order", "Party", "Customer", "Nation")).add_class("Order")
    spec.add_fulltext_field("Customer.c_name").add_filter_field("Customer.c_mktsegment")
    return D.build_documents(spec).select(
        "ID", "Order_Customer_c_name", "Order_Customer_c_mktsegment"
    )


@query("field_has_many", """SELECT c_custkey AS ID, 'Customer_Orders_o_orderpriority' AS field,
  o_orderkey AS value_id, o_orderpriority AS value
FROM customer JOIN orders ON o_custkey = c_custkey""")
def field_has_many(spark: SparkSession, sf: str) -> DataFrame:
    spec = IndexSpec(tree(spark, sf, "Party", "Customer", "Nation", "Order")).add_class("Customer")
    spec.add_fulltext_field("Orders.o_orderpriority")
    return D.build_values(spec).select("ID", "field", "value_id", "value")


@query("field_many_many", """SELECT p_partkey AS ID, 'Part_Suppliers_s_name' AS field,
  s_suppkey AS value_id, s_name AS value
FROM part JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey""")
def field_many_many(spark: SparkSession, sf: str) -> DataFrame:
    spec = IndexSpec(tree(spark, sf, "Part", "Party", "Supplier", "Nation")).add_class("Part")
    spec.add_fulltext_field("Suppliers.s_name")
    return D.build_values(spec).select("ID", "field", "value_id", "value")


@query("field_multi_hop", """SELECT c_custkey AS ID, 'single' AS kind, r_regionkey AS value_id, r_name AS value
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT p_partkey, 'many', n_nationkey, n_name
FROM part JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def field_multi_hop(spark: SparkSession, sf: str) -> DataFrame:
    """Two steps of has_one, and a many step followed by a has_one (duplicates kept)."""
    classes = tree(spark, sf, "Part", "Party", "Supplier", "Customer", "Order", "Nation", "Region")
    single = IndexSpec(classes).add_class("Customer")
    single.add_fulltext_field("Nation.Region.r_name").add_filter_field("Nation.Region.ID", "Int")
    many = IndexSpec(classes).add_class("Part").add_fulltext_field("Suppliers.Nation.n_name")
    one = D.build_documents(single).select(
        "ID", F.lit("single").alias("kind"),
        F.col("Customer_Nation_Region_ID").cast("int").alias("value_id"),
        F.col("Customer_Nation_Region_r_name").alias("value"),
    )
    rest = D.build_values(many).select("ID", F.lit("many").alias("kind"), "value_id", "value")
    return one.unionByName(rest)


@query("field_ambiguous_origin", """
SELECT c_custkey AS ID, 'Customer' AS ClassName, n_name AS Customer_Nation_n_name,
  NULL AS Supplier_Nation_n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT s_suppkey, 'Supplier', NULL, n_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def field_ambiguous_origin(spark: SparkSession, sf: str) -> DataFrame:
    """The same relation name on two classes: one field per origin."""
    classes = tree(spark, sf, "Party", "Customer", "Supplier", "Order", "Nation", "Region")
    spec = IndexSpec(classes).add_class("Party").add_fulltext_field("Nation.n_name")
    return D.build_documents(spec).select(
        "ID", "ClassName", "Customer_Nation_n_name", "Supplier_Nation_n_name"
    )


@query("field_all_text", f"""WITH {CONTENT}
SELECT ID, text AS Document_text, lang AS Document_lang, source AS Document_source,
  url AS Page_url, html AS Page_html FROM content""")
def field_all_text(spark: SparkSession, sf: str) -> DataFrame:
    spec = IndexSpec(tree(spark, sf, "Content", "Document", "Page")).add_class("Content")
    spec.add_all_fulltext_fields()
    return D.build_documents(spec).select("ID", *sorted(spec.fulltext))


@query("field_cast", """SELECT o_orderkey AS ID, CAST(o_totalprice AS FLOAT) AS Order_o_totalprice,
  try_cast(split_part(o_orderpriority, '-', 1) AS BIGINT) AS Order_Rank,
  CAST(o_orderkey AS VARCHAR) AS Order_Code, o_orderstatus = 'F' AS Order_Done,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS Order_o_orderdate FROM orders""")
def field_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Declared types and forced ones: float, integer, string, boolean and date."""
    from dataclasses import replace
    classes = tree(spark, sf, "Order", "Party", "Customer", "Nation")
    classes.classes["Order"] = replace(classes.classes["Order"], computed={
        "Rank": lambda: F.substring_index("o_orderpriority", "-", 1),
        "Code": lambda: F.col("ID"),
        "Done": lambda: (F.col("o_orderstatus") == "F").cast("string"),
    })
    spec = IndexSpec(classes).add_class("Order")
    spec.add_filter_field("o_totalprice", "Float").add_filter_field("Rank", "Int")
    spec.add_filter_field("Code", "Varchar").add_filter_field("Done", "Boolean")
    spec.add_filter_field("o_orderdate")
    return D.build_documents(spec).select(
        "ID", "Order_o_totalprice", "Order_Rank", "Order_Code", "Order_Done",
        V.display_date(F.col("Order_o_orderdate")).alias("Order_o_orderdate"),
    )


@query("field_date_norm", """SELECT event_id, strftime(d, '%Y-%m-%dT%H:%M:%SZ') AS happened FROM (
  SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN date_trunc('day', ts)
    ELSE ts END AS d FROM events) AS x""")
def field_date_norm(spark: SparkSession, sf: str) -> DataFrame:
    """Dates as text in several spellings, empty for errors."""
    text = (
        F.when(F.col("event_type") == "error", F.lit(""))
        .when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd"))
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return read(spark, sf, "events").select(
        "event_id", V.display_date(V.convert(text, "tdate")).alias("happened")
    )


@query("field_numeric_valid", """SELECT event_id,
  try_cast(CASE event_type WHEN 'view' THEN CAST(value AS VARCHAR) || ' s'
    WHEN 'signup' THEN '' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value,
  CASE WHEN event_type = 'view' THEN 1 ELSE 2 END AS n_valid FROM events""")
def field_numeric_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Values that are not numbers are absent, element-wise in lists."""
    text = (
        F.when(F.col("event_type") == "view", F.concat(F.col("value").cast("string"), F.lit(" s")))
        .when(F.col("event_type") == "signup", F.lit("")).otherwise(F.col("value").cast("string"))
    )
    second = F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(F.lit("7"))
    return read(spark, sf, "events").select(
        "event_id", V.convert(text, "tdouble").alias("value"),
        F.size(V.convert_all(F.array(F.lit("1"), second), "tint")).alias("n_valid"),
    )


@query("field_null_absent", f"""WITH {CONTENT}
SELECT ClassName, count(text) AS with_text, count(html) AS with_html, count(quality) AS with_quality,
  count(*) AS n FROM content GROUP BY 1""")
def field_null_absent(spark: SparkSession, sf: str) -> DataFrame:
    spec = content_spec(spark, sf).add_filter_field("quality")
    docs = D.build_documents(spec)
    return docs.groupBy("ClassName").agg(
        F.count("Document_text").alias("with_text"), F.count("Page_html").alias("with_html"),
        F.count("Document_quality").alias("with_quality"), F.count("*").alias("n"),
    )


@query("field_origin_guard", """
SELECT c_custkey AS ID, 'Customer' AS ClassName, c_acctbal AS customer_only, c_acctbal AS either_party FROM customer
UNION ALL SELECT s_suppkey, 'Supplier', NULL, s_acctbal FROM supplier""")
def field_origin_guard(spark: SparkSession, sf: str) -> DataFrame:
    rows = tree(spark, sf, "Party", "Customer", "Supplier", "Nation", "Order").rows("Party")
    balance = F.coalesce("c_acctbal", "s_acctbal")
    return rows.select(
        "ID", "ClassName", F.when(class_is("Customer"), balance).alias("customer_only"),
        F.when(class_is("Customer", "Supplier"), balance).alias("either_party"),
    )


@query("field_error_null", """SELECT event_id,
  try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k,
  CASE WHEN event_type = 'error' THEN NULL ELSE value / 2 END AS half FROM events""")
def field_error_null(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup that fails gives null; the document is kept."""
    divisor = F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.lit(2))
    return read(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        F.try_divide("value", divisor).alias("half"),
    )


ERRORS_SQL = """failed AS (
  SELECT o_orderkey || '-Order-[]' AS _documentid, 'Order_o_orderpriority' AS field, o_orderpriority AS raw, 'not a tint' AS reason
  FROM orders WHERE o_orderpriority IS NOT NULL AND try_cast(o_orderpriority AS BIGINT) IS NULL
  UNION ALL SELECT o_orderkey || '-Order-[]', 'Order_Customer_c_mktsegment', c_mktsegment, 'not a tdouble'
  FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment IS NOT NULL AND try_cast(c_mktsegment AS DOUBLE) IS NULL)"""


@query("field_errors", f"""WITH {ERRORS_SQL}
SELECT *, (SELECT count(*) FROM failed) AS n_errors, (SELECT count(*) FROM orders) AS n_documents FROM failed""")
def field_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Values that no conversion reads, beside the documents that go on without them, counted by the same pass."""
    spec = IndexSpec(tree(spark, sf, "Party", "Customer", "Order", "Nation", "Region", "Supplier")).add_class("Order")
    spec.add_filter_field("o_orderpriority", "Int").add_filter_field("o_totalprice", "Double")
    spec.add_filter_field("Customer.c_mktsegment", "Double").add_filter_field("Customer.c_acctbal", "Double")
    checked = D.write_checked(D.build_documents(spec, errors=True), f"{scratch_folder(spark, 'checked')}/documents")
    return checked.errors.withColumns({"n_errors": F.lit(checked.n_errors).cast("long"), "n_documents": F.lit(checked.n_documents).cast("long")})


# Documents ------------------------------------------------------------------

@query("doc_build", f"""WITH {STATED}
SELECT _documentid, ID, ClassName,
  ['Content', ClassName] AS ClassHierarchy, 'Content' AS base, _versionedstage, _subsite,
  text AS Document_text, html AS Page_html, lang AS Document_lang, source AS Document_source,
  n_chars AS Document_n_chars
FROM keyed WHERE quality IS NULL OR quality = 1""")
def doc_build(spark: SparkSession, sf: str) -> DataFrame:
    gate = F.coalesce(show_in_search(), F.lit(True))
    docs = D.build_documents(content_spec(spark, sf), [stage_variant(), site_variant()], gate)
    return docs.drop("state")


@query("doc_id", f"WITH {STATED} SELECT _documentid FROM keyed")
def doc_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.build_documents(content_spec(spark, sf), [stage_variant(), site_variant()])
    return docs.select("_documentid")


@query("copy_default", f"""WITH {CONTENT}
SELECT ID, '_text' AS dest, 'Document_text' AS source, text AS value FROM content WHERE text IS NOT NULL
UNION ALL SELECT ID, '_text', 'Page_html', html FROM content WHERE html IS NOT NULL""")
def copy_default(spark: SparkSession, sf: str) -> DataFrame:
    spec = content_spec(spark, sf)
    return D.copied(D.build_documents(spec), spec.copy_pairs(), "ID")


@query("copy_explicit", f"""WITH {CONTENT}
SELECT ID, 'spellcheckData' AS dest, 'Document_text' AS source, text AS value FROM content WHERE text IS NOT NULL
UNION ALL SELECT ID, 'spellcheckData', 'Page_html', html FROM content WHERE html IS NOT NULL
UNION ALL SELECT ID, 'everything', 'Page_html', html FROM content WHERE html IS NOT NULL""")
def copy_explicit(spark: SparkSession, sf: str) -> DataFrame:
    spec = content_spec(spark, sf)
    spec.add_copy_field("Document_text", "spellcheckData")
    spec.add_copy_field("Page_html", "spellcheckData").add_copy_field("Page_html", "everything")
    return D.copied(D.build_documents(spec), spec.copies, "ID")


@query("stored_projection", f"""WITH {STATED}
SELECT _documentid, ID, ClassName, ['Content', ClassName] AS ClassHierarchy, 'Content' AS base,
  _documentid[length(ID || '-Content-') + 1:] AS state, html AS Page_html FROM keyed""")
def stored_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Only fields declared as stored come back."""
    spec = content_spec(spark, sf)
    return D.stored(D.build_documents(spec, [stage_variant(), site_variant()]), spec)


@query("variant_columns", f"""WITH {STATED}
SELECT ID, ClassName, _versionedstage, CAST(_subsite AS INTEGER) AS _subsite FROM keyed""")
def variant_columns(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.build_documents(content_spec(spark, sf), [stage_variant(), site_variant()])
    return docs.select("ID", "ClassName", STAGE, F.col(SUBSITE).cast("int").alias(SUBSITE))


# Sinks ----------------------------------------------------------------------

LOG = """log AS (
  SELECT event_id AS seq, user_id || '-Party-[]' AS _documentid, event_type, value,
    CASE event_type WHEN 'error' THEN 'delete' ELSE 'upsert' END AS op FROM events)"""


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.lit("Party"), state_json([])).alias("_documentid"),
        "event_type", "value",
        F.when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("upsert")).alias("op"),
    )


@query("index_upsert", f"""WITH {LOG}
SELECT 'last wins' AS mode, seq, _documentid, event_type, value, op FROM (
  SELECT *, row_number() OVER (PARTITION BY _documentid ORDER BY seq DESC) AS r FROM log) AS x
WHERE r = 1 AND op <> 'delete'
UNION ALL SELECT 'duplicates', seq, _documentid, event_type, value, op FROM log WHERE op <> 'delete'""")
def index_upsert(spark: SparkSession, sf: str) -> DataFrame:
    log = event_log(spark, sf)
    last = store.latest(log).withColumn("mode", F.lit("last wins"))
    return last.unionByName(
        store.latest(log, allow_duplicates=True).withColumn("mode", F.lit("duplicates"))
    )


@query("index_delete_by_id", f"""WITH {STATED}
SELECT _documentid FROM keyed WHERE NOT (ClassName = 'Document' AND _versionedstage = 'Live'
  AND coalesce(toxic, 0) = 1)""")
def index_delete_by_id(spark: SparkSession, sf: str) -> DataFrame:
    """Drop the live document of everything labelled toxic; the draft stays."""
    docs = D.build_documents(
        content_spec(spark, sf), [stage_variant(), site_variant()], keep=["toxic"]
    )
    gone = docs.where((F.col(STAGE) == LIVE) & (F.col("toxic") == 1)).select("_documentid")
    return store.delete_ids(docs, gone).select("_documentid")


@query("index_delete_by_query", f"""WITH {STATED}
SELECT _documentid FROM keyed WHERE NOT coalesce(lang = 'fr' AND n_chars > 1000, false)""")
def index_delete_by_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.build_documents(content_spec(spark, sf), [stage_variant(), site_variant()])
    predicate = (F.col("Document_lang") == "fr") & (F.col("Document_n_chars") > 1000)
    return store.delete_where(docs, predicate).select("_documentid")
