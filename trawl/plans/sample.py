"""The given tables as classes, relations and index texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trawl.operators import postings as P
from trawl.operators.spec import IndexSpec
from trawl.operators.store import TextIndex, build
from trawl.operators.variants import DRAFT, LIVE, STAGE, SUBSITE, Variant
from trawl.sources.classes import ClassDef, ClassTree, has_many, has_one, many_many

# One site per language; '0' is the main site.
SITES = ("de", "en", "es", "fr")
PUBLISHED_FROM = 400


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def document_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels; even IDs, so pages can share the ID space."""
    labels = read(spark, sf, "labels")
    return (
        read(spark, sf, "documents").join(labels, "doc_id", "left")
        .select((F.col("doc_id") * 2).alias("ID"), "text", "lang", "source", "n_chars",
                "quality", "toxic")
    )


def page_rows(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select((F.col("page_id") * 2 + 1).alias("ID"), "url", "html")


def site_of(lang: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SITES)), lang).cast("string")


def definitions(spark: SparkSession, sf: str) -> dict[str, callable]:
    def named(table: str, key: str):
        return read(spark, sf, table).withColumnRenamed(key, "ID")

    return {
        "Content": lambda: ClassDef("Content"),
        "Document": lambda: ClassDef("Document", document_rows(spark, sf), "Content"),
        "Page": lambda: ClassDef("Page", page_rows(spark, sf), "Content", types={"html": "HTMLText"}),
        "Item": lambda: ClassDef("Item", named("benchmark", "item_id")),
        "Conversation": lambda: ClassDef(
            "Conversation",
            read(spark, sf, "conversations").select(F.col("conv_id").alias("ID")).distinct(),
            relations=(has_many("Turns", "Turn", "ConversationID"),),
        ),
        "Turn": lambda: ClassDef(
            "Turn",
            read(spark, sf, "conversations").select(
                (F.col("conv_id") * 1000 + F.col("turn")).alias("ID"),
                F.col("conv_id").alias("ConversationID"), "turn", "role", "text",
            ),
            relations=(has_one("Conversation", "Conversation", "ConversationID"),),
        ),
        "Region": lambda: ClassDef("Region", named("region", "r_regionkey")),
        "Nation": lambda: ClassDef(
            "Nation", named("nation", "n_nationkey"),
            relations=(has_one("Region", "Region", "n_regionkey"),),
        ),
        "Party": lambda: ClassDef("Party"),
        "Customer": lambda: ClassDef(
            "Customer", named("customer", "c_custkey"), "Party",
            relations=(has_one("Nation", "Nation", "c_nationkey"),
                       has_many("Orders", "Order", "o_custkey")),
        ),
        "Supplier": lambda: ClassDef(
            "Supplier", named("supplier", "s_suppkey"), "Party",
            relations=(has_one("Nation", "Nation", "s_nationkey"),),
        ),
        "Order": lambda: ClassDef(
            "Order", named("orders", "o_orderkey"),
            relations=(has_one("Customer", "Customer", "o_custkey"),),
        ),
        "Part": lambda: ClassDef(
            "Part", named("part", "p_partkey"),
            relations=(many_many("Suppliers", "Supplier", read(spark, sf, "lineitem"),
                                 "l_partkey", "l_suppkey"),),
        ),
    }


def tree(spark: SparkSession, sf: str, *names: str) -> ClassTree:
    known = definitions(spark, sf)
    return ClassTree(known[n]() for n in names)


def stage_variant() -> Variant:
    """Every document has a draft; those of some length are live too."""
    live = F.coalesce(F.col("n_chars") >= PUBLISHED_FROM, F.lit(False))
    return Variant(STAGE, (DRAFT, LIVE), ("Document",), lambda s: (s == DRAFT) | live)


def site_variant() -> Variant:
    """A document belongs to the site of its language."""
    sites = tuple(str(i) for i in range(len(SITES) + 1))
    return Variant(SUBSITE, sites, ("Document",), lambda s: s == site_of(F.col("lang")))


def content_spec(spark: SparkSession, sf: str) -> IndexSpec:
    spec = IndexSpec(tree(spark, sf, "Content", "Document", "Page"))
    spec.add_class("Content")
    spec.add_fulltext_field("text").add_stored_field("html")
    spec.add_filter_field("lang").add_filter_field("source").add_sort_field("n_chars")
    return spec


def show_in_search() -> Column:
    return F.col("quality") == 1


def anyone_can_view() -> Column:
    return F.coalesce(F.col("toxic"), F.lit(0)) == 0


# Text indexes ---------------------------------------------------------------

def document_index(spark: SparkSession, sf: str) -> TextIndex:
    """Documents only; the text is the default field."""
    documents = read(spark, sf, "documents")
    text = P.TextSource("_text", documents.select("doc_id", "text"))
    return build(documents.drop("text"), [text])


def content_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and pages in one table, keyed by their shared ID."""
    docs = read(spark, sf, "documents").select(
        (F.col("doc_id") * 2).alias("doc_id"), F.lit("Document").alias("ClassName"),
        "text", "lang", "source", "n_chars",
    )
    pages = page_rows(spark, sf).select(
        F.col("ID").alias("doc_id"), F.lit("Page").alias("ClassName"), "url", "html"
    )
    return docs.unionByName(pages, allowMissingColumns=True)


def content_index(spark: SparkSession, sf: str) -> TextIndex:
    """Documents and pages: a field of each, both copied to the default field."""
    docs = read(spark, sf, "documents").select((F.col("doc_id") * 2).alias("doc_id"), "text")
    pages = page_rows(spark, sf).select(F.col("ID").alias("doc_id"), F.col("html").alias("text"))
    sources = [
        P.TextSource("Document_text", docs), P.TextSource("Page_html", pages, "htmltext"),
        P.TextSource("_text", docs, "htmltext", source="Document_text"),
        P.TextSource("_text", pages, "htmltext", source="Page_html"),
    ]
    return build(content_documents(spark, sf).drop("text", "html"), sources)
