"""Rule files: stop words, protected words, synonyms and pinning rules.

The lists configure analyzers, so they end up as literals in plans; they are
files a person edits, and reading one is refused beyond a fixed number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trawl.functions import rules

MAX_RULES = 100_000


def _lines(spark: SparkSession, path: str) -> list[str]:
    rows = (
        spark.read.text(path).select(F.trim("value").alias("value"))
        .where((F.col("value") != "") & ~F.col("value").startswith("#"))
        .limit(MAX_RULES + 1).collect()
    )
    if len(rows) > MAX_RULES:
        raise ValueError(f"{path} has more than {MAX_RULES} rules")
    return [r.value for r in rows]


def read_words(spark: SparkSession, path: str) -> list[str]:
    """Stop words or protected words, one per line."""
    return _lines(spark, path)


def read_synonyms(spark: SparkSession, path: str) -> str:
    """Synonym rules as text for ``analysis.synonyms``."""
    return "\n".join(_lines(spark, path))


def read_elevation(spark: SparkSession, path: str) -> DataFrame:
    """``text, doc_id, excluded, pin`` from a pinning file in XML."""
    schema = (
        "_text string, doc array<struct<_id: string, _exclude: boolean>>"
    )
    rows = spark.read.format("xml").option("rowTag", "query").schema(schema).load(path)
    return rows.select(F.col("_text").alias("text"), F.posexplode("doc").alias("pin", "d")).select(
        "text", F.col("d._id").alias("doc_id"),
        F.coalesce("d._exclude", F.lit(False)).alias("excluded"), "pin",
    )


def default_elevation(spark: SparkSession) -> DataFrame:
    rows = [(t, d, x, i) for i, (t, d, x) in enumerate(rules.ELEVATION)]
    return spark.createDataFrame(rows, "text string, doc_id string, excluded boolean, pin int")
