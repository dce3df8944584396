"""Ordering, paging, counting, pinning and hydrating hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

DEFAULT_PAGE = 10
GROUP_LIMIT = 1000


def ranked(hits: DataFrame, order: Sequence[Column], first: int, last: int,
           key: str = "query_id") -> DataFrame:
    """Rows ``first..last`` (1-based) of every query, with their ``rank``.

    Spark cuts each input partition to ``last`` rows per query before the shuffle
    as long as ``last`` is within its group limit. Deeper pages do the same by
    hand over a salt, so a query that hits a third of all documents never brings
    them into one task.
    """
    if last > GROUP_LIMIT:
        salted = Window.partitionBy(key, "__salt").orderBy(*order)
        hits = (
            hits.withColumn("__salt", F.pmod(F.xxhash64("doc_id"), F.lit(256)))
            .withColumn("__r", F.row_number().over(salted))
            .where(F.col("__r") <= last).drop("__salt", "__r")
        )
    w = Window.partitionBy(key).orderBy(*order)
    top = hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= last)
    return top.where(F.col("rank") >= first) if first > 1 else top


def by_score() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc()]


def page_bounds(start: int = 0, limit: int = -1, offset: int = -1, length: int = -1) -> tuple[int, int]:
    """First and last rank of a page; -1 falls back to the query, then to ten rows."""
    offset = start if offset == -1 else offset
    length = limit if length == -1 else length
    length = DEFAULT_PAGE if length == -1 else length
    return offset + 1, offset + length


def page(hits: DataFrame, start: int = 0, limit: int = -1, offset: int = -1,
         length: int = -1, order: Sequence[Column] | None = None) -> DataFrame:
    first, last = page_bounds(start, limit, offset, length)
    return ranked(hits, order or by_score(), first, last)


def num_found(hits: DataFrame, queries: Sequence[str] | None = None) -> DataFrame:
    """Hits of each query; with ``queries`` also the zero of those without any."""
    counts = hits.groupBy("query_id").agg(F.count("*").alias("num_found"))
    if queries is None:
        return counts
    rows = hits.sparkSession.createDataFrame([(q,) for q in queries], "query_id string")
    return rows.join(counts, "query_id", "left").select(
        "query_id", F.coalesce("num_found", F.lit(0)).alias("num_found"))


def sort_key(name: str, descending: bool = False) -> Column:
    """Documents without the field come last in either direction."""
    column = F.col(name)
    return column.desc_nulls_last() if descending else column.asc_nulls_last()


def random_key(seed: str) -> Column:
    """A pseudo-random order that is stable for a seed."""
    return F.md5(F.concat_ws(":", F.col("doc_id"), F.lit(seed)).cast("binary"))


def alpha_key(value: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(value)), "[^a-z]", "")


def elevate(hits: DataFrame, documents: DataFrame, rules: DataFrame, queries: DataFrame) -> DataFrame:
    """Pin listed documents of an exact query text on top and drop excluded ones.

    ``rules``: ``text, doc_id, excluded, pin`` (pin order). Pinned documents appear
    even when they do not match; sort by ``pin`` with nulls last, then by score.
    """
    matched = queries.select("query_id", F.trim("text").alias("text")).join(rules, "text")
    pins = (
        matched.where(~F.col("excluded")).join(documents.select("doc_id"), "doc_id")
        .select("query_id", "doc_id", "pin")
    )
    dropped = matched.where(F.col("excluded")).select("query_id", "doc_id")
    both = hits.join(pins, ["query_id", "doc_id"], "full_outer")
    return (
        both.withColumn("score", F.coalesce("score", F.lit(0.0)))
        .join(dropped, ["query_id", "doc_id"], "left_anti")
    )


def by_elevation() -> list[Column]:
    return [F.col("pin").asc_nulls_last(), *by_score()]


def hydrate(hits: DataFrame, source: DataFrame, keys: Sequence[str] = ("ClassName", "ID")) -> DataFrame:
    """Live rows of the hits; hits whose row has vanished are dropped."""
    return hits.join(source, list(keys))
