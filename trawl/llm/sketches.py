"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the sorted array of the k least 64-bit hashes of a text's distinct shingles of five
words; a text of fewer words, but not none, is one shingle. Sketches of parts merge into that of
the whole, and estimate resemblance, containment and the number of distinct shingles. All is made
of built-in functions on array columns.

Null and empty texts, and texts without words, have empty sketches; two of these resemble each other
fully. Null ids come first, rows with equal ids are ordered by text. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trawl.llm.common import range_parts

K = 128
SHINGLE = 5
PARTS = 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, "[\\x20\\x09-\\x0D]+"), "")


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    def hashes(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(w) - shingle + 1), lambda i: F.xxhash64(F.slice(w, i, shingle)))
        return (F.when(F.size(w) >= shingle, many).when(F.size(w) > 0, F.array(F.xxhash64(w)))
                .otherwise(F.array().cast("array<bigint>")))

    # the words are bound to a name, so that they are split once
    found = F.transform(F.array(words(text)), hashes)[0]
    return F.slice(F.array_sort(F.array_distinct(found)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The share of common shingles among all, by the k least hashes of both."""
    def share(both: Column) -> Column:
        common = F.size(F.array_intersect(both, F.array_intersect(a, b)))
        return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))

    return F.transform(F.array(merge(a, b, k)), share)[0]


def distinct_shingles(a: Column, k: int = K) -> Column:
    """How many distinct shingles the text has: exact below k, else from the k-th least hash."""
    share = (F.get(a, k - 1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The share of a's shingles that b has; 1 for an empty a."""
    common = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def to_string(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def edited_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = PARTS) -> DataFrame:
    """``doc_id``, ``n_chars``, ``sketch``, ``next_sketch``, and ``edited``: the text with its last
    ``n_chars div 2`` code points replaced by the first as many of the next document's, in the
    order of ids and from the last to the first.

    One shuffle puts contiguous parts together; the next row of a part's last row is the first
    of the next part, of which there are a bounded number."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("part", range_parts(rows, "doc_id", parts))
    first = F.min(F.struct("doc_id", "text"))["text"]
    firsts = rows.groupBy("part").agg(first.alias("text"))
    by_part = Window.orderBy("part")
    following = firsts.select("part", F.coalesce(
        F.lead("text").over(by_part), F.first("text").over(by_part)).alias("border"))
    following = following.withColumn("border_sketch", sketch(F.col("border")))
    inside = Window.partitionBy("part").orderBy("doc_id", "text")
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    return rows.repartition("part").withColumn("sketch", sketch(F.col("text"))).select(
        "*", F.lead("text").over(inside).alias("next"), F.lead("sketch").over(inside).alias("next_sketch"),
    ).join(following, "part").select(
        "doc_id", "text", n.cast("long").alias("n_chars"), "sketch",
        F.coalesce("next_sketch", "border_sketch").alias("next_sketch"),
        F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next", "border"), F.lit(1), half)).alias("edited"))
