"""Contiguous shards of about equal bytes: prefix sums over parts of the table.

Rows are ordered by document id. Each of many contiguous parts sums its own sizes; the parts'
totals, a bounded number of rows, are summed before them. A row goes to the shard in whose equal
share of all bytes its middle byte lies, so a shard misses its share by at most one row at each
end.

A null text has no bytes, but each row counts the overhead. Null ids come first; rows with equal ids
are ordered by checksum and size, after which they are alike. Empty tables give no rows. With fewer
rows than shards some shards stay empty. Other columns aren't kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from trawl.llm.common import range_parts, saved

SHARDS = 40
OVERHEAD = 16
#: Parts whose totals are summed in one place.
PARTS = 512


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
          overhead: int = OVERHEAD, parts: int = PARTS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` (the row's place in its shard)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = saved(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32")), "sizes")
    inside = Window.partitionBy("part").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("part", range_parts(rows, "doc_id", parts)).select(
        "*", F.sum("size").over(inside).alias("bytes"), F.count("*").over(inside).alias("rows"))
    summed = saved(summed, "summed")
    totals = summed.groupBy("part").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    begins = totals.select(
        "part", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("b0"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.sum("b").over(everything).alias("all"))
    placed = summed.join(F.broadcast(begins), "part").select(
        "doc_id", "size", "text_crc32", (F.col("n0") + F.col("rows") - 1).alias("row"),
        F.least(F.expr(f"({shards} * (2 * (b0 + bytes) - size)) div (2 * `all`)"), F.lit(shards - 1)).cast("int").alias("shard"))
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))
