"""Near-duplicate documents by SimHash, found with multi-index hashing.

A 64-bit fingerprint has a bit set if over half the hashes of a text's 3-word shingles have it.
Equal fingerprints are taken together first, so a group of copies is one fingerprint however large
it is. Of two fingerprints at most 3 bits apart, one 32-bit half is at most 1 bit apart: each
fingerprint enumerates the 33 values within that ball in both halves, meets the fingerprints that
have such a half, and the complete distance is verified. Links are joined into groups by
alternating star operations on the edge list, each round of which is written out.

Null texts are empty; a text without words has fingerprint zero, which links like any other. Rows
without an id take part in no link and have no component. Rows with equal ids are one document for
the components, each row keeps its own fingerprint. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from trawl.llm.common import add_columns, saved
from trawl.operators.sizing import unless_few

SEED = 42
NEAR = 3
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACES = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: bytes) -> int:
    words = text.lower().split()  # of bytes: A-Z alone, and white space of one byte
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < 3 else map(b" ".join, zip(words, words[1:], words[2:]))
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED))), np.uint8).reshape(-1, 8)
    if len(hashes) < 256:
        counts = np.unpackbits(hashes, axis=1).sum(0, dtype=np.int64)
    else:
        each = np.bincount((hashes + _PLACES).ravel(), minlength=2048).reshape(8, 256)
        counts = (each @ _BITS).ravel()
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big", signed=True)


def with_fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint",
                      drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with each text's fingerprint, a signed 64-bit integer."""
    def start():
        def step(texts: pa.Array):
            return [pa.array([fingerprint(t or b"") for t in texts.cast(pa.binary()).to_pylist()], pa.int64())]
        return step

    return add_columns(docs, [T.StructField(out_col, T.LongType())], [text_col], start, drop)


def links(nodes: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of ids whose fingerprints differ in 1 to ``NEAR`` bits. ``nodes`` has distinct
    fingerprints ``fp`` with an ``id`` each. A pair that both halves find counts in the first.
    Spark sizes a side without its explode, which makes 66 rows of a node, so neither may be broadcast."""
    high = F.shiftrightunsigned("fp", 32)
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    half = 2**32
    tables = nodes.select("fp", "id", F.explode(F.array(high, low + half)).alias("key"))
    ball = F.array(*[F.lit(x) for x in [0, *(1 << b for b in range(32))]])
    near = F.concat(F.transform(ball, lambda x: high.bitwiseXOR(x)),
                    F.transform(ball, lambda x: low.bitwiseXOR(x) + half))
    probes = nodes.select(F.col("fp").alias("fp2"), F.col("id").alias("id2"), F.explode(near).alias("key"))
    apart = F.col("fp").bitwiseXOR(F.col("fp2"))
    first_half = F.bit_count(F.shiftrightunsigned(apart, 32))
    found = tables.join(probes.hint("merge"), (tables["key"] == probes["key"]) & (F.col("fp") < F.col("fp2"))
                        & (F.bit_count(apart) <= NEAR)
                        & ((tables["key"] < half) | (first_half > 1)))
    return found.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``root``, the least id reachable, of all ids in ``edges`` (``a < b``).

    A large star links all larger neighbours of an id to its least neighbour, a small star the
    smaller ones and the id itself. Least neighbours are aggregated and joined back, so no id's
    neighbours are gathered in one place."""
    edges = saved(edges.where("a < b").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(unless_few(least, edges), "a").select(F.col("m").alias("a"), "b")
        large = saved(large.where("a < b").distinct(), "edges")
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(unless_few(least, large), "b")
        small = joined.select(F.col("m").alias("x"), F.col("a").alias("y")).union(joined.select(F.col("m").alias("x"), F.col("b").alias("y")))
        edges = saved(small.where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("b").alias("id"), F.col("a").alias("root"))
        seen = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (signed 64-bit integer) and ``component_id``, the least id that links
    reach from the row, of every row."""
    marked = saved(with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")), "t", drop=("t",)), "fingerprints")
    nodes = saved(marked.where("doc_id IS NOT NULL").groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("id")), "nodes")
    roots = components(links(nodes))
    groups = nodes.join(unless_few(roots, roots), "id", "left").select(
        F.col("fp").alias("fingerprint"), F.coalesce("root", "id").alias("component_id"))
    return marked.join(groups, "fingerprint", "left").select(
        "doc_id", "fingerprint", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but for those of documents that aren't the first of their component."""
    later = near_duplicates(docs, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("__later"))
    return docs.join(later, docs[id_col] == F.col("__later"), "left_anti")
