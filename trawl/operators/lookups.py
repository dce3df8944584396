"""Lookup tables of a vocabulary: pieces of terms for edit distance, rotations for wildcards.

Both are published with an index, so that a word is looked up in few files and row groups
instead of cutting the whole vocabulary into pieces for each search. Candidates are always verified.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from trawl.operators.sizing import checked_broadcast

MAX_EDITS = 2
BUCKETS = 16
#: Up to so many keys are written into a lookup as literals, which prune files and row groups.
LITERAL_KEYS = 1000
#: Up to so many rotations are looked up by their whole beginnings, more by their first characters.
LITERAL_BEGINNINGS = 50
HEAD = 2
#: Ends a term in its rotations; no term has it.
END = "\u0003"


def hashed(text: Column) -> Column:
    return F.pmod(F.crc32(text.cast("binary")), F.lit(BUCKETS)).cast("int")


def _hash(text: str) -> int:
    return zlib.crc32(text.encode()) % BUCKETS


# Pieces ---------------------------------------------------------------------

def segments(term: Column) -> Column:
    """A word cut into ``MAX_EDITS + 1`` pieces as (number, start, text)."""
    n = F.length(term)
    k = MAX_EDITS + 1
    size = F.floor(n / k)
    cuts = []
    for i in range(k):
        # the last pieces take the remainder of the division
        short = F.lit(k) - n % k
        start = F.when(F.lit(i) <= short, size * i).otherwise(size * i + (F.lit(i) - short))
        length = size + F.when(F.lit(i) >= short, 1).otherwise(0)
        cuts.append(F.struct(
            F.lit(i).alias("piece"), start.cast("int").alias("start"),
            length.cast("int").alias("length"),
        ))
    return F.array(*cuts)


def pieces(vocab: DataFrame) -> DataFrame:
    """``field, term, key``: a row for each piece of a term, under its length, number and text."""
    cut = vocab.select("field", "term", F.explode(segments(F.col("term"))).alias("s"))
    text = F.expr("substring(term, s.start + 1, s.length)")
    return cut.select("field", "term", F.concat_ws("/", F.length("term"), F.col("s.piece"), text).alias("key"))


def probes(wanted: DataFrame) -> DataFrame:
    """``field, word, key``: pieces that a term within ``MAX_EDITS`` edits of the word may have.

    Two words within k edits share one of the k+1 pieces of either, shifted by at
    most k characters (the pass-join property).
    """
    return (
        wanted.select("field", F.col("term").alias("word")).distinct()
        .select("*", F.explode(F.sequence(
            F.greatest(F.length("word") - MAX_EDITS, F.lit(1)), F.length("word") + MAX_EDITS
        )).alias("len"))
        .select("*", F.explode(segments(F.rpad(F.lit(""), F.col("len"), F.lit("x")))).alias("s"))
        .select("*", F.explode(F.sequence(
            F.greatest(F.col("s.start") - MAX_EDITS, F.lit(0)), F.col("s.start") + MAX_EDITS
        )).alias("at"))
        .where("at + s.length <= length(word)")
        .select("field", "word", F.concat_ws(
            "/", "len", F.col("s.piece"), F.expr("substring(word, at + 1, s.length)")).alias("key"))
        .distinct()
    )


def near(wanted: DataFrame, table: DataFrame) -> DataFrame:
    """``field, word, term, distance``: terms within ``MAX_EDITS`` edits of each wanted word, by equi-join
    on pieces and then exact. ``table`` is ``pieces`` of a vocabulary, published or not."""
    asked = probes(wanted)
    table, asked = _cut(table, asked, lambda keys: F.col("key").isin(*keys))
    return (
        table.join(asked, ["field", "key"]).select("field", "word", "term").distinct()
        .withColumn("distance", F.levenshtein("word", "term", MAX_EDITS))
        .where(F.col("distance") >= 0)
    )


# Rotations ------------------------------------------------------------------

def rotations(vocab: DataFrame) -> DataFrame:
    """``field, key``: all rotations of a term and its end. Any literal run of a pattern, the one
    over the end included, is the beginning of a rotation of every term that matches."""
    turned = F.concat(F.expr("substring(term, i)"), F.lit(END), F.expr("left(term, i - 1)"))
    return (
        vocab.select("field", "term", F.explode(F.sequence(F.lit(1), F.length("term") + 1)).alias("i"))
        .select("field", turned.alias("key"))
    )


def head(key: Column) -> Column:
    return F.left(key, F.lit(HEAD))


def run_of(pattern: Column) -> Column:
    """The longest literal run of a wildcard pattern, read in a circle over the end of the term."""
    cut = F.split(pattern, r"[*?]")
    over_end = F.concat(F.element_at(cut, -1), F.lit(END), F.element_at(cut, 1))
    inner = F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 2, F.lit(0)))
    # among runs of one length those inside a term say more than its end alone
    sized = F.transform(F.concat(inner, F.array(over_end)), lambda r: F.struct(
        F.length(r).alias("n"), (~F.contains(r, F.lit(END))).alias("inside"), r.alias("run")))
    return F.array_max(sized)["run"]


def like(pattern: Column) -> Column:
    escaped = F.regexp_replace(pattern, r"([\\%_])", r"\\$1")
    return F.translate(escaped, "*?", "%_")


def matching(wanted: DataFrame, table: DataFrame) -> DataFrame:
    """``field, word, term``: terms each wildcard word stands for. ``table`` is ``rotations`` of a vocabulary,
    published or not; a run of one character meets rotations by that one."""
    asked = wanted.select("field", F.col("term").alias("word")).distinct().withColumn("key", run_of(F.col("word")))

    def begins(keys: list[str]) -> Column:
        if len(keys) > LITERAL_BEGINNINGS:
            return F.left("key", F.lit(1)).isin(*{k[:1] for k in keys})
        verdict = F.lit(False)
        for k in keys:
            verdict = verdict | F.startswith(F.col("key"), F.lit(k))
        return verdict

    table, asked = _cut(table, asked, begins, HEAD)
    both = F.array_distinct(F.array(head(F.col("key")), F.left("key", F.lit(1))))
    term = F.concat(F.substring_index("key", END, -1), F.substring_index("key", END, 1))
    rows = table.select("field", term.alias("term"), F.explode(both).alias("head"))
    return (
        rows.join(asked.withColumn("head", head(F.col("key"))), ["field", "head"])
        .withColumn("pattern", like(F.col("word"))).where(F.expr("term LIKE pattern"))
        .select("field", "word", "term").distinct()
    )


# Pruning --------------------------------------------------------------------

def _cut(table: DataFrame, asked: DataFrame, test: Callable[[list[str]], Column],
         size: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The table without rows that no key can meet, and the keys, to be broadcast if they are few. ``size``
    is that of the part of a key which its bucket is taken from."""
    rows = asked.limit(LITERAL_KEYS + 1).collect()
    if len(rows) > LITERAL_KEYS:
        return table, checked_broadcast(asked)
    keys, fields = sorted({r["key"] for r in rows}), sorted({r["field"] for r in rows})
    kept = F.col("field").isin(*fields) & test(keys)
    if "bucket" in table.columns and all(size is None or len(k) >= size for k in keys):
        kept = kept & F.col("bucket").isin(*{_hash(k[:size]) for k in keys})
    return table.where(kept), F.broadcast(asked.sparkSession.createDataFrame(rows, asked.schema))
