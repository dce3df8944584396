"""Tokens, postings, norms and vocabulary of analysed text.

Postings carry the length of their field, so scoring needs no join back to a
per-document table. Their grain is one *value* of a field, so neither a long
multi-valued field nor a hot term is ever gathered into one row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from trawl.functions.analysis import ALT, GAP, Step
from trawl.functions.profiles import PROFILES

VALUE = ("field", "source", "doc_id", "val_no")
POSITION_GAP = 100
#: Estimated input a core from which reading is left as split.
SPLIT_BYTES = 64 << 20


@dataclass(frozen=True)
class TextSource:
    """Text of one index field: ``frame`` has ``doc_id, text`` and, with ``multi``, ``val_no``."""

    field: str
    frame: DataFrame
    profile: str | Step = "text"
    multi: bool = False
    source: str | None = None

    def chain(self) -> Step:
        return PROFILES[self.profile].index if isinstance(self.profile, str) else self.profile


def term_count(slots: Column) -> Column:
    """Terms in an array of slots, those that share a position included."""
    def in_slot(slot: Column) -> Column:
        extra = F.length(slot) - F.length(F.replace(slot, F.lit(ALT), F.lit("")))
        return F.when(slot == GAP, F.lit(0)).otherwise(extra + 1)
    return F.aggregate(slots, F.lit(0), lambda total, slot: total + in_slot(slot))


def in_parallel(frame: DataFrame) -> DataFrame:
    """Analysis is CPU work: spread input that is small enough to be read in fewer splits
    than there are cores. Spark's estimate of its size decides, so no job runs for it;
    large input has splits enough and is not shuffled."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if estimated_bytes(frame) < cores * SPLIT_BYTES else frame


def estimated_bytes(frame: DataFrame) -> int:
    return int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def analysed(sources: Iterable[TextSource]) -> DataFrame:
    """``field, source, doc_id, val_no, slots, n_terms`` per text value."""
    frames = []
    for s in sources:
        val_no = F.col("val_no").cast("long") if s.multi else F.lit(0).cast("long")
        rows = in_parallel(s.frame.where(F.col("text").isNotNull())).select(
            F.lit(s.field).alias("field"), F.lit(s.source or s.field).alias("source"),
            "doc_id", val_no.alias("val_no"), s.chain()(F.col("text")).alias("slots"),
        )
        frames.append(rows.select("*", term_count(F.col("slots")).alias("n_terms")))
    return reduce(DataFrame.unionByName, frames)


def spread_over_values(sources: Iterable[TextSource]) -> set[str]:
    """Fields whose length has to be added up over several rows."""
    sources = list(sources)
    names = [s.field for s in sources]
    return {s.field for s in sources if s.multi or names.count(s.field) > 1}


def explode_terms(rows: DataFrame) -> DataFrame:
    """One row per term occurrence. The outer explode keeps Spark from evaluating
    the analysis a second time in an inferred filter."""
    carried = [c for c in rows.columns if c != "slots"]
    slot = F.col("slot")
    terms = F.when(F.contains(slot, F.lit(ALT)), F.split(slot, ALT)).otherwise(F.array(slot))
    return (
        rows.select(*carried, F.posexplode_outer("slots").alias("pos", "slot"))
        .where(slot != GAP)
        .select(*carried, "pos", F.explode(terms).alias("term"))
    )


def postings(occurrences: DataFrame) -> DataFrame:
    """``field, term, source, doc_id, val_no, tf, positions, n_terms``.

    All occurrences of a value sit in one input row, so the map side already
    reduces them to postings before anything is shuffled.
    """
    return occurrences.groupBy("field", "term", "source", "doc_id", "val_no").agg(
        F.count("*").cast("int").alias("tf"),
        F.sort_array(F.collect_list("pos")).alias("positions"),
        F.max("n_terms").alias("n_terms"),
    )


def named(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _entries(slots: Column) -> Column:
    """Terms of an array of slots with their positions, sorted."""
    def of(slot: Column, pos: Column) -> Column:
        terms = F.when(F.contains(slot, F.lit(ALT)), F.split(slot, ALT)).otherwise(F.array(slot))
        found = F.transform(terms, lambda t: F.struct(t.alias("term"), pos.alias("pos")))
        return F.when(slot != GAP, found).otherwise(F.array().cast("array<struct<term:string,pos:int>>"))
    return F.sort_array(F.flatten(F.transform(slots, of)))


def _runs(sorted_entries: Column) -> Column:
    """One ``term, positions`` per term, cut where the next term begins."""
    n = F.size(sorted_entries["term"])
    ends = F.filter(F.sequence(F.lit(0), n), lambda i: (i == 0) | (i == n) | (
        F.get(sorted_entries["term"], i) != F.get(sorted_entries["term"], i - 1)))
    return named(ends, lambda at: F.transform(F.slice(at, F.lit(1), F.size(at) - 1), lambda start, k: F.struct(
        F.get(sorted_entries["term"], start).alias("term"),
        F.slice(sorted_entries["pos"], start + 1, F.get(at, k + 1) - start).alias("positions"))))


def postings_in_place(rows: DataFrame) -> DataFrame:
    """``postings`` of all terms of ``analysed`` rows that have distinct values: they are grouped inside
    the row of the value, so that nothing is shuffled, spilled or hashed."""
    runs = named(_entries(F.col("slots")), lambda e: named(F.struct(e["term"].alias("term"), e["pos"].alias("pos")), _runs))
    carried = [c for c in rows.columns if c != "slots"]
    each = rows.select(*carried, F.explode_outer(runs).alias("run")).where(F.col("run.term").isNotNull())
    return each.select("field", "run.term", "source", "doc_id", "val_no",
                       F.size("run.positions").alias("tf"), "run.positions", "n_terms")


def has_distinct_values(sources: Iterable[TextSource]) -> bool:
    """Whether no two texts are the same value of a field. Only their keys are read."""
    sources = list(sources)
    names = {(s.field, s.source or s.field) for s in sources}
    keys = {(id(s.frame), s.multi): s.frame.groupBy("doc_id", *["val_no"] * s.multi).count() for s in sources}
    return len(names) == len(sources) and all(k.where("count > 1").isEmpty() for k in keys.values())


def with_field_length(found: DataFrame, rows: DataFrame, spread: Iterable[str]) -> DataFrame:
    """Postings with the length of the whole field instead of that of one value.

    Only fields spread over several values need it; their lengths are added up from
    ``rows`` (``analysed`` output) and joined to the postings that are left. All of them have a length,
    and the outer join tells Spark so: it is left out where lengths aren't used.
    """
    spread = list(spread)
    if not spread:
        return found
    inside = F.col("field").isin(*spread)
    totals = (
        rows.where(inside).groupBy("field", "doc_id")
        .agg(F.sum("n_terms").cast("int").alias("n_total"))
    )
    many = found.where(inside & F.col("doc_id").isNotNull()).join(totals, ["field", "doc_id"], "left")
    many = many.withColumn("n_terms", F.col("n_total")).select(*found.columns)
    return found.where(~inside).unionByName(many)


def field_stats(rows: DataFrame) -> DataFrame:
    """``field, doc_id, n_terms, norm`` of ``analysed`` rows, without exploding them."""
    return (
        rows.groupBy("field", "doc_id").agg(F.sum("n_terms").alias("n_terms"))
        .where(F.col("n_terms") > 0)
        .withColumn("norm", norm(F.col("n_terms")))
    )


def norm(n_terms: Column) -> Column:
    return F.lit(1.0) / F.sqrt(n_terms.cast("double"))


def distinct_terms(slots: Column) -> Column:
    filled = F.filter(slots, lambda slot: slot != GAP)
    return F.array_distinct(F.split(F.array_join(filled, ALT), ALT))


def vocabulary(rows: DataFrame, spread: Iterable[str] = ()) -> DataFrame:
    """``field, term, df, len`` from postings, counting each document once.

    Only fields spread over several values need a distinct; for the others a
    posting is a document and the count reduces on the map side.
    """
    return _frequencies(rows.select("field", "term", "doc_id"), spread)


def vocabulary_of(rows: DataFrame, spread: Iterable[str] = ()) -> DataFrame:
    """The same from ``analysed`` rows: a value's distinct terms are found in place."""
    terms = rows.select(
        "field", "doc_id", F.explode_outer(distinct_terms(F.col("slots"))).alias("term")
    ).where(F.col("term") != GAP)
    return _frequencies(terms, spread)


def _frequencies(rows: DataFrame, spread: Iterable[str]) -> DataFrame:
    spread = list(spread)
    if spread:
        many = rows.where(F.col("field").isin(*spread)).distinct()
        rows = rows.where(~F.col("field").isin(*spread)).unionByName(many)
    return (
        rows.groupBy("field", "term").agg(F.count("*").alias("df"))
        .withColumn("len", F.length("term"))
    )


def global_positions(rows: DataFrame, block: int = 1024) -> DataFrame:
    """Offset of every value in its field when values follow each other with a gap.

    ``rows`` is ``analysed`` output whose ``val_no`` counts the values of a
    document. The running sum is taken per block of values and then over block
    totals, so a document with very many values is not summed in one task.
    """
    sized = rows.select(
        *VALUE, F.size("slots").alias("n_slots"),
        F.floor(F.col("val_no") / block).alias("block"),
    )
    key = ["field", "source", "doc_id"]
    before = Window.unboundedPreceding, -1
    inner = Window.partitionBy(*key, "block").orderBy("val_no").rowsBetween(*before)
    outer = Window.partitionBy(*key).orderBy("block").rowsBetween(*before)
    blocks = (
        sized.groupBy(*key, "block").agg(F.sum("n_slots").alias("total"))
        .withColumn("earlier", F.coalesce(F.sum("total").over(outer), F.lit(0)))
        .drop("total")
    )
    return (
        sized.withColumn("inside", F.coalesce(F.sum("n_slots").over(inner), F.lit(0)))
        .join(blocks, [*key, "block"])
        .select(
            *VALUE, "n_slots",
            (F.col("earlier") + F.col("inside") + POSITION_GAP * F.col("val_no")).alias("offset"),
        )
    )
