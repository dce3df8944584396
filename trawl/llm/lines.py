"""Lines that many documents repeat, dropped but for one document each.

Batches of documents come in descending order of id. Runs hold, for a line's hash, how many documents
have it, and from the batch that saw it first the largest id. A new batch is anti-joined with the
runs to tell which of its lines are new, and adds its own run, sorted by hash. When a level has
several runs, they are compacted into one of the next level, so a batch meets few runs.

A line's key is the line with white space stripped at both ends and A-Z lower-cased, as 128 bits of
hash. Null or empty texts are one empty line. Rows without an id count as no document and keep all
lines; rows with equal ids are one document. A line that one document repeats counts once. What a text
costs grows in proportion to its lines, dropped ones too. An empty table gives no rows; columns named
like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trawl.llm.common import range_parts, saved
from trawl.operators.sizing import unless_few

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FAN = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), _UPPER, _LOWER)


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


class Runs:
    """Levels of sorted runs of ``h1``, ``h2``, ``n`` (documents) and ``top`` (the largest id, in
    the run that saw the line first)."""

    def __init__(self, fan: int = FAN):
        self.fan, self.levels = fan, []

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> DataFrame:
        """Add a batch of distinct ``h1``, ``h2``, ``doc``; gives its lines that no run had."""
        own = saved(batch.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc").alias("top")), "batch")
        new = own
        for run in self.all():
            new = new.join(unless_few(run.select("h1", "h2"), run), ["h1", "h2"], "left_anti")
        if self.levels:
            known = own.join(unless_few(new.select("h1", "h2"), own), ["h1", "h2"], "left_anti").withColumn("top", F.lit(None).cast(own.schema["top"].dataType))
            own = new.unionByName(known)
        self._push(0, [own])
        return new

    def _push(self, level: int, runs: list[DataFrame]) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(saved(merged(runs).repartition("h1", "h2").sortWithinPartitions("h1", "h2"), "run"))
        if len(self.levels[level]) > self.fan:
            full, self.levels[level] = self.levels[level], []
            self._push(level + 1, full)

    def counts(self) -> DataFrame:
        return merged(self.all())


def merged(runs: list[DataFrame]) -> DataFrame:
    if len(runs) == 1:
        return runs[0]
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    return out.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("top").alias("top"))


def repeated_lines(entries: DataFrame, batches: int, min_docs: int) -> DataFrame:
    """``h1``, ``h2`` and ``top`` of the lines in at least ``min_docs`` documents."""
    part = range_parts(entries, "doc", batches)
    dealt = saved(entries.withColumn("part", part).distinct(), "lines", ("part",))
    runs = Runs()
    for number in reversed(range(batches)):
        runs.add(dealt.where(F.col("part") == number).drop("part"))
    return runs.counts().where(F.col("n") >= min_docs).select("h1", "h2", "top")


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "kept",
    batches: int = BATCHES, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``docs`` with ``out_col``, the text without its repeated lines, ``n_lines`` before dropping and
    ``n_dropped``. With ``out_col`` the text column itself, texts are replaced."""
    numbered = F.transform(split_lines(F.col(text_col)), lambda line, i: F.struct(i.alias("line"), line_key(line).alias("key")))
    long = F.filter(numbered, lambda entry: F.char_length(entry["key"]) >= min_chars)
    # the text's hash is taken before the explode, so that no text is copied for each of its lines
    hashed = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text"),
        F.transform(long, lambda entry: F.struct(entry["line"].alias("line"), _hashes(entry["key"]).alias("h"))).alias("lines"))
    entries = saved(hashed.select("doc", "text", F.explode_outer("lines").alias("e")).where("e IS NOT NULL")
                    .select("doc", "text", "e.line", "e.h.h1", "e.h.h2"), "entries")
    repeated = saved(repeated_lines(entries.select("doc", "h1", "h2"), batches, min_docs), "repeated")
    # equal texts of one id have the same lines to drop
    gone = entries.join(unless_few(repeated, repeated), ["h1", "h2"]).where("doc <> top").groupBy(
        F.col("doc").alias("__doc"), F.col("text").alias("__text")).agg(F.collect_set("line").alias("__gone"))
    same = (docs[id_col] == F.col("__doc")) & (F.xxhash64(docs[text_col]) == F.col("__text"))
    kept = docs.join(gone, same, "left").withColumn("__lines", split_lines(F.col(text_col)))
    # line numbers are a hashed set; a line is then read by its number
    numbers = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    left = F.transform(numbers, lambda i: F.get("__lines", i))
    return kept.withColumns({
        out_col: F.when(F.col("__gone").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.array_join(left, "\n")),
        "n_lines": F.size("__lines").cast("long"),
        "n_dropped": F.when(F.col("__gone").isNull(), F.lit(0)).otherwise(F.size("__lines") - F.size(numbers)).cast("long"),
    }).drop("__doc", "__text", "__gone", "__lines")
