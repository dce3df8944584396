"""Index tables: building, publishing and reading them, upserts and deletes.

A published generation has seven tables:

    documents   the rows given
    postings    by field and bucket of the term
    vocab       terms with their frequencies; in later generations, by how much these change
    forward     the terms of each document, by bucket of the document
    pieces      of the terms, for edit distance (``lookups``), by bucket of the piece
    rotations   of the terms, for wildcards, by bucket of the beginning
    values      of fields with several values, for filters, by bucket of the value
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trawl.operators import lookups as L
from trawl.operators import postings as P
from trawl.operators.sizing import BROADCAST_ROWS, materialised, within

BUCKETS = 64
LITERAL_KEYS = 1000
#: Rows a published file holds at most, so that its size is bounded whatever a term's frequency.
FILE_ROWS = 20_000_000
#: Texts of fewer bytes, and vocabularies of fewer terms, are written in few files by a shuffle. Of more, each task sorts and
#: writes its own rows, and the tasks are so large that their files aren't small: a shuffle would need several times the disk.
SMALL_BYTES, SMALL_TERMS = 16 << 20, 200_000
TASK_BYTES, TASK_TERMS = 256 << 20, 1_000_000
#: Changed ids that are broadcast, of some 50 bytes each: else all rows of the tables they are joined to are shuffled.
BROADCAST_IDS = 1_000_000


def bucket(term: Column) -> Column:
    """Partition of a term in published tables."""
    return F.pmod(F.crc32(term.cast("binary")), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class Layout:
    """How a table is written: what its bucket is taken from, the columns it is partitioned by and sorted
    by within them, and its columns but for those of documents, whose key type stands for ``{key}``."""

    bucket: Callable[[], Column]
    by: tuple[str, ...]
    order: tuple[str, ...]
    columns: str


def _document_bucket() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")


LAYOUTS = {
    "postings": Layout(lambda: bucket(F.col("term")), ("field", "bucket"), ("term", "doc_id", "val_no"),
                       "term string, source string, doc_id {key}, val_no long, tf int, positions array<int>, n_terms int"),
    "vocab": Layout(lambda: bucket(F.col("term")), ("field", "bucket"), ("term",), "term string, df long, len int"),
    "forward": Layout(_document_bucket, ("bucket",), ("doc_id", "field", "term"), "doc_id {key}, field string, term string"),
    "pieces": Layout(lambda: L.hashed(F.col("key")), ("field", "bucket"), ("key",), "term string, key string"),
    "rotations": Layout(lambda: L.hashed(L.head(F.col("key"))), ("field", "bucket"), ("key",), "key string"),
    "values": Layout(lambda: bucket(F.col("value")), ("field", "bucket"), ("value", "doc_id"),
                     "value string, number double, doc_id {key}"),
}


@dataclass(frozen=True)
class Published:
    """The tables of a published index but for its documents."""

    postings: DataFrame
    vocab: DataFrame
    forward: DataFrame
    pieces: DataFrame
    rotations: DataFrame
    values: DataFrame

    def each(self, change: Callable[[DataFrame], DataFrame]) -> Published:
        return Published(*(change(getattr(self, f.name)) for f in fields(self)))


@dataclass(frozen=True)
class Wanted:
    """Terms a batch of queries looks up, whether they were counted as few enough to
    broadcast, and their distinct (field, term) pairs when those are few."""

    frame: DataFrame
    small: bool
    keys: tuple[tuple[str, str], ...] | None

    @classmethod
    def of(cls, terms: DataFrame, derived: bool = False) -> Wanted:
        """``derived`` terms come out of lookups: a few are fetched at once, many are written once; those
        read off the query texts are cheaper to compute again than to keep."""
        if derived:
            rows = terms.limit(LITERAL_KEYS + 1).collect()
            if len(rows) <= LITERAL_KEYS:
                keys = tuple(sorted({(r["field"], r["term"]) for r in rows}))
                return cls(terms.sparkSession.createDataFrame(rows, terms.schema), True, keys)
        frame = materialised(terms) if derived else terms
        listed = (
            frame.limit(BROADCAST_ROWS + 1).groupBy("field", "term").agg(F.count("*").alias("n"))
            .limit(LITERAL_KEYS + 1).collect()
        )
        few = len(listed) <= LITERAL_KEYS and sum(r.n for r in listed) <= BROADCAST_ROWS
        keys = tuple((r.field, r.term) for r in listed) if few else None
        return cls(frame, few or within(frame, BROADCAST_ROWS), keys)

    def hinted(self, frame: DataFrame) -> DataFrame:
        """Broadcast something that has at most as many rows as the terms."""
        return F.broadcast(frame) if self.small else frame

    def cut(self, rows: DataFrame) -> DataFrame:
        """Rows of the wanted terms only. Few terms become literals, which prune
        partitions and row groups of a table and filter tokens without a join."""
        if self.keys is None:
            pairs = self.hinted(self.frame.select("field", "term").distinct())
            return rows.join(pairs, ["field", "term"], "left_semi")
        fields, terms = {f for f, _ in self.keys}, {t for _, t in self.keys}
        kept = F.col("field").isin(*fields) & F.col("term").isin(*terms)
        if "bucket" in rows.columns:
            buckets = {zlib.crc32(t.encode()) % BUCKETS for t in terms}
            kept = kept & F.col("bucket").isin(*buckets)
        return rows.where(kept)


@dataclass(frozen=True)
class TextIndex:
    """Documents (unique ``doc_id``) with the postings and vocabulary of their text.

    Either read from published tables, or lazy over text ``sources``; a lazy index
    analyses the text again in every query and suits one-off jobs.
    """

    documents: DataFrame
    sources: tuple[P.TextSource, ...] = ()
    tables: Published | None = None
    spread: frozenset[str] = frozenset()
    roots: tuple[str, ...] = ()
    analyzers: tuple[tuple[str, str], ...] = ()
    given_values: DataFrame | None = None

    @cached_property
    def analysed(self) -> DataFrame:
        return P.analysed(self.sources)

    @cached_property
    def _every_posting(self) -> DataFrame:
        if P.has_distinct_values(self.sources):
            found = P.postings_in_place(self.analysed)
        else:
            found = P.postings(P.explode_terms(self.analysed))
        return P.with_field_length(found, self.analysed, self.spread)

    @property
    def postings(self) -> DataFrame:
        return self.tables.postings if self.tables else self._every_posting

    @property
    def vocab(self) -> DataFrame:
        return self.tables.vocab if self.tables else P.vocabulary_of(self.analysed, self.spread)

    @property
    def pieces(self) -> DataFrame:
        return self.tables.pieces if self.tables else L.pieces(self.vocab)

    @property
    def rotations(self) -> DataFrame:
        return self.tables.rotations if self.tables else L.rotations(self.vocab)

    @property
    def values(self) -> DataFrame | None:
        """``field, value, number, doc_id`` of fields with several values, if there are any."""
        return self.tables.values if self.tables else self.given_values

    def only_fields(self, names: Iterable[str]) -> TextIndex:
        """The same index without the text of fields a query does not name."""
        names = list(names)
        if self.tables:
            kept = self.tables.each(lambda t: t.where(F.col("field").isin(*names)))
            return replace(self, tables=replace(kept, values=self.tables.values))
        kept = tuple(s for s in self.sources if s.field in names)
        return replace(self, sources=kept, spread=self.spread & set(names))

    def matched(self, wanted: Wanted) -> tuple[DataFrame, DataFrame]:
        """Postings and document frequencies of wanted terms.

        On text, tokens are dropped before they are grouped, and what is left is
        written once: the text is analysed in a single pass however often the
        matches are used.
        """
        if self.tables:
            postings, vocab = wanted.cut(self.postings), wanted.cut(self.vocab)
        else:
            found = P.postings(wanted.cut(P.explode_terms(self.analysed)))
            postings = materialised(P.with_field_length(found, self.analysed, self.spread))
            vocab = P.vocabulary(postings, self.spread)
        return postings, vocab.select("field", "term", "df")

    def total(self) -> Column:
        """Number of documents, as a scalar subquery."""
        return self.documents.select(F.count("*").alias("n")).scalar()


def build(documents: DataFrame, sources: Iterable[P.TextSource], values: DataFrame | None = None) -> TextIndex:
    """Lazy index over analysed text; see ``publish`` for keeping it. Searches analyse their
    words by the profile of the field. ``values`` are those of fields with several values, long:
    ``doc_id, field, value``."""
    sources = tuple(sources)
    analyzers = {s.field: s.profile for s in sources if isinstance(s.profile, str)}
    return TextIndex(documents, sources, spread=frozenset(P.spread_over_values(sources)),
                     analyzers=tuple(analyzers.items()), given_values=None if values is None else typed_values(values))


def typed_values(values: DataFrame) -> DataFrame:
    """Values as strings, and as numbers where they are: what a range compares follows from its ends."""
    value = F.col("value").cast("string")
    return values.where(F.col("value").isNotNull()).select(
        "field", value.alias("value"), value.try_cast("double").alias("number"), "doc_id").distinct()


def _write(rows: DataFrame, root: str, table: str, in_place: bool = False) -> None:
    """Partitioned and sorted as ``LAYOUTS`` has it. Adaptive execution sizes the tasks by
    the bytes that were shuffled and splits a bucket whose terms are frequent, so a
    term that is in every document is spread over files. ``in_place`` rows stay in their task, which
    writes a sorted file of each bucket; disk is needed for the sort of the running tasks only."""
    layout = LAYOUTS[table]
    rows = rows.withColumn("bucket", layout.bucket())
    if not in_place:
        rows = rows.hint("rebalance", *map(F.col, layout.by))
    (
        rows.sortWithinPartitions(*layout.by, *layout.order)
        .write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(*layout.by).parquet(f"{root}/{table}")
    )


def _read(spark: SparkSession, root: str, table: str, key: str) -> DataFrame:
    """A table under a root. Schemas are given, as a table may have no rows and so no files."""
    layout = LAYOUTS[table]
    columns = ", ".join([layout.columns, *(f"{c} {'int' if c == 'bucket' else 'string'}" for c in layout.by)])
    return spark.read.schema(columns.replace("{key}", key)).parquet(f"{root}/{table}")


def _key_type(documents: DataFrame) -> str:
    return documents.schema["doc_id"].dataType.simpleString()


def _at_once(*jobs: Callable[[], None]) -> None:
    """Jobs that don't wait for each other share the cluster."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def _write_generation(index: TextIndex, root: str, spread: Iterable[str], change: Callable[[DataFrame], DataFrame]) -> None:
    """The tables of an index. What is derived from postings reads them as written, so that texts are
    analysed once; ``change`` makes the frequencies to write of those of its own rows."""
    spark, key = index.documents.sparkSession, _key_type(index.documents)
    values = index.values
    if values is None:
        values = spark.createDataFrame([], f"field string, value string, number double, doc_id {key}")
    large = bool(index.sources) and sum(P.estimated_bytes(s.frame) for s in index.sources) >= SMALL_BYTES
    _at_once(lambda: index.documents.write.parquet(f"{root}/documents"),
             lambda: _write(index.postings, root, "postings", large),
             lambda: _write(values.select("field", "value", "number", "doc_id"), root, "values"))
    written = _read(spark, root, "postings", key)
    own = written.select("doc_id", "field", "term")
    if large:
        own = own.coalesce(_tasks(spark, P.estimated_bytes(written), TASK_BYTES))
    if not index.sources or index.spread:  # else a posting is a document and term already
        own = own.distinct()

    vocab = P.vocabulary(written, spread).persist()
    try:
        terms, n_terms = vocab.select("field", "term"), vocab.count()
        many = n_terms >= SMALL_TERMS
        if many:
            terms = terms.coalesce(_tasks(spark, n_terms, TASK_TERMS))
        _at_once(lambda: _write(own, root, "forward", large), lambda: _write(change(vocab), root, "vocab"),
                 lambda: _write(L.pieces(terms), root, "pieces", many), lambda: _write(L.rotations(terms), root, "rotations", many))
    finally:
        vocab.unpersist()


def _tasks(spark: SparkSession, size: int, each: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-size // each))


def publish(index: TextIndex, path: str, generation: int) -> TextIndex:
    """Write one generation of the index tables under a fresh path and read it back.

    Postings and lookup tables are partitioned by field and bucket and sorted, so a lookup
    reads few files and row groups. An index of several generations becomes one.
    """
    root = f"{path}/gen={generation}"
    _write_generation(index, root, index.spread, lambda vocab: vocab)
    return load(index.documents.sparkSession, root, index.spread, index.analyzers)


def publish_changes(index: TextIndex, documents: DataFrame, sources: Iterable[P.TextSource],
                    deleted: DataFrame, path: str, generation: int, values: DataFrame | None = None) -> TextIndex:
    """Write changed documents as a further generation of a published index.

    ``documents``, ``sources`` and ``values`` hold the upserted documents whole, ``deleted`` the
    ``doc_id`` of those that go; one that is in both is upserted. Written are the changed
    documents' rows only: the ids that older generations no longer hold, postings, lookups and by
    how much each term's frequency changes. What falls is looked up in the forward table, of which the rows of changed documents
    are read. ``publish`` makes one generation of the result when there are many.
    """
    if not index.roots:
        raise ValueError("changes go to a published index")
    spark, root = documents.sparkSession, f"{path}/gen={generation}"
    changed = build(documents, sources, values)
    ids = documents.select("doc_id").unionByName(deleted.select("doc_id"))
    ids.where(F.col("doc_id").isNotNull()).distinct().write.parquet(f"{root}/gone")
    gone = spark.read.parquet(f"{root}/gone")
    spread = index.spread | changed.spread
    lost = forward_of(index, gone).groupBy("field", "term").agg((-F.count("*")).alias("df")).withColumn("len", F.length("term"))

    def change(vocab: DataFrame) -> DataFrame:
        return summed(vocab.unionByName(lost), "field", "term").where(F.col("df") != 0)

    _write_generation(changed, root, spread, change)
    return load(spark, (*index.roots, root), spread, index.analyzers)


def forward_of(index: TextIndex, ids: DataFrame) -> DataFrame:
    """``doc_id, field, term`` of some documents. Few ids become literals, which prune buckets and row groups."""
    rows = ids.select("doc_id", _document_bucket().alias("bucket")).limit(LITERAL_KEYS + 1).collect()
    forward = index.tables.forward
    if len(rows) > LITERAL_KEYS:
        return forward.join(_counted(ids), "doc_id", "left_semi")
    return forward.where(F.col("bucket").isin(*{r["bucket"] for r in rows}) & F.col("doc_id").isin(*[r["doc_id"] for r in rows]))


def summed(vocab: DataFrame, *key: str) -> DataFrame:
    """Frequencies of several vocabularies added up."""
    return vocab.groupBy(*key).agg(F.sum("df").alias("df"), F.max("len").alias("len"))


def _counted(ids: DataFrame) -> DataFrame:
    """Written ids, to be broadcast if they are few."""
    return F.broadcast(ids) if within(ids, BROADCAST_IDS) else ids


def load(spark: SparkSession, roots: str | Iterable[str], spread: Iterable[str] = (),
         analyzers: Iterable[tuple[str, str]] = ()) -> TextIndex:
    """A published index; ``roots`` are its generations from the oldest on.

    A row counts unless a later generation says that its document is gone: one anti join
    with the changed ids. Lookups still reach every generation's files as filters.
    """
    roots = (roots,) if isinstance(roots, str) else tuple(roots)
    documents = [spark.read.parquet(f"{root}/documents") for root in roots]
    key = _key_type(documents[0])
    tables = {t: [_read(spark, root, t, key) for root in roots] for t in LAYOUTS}
    if len(roots) == 1:
        return TextIndex(documents[0], (), Published(**{t: own[0] for t, own in tables.items()}),
                         frozenset(spread), roots, tuple(analyzers))
    gone = reduce(DataFrame.unionByName, (
        spark.read.parquet(f"{root}/gone").select("doc_id", F.lit(i).alias("__until"))
        for i, root in enumerate(roots[1:], 1)))
    gone = _counted(gone.groupBy("doc_id").agg(F.max("__until").alias("__until")))

    def current(parts: Iterable[DataFrame]) -> DataFrame:
        rows = reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True),
            (t.withColumn("__gen", F.lit(i)) for i, t in enumerate(parts)))
        last = gone.withColumnRenamed("doc_id", "__doc_id")
        replaced = (rows["doc_id"] == last["__doc_id"]) & (rows["__gen"] < last["__until"])
        return rows.join(last, replaced, "left_anti").drop("__gen")

    # a term of older generations that no document has any longer is left out of the vocabulary; lookups may
    # still name it, which then meets no posting
    whole = {t: current(tables[t]) for t in ("postings", "forward", "values")}
    whole |= {t: reduce(DataFrame.unionByName, tables[t]) for t in ("vocab", "pieces", "rotations")}
    whole["vocab"] = summed(whole["vocab"], "field", "bucket", "term").where("df > 0")
    return TextIndex(current(documents), (), Published(**whole), frozenset(spread), roots, tuple(analyzers))


# Upserts and deletes ------------------------------------------------------

def latest(log: DataFrame, key: str = "_documentid", seq: str = "seq",
           allow_duplicates: bool = False) -> DataFrame:
    """Current rows of an operation log: the last entry per key, deletes hidden.

    A partial ``max_by`` runs before the shuffle, so a key written very often
    reaches its task already reduced.
    """
    if allow_duplicates:
        return log.where(F.col("op") != "delete")
    row = F.struct(*log.columns)
    last = log.groupBy(key).agg(F.max_by(row, F.col(seq)).alias("row"))
    return last.select("row.*").where(F.col("op") != "delete")


def delete_ids(documents: DataFrame, ids: DataFrame, key: str = "_documentid") -> DataFrame:
    return documents.join(ids.select(key), key, "left_anti")


def delete_where(documents: DataFrame, predicate: Column) -> DataFrame:
    """Remove what the predicate matches; rows it is null for stay."""
    return documents.where(~F.coalesce(predicate, F.lit(False)))
