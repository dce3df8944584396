"""Hard negatives of anchor vectors, by lists that the anchors of a cluster share.

Anchors are clustered by angle. For every cluster the candidates of a segment are sorted once by an
upper bound of their inner product with any member: a candidate at angle t from the centre, whose farthest
member is at angle m, has at most its length times cos(max(0, t - m)) times the member's length. Every
member walks that list until the bound falls below what could still enter its result; what is left
can't matter, so results are exact. Inner products are of integers.

Candidates stay where Spark reads them: a task holds a segment of ``SEGMENT`` entries at a time and what
the anchors have found so far, which ends later walks sooner. Anchors come in blocks of ``BLOCK`` entries,
the stated query set, each a pass over all candidates; a block is the only thing the driver sees, and its
results are written before the next one is collected. Centres are fitted on up to ``FIT`` anchors of the
block. A cluster is walked by at most ``TOGETHER`` members at a time, however large it is.

Rows with a null id, label or vector, or with a null or non-finite entry take no part. Of rows with
equal ids the least label and vector counts, so repeated rows are one. Vectors shorter than the
longest are filled up with zeros. Ties go to the smaller id. Products beyond 64 bits saturate in the result.
Other columns don't matter. Without anchors, positives or negatives there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trawl.llm.common import give_back, saved

BLOCK = 1 << 20
SEGMENT = 1 << 21
CHUNK = 1024
FIT = 4096
TOGETHER = 256
#: Anchors a cluster on average, and clusters of a block at most.
MEMBERS, CLUSTERS = 64, 256
SCALE = 256
LONG = 2**63 - 1
#: Scores are compared up to 38 digits.
WIDEST = 10**38 - 1


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``id, label, x`` of the rows that take part, one an id; ``x`` are the vectors in integers."""
    entries = F.transform(vector_col, lambda c: c.cast("double"))
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(entries, lambda c: F.floor(c * SCALE))
    kept = rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x")).where("label IS NOT NULL")
    return kept.groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x")


def exact_type(width: int, most: float) -> type:
    """Of numbers that hold all inner products: doubles, or Python's integers beyond their 53 bits."""
    return np.float64 if width * most * most < 2**53 else object


def clusters(x: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Unit centres, and the centre each row is nearest to by angle."""
    unit = _unit(x)
    k = max(1, min(CLUSTERS, len(x) // MEMBERS))
    rng = np.random.default_rng(seed)
    fit = unit[rng.choice(len(unit), min(FIT, len(unit)), replace=False)]
    centres = fit[rng.choice(len(fit), k, replace=False)]
    for _ in range(8):
        nearest = (fit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, fit)
        filled = np.linalg.norm(sums, axis=1) > 0
        centres[filled] = _unit(sums[filled])
    return centres, (unit @ centres.T).argmax(1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def _sorted(search, score, ids) -> np.ndarray:
    if score.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (search[i], -score[i], ids[i])), np.int64)
    return np.lexsort((ids, -score, search))


class Found:
    """The best ``k`` (score, id) of each of ``n`` searches; ``least`` is the score a further one must reach."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.n, self.floor = k, n, least
        self.search, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, least.dtype), np.zeros(0, np.int64)
        self.least = least.copy()

    def add(self, search: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(search):
            return
        touched = np.zeros(self.n, bool)
        touched[search] = True
        old = touched[self.search]
        search, score, ids = (np.concatenate([a[old], b]) for a, b in ((self.search, search), (self.score, score), (self.id, ids)))
        order = _sorted(search, score, ids)
        search, score, ids = search[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, search[1:] != search[:-1]])
        place = np.arange(len(search)) - np.repeat(first, np.diff(np.r_[first, len(search)]))
        kept, last = place < self.k, place == self.k - 1
        self.least[search[last]] = score[last]
        self.search, self.score, self.id = (
            np.concatenate([a[~old], b[kept]]) for a, b in ((self.search, search), (self.score, score), (self.id, ids)))


class Anchors:
    """A block of anchors in clusters. ``limits`` are of their searches ``(anchors, searches)``: the highest and
    lowest score that counts; None lets any score count, for rows of the anchor's own label."""

    def __init__(self, ids: list[int], labels: list[int], x: np.ndarray, limits: tuple[np.ndarray, np.ndarray] | None = None):
        self.ids, self.labels, self.x, self.limits = np.array(ids, np.int64), np.array(labels, np.int64), x, limits
        self.centres, self.of = clusters(x)
        self.lengths = np.linalg.norm(x.astype(np.float64), axis=1)
        to_centre = _angle((_unit(x) * self.centres[self.of]).sum(1))
        self.reach = np.zeros(len(self.centres))
        np.maximum.at(self.reach, self.of, to_centre)

    def start(self, k: int) -> Found:
        if self.limits is None:
            return Found(len(self.ids), k, np.full(len(self.ids), -np.inf, self.x.dtype))
        return Found(self.limits[1].size, k, self.limits[1].ravel())

    def walk(self, found: Found, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> int:
        """Meet a segment of candidates; how many inner products were worked out."""
        lengths, unit, n = np.linalg.norm(x.astype(np.float64), axis=1), _unit(x), 0
        for c, centre in enumerate(self.centres):
            members = np.flatnonzero(self.of == c)
            if not len(members):
                continue
            bound = lengths * np.cos(np.maximum(0, _angle(unit @ centre) - self.reach[c]))
            bound += 1e-7 * lengths  # more than rounding takes away
            order = np.argsort(-bound, kind="stable")
            for m in range(0, len(members), TOGETHER):
                n += self._walk(found, members[m:m + TOGETHER], order, bound, ids, labels, x)
        return n

    def _walk(self, found, members, order, bound, ids, labels, x) -> int:
        per, n = found.n // len(self.ids), 0
        for at in range(0, len(order), CHUNK):
            top, lengths = bound[order[at]], self.lengths[members]
            least = found.least.reshape(-1, per)[members].min(1)
            members = members[(top * lengths >= least).astype(bool)]
            if not len(members):
                break
            part = order[at:at + CHUNK]
            score = self.x[members] @ x[part].T
            n += score.size
            own = self.labels[members][:, None] == labels[part]
            least = found.least.reshape(-1, per)[members]
            if self.limits is None:
                own &= self.ids[members][:, None] != ids[part]
                row, column = np.nonzero(own & (score >= least))
                found.add(members[row], score[row, column], ids[part][column])
                continue
            row, column = np.nonzero(~own & (score >= least.min(1)[:, None]))
            if not len(row):
                continue
            value, high = score[row, column], self.limits[0][members]
            for j in range(per):
                fits = (value >= least[row, j]) & (value <= high[row, j])
                found.add(members[row[fits]] * per + j, value[fits], ids[part][column[fits]])
        return n


def _segments(batches, width: int, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    held, n = [], 0

    def arrays():
        table = pa.Table.from_batches(held).combine_chunks()
        return table["id"].to_numpy(), table["label"].to_numpy(), matrix(table["x"], width).astype(kind)

    for batch in batches:
        held.append(batch)
        n += len(batch) * width
        if n >= SEGMENT:
            yield arrays()
            held, n = [], 0
    if held:
        yield arrays()


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    column = column.combine_chunks()
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def best(rows: DataFrame, anchors: Anchors, k: int) -> DataFrame:
    """``anchor`` and ``search`` (places in the block), ``score`` and ``id``: of each search the best ``k`` rows
    among those each task has read."""
    wide = anchors.x.dtype == object

    def run(batches):
        found = anchors.start(k)
        for segment in _segments(batches, anchors.x.shape[1], anchors.x.dtype):
            anchors.walk(found, *segment)
        per = max(1, found.n // max(1, len(anchors.ids)))
        score = pa.array([Decimal(min(max(int(s), -WIDEST), WIDEST)) for s in found.score], pa.decimal128(38, 0)) if wide \
            else pa.array(found.score.astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(found.search // per), pa.array(found.search % per), score, pa.array(found.id)],
            names=["anchor", "search", "score", "id"])
        give_back()

    each = rows.mapInArrow(run, f"anchor bigint, search bigint, score {'decimal(38,0)' if wide else 'bigint'}, id bigint")
    order = Window.partitionBy("anchor", "search").orderBy(F.desc("score"), "id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor (rows where
    ``anchor``, a predicate on ``id``, holds) and each of its best ``positives`` of the same label, the best
    ``negatives`` of other labels whose score is ``low`` to ``high`` hundredths of the positive's."""
    label = F.col(label) if isinstance(label, str) else label
    kept = saved(usable(rows, id_col, vector_col, label), "vectors")
    most = F.array_max(F.transform("x", lambda v: F.abs(v.cast("double"))))
    sizes = kept.agg(F.max(F.size("x")).alias("width"), F.max(most).alias("most"), F.count(F.when(anchor, 1)).alias("n")).first()
    width, blocks = sizes["width"] or 0, -(-sizes["n"] * max(1, sizes["width"] or 0) // BLOCK)
    kind = exact_type(width, sizes["most"] or 0)
    numbered = kept.where(anchor).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, blocks))))
    parts = [_of_block(kept, numbered.where(F.col("block") == b), width, kind, positives, negatives, low, high) for b in range(blocks)]
    if not parts:
        return kept.sparkSession.createDataFrame([], RESULT)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _of_block(kept: DataFrame, block: DataFrame, width: int, kind: type, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    table = block.select("id", "label", "x").toArrow()
    ids, labels, x = table["id"].to_numpy(), table["label"].to_numpy(), matrix(table["x"], width).astype(kind)
    if not len(ids):
        return kept.sparkSession.createDataFrame([], RESULT)
    first = best(kept, Anchors(ids, labels, x), positives).toArrow()
    held = dict(zip(zip(first["anchor"].to_pylist(), [r - 1 for r in first["rank"].to_pylist()]),
                    zip(first["id"].to_pylist(), map(int, first["score"].to_pylist()))))
    # a search without a positive, or whose range is empty, has a lowest score that nothing reaches
    top, least = (np.full((len(ids), positives), v, kind) for v in (-np.inf, np.inf))
    for (i, j), (_, score) in held.items():
        a, b = (high * score) // 100, -((-low * score) // 100)
        if a >= b:
            top[i, j], least[i, j] = a, b
    rows = best(kept, Anchors(ids, labels, x, (top, least)), negatives)
    spark = kept.sparkSession
    known = spark.createDataFrame(pa.table({
        "anchor": [i for i, _ in held], "search": [j for _, j in held], "anchor_id": [int(ids[i]) for i, _ in held],
        "positive_id": [p for p, _ in held.values()], "positive_score": [min(max(s, -LONG - 1), LONG) for _, s in held.values()]}, schema=pa.schema(
            [(c, pa.int64()) for c in ("anchor", "search", "anchor_id", "positive_id", "positive_score")])))
    return saved(rows.join(F.broadcast(known), ["anchor", "search"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.least(F.greatest("score", F.lit(-LONG - 1)), F.lit(LONG)).cast("long").alias("negative_score")), "negatives")
