"""Whitening of embeddings along their leading principal components, found by Jacobi-Davidson.

The covariance is never formed: it is applied to a few vectors at a time, each task adding up the products
of its rows, centred before they are multiplied. A subspace gives Ritz pairs; for each wanted one that
hasn't converged a correction equation, projected onto the complement of the Ritz vectors, is solved by a few
steps of MINRES, all of them sharing one pass over the rows a step. Corrections widen the subspace.
Converged pairs are locked: they get no more corrections and outlast restarts. It ends when all
residuals, worked out afresh, are at double precision.

An entry c becomes the integer floor(1024 c) + 100000; sums and deviations are exact. Rows with a null
vector, or with a null or non-finite entry, are dropped; entries beyond 2^62 are held at that; vectors shorter than
the longest are filled up as if by zeros. Rows with a null or a repeated id count like any other. There are
as many components as the shorter of ``COMPONENTS`` and the dimensions. A component without variance has
null ``whitened``. A deviation beyond 64 bits is null. Other columns don't matter; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trawl.llm.common import give_back, saved

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
MOST = 2**62
#: A residual counts as zero below so many times the largest eigenvalue.
TOLERANCE = 1e-13
#: Ritz vectors that corrections are kept away from, besides the wanted ones.
GUARDS = 4
INNER = 12
OUTER = 60
SPACE = 96


def integers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and the vector ``x`` in integers, of the rows that remain."""
    entries = F.transform(vector_col, lambda c: c.cast("double"))
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(entries, lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-float(MOST))), F.lit(float(MOST)))) + SHIFT)
    return rows.where(F.col(vector_col).isNotNull() & ~bad).select(F.col(id_col).alias("vec_id"), x.alias("x"))


@dataclass(frozen=True)
class Centring:
    """The length of the fit list, its dimensions and sums, and whether 64 bits hold all centred entries times n."""

    n: int
    width: int
    sums: list[int]
    plain: bool

    def scaled(self, column: pa.Array) -> np.ndarray:
        """n * x - S, exact."""
        x = filled(column, self.width)
        if self.plain:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, column: pa.Array) -> np.ndarray:
        return self.scaled(column).astype(np.float64) / self.n


def filled(column: pa.Array, width: int) -> np.ndarray:
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    x = np.full((len(size), width), SHIFT, np.int64)
    x[np.arange(width) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return x


def summed(rows: DataFrame, by: Centring, fn: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all rows of what ``fn`` gives for some of them, centred. Tasks add up their own rows."""
    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            total += fn(by.centred(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["k", "v"])

    parts = rows.select("x").mapInArrow(run, "k bigint, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(int(np.prod(shape)))
    out[parts["k"].to_numpy()] = parts["v"].to_numpy()
    return out.reshape(shape)


def centring(rows: DataFrame) -> Centring:
    sizes = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"),
                     F.max(F.array_max(F.transform("x", lambda v: F.abs(v)))).alias("most")).first()
    n, width = sizes["n"], sizes["width"] or 0

    def run(batches):
        total = np.zeros(width, object)
        for batch in batches:
            x = filled(batch.column(0), width)
            # halves, so that 64 bits hold the sums of a batch
            total = total + ((x >> 32).sum(0).astype(object) << 32) + (x & 0xFFFFFFFF).sum(0).astype(object)
        yield pa.RecordBatch.from_pydict({"k": list(range(width)), "v": [str(v) for v in total]},
                                         pa.schema([("k", pa.int64()), ("v", pa.string())]))

    sums = [0] * width
    if width:
        parts = rows.select("x").mapInArrow(run, "k bigint, v string").groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
        for r in parts.collect():
            sums[r["k"]] = int(r["v"])
    return Centring(n, width, sums, 2 * n * max(sizes["most"] or 0, SHIFT) < 2**63)


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, enough: float = 1e-2) -> np.ndarray:
    """Approximate solutions of ``apply(x) = b``, a column each, by up to ``steps`` applications."""
    beta = np.linalg.norm(b, axis=0)
    start = np.maximum(beta, 1e-300)
    x, v_old, v = np.zeros_like(b), np.zeros_like(b), b / start
    w_old, w = np.zeros_like(b), np.zeros_like(b)
    c_old, c, s_old, s, eta = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta), beta
    beta = np.zeros_like(beta)  # of the vector before the first
    for _ in range(steps):
        p = apply(v)
        alpha = (p * v).sum(0)
        p -= alpha * v + beta * v_old
        following = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        r1 = np.maximum(np.hypot(delta, following), 1e-300)
        r2, r3 = s * alpha + c_old * c * beta, s_old * beta
        w_old, w = w, (v - r3 * w_old - r2 * w) / r1
        c_old, c, s_old, s = c, delta / r1, s, following / r1
        x = x + c * eta * w
        eta = -s * eta
        v_old, v, beta = v, p / np.maximum(following, 1e-300), following
        if (np.abs(eta) <= enough * start).all() or (following <= 1e-14 * np.abs(alpha)).all():
            break
    return x


def _against(vectors: np.ndarray, basis: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``vectors`` add to ``basis``."""
    for _ in range(2):
        vectors = vectors - basis @ (basis.T @ vectors)
    q, r = np.linalg.qr(vectors)
    q = q[:, np.abs(np.diag(r)) > 1e-10 * scale]
    q = q - basis @ (basis.T @ q)
    return np.linalg.qr(q)[0] if q.shape[1] else q


def eigenpairs(times: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest ``wanted`` eigenvalues of a symmetric operator, their unit vectors in columns, and the residuals' lengths."""
    rng = np.random.default_rng(seed)
    space = np.linalg.qr(rng.standard_normal((width, min(width, wanted + GUARDS))))[0]
    image = times(space)
    least = np.inf
    for outer in range(OUTER):
        h = space.T @ image
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_image = space @ turn, image @ turn
        gap = ritz_image - ritz * values
        size = np.linalg.norm(gap, axis=0)[:wanted]
        locked = size <= TOLERANCE * max(values[0], 0)
        if locked.all() or space.shape[1] == width:
            afresh = times(ritz[:, :wanted])
            values = (ritz[:, :wanted] * afresh).sum(0)
            size = np.linalg.norm(afresh - ritz[:, :wanted] * values, axis=0)
            # rounding of the sums may leave a little more than the tolerance: it doesn't shrink further
            if (size <= 10 * TOLERANCE * max(values[0], 0)).all() or size.max() >= least / 2 or space.shape[1] == width:
                break
            least, locked = size.max(), size <= TOLERANCE * max(values[0], 0)
            image = times(space)
            continue
        kept = ritz[:, : wanted + GUARDS]
        left = np.flatnonzero(~locked)
        if space.shape[1] + len(left) > SPACE:
            space, image = ritz[:, : 2 * (wanted + GUARDS)], ritz_image[:, : 2 * (wanted + GUARDS)]

        def project(v):
            return v - kept @ (kept.T @ v)

        def shifted(v):
            v = project(v)
            return project(times(v) - v * values[left])

        more = minres(shifted, project(-gap[:, left]), INNER)
        more = _against(more / np.maximum(np.linalg.norm(more, axis=0), 1e-300), space, 1.0)
        if not more.shape[1]:
            more = _against(rng.standard_normal((width, len(left))), space, 1.0)[:, : width - space.shape[1]]
        space, image = np.hstack([space, more]), np.hstack([image, times(more)])
    vectors = ritz[:, :wanted]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(wanted)])
    return values[:wanted], vectors * sign, size


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every remaining row and component."""
    kept = saved(integers(rows, id_col, vector_col), "vectors")  # read again and again
    fit = centring(kept)
    wanted = min(components, fit.width)
    schema = kept.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {schema}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not fit.n or not wanted:
        return kept.sparkSession.createDataFrame([], schema)

    def times(v):
        return summed(kept, fit, lambda y: y.T @ (y @ v), v.shape) / fit.n

    values, vectors, _ = eigenpairs(times, fit.width, wanted)
    trace = float(summed(kept, fit, lambda y: np.array([(y * y).sum()]), (1,))[0]) / fit.n
    full = values > fit.width * np.finfo(float).eps * max(values[0], 0)
    to_unit = np.where(full, vectors / np.sqrt(np.where(full, values, 1)), 0)
    explained = values / trace if trace > 0 else np.zeros(wanted)

    def moments(y):
        z = np.hstack([y @ to_unit, np.ones((len(y), 1))])
        return z.T @ z

    m = summed(kept, fit, moments, (wanted + 1, wanted + 1)) / fit.n
    apart = (m[:-1, :-1] - np.outer(m[-1, :-1], m[-1, :-1]) - np.eye(wanted))[np.ix_(full, full)]
    error = float(np.abs(apart).max(initial=0))

    def run(batches):
        for batch in batches:
            scaled = fit.scaled(batch.column(1))
            z = scaled.astype(np.float64) / fit.n @ to_unit
            z[:, ~full] = np.nan
            each = len(z) * wanted
            deviation = np.repeat(_deviation(scaled), wanted)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(len(z)), wanted))),
                pa.array(np.tile(np.arange(1, wanted + 1, dtype=np.int32), len(z))), pa.array(np.full(each, fit.n)),
                pa.array(deviation.tolist() if deviation.dtype == object else deviation, pa.int64()),
                pa.array(z.ravel(), from_pandas=True), pa.array(np.tile(explained, len(z))), pa.array(np.full(each, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
        give_back()

    return kept.mapInArrow(run, schema)


def _deviation(scaled: np.ndarray) -> np.ndarray:
    """The sum of squares of each row; null beyond 64 bits."""
    if scaled.dtype != object and scaled.size and scaled.shape[1] * float(np.abs(scaled).max()) ** 2 < 2**62:
        return (scaled * scaled).sum(1)
    return np.array([d if (d := sum(int(v) ** 2 for v in row)) < 2**63 else None for row in scaled], object)
