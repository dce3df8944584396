"""Whitening and hard negatives against numpy and brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.llm import negatives, queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, x int, n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, 2) for r in rows], SCHEMA)


def odd_rows(seed=0, n=300, d=6):
    rng = np.random.default_rng(seed)
    vectors = np.round(rng.standard_normal((n, d)) / 4, 3)
    vectors[50:90] = vectors[50]  # a group of copies
    rows = [(i, vectors[i].tolist(), int(rng.integers(4))) for i in range(n)]
    rows += [rows[3], rows[3], (None, [0.1] * d, 1), (n + 1, None, 1), (n + 2, [0.1] * d, None), (n + 3, [0.1, None, 0.1], 1),
             (n + 4, [float("nan")] * d, 1), (n + 5, [float("inf")] * d, 1), (n + 6, [0.0] * d, 2), (n + 7, [0.5, 0.25], 3), (n + 8, [], 0)]
    return rows


def brute_negatives(rows, every):
    found = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(c is not None and np.isfinite(c) for c in v):
            x = tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)
            found[i] = min(found.get(i, (label, x)), (label, x))
    d = max(len(x) for _, x in found.values())
    x = {i: np.array([*x, *[0] * (d - len(x))], object) for i, (_, x) in found.items()}
    out = []
    for a in found:
        if a % every:
            continue
        scores = {i: int(x[a] @ x[i]) for i in found if i != a}
        same = sorted((i for i in scores if found[i][0] == found[a][0]), key=lambda i: (-scores[i], i))[:5]
        for p in same:
            fits = [i for i in scores if found[i][0] != found[a][0] and 50 * scores[p] <= 100 * scores[i] <= 95 * scores[p]]
            for rank, i in enumerate(sorted(fits, key=lambda i: (-scores[i], i))[:3], 1):
                out.append((a, p, rank, i, *(min(s, 2**63 - 1) for s in (scores[p], scores[i]))))
    return sorted(out)


@pytest.mark.parametrize("chunk, block, scale", [(1024, 1 << 20, 1), (16, 100, 1), (16, 1 << 20, 1 << 24)])
def test_hard_negatives(spark, monkeypatch, chunk, block, scale):
    monkeypatch.setattr(negatives, "CHUNK", chunk)
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "MEMBERS", 4)
    rows = [(i, v and [c and c * scale for c in v], label) for i, v, label in odd_rows()]
    out = negatives.hard_negatives(table(spark, rows), F.col("id") % 6 == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, out.collect())) == brute_negatives(rows, 6)


def test_hard_negatives_of_empty_tables(spark):
    rows = table(spark, odd_rows())
    assert negatives.hard_negatives(rows.limit(0), F.col("id") % 6 == 0).count() == 0
    assert negatives.hard_negatives(rows, F.col("id") < 0).count() == 0
    assert negatives.hard_negatives(rows.where("label = 1"), F.col("id") % 6 == 0).count() == 0


def test_walks_end_early():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((8, 16)) * 100
    x = np.floor(centres[np.arange(8000) % 8] + rng.standard_normal((8000, 16)) * 5)
    anchors = negatives.Anchors(list(range(800)), [0] * 800, x[:800])
    done = anchors.walk(anchors.start(5), np.arange(8000), np.zeros(8000, np.int64), x)
    assert done < 0.5 * 800 * 8000


def test_hard_negatives_query(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in frame.collect()]
    assert sorted(map(tuple, queries.QUERIES["op13_anchor_lists"](spark, SF).collect())) == brute_negatives(rows, 50)


def brute_whitening(vectors, k):
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    d = max(map(len, x))
    x = np.array([[*v, *[100_000] * (d - len(v))] for v in x], object)
    n, sums = len(x), x.sum(0)
    scaled = x * n - sums
    y = (scaled / n).astype(float)
    values, turn = np.linalg.eigh(y.T @ y / n)
    values, turn = values[::-1], turn[:, ::-1]
    return (scaled**2).sum(1), y @ turn[:, :k], values[:k], values.sum()


@pytest.mark.parametrize("d", [3, 12, 40, 130])
def test_whitening(spark, d):
    rows = odd_rows(2, 400, d)
    ok = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    k = min(8, d)
    deviation, projected, values, trace = brute_whitening([v for _, v in ok], k)
    out = whitening.whiten(table(spark, rows)).collect()
    assert len(out) == len(ok) * k
    key = lambda r: (r[0] is None, r[0], r[1])
    expect = sorted(((i, int(dev), *p) for (i, _), dev, p in zip(ok, deviation, projected)), key=key)
    for c in range(k):
        own = sorted(((r["vec_id"], r["deviation"], r["whitened"]) for r in out if r["component"] == c + 1), key=key)
        assert [r[:2] for r in own] == [r[:2] for r in expect]
        z, p = np.array([r[2] for r in own]), np.array([r[2 + c] for r in expect]) / values[c] ** 0.5
        order = np.lexsort((np.round(np.abs(p), 6),))
        assert min(np.abs(z - p).max(), np.abs(z + p).max()) < 1e-8, order
    first = out[0]
    assert first["n"] == len(ok) and first["identity_error"] < 1e-10
    for r in out:
        assert abs(r["explained"] - values[r["component"] - 1] / trace) < 1e-12


def test_whitening_of_odd_tables(spark):
    rows = table(spark, odd_rows())
    assert whitening.whiten(rows.limit(0)).count() == 0
    assert whitening.whiten(rows.where("embedding IS NULL")).count() == 0
    alone = whitening.whiten(table(spark, [(1, [0.5, 0.25, 1.0], 1)] * 3)).collect()
    assert len(alone) == 9 and all(r["whitened"] is None and r["deviation"] == 0 and r["explained"] == 0 for r in alone)
    line = whitening.whiten(table(spark, [(i, [i / 8.0, i / 4.0], 1) for i in range(9)])).collect()
    assert {r["component"]: r["whitened"] is None for r in line} == {1: False, 2: True}
    huge = table(spark, [(i, [1e30 * (-1) ** i, 1.0], 1) for i in range(4)])
    assert {r["deviation"] for r in whitening.whiten(huge).collect()} == {None}


def test_jacobi_davidson_needs_few_products():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((500, 500))
    a = a @ a.T + 1e5
    products = []
    values, vectors, size = whitening.eigenpairs(lambda v: products.append(v.shape[1]) or a @ v, 500, 8)
    expect, turn = np.linalg.eigh(a)
    assert np.allclose(values, expect[::-1][:8], rtol=1e-12)
    assert np.allclose(np.abs((turn[:, ::-1][:, :8] * vectors).sum(0)), 1, atol=1e-10)
    assert len(products) < 200


def test_whitening_query(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    out = queries.QUERIES["op12_jacobi_davidson_whitening"](spark, SF).collect()
    assert len(out) == frame.count() * 8 and all(r["identity_error"] < 1e-9 for r in out)
