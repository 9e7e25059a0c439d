"""Lanczos whitening against a dense eigendecomposition."""

import math

import numpy as np
from leadloom.llm.whitening import whiten


def dense(vectors, components=4):
    """What the operator gives for vectors of one length, by numpy's eigenvectors of the covariance."""
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    v = centred.T @ centred / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    real = min(components, int((e > 1e-9 * e.sum()).sum()))
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ w[:, :real] / np.sqrt(e[:real]), e[:real] / e.sum()


def compare(spark, vectors, components=4, tolerance=1e-8):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), components=components).collect()
    n, deviation, white, explained = dense(vectors, components)
    assert len(got) == len(vectors) * white.shape[1]
    signs = {}
    for r in got:
        c = r["component"] - 1
        want = white[r["vec_id"], c]
        if c not in signs and abs(want) > 1e-3:
            signs[c] = np.sign(want * r["whitened"])
        assert r["n"] == n and int(r["deviation"]) == int(deviation[r["vec_id"]])
        assert abs(r["explained"] - explained[c]) < 1e-10 and r["identity_error"] < 1e-9
    for r in got:
        c = r["component"] - 1
        assert abs(signs.get(c, 1) * r["whitened"] - white[r["vec_id"], c]) < tolerance


def test_equals_dense_eigenvectors(spark):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(300, 24)) * np.linspace(3, 0.5, 24)
    compare(spark, np.vstack([vectors, vectors[:40], vectors[:1], vectors[:1]]))  # copies count once


def test_wide_vectors_end_early(spark):
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=(400, 80)) * np.append([20, 14, 10, 7], np.full(76, 0.4))
    compare(spark, vectors)


def test_few_directions_and_few_rows(spark):
    draw = np.random.default_rng(7)
    compare(spark, np.column_stack([np.repeat(np.arange(20), 2), np.zeros((40, 5)), np.tile([1.5, -1.5], 20)]))
    compare(spark, draw.normal(size=(3, 10)))
    compare(spark, [[0.5, 0.25], [0.5, 0.75]])
    flat = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<float>")
    assert whiten(flat).count() == 0


def test_equal_eigenvalues(spark):
    """Four directions of the same variance: any basis of them will do."""
    vectors = np.vstack([np.eye(6)[:4] * 2, -np.eye(6)[:4] * 2, np.eye(6)[4:], -np.eye(6)[4:]])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    white = np.zeros((12, 4))
    for r in got:
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["identity_error"] < 1e-9
    assert np.allclose(white[:8] @ white[:8].T, vectors[:8] @ vectors[:8].T * 12 / 8, atol=1e-8) and np.allclose(white[8:], 0, atol=1e-8)


def test_odd_rows(spark):
    good = [[0.1 * i, 0.3 * (i % 3), -0.2 * i * i] for i in range(8)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [nan, 1.0, 2.0], [inf, 1.0, 2.0], [None, 1.0, 2.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]
    rows = [(i, v, "?", "?") for i, v in enumerate(good)] + [(100 + i, v, "?", "?") for i, v in enumerate(odd)]
    rows += [(3, good[3], "?", "?"), (None, good[4], "?", "?")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, component string")
    got = whiten(frame).collect()
    assert {r["vec_id"] for r in got} == {*range(8), None} and len(got) == 10 * 3 and {r["n"] for r in got} == {8}
    for bad in (frame.limit(0), frame.where("vec_id >= 100 and vec_id < 105")):
        assert whiten(bad).count() == 0


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e9 * i, 3e8 - i]) for i in range(4)]
    got = {r["vec_id"]: r["deviation"] for r in whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    sums = [sum(v[k] for v in x) for k in range(2)]
    assert got == {i: sum((4 * v[k] - sums[k]) ** 2 for k in range(2)) for i, v in enumerate(x)}


def test_every_vector_of_a_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in rows] == list(range(len(rows)))
    compare(spark, [r["embedding"] for r in rows], tolerance=1e-7)
