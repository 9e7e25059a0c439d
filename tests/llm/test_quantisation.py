"""Links of embeddings against all pairs."""

import numpy as np
from leadloom.llm import quantisation
from leadloom.llm.quantisation import Index, coded, fit, near_duplicate_vectors, unit


def brute_force(rows, cosine=0.93):
    able = []
    for i, (_, vector, label) in enumerate(rows):
        v = None if vector is None or label is None or any(c is None for c in vector) else np.array(vector, dtype=float)
        if v is not None and len(v) and np.isfinite(v).all() and v.any():
            able.append((i, v / np.abs(v).max(), label))
    links, top = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for n, (i, a, la) in enumerate(able):
        for j, b, lb in able[:n]:
            if la == lb and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                links[i] += 1
                links[j] += 1
                top[root(i)] = root(j)
    out = []
    for i, (key, _, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = min(keys) if links[i] and keys else (None if links[i] else key)
        out.append((key, links[i], least, key is not None and key == least))
    return sorted(out, key=repr)


def answer(frame, **options):
    return sorted((tuple(r) for r in near_duplicate_vectors(frame, **options).collect()), key=repr)


def groups(seed, width=24, around=12, each=25, noise=0.05):
    """Clusters of vectors, many of them close to the threshold, among unlike ones."""
    draw = np.random.default_rng(seed)
    middle = unit(draw.normal(size=(around, width)))
    near = np.repeat(middle, each, 0) + draw.normal(size=(around * each, width)) * noise
    return np.vstack([near, draw.normal(size=(200, width))]).astype(np.float32)


def test_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(quantisation, "BLOCK_ROWS", 64)  # several blocks a list
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(groups(1))]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(20)] + [(2000, rows[0][1], rows[0][2])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    want = brute_force(rows)
    assert sum(r[1] for r in want) > 1000 and answer(frame) == want


def test_one_dense_group(spark):
    draw = np.random.default_rng(2)
    rows = [(i, (np.ones(16) + draw.normal(size=16) * 0.19).tolist(), 7) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute_force(rows)
    assert 0 < sum(r[1] for r in want) < 400 * 399 and answer(frame) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    a = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, a, 1), (2, [2.0, 4.0, 6.0, 8.0], 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [], 1), (7, [0.0] * 4, 1), (8, [nan, 1.0, 1.0, 1.0], 1),
        (9, [inf, 1.0, 1.0, 1.0], 1), (10, [None, 1.0, 1.0, 1.0], 1), (11, a[:3], 1), (12, [*a, 0.0], 1), (13, [1e200 * c for c in a], 1),
        (14, [1e-200 * c for c in a], 1), (2, a, 1), (None, a, 1), (None, [0.0, 0.0, 1.0, 0.0], 3), (None, [0.0, -0.0, 1.0, 0.0], 3),
        (15, [-c for c in a], 1),
    ]
    clash = ["key", "mark", "node", "cell", "list", "times", "least", "top", "n_links", "kept"]
    names = ", ".join(f"{c} string" for c in clash)
    frame = spark.createDataFrame([(*r, *["?"] * len(clash)) for r in rows], f"vec_id long, embedding array<double>, label int, {names}")
    assert answer(frame) == brute_force(rows)
    assert answer(frame.limit(0)) == [] and [r[1] for r in answer(frame.where("vec_id in (5, 7, 9)"))] == [0, 0, 0]


def test_probes_lose_no_pair():
    """Of two vectors within reach of each other, one visits the other's list or they share one; and looked-up distances are off by
    the error of the code at most."""
    x = unit(groups(3, width=20, noise=0.09).astype(float))
    index: Index = fit(x[::2], 32)
    reach = np.sqrt(2 - 2 * 0.93)
    own, codes, error, probes = coded(x, index, reach)
    near = np.argwhere(np.triu(x @ x.T >= 0.93, 1))
    assert len(near) > 100 and any(own[i] != own[j] for i, j in near)
    for i, j in near:
        assert own[i] == own[j] or own[j] in probes[i] or own[i] in probes[j]
    guess = index.centres[own] + np.concatenate([b[codes[:, m]] for m, b in enumerate(index.books)], 1)
    assert np.allclose(np.linalg.norm(x - guess, axis=1), error)


def test_recall_on_a_table(spark):
    frame = spark.read.parquet("/root/testdata/check_s/embeddings.parquet").where("label = 1")
    rows = frame.select("vec_id", "embedding", "label").collect()
    x = np.array([r["embedding"] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = dict(zip([r["vec_id"] for r in rows], ((x @ x.T) >= 0.93).sum(1) - 1, strict=True))
    got = {r["vec_id"]: r["n_links"] for r in near_duplicate_vectors(frame).collect()}
    assert sum(want.values()) > 10_000 and got == want
