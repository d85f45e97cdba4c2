"""Anchor integration against numpy, and what it does to mixing and to labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import anchors, neighbors


def frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vec array<double>")


def standard(x):
    return (x - x.mean(0)) / x.std(0, ddof=1)


@pytest.fixture(scope="module")
def two():
    rng = np.random.default_rng(8)
    kinds = rng.integers(0, 3, 160)
    centre = rng.normal(size=(3, 12)) * 3
    x = centre[kinds] + rng.normal(size=(160, 12))
    x[90:] = x[90:] + rng.normal(size=12) * 4
    return x[:90], x[90:], kinds


def test_canonical_axes_equal_the_svd_of_the_cross_product(spark, two):
    a, b = anchors.Batch(frame(spark, two[0])), anchors.Batch(frame(spark, two[1], 90))
    la, lb, sigma = anchors.canonical_axes(a, b, 3, rounds=12)
    x, y = standard(two[0]), standard(two[1])
    u, s, vt = np.linalg.svd(x @ y.T)
    assert np.allclose(sigma, s[:3], rtol=1e-5)
    assert np.allclose(np.abs((x @ la)[:, :2]), np.abs(u[:, :2]), atol=1e-3) and np.allclose(np.abs((y @ lb)[:, :2]), np.abs(vt[:2].T), atol=1e-3)
    got = np.array([r["vec"] for r in a.onto(la, unit=False).orderBy("id").collect()])
    assert np.allclose(got, x @ la)
    load = a.components(2, rounds=12)
    assert np.allclose(np.abs(load), np.abs(np.linalg.svd(x)[2][:2].T), atol=1e-3)


def test_scores_and_corrections_equal_numpy(spark, two):
    x, y = two[0][:40], two[1][:35]
    a, b = anchors.Batch(frame(spark, x)), anchors.Batch(frame(spark, y, 90))
    k, ks, kw = 3, 6, 10
    found = {(r["a"], r["b"]): r["score"] for r in anchors.find_anchors(anchors.spaces(a, b, "none", 0), k, ks).collect()}
    d = lambda p, q: np.linalg.norm(p[:, None] - q[None], axis=2)
    ab, ba, aa, bb = (np.argsort(m, 1, kind="stable") for m in (d(x, y), d(y, x), d(x, x), d(y, y)))
    pairs = [(i, j) for i in range(40) for j in ab[i, :k] if i in ba[j, :k]]
    n = np.array([len({("a", v) for v in aa[i, 1 : ks + 1]} & {("a", v) for v in ba[j, :ks]}) + len({v for v in ab[i, :ks]} & {v for v in bb[j, 1 : ks + 1]}) for i, j in pairs], float)
    lo, hi = np.quantile(n, 0.01), np.quantile(n, 0.9)
    want = {(i, 90 + j): float(np.clip((v - lo) / (hi - lo), 0, 1)) for (i, j), v in zip(pairs, n)}
    assert set(found) == set(want) and all(np.isclose(found[p], want[p]) for p in want)
    got = {r["id"]: r["vec"] for r in anchors.correction(a, b, spark.createDataFrame([(int(i), int(j), s) for (i, j), s in want.items()], "a long, b long, score double"), b.cells, kw).collect()}
    held = sorted({j for _, j in pairs})
    for c in range(35):
        near = sorted(held, key=lambda j: (np.linalg.norm(y[c] - y[j]), j))[:kw]
        dk = max(np.linalg.norm(y[c] - y[j]) for j in near)
        w, v = [], []
        for j in near:
            for i, jj in pairs:
                if jj == j:
                    w.append(1 - np.exp(-(1 - np.linalg.norm(y[c] - y[j]) / dk) * want[i, 90 + j] / 4))
                    v.append(x[i] - y[j])
        move = np.array(w) @ np.array(v) / sum(w) if sum(w) else 0
        assert np.allclose(got[90 + c], y[c] + move)


def test_correction_by_blocks_copies_no_difference_to_cells(spark, two):
    x, y = two[0][:40], two[1][:60]
    a, b = anchors.Batch(frame(spark, x)), anchors.Batch(frame(spark, y, 90))
    rng = np.random.default_rng(3)
    pairs = {(int(i), int(j)): float(s) for i, j, s in zip(rng.integers(0, 40, 90), rng.integers(0, 30, 90), rng.choice([0.0, 0.3, 1.0], 90))}
    found = spark.createDataFrame([(i, 90 + j, s) for (i, j), s in pairs.items()], "a long, b long, score double")
    out = anchors.correction(a, b, found, b.cells, 8, near_block=50, diff_bytes=1000)
    assert "collect_list" not in out._jdf.queryExecution().toString()  # cells would gather a difference for each of their anchors
    got = {r["id"]: r["vec"] for r in out.collect()}
    held = sorted({j for _, j in pairs})
    for c in range(60):
        near = sorted(held, key=lambda j: (np.linalg.norm(y[c] - y[j]), j))[:8]
        far = np.linalg.norm(y[c] - y[near[-1]])
        w = np.array([1 - np.exp(-(1 - np.linalg.norm(y[c] - y[j]) / far) * s / 4) for (_, j), s in pairs.items() if j in near])
        move = w @ np.array([x[i] - y[j] for i, j in pairs if j in near]) / w.sum() if w.sum() else 0
        assert np.allclose(got[90 + c], y[c] + move)
    still = anchors.correction(a, b, found.withColumn("score", F.lit(0.0)), b.cells, 8)
    assert np.allclose([r["vec"] for r in still.orderBy("id").collect()], y)
    assert np.allclose([r["vec"] for r in anchors.correction(a, b, found.limit(0), b.cells, 8).orderBy("id").collect()], y)


@pytest.mark.parametrize("reduction", ["cca", "rpca"])
def test_batches_mix_and_labels_stay_apart(spark, two, reduction):
    x = np.concatenate(two[:2])
    cells = spark.createDataFrame([(i, "p" if i < 90 else "q", f"k{two[2][i]}", [float(v) for v in row]) for i, row in enumerate(x)], "id long, batch string, label string, vec array<double>")
    out = anchors.integrate_anchors(cells, reduction, dims=5, k_weight=20)
    assert out.count() == 160 and out.where("batch = 'p'").join(cells.withColumnRenamed("vec", "old"), "id").where("vec <> old").count() == 0

    def lisi(df, label):
        near = neighbors.knn(df, df, 15, include_self=False)
        return neighbors.lisi(near, cells, label=label).first()

    assert lisi(out, "batch")["ilisi"] > lisi(cells, "batch")["ilisi"] + 0.2 and lisi(out, "label")["clisi"] > 0.85


def test_awkward_batches(spark):
    cells = spark.createDataFrame([(1, "a", [1.0, 2.0]), (2, "a", [1.0, 3.0]), (3, "b", [5.0, 2.0]), (4, None, [0.0, 0.0]), (5, "b", None)], "id long, batch string, vec array<double>")
    out = anchors.integrate_anchors(cells, "none", k=1, k_weight=5)
    assert {r["id"] for r in out.collect()} == {1, 2, 3}
    assert anchors.integrate_anchors(cells.limit(0)).count() == 0
    with pytest.raises(ValueError, match="unknown reduction"):
        anchors.integrate_anchors(cells, "pls")
