"""Sparse principal components against a dense computation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import decompose, metrics


def dense(rows, n_cells, n_genes, limit):
    x = np.zeros((n_cells, n_genes))
    for c, g, v in rows:
        x[c, g] = v
    sd = x.std(0, ddof=1)
    z = np.where(sd > 0, (x - x.mean(0)) / np.where(sd > 0, sd, 1), 0)
    return np.clip(z, -limit, limit)


@pytest.fixture(scope="module")
def counts():
    rng = np.random.default_rng(4)
    kind = rng.integers(0, 3, 150)
    rows = []
    for c in range(150):
        for g in range(40):
            v = rng.poisson(0.3 + 5 * (g % 3 == kind[c]) * (g < 24))
            if v and c != 149:  # the last cell has no stored value
                rows.append((c, g, float(v)))
    return rows


@pytest.mark.parametrize("limit", [10.0, 1.5])
def test_components_equal_the_dense_ones(spark, counts, limit):
    v = spark.createDataFrame(counts, "cell long, gene long, value double")
    cells = spark.range(150).withColumnRenamed("id", "cell")
    m = metrics.gene_moments(v, 150)
    pcs, loads, variance = decompose.sparse_pca(v, cells, m, k=5, limit=limit, rounds=8)
    z = dense(counts, 150, 40, limit)
    z = z - z.mean(0)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(variance, s[:5] ** 2 / 149, rtol=1e-3)
    got = np.array([r["pc"] for r in pcs.orderBy("cell").collect()])
    assert got.shape == (150, 5)
    for k in range(2):  # the leading components are well apart
        mine, true = got[:, k], u[:, k] * s[k]
        assert min(np.abs(mine - true).max(), np.abs(mine + true).max()) < 0.02 * np.abs(true).max()
    w = np.array([r["loading"] for r in loads.orderBy("gene").collect()])
    assert np.allclose(w.T @ w, np.eye(5), atol=1e-8)
    assert np.allclose(got, z @ w, atol=1e-8)


def test_scaled_parts_cover_zeros(spark, counts):
    v = spark.createDataFrame(counts, "cell long, gene long, value double")
    off, zero = decompose.scaled_parts(v, metrics.gene_moments(v, 150), 2.0)
    z = dense(counts, 150, 40, 2.0)
    base = {r["gene"]: r["zero"] for r in zero.collect()}
    for r in off.collect():
        assert np.isclose(base[r["gene"]] + r["off"], z[r["cell"], r["gene"]])
    assert all(np.isclose(base[g], z[149, g]) for g in base)


def test_selected_genes_only_and_nothing(spark, counts):
    v = spark.createDataFrame(counts, "cell long, gene long, value double")
    cells = spark.range(150).withColumnRenamed("id", "cell")
    m = metrics.gene_moments(v, 150).where("gene < 3")
    pcs, loads, variance = decompose.sparse_pca(v, cells, m, k=10)
    assert len(variance) == 3 and {r["gene"] for r in loads.collect()} == {0, 1, 2} and pcs.count() == 150
    pcs, loads, variance = decompose.sparse_pca(v, cells, m.limit(0))
    assert pcs.count() == 150 and loads.count() == 0 and variance == []
    assert decompose.select_genes(v, m).agg(F.max("gene")).first()[0] == 2
