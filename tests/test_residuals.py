"""Regularised negative-binomial residuals against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import residuals


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(9)
    out = {}
    for s, n in (("a", 120), ("b", 60)):
        depth = rng.lognormal(0, 0.5, n)
        rate = rng.gamma(0.5, 2.0, 30)
        x = rng.negative_binomial(3.0, 3.0 / (3.0 + depth[:, None] * rate)).astype(float)
        x[n - 1] = 0  # a cell without counts
        out[s] = x, rng.normal(size=n)
    return out


def frames(spark, data):
    rows = [(s, c, g, x[c, g]) for s, (x, _) in data.items() for c in range(len(x)) for g in range(30) if x[c, g]]
    cells = [(s, c, float(z[c])) for s, (x, z) in data.items() for c in range(len(x))]
    return spark.createDataFrame([(s, c, g, float(v)) for s, c, g, v in rows], "sample string, cell long, gene long, count double"), spark.createDataFrame(cells, "sample string, cell long, mito double")


def plain_fit(x, bins=256, bandwidth=0.3, least=5):
    t, n = x.sum(1), len(x)
    keep = (x > 0).sum(0) >= least
    share, mean = x.sum(0) / x.sum(), x.mean(0)
    mu = t[:, None] * share
    excess = ((x - mu) ** 2).sum(0) - mu.sum(0)
    raw = np.where(excess > 0, np.log10(1 + mean * np.maximum(excess, 0) / (mu**2).sum(0)), 0)
    lm = np.log10(np.where(keep, mean, 1))
    lo, width = lm[keep].min(), (lm[keep].max() - lm[keep].min()) / bins
    at = np.minimum(np.floor((lm - lo) / width), bins - 1)
    w = np.exp(-0.5 * ((at[:, None] - at[None, keep]) * width / bandwidth) ** 2)
    smooth = (w * raw[keep]).sum(1) / w.sum(1)
    return keep, share, mean / np.maximum(10**smooth - 1, 1e-8), n


def test_models_and_residuals_equal_numpy(spark, data):
    counts, cells = frames(spark, data)
    m = residuals.fit_genes(counts, cells)
    got = {(r["sample"], r["gene"]): r for r in m.collect()}
    genes = [3, 0, 17, 29, 999]
    for covariate in (None, "mito"):
        res = {(r["sample"], r["cell"]): r["residual"] for r in residuals.residuals(counts, cells, m, genes, covariate).collect()}
        assert len(res) == 180
        for s, (x, z) in data.items():
            keep, share, theta, n = plain_fit(x)
            assert {g for t, g in got if t == s} == set(np.nonzero(keep)[0])
            assert all(np.isclose(got[s, g]["theta"], theta[g], rtol=1e-6) and np.isclose(got[s, g]["share"], share[g]) for g in np.nonzero(keep)[0])
            mu = x.sum(1)[:, None] * share
            r = np.where(mu > 0, (x - mu) / np.sqrt(np.where(mu > 0, mu + mu**2 / theta, 1)), 0) * keep
            r = np.clip(r, -np.sqrt(n), np.sqrt(n))
            r = np.concatenate([r[:, genes[:4]], np.zeros((n, 1))], 1)
            if covariate:
                a = np.column_stack([np.ones(n), z])
                r = r - a @ np.linalg.lstsq(a, r, rcond=None)[0]
            assert np.allclose([res[s, c] for c in range(n)], r, atol=1e-8)


def test_residuals_of_nothing(spark, data):
    counts, cells = frames(spark, data)
    m = residuals.fit_genes(counts.limit(0), cells)
    assert m.count() == 0
    out = residuals.residuals(counts.limit(0), cells, m, [1, 2], "mito")
    assert out.count() == 180 and out.where(F.exists("residual", lambda v: v != 0)).count() == 0
    assert residuals.residuals(counts, cells.limit(0), m, [1]).count() == 0


def test_rows_of_cells_are_dealt_by_their_number(spark, monkeypatch):
    from tesserae.plans.workspace import Workspace

    parts, save = {}, Workspace.save

    def kept(self, df, name):
        parts[name] = df.rdd.getNumPartitions() if name == "cells" else None
        return save(self, df, name)

    monkeypatch.setattr(Workspace, "save", kept)
    counts = spark.range(4000).selectExpr("concat('s', id % 2) as sample", "id % 400 as cell", "id % 13 as gene", "1 + id % 5 as count")
    got = residuals.fit_genes(counts, counts.select("sample", "cell").distinct(), part_rows=100)
    assert parts["cells"] == 40 and got.count() == 26
