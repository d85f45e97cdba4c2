"""Kernel density on a grid against numpy; variable genes at the edges."""

import numpy as np
from pyspark.sql import functions as F

from tesserae.operators import density, metrics


def test_density_equals_numpy(spark):
    rng = np.random.default_rng(1)
    p = np.concatenate([rng.normal(size=(200, 2)), rng.normal(3, 0.3, (100, 2))])
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(p)] + [(900, None, 1.0), (901, float("nan"), 0.0), (902, 1.0, float("inf"))]
    got = {r["id"]: r["density"] for r in density.point_density(spark.createDataFrame(rows, "id long, x double, y double").repartition(5), n=30).collect()}
    g, h = [np.linspace(c.min(), c.max(), 30) for c in p.T], [1.06 * min(c.std(ddof=1), np.subtract(*np.quantile(c, [0.75, 0.25])) / 1.34) * 300**-0.2 for c in p.T]
    u, v = (np.exp(-0.5 * ((g[k][:, None] - p[:, k]) / h[k]) ** 2) / np.sqrt(2 * np.pi) / h[k] for k in (0, 1))
    z = u @ v.T / 300
    at = [np.clip(np.searchsorted(g[k], p[:, k], side="right") - 1, 0, 28) for k in (0, 1)]
    assert np.allclose([got[i] for i in range(300)], z[at[0], at[1]]) and got[900] is got[901] is got[902] is None


def test_density_of_too_little(spark):
    few = spark.createDataFrame([(1.0, 2.0)] * 9, "x double, y double")
    flat = spark.createDataFrame([(float(i), 2.0) for i in range(20)], "x double, y double")
    for df in (few, flat, few.limit(0)):
        out = density.point_density(df)
        assert out.count() == df.count() and out.where("density is not null").count() == 0


def test_lone_genes_of_a_bin(spark):
    m = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 4.0), ("c", 90.0, 5.0), ("d", 0.0, 0.0), ("e", 3.0, 0.0)], "gene string, mean double, variance double")
    got = {r["gene"]: r for r in metrics.log_dispersion_genes(m, 10).collect()}
    assert set(got) == {"a", "b", "c"} and got["c"]["z"] == 1.0 and np.isclose(got["b"]["z"], -got["a"]["z"]) and got["c"]["bin"] == 19
    assert metrics.log_dispersion_genes(m.where(F.col("mean") < 0)).count() == 0
