"""Doublet scores on planted doublets."""

import numpy as np

from tesserae.operators import doublets


def auc(y, s):
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_both_scorers_find_planted_doublets(spark):
    rng = np.random.default_rng(12)
    centres = rng.normal(scale=2.2, size=(5, 8))
    rows, planted = [], {}
    for b, n in (("p", 260), ("q", 160)):
        kinds = rng.choice(5, n, p=[0.35, 0.3, 0.2, 0.1, 0.05])
        x = centres[kinds] + rng.normal(size=(n, 8)) * rng.uniform(0.6, 1.3, (n, 1))
        for i in range(n):
            two = i < n // 10
            v = (x[i] + x[rng.choice(np.nonzero(kinds != kinds[i])[0])]) / 2 if two else x[i]
            planted[f"{b}{i}"] = int(two)
            rows.append((b, f"{b}{i}", [float(k) for k in v]))
    latent = spark.createDataFrame(rows, "batch string, cell_id string, vec array<double>")
    y = np.array([planted[r[1]] for r in rows])
    got = {}
    for name, df in (("share", doublets.score_doublets(latent, "batch", 0.1)), ("boosted", doublets.boosted_doublets(latent, "batch", 0.1, trees=12))):
        out = {r["cell_id"]: r for r in df.collect()}
        assert len(out) == len(rows) and {r["class"] for r in out.values()} == {"singlet", "doublet"}
        got[name] = auc(y, np.array([out[r[1]]["score"] for r in rows]))
        assert sum(r["class"] == "doublet" for r in out.values()) <= 0.11 * len(rows)
    assert got["share"] > 0.85 and got["boosted"] > 0.85, got


def test_boosted_scores_of_too_little(spark):
    one = spark.createDataFrame([("p", "a", [1.0, 2.0])], "batch string, cell_id string, vec array<double>")
    assert [r["class"] for r in doublets.boosted_doublets(one, "batch", 0.1, trees=1).collect()] == ["singlet"]
    assert doublets.boosted_doublets(one.limit(0), "batch", 0.1).count() == 0
