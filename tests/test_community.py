"""Leiden clustering at many resolutions, and the choice among them."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import community, integration, neighbors


def ring(spark, cliques=12, size=6):
    """Cliques in a ring, each tied to the next by one edge."""
    rows = [(c * size + i, c * size + j) for c in range(cliques) for i in range(size) for j in range(i)]
    rows += [(c * size, (c + 1) % cliques * size + 1) for c in range(cliques)]
    return spark.createDataFrame(rows, "query long, neighbour long")


def plain_modularity(edges, cluster, resolution):
    w = Counter()
    for a, b in edges:
        if a != b:
            w[a, b] += 1
            w[b, a] += 1
    m2, k = sum(w.values()), Counter()
    for (a, _), x in w.items():
        k[cluster[a]] += x
    return sum(x for (a, b), x in w.items() if cluster[a] == cluster[b]) / m2 - resolution * sum(x * x for x in k.values()) / m2**2


def test_cliques_are_found(spark):
    e = ring(spark)
    c = community.leiden(e, [1.0])
    got = {r["node"]: r["cluster"] for r in c.collect()}
    assert len(got) == 72 and all(len({got[k * 6 + i] for i in range(6)}) == 1 for k in range(12)) and len(set(got.values())) >= 6
    assert {r["disconnected"] for r in community.disconnected(e, c).collect()} == {0}


@pytest.fixture(scope="module")
def graph(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(scale=0.5, size=4) + np.eye(4)[i % 4] * (3 + i % 3)]) for i in range(240)]
    v = spark.createDataFrame(rows, "id long, vec array<double>")
    e = neighbors.knn(v, v, 8, include_self=False).select("query", "neighbour")
    return spark.createDataFrame(e.collect(), e.schema)


def test_sweep_holds_together_and_beats_local_moves(spark, graph):
    c = community.leiden(graph, [0.2, 1.0, 3.0])
    c = spark.createDataFrame(c.collect(), c.schema)
    q = {r["resolution"]: r["modularity"] for r in community.modularities(graph, c).collect()}
    n = {r["resolution"]: r["n_clusters"] for r in community.cluster_counts(c).collect()}
    assert n[0.2] <= n[1.0] < n[3.0] and sum(r["disconnected"] for r in community.disconnected(graph, c).collect()) == 0
    edges = [tuple(r) for r in graph.collect()]
    for r in q:
        named = {x["node"]: x["cluster"] for x in c.where(F.col("resolution") == r).collect()}
        assert len(named) == 240 and math.isclose(q[r], plain_modularity(edges, named, r), abs_tol=1e-9)
    old = integration.modularity(graph, integration.modularity_clusters(graph)).first()["modularity"]
    assert q[1.0] >= old - 1e-9
    sizes = Counter(x["cluster"] for x in c.where("resolution = 1.0").collect())
    assert [sizes[str(i)] for i in range(len(sizes))] == sorted(sizes.values(), reverse=True)


def test_disconnected_clusters_are_counted(spark):
    e = spark.createDataFrame([(1, 2), (3, 4), (2, 5), (5, 3)], "query long, neighbour long")
    c = spark.createDataFrame([(1.0, 1, "a"), (1.0, 2, "a"), (1.0, 3, "a"), (1.0, 4, "a"), (1.0, 5, "b"), (2.0, 1, "a"), (2.0, 2, "a"), (2.0, 3, "b"), (2.0, 4, "b"), (2.0, 5, "b")], "resolution double, node long, cluster string")
    assert {r["resolution"]: r["disconnected"] for r in community.disconnected(e, c).collect()} == {1.0: 1, 2.0: 0}


def test_awkward_graphs(spark):
    none = spark.createDataFrame([], "query long, neighbour long")
    assert community.leiden(none, [1.0]).count() == 0
    loops = spark.createDataFrame([(1, 1), (2, 3), (3, 2), (2, 3)], "query long, neighbour long")
    assert {(r["node"], r["cluster"]) for r in community.leiden(loops, [1.0]).collect()} == {(2, "0"), (3, "0")}
    weighted = spark.createDataFrame([("a", "b", 5.0), ("b", "c", 0.1), ("c", "d", 5.0)], "query string, neighbour string, weight double")
    got = {r["node"]: r["cluster"] for r in community.leiden(weighted, [1.0]).collect()}
    assert got["a"] == got["b"] != got["c"] == got["d"]


def test_resolution_by_nmi(spark):
    rows = [(r, i, str(i % 4 if r == 1.0 else i % 2 if r == 0.5 else i)) for r in (0.5, 1.0, 2.0) for i in range(40)]
    c = spark.createDataFrame(rows, "resolution double, node long, cluster string")
    lab = spark.createDataFrame([(i, f"t{i % 4}" if i != 7 else None) for i in range(40)], "node long, label string")
    got = {r["resolution"]: r for r in community.resolution_by_nmi(c, lab).collect()}
    assert got[1.0]["best"] and math.isclose(got[1.0]["nmi"], 1.0) and not got[0.5]["best"] and got[0.5]["nmi"] < 1


def test_a_round_of_moves_needs_few_exchanges(spark, monkeypatch):
    e = spark.createDataFrame([(i, (i * 7 + j) % 40) for i in range(40) for j in (1, 2, 3)], "query long, neighbour long")
    seen, save = [], community.Leiden._counted

    def counted(self, df, name, flag):
        seen.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return save(self, df, name, flag)

    monkeypatch.setattr(community.Leiden, "_counted", counted)
    run = community.Leiden(community.undirected(e), [0.5, 1.0], most=2)
    assert run.move(run.graph, run.start).count() == 80
    assert len(seen) == 2 and max(seen) <= 3
