"""Graphs that fit a task: the same clusters or qualities as by rounds over tables, in few jobs."""

import numpy as np
import pyarrow as pa
import pytest

from tesserae.operators import community, integration, small_graphs
from tesserae.plans.workspace import Workspace
from tests.test_community import ring


@pytest.fixture
def saved(monkeypatch):
    names, save = [], Workspace.save

    def counted(self, df, name):
        names.append(name)
        return save(self, df, name)

    monkeypatch.setattr(Workspace, "save", counted)
    return names


def qualities(spark, e, c):
    c = spark.createDataFrame(c.collect(), c.schema)
    assert not any(r["disconnected"] for r in community.disconnected(e, c).collect())
    return {r["resolution"]: r["modularity"] for r in community.modularities(e, c).collect()}, c.count()


def test_a_small_graph_takes_few_written_tables(spark, saved):
    rng = np.random.default_rng(0)
    e = spark.createDataFrame([(i, int(j)) for i in range(400) for j in (i // 40 * 40 + rng.integers(0, 40, 6))], "query long, neighbour long")
    c = community.leiden(e, [0.2, 1.0, 4.0])
    assert len(saved) <= 4
    q, n = qualities(spark, e, c)
    assert n == 1200 and q[1.0] > 0.85
    saved.clear()
    moved = integration.modularity_clusters(e)
    assert len(saved) <= 5 and q[1.0] >= integration.modularity(e, moved).first()[0]


def test_levels_over_tables_are_finished_in_tasks(spark, saved):
    e = ring(spark)
    c = community.leiden(e, [0.5, 1.0], in_task=200)  # 384 directed edges at first, then fewer
    assert any(x.startswith("move") for x in saved) and any(x.startswith("rest") for x in saved)
    whole = community.leiden(e, [0.5, 1.0])
    (q, n), (best, m) = qualities(spark, e, c), qualities(spark, e, whole)
    assert n == m == 144 and all(abs(q[r] - best[r]) < 0.05 for r in best)


def test_local_moves_equal_those_over_tables(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(j)) for i in range(300) for j in rng.integers(0, 300, 2)] + [(i, i // 30 * 30) for i in range(300)] + [(0, 0), (1, 2), (2, 1)]
    e = spark.createDataFrame(rows, "query long, neighbour long")
    one, many = ({tuple(r) for r in integration.modularity_clusters(e, 1.3, 4, n).collect()} for n in (small_graphs.MOST, 0))
    assert one == many and len(one) == 300


def test_splits_equal_those_over_tables(spark):
    e = spark.createDataFrame([("a", "b"), ("c", "d"), ("b", "e"), ("e", "c"), ("x", "a")], "query string, neighbour string")
    c = spark.createDataFrame([(1.0, n, 1.0, "q" if n in "abcd" else n) for n in "abcdez"], "res double, node string, k double, cluster string")
    got = []
    for n in (small_graphs.MOST, 0):
        run = community.Leiden(community.undirected(e), [1.0], in_task=n)
        got.append({(r["node"], r["cluster"]) for r in run.connected(run.graph, c.where("node <> 'z'")).collect()})
    assert got[0] == got[1] == {("a", "a"), ("b", "a"), ("c", "c"), ("d", "c"), ("e", "e")}


def test_components_and_bare_nodes():
    assert small_graphs.components(7, np.array([6, 4, 1, 0]), np.array([4, 2, 5, 3])).tolist() == [0, 1, 2, 0, 2, 1, 2]
    nodes = pa.table({"res": [1.0, 1.0], "node": [9, 7], "k": [2.0, 2.0], "cluster": [3, 3]})
    none = pa.table({"res": pa.array([], pa.float64()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "w": pa.array([], pa.float64())})
    assert small_graphs.leiden(4.0)(nodes, none).to_pydict() == {"res": [1.0, 1.0], "node": [7, 9], "cluster": [7, 9]}
    assert small_graphs.connected(nodes, none)["cluster"].to_pylist() == [7, 9]


def test_large_and_small_weights_end():
    for w in (1e12, 1.0, 1e-9):
        rng = np.random.default_rng(2)
        a, b = np.unique(np.sort(rng.integers(0, 60, (300, 2)), axis=1), axis=0).T
        a, b = a[a < b], b[a < b]
        x = w * rng.random(len(a))
        k = np.bincount(a, x, 60) + np.bincount(b, x, 60)
        nodes = pa.table({"res": np.ones(60), "node": np.arange(60), "k": k, "cluster": np.arange(60)})
        edges = pa.table({"res": np.ones(len(a)), "a": a, "b": b, "w": x})
        c = np.array(small_graphs.leiden(k.sum())(nodes, edges)["cluster"].to_pylist())
        inside = 2 * x[c[a] == c[b]].sum() / k.sum() - (np.bincount(c, k) ** 2).sum() / k.sum() ** 2
        assert inside > 0.2
