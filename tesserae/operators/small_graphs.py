"""Graphs that fit one task: Leiden levels, local moves and components of each resolution, in memory.

Rounds over tables cost a few Spark jobs each, however small the graph. A graph of at most ``MOST`` edges and nodes a resolution is
dealt out instead, one task a resolution; larger ones are brought down to that by rounds over tables (``community``).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Directed edges, and nodes, of a resolution.
MOST = 4 << 20


def by_resolution(nodes: DataFrame, edges: DataFrame, solve: Callable[[pa.Table, pa.Table], pa.Table], schema: str, resolutions: int) -> DataFrame:
    """``solve`` over ``nodes(res, node, ...)`` and ``edges(res, a, b, ...)`` of each resolution, each edge given in one direction. There
    are many partitions for each resolution: Spark packs partitions by bytes and would give one task several. A resolution of edges
    has nodes."""
    apart = max(resolutions, min(16 * resolutions, 256))
    n, e = (df.repartition(apart, "res").groupBy("res") for df in (nodes, edges.where("a < b")))
    return n.cogroup(e).applyInArrow(solve, schema)


def _numbered(nodes: pa.Table, edges: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes in their order, and the edges' ends as numbers in it with the edges' places; edges to other nodes are left out."""
    nodes = nodes.sort_by("node").combine_chunks()
    ids = nodes["node"].combine_chunks()
    a, b = (pc.fill_null(pc.index_in(edges[c], value_set=ids), -1).to_numpy().astype(np.int64) for c in "ab")
    at = np.flatnonzero((a >= 0) & (b >= 0))
    return nodes, a[at], b[at], at


def _distinct(key: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their summed weights."""
    if not len(key):
        return key, w
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(w[order], first)


class _Graph:
    """Rows of neighbours of nodes 0 to n - 1, both directions."""

    def __init__(self, k: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray):
        self.k, n = k, len(k)
        key, self.w = _distinct(a * n + b, w)
        self.a, self.b = (key // n).astype(np.int32), (key % n).astype(np.int32)
        self.start = np.r_[0, np.bincount(self.a, minlength=n).cumsum()].tolist()

    def near(self, v: int) -> tuple[list[int], list[float]]:
        i, j = self.start[v], self.start[v + 1]
        return self.b[i:j].tolist(), self.w[i:j].tolist()

    def contract(self, part: np.ndarray, n: int) -> _Graph:
        a, b = part[self.a], part[self.b]
        out = a != b
        return _Graph(np.bincount(part, self.k, n), a[out], b[out], self.w[out])


def _move(g: _Graph, cluster: np.ndarray, scale: float, order: np.ndarray) -> np.ndarray:
    """Moves of single nodes to the neighbouring or an empty cluster of greatest gain, until none gains; a move calls up the neighbours."""
    n, k = len(g.k), g.k.tolist()
    total, rows = np.bincount(cluster, g.k, n).tolist(), np.bincount(cluster, minlength=n).tolist()
    cluster, free = cluster.tolist(), [c for c in range(n) if not rows[c]]
    queue, queued = deque(order.tolist()), bytearray(b"\1") * n
    while queue:
        v = queue.popleft()
        queued[v] = 0
        near, weights = g.near(v)
        own, kv, beside = cluster[v], k[v], {}
        for u, x in zip(near, weights, strict=True):
            c = cluster[u]
            beside[c] = beside.get(c, 0.0) + x
        total[own] -= kv
        to, best, least = own, beside.get(own, 0.0) - scale * kv * total[own], 1e-9 * kv
        for c, x in beside.items():
            gain = x - scale * kv * total[c]
            if gain > best + least:
                to, best = c, gain
        if best < -least and rows[own] > 1:
            to = free.pop()
            total[to] = 0.0
        total[to] += kv
        if to != own:
            cluster[v] = to
            rows[own], rows[to] = rows[own] - 1, rows[to] + 1
            if not rows[own]:
                free.append(own)
            for u in near:
                if not queued[u] and cluster[u] != to:
                    queued[u] = 1
                    queue.append(u)
    return np.array(cluster, np.int64)


def _refine(g: _Graph, cluster: np.ndarray, scale: float, order: np.ndarray) -> np.ndarray:
    """Connected parts of each cluster: a node alone joins the part of greatest gain that it touches in its cluster, if both are well
    connected to the rest of it."""
    n, k, inner = len(g.k), g.k.tolist(), cluster[g.a] == cluster[g.b]
    whole, out = np.bincount(cluster, g.k, n).tolist(), np.bincount(g.a[inner], g.w[inner], n).tolist()
    cluster, part, kp, rows = cluster.tolist(), list(range(n)), list(k), [1] * n

    def well(p: int, c: int) -> bool:
        return out[p] >= scale * kp[p] * (whole[c] - kp[p]) - 1e-9 * kp[p]

    for v in order.tolist():
        c, kv = cluster[v], k[v]
        if rows[v] != 1 or not well(v, c):
            continue
        beside: dict[int, float] = {}
        for u, x in zip(*g.near(v), strict=True):
            if cluster[u] == c:
                p = part[u]
                beside[p] = beside.get(p, 0.0) + x
        to, best = v, 1e-9 * kv
        for p, x in beside.items():
            gain = x - scale * kv * kp[p]
            if gain > best and well(p, c):
                to, best = p, gain
        if to != v:
            part[v], rows[v] = to, 0
            rows[to], kp[to], out[to] = rows[to] + 1, kp[to] + kv, out[to] + out[v] - 2 * beside[to]
    return np.array(part, np.int64)


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of ``n`` nodes the least that it is connected with."""
    low = np.arange(n)
    while True:
        x, y = low[a], low[b]
        apart = x != y
        if not apart.any():
            return low
        np.minimum.at(low, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (low != low[low]).any():
            low = low[low]


def leiden(m2: float):
    """Task of Leiden's levels from the clusters in ``nodes(res, node, k, cluster)`` on; clusters are connected and named by their least node."""

    def solve(nodes: pa.Table, edges: pa.Table) -> pa.Table:
        nodes, a, b, at = _numbered(nodes, edges)
        n, w = len(nodes), edges["w"].to_numpy()[at]
        g = _Graph(nodes["k"].to_numpy(), np.r_[a, b], np.r_[b, a], np.r_[w, w])
        scale, draw, place = nodes["res"][0].as_py() / m2, np.random.default_rng(0), np.arange(n)
        cluster = nodes["cluster"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        while True:
            cluster = _move(g, cluster, scale, draw.permutation(len(g.k)))
            kept, part = np.unique(_refine(g, cluster, scale, draw.permutation(len(g.k))), return_inverse=True)
            if len(kept) == len(part):
                break
            place, g = part[place], g.contract(part, len(kept))
            cluster = np.unique(cluster[kept], return_inverse=True)[1]
        inner = cluster[g.a] == cluster[g.b]
        found = components(len(g.k), g.a[inner], g.b[inner])[place]
        least = np.full(len(g.k), n)
        np.minimum.at(least, found, np.arange(n))
        return pa.table({"res": nodes["res"], "node": nodes["node"], "cluster": nodes["node"].combine_chunks().take(pa.array(least[found]))})

    return solve


def connected(nodes: pa.Table, edges: pa.Table) -> pa.Table:
    """Task that splits the clusters of ``nodes(res, node, k, cluster)`` into their components, named by their least node."""
    nodes, a, b, _ = _numbered(nodes, edges)
    cluster = nodes["cluster"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    inner = cluster[a] == cluster[b]
    low = components(len(nodes), a[inner], b[inner])
    return nodes.select(["res", "node", "k"]).append_column("cluster", nodes["node"].combine_chunks().take(pa.array(low)))


def local_moves(m2: float, rounds: int):
    """Task of the rounds of ``integration.modularity_clusters`` over ``nodes(res, node, k, turn)``."""

    def solve(nodes: pa.Table, edges: pa.Table) -> pa.Table:
        nodes, a, b, at = _numbered(nodes, edges)
        n, k, turn, w = len(nodes), nodes["k"].to_numpy(), nodes["turn"].to_numpy(), edges["w"].to_numpy()[at]
        own, cluster, scale = np.arange(n), np.arange(n), nodes["res"][0].as_py()
        a, b, w = np.r_[a, b, own], np.r_[b, a, own], np.r_[w, w, np.zeros(n)]
        for i in range(rounds):
            total = np.bincount(cluster, k, n)
            key, beside = _distinct(a * n + cluster[b], w)
            node, to = np.divmod(key, n)
            stay = to == cluster[node]
            gain = np.round(beside - scale * k[node] * (total[to] - np.where(stay, k[node], 0.0)) / m2, 9)
            # rows are in the order of node and cluster, and each node has one of its own cluster
            best = np.maximum.reduceat(gain, np.searchsorted(node, own))[node] == gain
            good = np.flatnonzero(best)
            least = to[good[np.searchsorted(node[good], own)]]
            least[node[best & stay]] = cluster[node[best & stay]]
            cluster = np.where(turn == i % 2, least, cluster)
        return pa.table({"node": nodes["node"], "cluster": nodes["node"].combine_chunks().take(pa.array(cluster)), "k": nodes["k"]})

    return solve
