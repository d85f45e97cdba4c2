"""Connected components by alternating large-star and small-star, on edge tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace


def _digest(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.shiftright(F.xxhash64("a", "b"), 20)).alias("h")).first()
    return r["n"], r["h"] or 0


def connected_components(ws: Workspace, edges: DataFrame, tag: str, max_rounds: int = 64) -> DataFrame:
    """``edges(a, b)`` of integers -> ``(node, component)``: a row for each node of an edge, the smallest node reachable.

    Each star operation takes a node's least neighbour by a map-side combined minimum and joins it back to the edges;
    both sides of that join come from written tables, so a hub's edges can be split. Self-loops, nulls, repeated and
    reversed edges are allowed and change nothing; without edges the result is empty.
    """
    clean = edges.where("a is not null and b is not null and a <> b")
    cur = ws.save(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{tag}-e0")
    state = _digest(cur)
    if not state[0]:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for i in range(max_rounds):
        # large-star: every larger neighbour of u moves to the least of u and its neighbours
        both = cur.union(cur.select("b", "a"))
        least = ws.save(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), f"{tag}-l{i}")
        big = ws.save(both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"{tag}-b{i}")
        # small-star: u and its smaller neighbours move to the least of them
        low = ws.save(big.groupBy("a").agg(F.min("b").alias("m")), f"{tag}-s{i}")
        moved = big.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        nxt = ws.save(moved.union(low.select("a", F.col("m").alias("b"))).distinct(), f"{tag}-e{i + 1}")
        new = _digest(nxt)
        ws.drop(f"{tag}-e{i}", f"{tag}-l{i}", f"{tag}-b{i}", f"{tag}-s{i}")
        cur, done, state = nxt, new == state, new
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return ws.save(cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots), f"{tag}-cc")
