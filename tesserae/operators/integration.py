"""Graph clustering by modularity, integration features, mutual neighbours, and batch correction of embeddings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.operators import small_graphs
from tesserae.operators.neighbors import knn
from tesserae.plans.workspace import Workspace


def modularity_clusters(edges: DataFrame, resolution: float = 1.0, rounds: int = 12, in_task: int = small_graphs.MOST) -> DataFrame:
    """(node, cluster) of an undirected graph ``edges(query, neighbour)`` by local moves that raise modularity.

    In each round the nodes of one hash half join the neighbouring cluster of greatest gain, ties to the smaller id;
    halves take turns so that neighbours do not swap forever. Weights are summed before they are compared, and a node
    compares as many clusters as its neighbours have. Graphs of at most ``in_task`` directed edges take their rounds in one task.
    Not Leiden: compare results by agreement scores, not by name.
    """
    ws = Workspace(edges.sparkSession, "clusters")
    e = edges.where("query <> neighbour").select(F.col("query").alias("a"), F.col("neighbour").alias("b"))
    e = ws.save(e.union(e.select("b", "a")).groupBy("a", "b").agg(F.count("*").cast("double").alias("w")), "edges")
    deg = ws.save(e.groupBy("a").agg(F.sum("w").alias("k")), "degrees")
    m2 = deg.agg(F.sum("k")).first()[0] or 1.0
    if e.count() <= in_task:
        res, kind = F.lit(float(resolution)).alias("res"), dict(deg.dtypes)["a"]
        nodes = deg.select(res, F.col("a").alias("node"), "k", F.pmod(F.xxhash64("a"), F.lit(2)).alias("turn"))
        cur = small_graphs.by_resolution(nodes, e.select(res, "a", "b", "w"), small_graphs.local_moves(m2, rounds), f"node {kind}, cluster {kind}, k double", 1)
        return _ranked(ws.save(cur, "moved"))
    # with an edge of weight 0 to itself, a node gets its own state and its neighbours' by one join and one exchange
    e = ws.save(e.join(deg, "a").unionByName(deg.select("a", F.col("a").alias("b"), F.lit(0.0).alias("w"), "k")), "around")
    cur = ws.save(deg.select(F.col("a").alias("node"), F.col("a").alias("cluster"), "k"), "c0")
    for i in range(rounds):
        size = cur.groupBy("cluster").agg(F.sum("k").alias("kc"))
        turn = F.pmod(F.xxhash64("node"), F.lit(2)) == i % 2
        x = e.join(cur.select(F.col("node").alias("b"), "cluster").join(size, "cluster"), "b").repartition("a")
        x = x.groupBy(F.col("a").alias("node"), "cluster").agg(F.sum("w").alias("w"), F.first("k").alias("k"), F.first("kc").alias("kc"), F.max(F.col("a") == F.col("b")).alias("stay"))
        gain = F.round(F.col("w") - F.lit(resolution) * F.col("k") * (F.col("kc") - F.when(F.col("stay"), F.col("k")).otherwise(0.0)) / F.lit(m2), 9)
        best = x.groupBy("node").agg(F.first("k").alias("k"), F.max(F.when(F.col("stay"), F.col("cluster"))).alias("mine"), F.max_by("cluster", F.struct(gain.alias("g"), F.col("stay"), (-F.col("cluster")).alias("c"))).alias("to"))
        cur = ws.save(best.select("node", F.when(turn, F.col("to")).otherwise(F.col("mine")).alias("cluster"), "k"), f"c{i + 1}")
        ws.drop(f"c{i}")
    return _ranked(cur)


def _ranked(cur: DataFrame) -> DataFrame:
    """(node, cluster), clusters numbered from '0' by falling size."""
    w = F.dense_rank().over(Window.orderBy(F.desc("n"), "cluster")) - 1
    rank = cur.groupBy("cluster").agg(F.count("*").alias("n")).select("cluster", w.alias("rank"))
    return cur.join(rank, "cluster").select("node", F.col("rank").cast("string").alias("cluster"))


def modularity(edges: DataFrame, clusters: DataFrame, resolution: float = 1.0) -> DataFrame:
    """One row ``modularity`` of a clustering."""
    e = edges.where("query <> neighbour").select(F.col("query").alias("a"), F.col("neighbour").alias("b"))
    e = e.union(e.select("b", "a"))
    c = clusters.select("node", "cluster")
    x = e.join(c.toDF("a", "ca"), "a").join(c.toDF("b", "cb"), "b")
    inside = x.agg(F.count_if(F.col("ca") == F.col("cb")).cast("double").alias("i"), F.count("*").cast("double").alias("m2"))
    deg = x.groupBy("ca").agg(F.count("*").cast("double").alias("k")).agg(F.sum(F.col("k") * F.col("k")).alias("kk"))
    return inside.join(F.broadcast(deg)).select((F.col("i") / F.col("m2") - F.lit(resolution) * F.col("kk") / (F.col("m2") * F.col("m2"))).alias("modularity"))


def integration_features(dispersions: DataFrame, top: int = 2500) -> DataFrame:
    """(gene, n_samples, median_rank): genes of ``dispersions(sample, gene, dispersion)`` that rank among the ``top`` of
    most samples, then by median rank, then by name."""
    w = Window.partitionBy("sample").orderBy(F.desc("dispersion"), "gene")
    r = dispersions.withColumn("r", F.row_number().over(w)).where(F.col("r") <= top)
    out = r.groupBy("gene").agg(F.count("*").alias("n_samples"), F.median("r").alias("median_rank"))
    return out.orderBy(F.desc("n_samples"), "median_rank", "gene").limit(top)


def mutual_neighbours(a: DataFrame, b: DataFrame, k: int = 5) -> DataFrame:
    """(a, b, dist): pairs of two batches ``(id, vec)`` that are among each other's ``k`` nearest."""
    ab = knn(a, b, k).select(F.col("query").alias("a"), F.col("neighbour").alias("b"), "dist")
    ba = knn(b, a, k).select(F.col("query").alias("b"), F.col("neighbour").alias("a"))
    return ab.join(ba, ["a", "b"])


def correct_batches(cells: DataFrame, clusters: int = 10, rounds: int = 5, theta: float = 2.0, sigma: float = 0.1, ridge: float = 1.0, seed: int = 42) -> DataFrame:
    """``cells(id, batch, vec)`` with ``vec`` corrected for batch by soft clusters, in the manner of Harmony.

    Each round assigns cells softly to ``clusters`` centroids by cosine distance, favouring clusters where the cell's
    batch is scarce, then takes off, cluster by cluster, a ridge-shrunk offset of the batch. Tasks send sums per cluster
    and batch (a table whose size does not depend on the cells); the centroids start from cells drawn by hash.
    """
    spark = cells.sparkSession
    ws = Workspace(spark, "harmony")
    kinds = dict(cells.dtypes)
    cur = ws.save(cells.select("id", "batch", F.col("vec").cast("array<double>").alias("vec")), "v0")
    start = cur.orderBy(F.xxhash64(F.col("id"), F.lit(seed))).limit(clusters).collect()
    share = {r["batch"]: r["count"] for r in cur.groupBy("batch").count().collect()}
    n = max(sum(share.values()), 1)
    share = {b: c / n for b, c in share.items()}
    y = np.array([r["vec"] for r in start])
    observed: dict = {}

    def soft(x: np.ndarray, batch: pd.Series, y: np.ndarray, observed: dict) -> np.ndarray:
        unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        c = y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
        logit = -2 * (1 - unit @ c.T) / sigma
        if observed:
            size = sum(observed.values())
            for b in batch.unique():
                logit[(batch == b).to_numpy()] += theta * np.log((share[b] * size + 1) / (observed.get(b, np.zeros(len(y))) + 1))
        r = np.exp(logit - logit.max(1, keepdims=True))
        return r / r.sum(1, keepdims=True)

    if not start:
        return cur
    for i in range(rounds):
        state = spark.sparkContext.broadcast((y, observed))

        def sums(frames, state=state):
            for pdf in frames:
                x = np.stack(pdf["vec"].to_numpy())
                r = soft(x, pdf["batch"], *state.value)
                for b in pdf["batch"].unique():
                    at = (pdf["batch"] == b).to_numpy()
                    s = r[at].T @ x[at]
                    yield pd.DataFrame({"batch": b, "k": np.arange(len(s)), "w": r[at].sum(0), "s": list(s)})

        part = cur.mapInPandas(sums, f"batch {kinds['batch']}, k int, w double, s array<double>")
        flat = part.select("batch", "k", "w", F.posexplode("s").alias("d", "s")).groupBy("batch", "k", "d").agg(F.sum("w").alias("w"), F.sum("s").alias("s")).collect()
        w = {b: np.zeros(len(y)) for b in share}
        s = {b: np.zeros_like(y) for b in share}
        for row in flat:
            w[row["batch"]][row["k"]] = row["w"]
            s[row["batch"]][row["k"], row["d"]] = row["s"]
        total = sum(w.values())
        centre = sum(s.values()) / np.maximum(total, 1e-9)[:, None]
        shift = {b: (s[b] - w[b][:, None] * centre) / (w[b] + ridge)[:, None] for b in share}
        fix = spark.sparkContext.broadcast((y, observed, shift))

        def apply(frames, fix=fix):
            y0, obs, move = fix.value
            for pdf in frames:
                x = np.stack(pdf["vec"].to_numpy())
                r = soft(x, pdf["batch"], y0, obs)
                for b in pdf["batch"].unique():
                    at = (pdf["batch"] == b).to_numpy()
                    x[at] -= r[at] @ move[b]
                yield pdf.assign(vec=list(x))

        cur = ws.save(cur.mapInPandas(apply, f"id {kinds['id']}, batch {kinds['batch']}, vec array<double>"), f"v{i + 1}")
        ws.drop(f"v{i}")
        y, observed = centre, w
    return cur


def integrable(cells: DataFrame, batch: str, least: int = 2) -> str | None:
    """Why cells cannot be integrated, or None."""
    n = cells.agg(F.count("*").alias("n"), F.count_distinct(F.nullif(F.trim(F.col(batch).cast("string")), F.lit(""))).alias("b")).first()
    return "no cells" if not n["n"] else f"fewer than {least} batches in {batch}" if n["b"] < least else None
