"""Leiden clustering of one graph at many resolutions at once, and the choice among them.

All state is keyed by ``(res, node)``, so a round of joins serves every resolution. A level moves nodes until nothing moves,
refines each community from single nodes into connected parts, and contracts the parts to the nodes of the next level. From the
level on whose graphs fit a task each, a task a resolution does the rest (``small_graphs``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tesserae.operators import small_graphs
from tesserae.plans.workspace import Workspace


def undirected(edges: DataFrame) -> DataFrame:
    """(a, b, w) in both directions from ``edges(query, neighbour[, weight])``; repeated edges add up, self-loops go."""
    w = F.col("weight").cast("double") if "weight" in edges.columns else F.lit(1.0)
    e = edges.where("query <> neighbour").select(F.col("query").alias("a"), F.col("neighbour").alias("b"), w.alias("w"))
    return e.union(e.select("b", "a", "w")).groupBy("a", "b").agg(F.sum("w").alias("w"))


def _turn(key: str, i: int) -> Column:
    """A fair coin for each (res, key): thrown anew every second round, and turned over in the round between."""
    return F.pmod(F.xxhash64("res", key, F.lit(i // 2)), F.lit(2)) == i % 2


class Leiden:
    """One run; ``graph(a, b, w)`` is symmetric and, at the first level, shared by all resolutions. Graphs of at most ``in_task``
    directed edges and nodes a resolution are finished in a task each."""

    def __init__(self, graph: DataFrame, resolutions: list[float], most: int = 16, tolerance: float = 0.02, in_task: int = small_graphs.MOST):
        self.ws, self.in_task = Workspace(graph.sparkSession, "leiden"), in_task
        self.graph = self.ws.save(graph, "graph")
        self.resolutions, self.most, self.tolerance = sorted({float(r) for r in resolutions}), most, tolerance
        deg = self.ws.save(self.graph.groupBy("a").agg(F.sum("w").alias("k")), "degrees")
        self.m2 = deg.agg(F.sum("k")).first()[0] or 1.0
        self.start = deg.withColumn("res", F.explode(F.array(*map(F.lit, self.resolutions)))).select("res", F.col("a").alias("node"), "k", F.col("a").alias("cluster"))
        self.step = 0

    def _save(self, df: DataFrame, name: str) -> DataFrame:
        self.step += 1
        return self.ws.save(df, f"{name}-{self.step}")

    def _counted(self, df: DataFrame, name: str, flag: str) -> tuple[DataFrame, int, int]:
        """The saved table, its rows, and the rows whose ``flag`` is set, counted as they are written."""
        seen = Observation()
        out = self._save(df.observe(seen, F.count("*").alias("n"), F.count_if(flag).alias("k")), name)
        return out, seen.get["n"], seen.get["k"]

    def _small(self, edges: DataFrame, nodes: DataFrame) -> bool:
        """Whether the graph of each resolution fits a task."""

        def most(df: DataFrame) -> int:
            return df.groupBy("res").count().agg(F.max("count")).first()[0] or 0 if "res" in df.columns else df.count()

        return most(edges) <= self.in_task and most(nodes) <= self.in_task

    def _each(self, edges: DataFrame) -> DataFrame:
        """Edges of each resolution."""
        return edges if "res" in edges.columns else edges.withColumn("res", F.explode(F.array(*map(F.lit, self.resolutions))))

    def _in_tasks(self, edges: DataFrame, cur: DataFrame, solve, columns: list[str], name: str) -> DataFrame:
        kind = dict(cur.dtypes) | {"cluster": dict(cur.dtypes)["node"]}
        out = small_graphs.by_resolution(cur.select("res", "node", "k", "cluster"), self._each(edges).select("res", "a", "b", "w"), solve, ", ".join(f"{c} {kind[c]}" for c in columns), len(self.resolutions))
        return self._save(out, name)

    def _beside(self, edges: DataFrame, cur: DataFrame, column: str) -> DataFrame:
        """(res, node, column, w): weight from each node to each value of ``column`` of its neighbours, itself left out."""
        far = cur.select("res", F.col("node").alias("b"), column)
        x = edges.join(far, ["res", "b"] if "res" in edges.columns else "b")
        return x.groupBy("res", F.col("a").alias("node"), column).agg(F.sum("w").alias("w"))

    def _expected(self, k: str, total: Column) -> Column:
        return F.col("res") * F.col(k) * total / F.lit(self.m2)

    def _with_self(self, edges: DataFrame, cur: DataFrame, name: str) -> DataFrame:
        """Edges with the degree ``k`` of their first node, and an edge of weight 0 from each node to itself, so that one join and
        one exchange bring a node its neighbours' state and its own."""
        own = cur.select("res", F.col("node").alias("a"), "k")
        if "res" not in edges.columns:
            own = own.where(F.col("res") == F.lit(self.resolutions[0])).drop("res")
        keys = ["res", "a"] if "res" in edges.columns else ["a"]
        e = edges.select(*keys, "b", "w").join(own, keys)
        return self._save(e.unionByName(own.select(*keys, F.col("a").alias("b"), F.lit(0.0).alias("w"), "k")), name)

    def move(self, edges: DataFrame, cur: DataFrame) -> DataFrame:
        """Local moves of half of the nodes at a time, the halves drawn anew every second round, until of all nodes at most the
        share ``tolerance`` still moves (none, once a level has few)."""
        cur, last = self._save(cur.withColumn("moved", F.lit(False)), "move"), 0
        before = f"move-{self.step}"
        around = self._with_self(edges, cur, "around")
        self_edges, keys = f"around-{self.step}", ["res", "b"] if "res" in edges.columns else "b"
        for i in range(self.most):
            size = cur.groupBy("res", "cluster").agg(F.sum("k").alias("kc"))
            state = cur.select("res", F.col("node").alias("b"), "cluster").join(size, ["res", "cluster"])
            x = around.join(state, keys).repartition("res", "a")
            x = x.groupBy("res", F.col("a").alias("node"), "cluster").agg(F.sum("w").alias("w"), F.first("k").alias("k"), F.first("kc").alias("kc"), F.max(F.col("a") == F.col("b")).alias("stays"))
            gain = F.round(F.col("w") - self._expected("k", F.col("kc") - F.when(F.col("stays"), F.col("k")).otherwise(0.0)), 9)
            best = x.groupBy("res", "node").agg(F.first("k").alias("k"), F.max(F.when(F.col("stays"), F.col("cluster"))).alias("mine"), F.max_by("cluster", F.struct(gain.alias("g"), F.col("stays").alias("s"), F.xxhash64("cluster").alias("h"))).alias("to"))
            to = F.when(_turn("node", i), F.col("to")).otherwise(F.col("mine"))
            cur, n, moved = self._counted(best.select("res", "node", "k", to.alias("cluster"), (to != F.col("mine")).alias("moved")), "move", "moved")
            self.ws.drop(before)
            before = f"move-{self.step}"
            if i % 2 and last + moved <= self.tolerance * n:
                break
            last = moved
        self.ws.drop(self_edges)
        return cur.drop("moved")

    def refine(self, edges: DataFrame, cur: DataFrame, rounds: int = 4) -> DataFrame:
        """``cur`` with ``part``: connected parts of each community.

        A node alone in its part may join a part that it touches within its community, if both are well connected to the rest
        of it and modularity rises. Parts that may be joined in a round do not move in it, so each part stays connected.
        """
        inner = cur.select("res", F.col("node").alias("a"), F.col("cluster").alias("ca"))
        x = edges.join(inner, ["res", "a"] if "res" in edges.columns else "a")
        x = x.join(inner.select("res", F.col("a").alias("b"), F.col("ca").alias("cb")), ["res", "b"]).where("ca = cb")
        inner = self._save(x.select("res", "a", "b", "w"), "inner")
        whole = cur.groupBy("res", "cluster").agg(F.sum("k").alias("kc"))
        reach = inner.groupBy("res", F.col("a").alias("node")).agg(F.sum("w").alias("reach"))
        p = cur.join(whole, ["res", "cluster"]).join(reach, ["res", "node"], "left").withColumn("reach", F.coalesce("reach", F.lit(0.0)))
        p, last = self._save(p.withColumns({"part": F.col("node"), "moved": F.lit(False)}), "part"), 0
        before = f"part-{self.step}"
        for i in range(rounds):
            near = self._save(self._beside(inner, p, "part"), "near")
            used = f"near-{self.step}"
            # edges that leave a part for the rest of its community: those of its nodes less those within it, both ways
            within = near.join(p.select("res", "node", F.col("part")), ["res", "node", "part"]).groupBy("res", "part").agg(F.sum("w").alias("within"))
            parts = p.groupBy("res", "part").agg(F.sum("k").alias("kp"), F.count("*").alias("n"), F.sum("reach").alias("out"), F.first("kc").alias("kw")).join(within, ["res", "part"], "left")
            parts = parts.withColumn("out", F.col("out") - F.coalesce("within", F.lit(0.0)))
            parts = parts.withColumn("well", F.col("out") >= self._expected("kp", F.col("kw") - F.col("kp")) - 1e-9).select("res", "part", "kp", "n", "well")
            alone = p.join(parts.where("n = 1 and well"), ["res", "part"]).where(~_turn("part", i)).select("res", "node", "k")
            hosts = parts.where("well").where(_turn("part", i)).select("res", "part", "kp")
            offer = near.join(alone, ["res", "node"]).join(hosts, ["res", "part"]).withColumn("gain", F.round(F.col("w") - self._expected("k", F.col("kp")), 9)).where("gain > 0")
            to = offer.groupBy("res", "node").agg(F.max_by("part", F.struct("gain", F.xxhash64("part"))).alias("to"))
            p = p.drop("moved").join(to, ["res", "node"], "left").withColumns({"part": F.coalesce("to", "part"), "moved": F.col("to").isNotNull()}).drop("to")
            p, _, moved = self._counted(p, "part", "moved")
            self.ws.drop(before, used)
            before = f"part-{self.step}"
            if i % 2 and not last + moved:
                break
            last = moved
        return p.select("res", "node", "k", "cluster", "part")

    def contract(self, edges: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Edges between parts (those inside weigh in the degree only), and the parts as nodes in their communities."""
        side = parts.select("res", F.col("node").alias("a"), F.col("part").alias("pa"))
        x = edges.join(side, ["res", "a"] if "res" in edges.columns else "a").join(side.select("res", F.col("a").alias("b"), F.col("pa").alias("pb")), ["res", "b"])
        e = self._save(x.where("pa <> pb").groupBy("res", F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.sum("w").alias("w")), "edges")
        nodes = parts.groupBy("res", F.col("part").alias("node")).agg(F.sum("k").alias("k"), F.first("cluster").alias("cluster"))
        return e, self._save(nodes, "nodes")

    def connected(self, edges: DataFrame, cur: DataFrame) -> DataFrame:
        """``cur`` with communities that fall apart split into their components, which raises modularity."""
        cur = self._save(cur, "whole")
        if self._small(edges, cur):
            return self._in_tasks(edges, cur, small_graphs.connected, ["res", "node", "k", "cluster"], "split")
        pair = lambda a, b: cur.select("res", F.col("node").alias(a), F.col("cluster").alias(b))
        inner = self._each(edges).join(pair("a", "ca"), ["res", "a"]).join(pair("b", "cb"), ["res", "b"]).where("ca = cb").select("res", "a", "b")
        inner = self._save(inner.union(cur.select("res", F.col("node").alias("a"), F.col("node").alias("b"))), "within")
        least = cur.select("res", "node", F.col("node").alias("least"))
        while True:
            low = inner.join(least.select("res", F.col("node").alias("b"), "least"), ["res", "b"]).groupBy("res", F.col("a").alias("node"))
            low = low.agg(F.min("least").alias("least"), F.max(F.when(F.col("a") == F.col("b"), F.col("least"))).alias("was"))
            least, _, changed = self._counted(low.select("res", "node", "least", (F.col("least") != F.col("was")).alias("changed")), "least", "changed")
            if not changed:
                return cur.join(least, ["res", "node"]).select("res", "node", "k", F.col("least").alias("cluster"))

    def run(self) -> DataFrame:
        """(res, node, cluster), clusters named by a node."""
        edges, cur = self.graph, self.start
        place = cur.select("res", "node", F.col("node").alias("at"))  # each first node's place at the present level
        while not (small := self._small(edges, cur)):
            cur = self.move(edges, cur)
            parts = self.refine(edges, cur)
            before, after = parts.agg(F.count("*"), F.count_distinct("res", "part")).first()
            if before == after:
                break
            place = self._save(place.join(parts.select("res", F.col("node").alias("at"), "part"), ["res", "at"]).select("res", "node", F.col("part").alias("at")), "place")
            edges, cur = self.contract(edges, parts)
            self.ws.release()
        cur = self._in_tasks(edges, cur, small_graphs.leiden(self.m2), ["res", "node", "cluster"], "rest") if small else self.connected(edges, cur)
        return self._save(place.join(cur.select("res", F.col("node").alias("at"), "cluster"), ["res", "at"]).select("res", "node", "cluster"), "clusters")


def leiden(edges: DataFrame, resolutions: list[float], in_task: int = small_graphs.MOST) -> DataFrame:
    """(resolution, node, cluster): Leiden clusters of ``edges(query, neighbour[, weight])`` at each resolution.

    Clusters are numbered from '0' by falling size within their resolution. Every cluster is connected. Nodes without an edge
    to another node are not in the graph. Moves are parallel, so clusters are compared with others' by agreement, not by name.
    """
    found = Leiden(undirected(edges), resolutions, in_task=in_task).run()
    w = F.row_number().over(Window.partitionBy("res").orderBy(F.desc("n"), "cluster")) - 1
    rank = found.groupBy("res", "cluster").agg(F.count("*").alias("n")).select("res", "cluster", w.cast("string").alias("rank"))
    return found.join(rank, ["res", "cluster"]).select(F.col("res").alias("resolution"), "node", F.col("rank").alias("cluster"))


def modularities(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """(resolution, modularity) of ``clusters(resolution, node, cluster)`` on ``edges(query, neighbour[, weight])``."""
    e = undirected(edges)
    c = clusters.select(F.col("resolution").alias("res"), "node", "cluster")
    x = e.join(c.select("res", F.col("node").alias("a"), F.col("cluster").alias("ca")), "a").join(c.select("res", F.col("node").alias("b"), F.col("cluster").alias("cb")), ["res", "b"])
    per = x.groupBy("res", F.col("ca").alias("c")).agg(F.sum("w").alias("k"), F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(0.0)).alias("i"))
    out = per.groupBy("res").agg(F.sum("k").alias("m2"), F.sum("i").alias("i"), F.sum(F.col("k") * F.col("k")).alias("kk"))
    return out.select(F.col("res").alias("resolution"), (F.col("i") / F.col("m2") - F.col("res") * F.col("kk") / (F.col("m2") * F.col("m2"))).alias("modularity"))


def disconnected(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """(resolution, disconnected): how many clusters of ``clusters(resolution, node, cluster)`` their own edges do not hold together."""
    run = Leiden(undirected(edges), [r[0] for r in clusters.select("resolution").distinct().collect()])
    cur = clusters.select(F.col("resolution").cast("double").alias("res"), "node", F.lit(0.0).alias("k"), "cluster")
    split = run.connected(run.graph, cur).select("res", "node", F.col("cluster").alias("part"))
    n = cur.join(split, ["res", "node"]).groupBy("res", "cluster").agg(F.count_distinct("part").alias("n"))
    return n.groupBy(F.col("res").alias("resolution")).agg(F.count_if(F.col("n") > 1).alias("disconnected"))


def cluster_counts(clusters: DataFrame) -> DataFrame:
    """(resolution, n_clusters)."""
    return clusters.groupBy("resolution").agg(F.count_distinct("cluster").alias("n_clusters"))


def resolution_by_nmi(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """(resolution, nmi, best) of ``clusters(resolution, node, cluster)`` against ``labels(node, label)``.

    The best is the greatest mutual information over the mean of the entropies, the smallest resolution among ties. All
    resolutions are scored from one contingency table.
    """
    x = clusters.join(labels.where("label is not null").select("node", "label"), "node")
    c = x.groupBy("resolution", "cluster", "label").agg(F.count("*").cast("double").alias("n"))

    def entropy(of: DataFrame, name: str) -> DataFrame:
        p = F.col("n") / F.col("t")
        t = of.withColumn("t", F.sum("n").over(Window.partitionBy("resolution")))
        return t.groupBy("resolution").agg((-F.sum(p * F.log(p))).alias(name))

    parts = [entropy(c.groupBy("resolution", k).agg(F.sum("n").alias("n")), f"h_{k}") for k in ("cluster", "label")]
    h = entropy(c, "h").join(parts[0], "resolution").join(parts[1], "resolution")
    nmi = F.coalesce(F.try_divide((F.col("h_cluster") + F.col("h_label") - F.col("h")) * 2, F.nullif(F.col("h_cluster") + F.col("h_label"), F.lit(0.0))), F.lit(1.0))
    first = F.row_number().over(Window.orderBy(F.desc(F.round("nmi", 12)), "resolution"))
    return h.select("resolution", nmi.alias("nmi")).withColumn("best", first == 1)

