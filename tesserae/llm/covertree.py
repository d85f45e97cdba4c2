"""Exact top-k inner-product search with one cover tree over queries and data, walked by pairs of nodes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace

_LEAF = 24


def _far(x: np.ndarray, sq: np.ndarray, i: int) -> np.ndarray:
    """Distances from row i; exact for integers, and within 1e-7 of the longest vector for others."""
    return np.sqrt(np.maximum(sq - 2 * (x @ x[i]) + sq[i], 0))


def _heads(x: np.ndarray, first: int, apart: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of points from ``first`` on, each the farthest from those before, until ``most`` or all lie within ``apart``.

    Also each point's nearest of them, and its distance: the points kept lie further apart than any of these distances.
    """
    sq = (x**2).sum(1)
    heads, owner, near = [first], np.zeros(len(x), np.int64), _far(x, sq, first)
    while len(heads) < most and near.max() > apart:
        new = int(near.argmax())
        d = _far(x, sq, new)
        closer = d < near
        owner[closer], near[closer] = len(heads), d[closer]
        heads.append(new)
    return np.array(heads), owner, near + 1e-6 * np.sqrt(sq.max())


class CoverTree:
    """Nested balls: a node's children lie on its points, further apart than they reach, and cover all its points.

    Children are taken at half the node's radius or, if that needs more than an eighth of its points (data without
    structure at that scale), at the scale that so many cover. ``rows`` of a node are all its points, ``radius`` is their
    greatest distance from its centre; nodes of few points are leaves. Children's centres, radii and norms are kept as
    arrays, so that one product bounds a node against all children of another.
    """

    __slots__ = ("centre", "radius", "rows", "kids", "centres", "radii", "norms")

    def __init__(self, x: np.ndarray, rows: np.ndarray, centre: np.ndarray, radius: float):
        self.centre, self.radius, self.rows = centre, radius, rows
        self.kids: list[CoverTree] = []
        if len(rows) <= _LEAF or not radius:
            return
        own = x[rows]
        heads, owner, near = _heads(own, int(((own - centre) ** 2).sum(1).argmin()), radius / 2, max(8, len(own) // 8))
        if len(heads) < 2:  # equal points
            return
        reach = np.zeros(len(heads))
        np.maximum.at(reach, owner, near)
        by = np.argsort(owner, kind="stable")
        parts = np.split(by, np.cumsum(np.bincount(owner, minlength=len(heads)))[:-1])
        self.kids = [CoverTree(x, rows[p], own[h], float(r)) for p, h, r in zip(parts, heads, reach, strict=True)]
        self.centres, self.radii = own[heads], reach
        self.norms = np.sqrt((self.centres**2).sum(1))

    @staticmethod
    def build(x: np.ndarray) -> CoverTree:
        centre = x[int(((x - x.mean(0)) ** 2).sum(1).argmin())]
        return CoverTree(x, np.arange(len(x)), centre, float(np.sqrt(((x - centre) ** 2).sum(1).max())))


class Best:
    """The k best of each query so far: higher score first, then smaller id. ``floor`` is what others are known to reach."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.floor = np.full(n, -np.inf) if floor is None else floor
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def worst(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[rows, -1], self.floor[rows])

    def add(self, rows: np.ndarray, s: np.ndarray, ids: np.ndarray) -> None:
        """Scores ``s`` (rows x ids) of candidates; -inf takes no part."""
        k = min(self.k, s.shape[1])
        least = np.maximum(np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k], self.worst(rows))
        i, j = np.nonzero((s >= least[:, None]) & np.isfinite(s))
        if not len(i):
            return
        hit = np.unique(i)
        at = np.concatenate([i, np.repeat(hit, self.k)])
        score = np.concatenate([s[i, j], self.score[rows[hit]].ravel()])
        who = np.concatenate([ids[j], self.id[rows[hit]].ravel()])
        order = np.lexsort((who, -score, at))
        at, score, who = at[order], score[order], who[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        keep = rank < self.k
        self.score[rows[at[keep]], rank[keep]] = score[keep]
        self.id[rows[at[keep]], rank[keep]] = who[keep]


def dual_search(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, best: Best) -> int:
    """Walk both trees, greatest bound first; a pair of nodes goes if its bound is below its queries' worst kth score.

    Points of two balls score at most cq.cd + rq|cd| + rd|cq| + rq*rd. Ties with the worst kth score stay. Returns the
    number of pairs of points that were scored.
    """
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    exact = top < 2**53
    a, b = (q, x) if exact else (q.astype(np.int64), x.astype(np.int64))
    slack, scored = 1e-6 * (1 + top), 0

    def scan(rows: np.ndarray, cols: np.ndarray) -> None:
        nonlocal scored
        scored += len(rows) * len(cols)
        s = (a[rows] @ b[cols].T).astype(np.float64 if exact else np.longdouble)
        s[q_ids[rows][:, None] == x_ids[cols][None, :]] = -np.inf
        best.add(rows, s, x_ids[cols])

    def down(m: CoverTree, n: CoverTree) -> None:
        """Node m of the queries against all of node n."""
        if m.kids and m.radius >= n.radius or m.kids and not n.kids:
            for kid in m.kids:
                down(kid, n)
            return
        if not n.kids:
            scan(m.rows, n.rows)
            return
        norm = float(np.sqrt(m.centre @ m.centre))
        most = n.centres @ m.centre + m.radius * n.norms + n.radii * norm + m.radius * n.radii + slack
        order = np.argsort(-most)
        i = 0
        while i < len(order) and most[order[i]] >= best.worst(m.rows).min():
            kid = n.kids[order[i]]
            i += 1
            if m.kids or kid.kids or len(kid.rows) > _LEAF:
                down(m, kid)
                continue
            rows = [kid.rows]  # small leaves are scored together
            while i < len(order) and sum(map(len, rows)) < 4 * _LEAF and not n.kids[order[i]].kids and most[order[i]] >= best.worst(m.rows).min():
                rows.append(n.kids[order[i]].rows)
                i += 1
            scan(m.rows, np.concatenate(rows))

    down(CoverTree.build(q), CoverTree.build(x))
    return scored


def _by_length(pdf: pd.DataFrame) -> dict[int, pd.DataFrame]:
    return dict(iter(pdf.groupby(pdf["v"].map(len)))) if len(pdf) else {}


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["v"].to_numpy()).astype(np.float64)


def _search(k: int):
    def run(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")]
        right = _by_length(data)
        for d, left in _by_length(queries).items():
            if d not in right:
                continue
            ids, best = left["id"].to_numpy(np.int64), Best(len(left), k, left["worst"].to_numpy(float))
            dual_search(_matrix(left), ids, _matrix(right[d]), right[d]["id"].to_numpy(np.int64), best)
            i, r = np.nonzero(np.isfinite(best.score))
            out.append(pd.DataFrame({"query_id": ids[i], "vec_id": best.id[i, r], "score": best.score[i, r].astype(np.int64)}))
        return pd.concat(out, ignore_index=True)

    return run


class TopTree:
    """The upper levels of the cover tree, on a bounded sample: for each length of vector, points of it in farthest-first
    order, so that any first few of them are a coarser level; a cell is (length, place of its centre) in one number."""

    def __init__(self, sample: list[np.ndarray], cells: int):
        self.centres: dict[int, np.ndarray] = {}
        for d in sorted({len(v) for v in sample}):
            x = np.stack([v for v in sample if len(v) == d])
            self.centres[d] = x[_heads(x, int(((x - x.mean(0)) ** 2).sum(1).argmin()), 0.0, min(cells, len(x)))[0]]

    def centre(self, cell: int) -> np.ndarray:
        d = cell >> 32
        return self.centres[d][cell & 0xFFFFFFFF] if d in self.centres else np.zeros(d)

    def cells(self, v: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest of the first ``most`` centres of each vector, and how far it is; a length that the sample lacks is one
        cell around the origin."""
        size = np.fromiter(map(len, v), np.int64, len(v))
        cell, far = size << 32, np.zeros(len(v))
        for d in np.unique(size):
            at = np.nonzero(size == d)[0]
            x, c = np.stack([v[i] for i in at]), self.centres.get(int(d), np.zeros((1, d)))[:most]
            own = ((c**2).sum(1)[None, :] - 2 * (x @ c.T)).argmin(1)
            cell[at] += own
            far[at] = np.sqrt(((x - c[own]) ** 2).sum(1))
        return cell, far


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, group: int = 2048, sample: int = 8192) -> DataFrame:
    """Best ``k`` inner products of each query with all other rows of ``vectors(vec_id, embedding)``.

    A component x counts as floor(256 * x). Queries are the rows whose vec_id is divisible by ``every``; candidates
    all rows of another vec_id. Returns query_id, rank (from 1), vec_id, score; all candidates if fewer than ``k``;
    ties go to the smaller vec_id. Nothing is approximated.

    The upper levels of one cover tree are built on at most ``sample`` rows, drawn by a hash. Every row goes down to a
    cell of about ``group`` rows (at most ``sample`` cells), queries also to a coarser node of about ``group`` queries.
    A query first searches its own cell, and so gets a kth score that it reaches at least. A query node then meets the
    cells alone whose bound by centres and radii reaches the worst of its queries' kth scores; cells of many rows are dealt
    over several tasks. In a task the lower levels of both trees are built and walked together, leaf by leaf.

    Vectors null, empty, or with null or non-finite components take no part, nor null ids. Only vectors of one length
    are compared. Repeated rows are candidates each; of repeated query ids the least vector counts. Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ws = Workspace(spark, "covertree")
    fine = F.expr("embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    src = vectors.where("vec_id is not null").where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("id"), v.alias("v"))
    n = src.count()
    drawn = src.orderBy(F.xxhash64("id", "v"), "id").limit(sample).select("v").toArrow().column("v").to_pylist()
    cells, nodes = max(1, n // group), max(1, n // every // group)
    tree = spark.sparkContext.broadcast(TopTree([np.array(x) for x in drawn], cells))

    def place(batches):
        for b in batches:
            vs = [np.array(x) for x in b.column(1).to_pylist()]
            (cell, far), (node, node_far) = tree.value.cells(vs, cells), tree.value.cells(vs, nodes)
            yield pa.record_batch([b.column(0), b.column(1), *map(pa.array, (cell, far, node, node_far))], ["id", "v", "cell", "far", "node", "node_far"])

    data = ws.save(src.mapInArrow(place, "id long, v array<double>, cell long, far double, node long, node_far double"), "data")
    ball = ws.save(data.groupBy("cell").agg(F.max("far").alias("r"), F.ceil(F.count("*") / (4 * group)).cast("int").alias("parts")), "balls")
    queries = ws.save(data.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("v", "cell", "node", "node_far")).alias("q")).select("id", "q.*"), "queries")
    rows = data.join(ball, "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id", "v")

    def meet(asked: DataFrame, pairs: DataFrame) -> DataFrame:
        """Search ``asked(at, id, v, worst)`` in all parts of the cells of ``pairs(at, cell)``."""
        pairs = pairs.join(ball, "cell").select("at", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        left = asked.join(pairs, "at").select("at", "cell", "part", "id", "v", "worst").groupBy("at", "cell", "part")
        right = rows.join(pairs, ["cell", "part"]).select("at", "cell", "part", "id", "v").groupBy("at", "cell", "part")
        return left.cogroup(right).applyInPandas(_search(k), "query_id long, vec_id long, score long")

    none = F.lit(float("-inf"))
    first = meet(queries.select(F.col("cell").alias("at"), "id", "v", none.alias("worst")), ball.select(F.col("cell").alias("at"), "cell"))
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("n", F.row_number().over(top)).where(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("kth"))
    asked = ws.save(queries.join(kth, "id", "left").select(F.col("node").alias("at"), "id", "v", F.coalesce("kth", none).alias("worst"), "node_far"), "asked")
    balls = spark.sparkContext.broadcast([(r["cell"], r["r"]) for r in ball.select("cell", "r").collect()])  # at most ``sample``
    reach = asked.groupBy("at").agg(F.max("node_far").alias("far"), F.min("worst").alias("worst")).mapInPandas(_reached(tree, balls), "at long, cell long")
    found = meet(asked, ws.save(reach, "pairs"))
    return found.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _reached(tree, balls):
    """(at, cell) of query nodes and the cells, of vectors as long, whose bound reaches the node's worst kth score."""

    def run(frames):
        by: dict[int, list] = {}
        for cell, r in balls.value:
            by.setdefault(cell >> 32, []).append((cell, r, tree.value.centre(cell)))
        held = {d: (np.array([x[0] for x in b]), np.array([x[1] for x in b]), np.stack([x[2] for x in b])) for d, b in by.items()}
        for pdf in frames:
            for at, far, worst in zip(pdf["at"], pdf["far"], pdf["worst"], strict=True):
                cell, r, c = held[at >> 32]
                q = tree.value.centre(at)
                most = c @ q + far * np.sqrt((c**2).sum(1)) + r * np.sqrt(q @ q) + far * r
                cell = cell[most + 1e-6 * (1 + np.abs(most)) >= worst]
                yield pd.DataFrame({"at": np.full(len(cell), at), "cell": cell})

    return run
