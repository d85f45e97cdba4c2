"""Integration by anchors: shared spaces of two batches, mutual neighbours in them, scores, and weighted correction vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tesserae.operators.neighbors import knn
from tesserae.plans.workspace import Workspace


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(float)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


class Batch:
    """Cells ``(id, vec)`` of one batch; features are standardised by the batch's own means and deviations.

    Tasks send sums whose size is features times components, whatever the number of cells.
    """

    def __init__(self, cells: DataFrame):
        self.cells = cells.select("id", F.col("vec").cast("array<double>").alias("vec"))
        x = self.cells.select(F.posexplode("vec").alias("j", "x")).groupBy("j").agg(F.count("*").alias("n"), F.avg("x").alias("m"), F.stddev_samp("x").alias("s"))
        rows = x.orderBy("j").collect()  # one row a feature
        self.n = rows[0]["n"] if rows else 0
        self.mean = np.array([r["m"] for r in rows])
        sd = np.array([r["s"] or 0.0 for r in rows])
        self.sd = np.where(sd > 1e-12, sd, 1.0)
        self.width = len(rows)

    def gram_times(self, right: np.ndarray) -> np.ndarray:
        """X'X R of the standardised matrix X."""
        mean, sd, width = self.mean, self.sd, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(right)
            for b in batches:
                if len(b):
                    x = (_matrix(b.column(0), width) - mean) / sd
                    total += x.T @ (x @ right)
            yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "v"])

        got = self.cells.select("vec").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        out = np.zeros(right.size)
        out[got["i"].to_numpy()] = got["v"].to_numpy()
        return out.reshape(right.shape)

    def onto(self, load: np.ndarray, unit: bool = True) -> DataFrame:
        """(id, vec): standardised cells times ``load``; with ``unit``, of length 1."""
        mean, sd, width = self.mean, self.sd, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                y = (_matrix(b.column("vec"), width) - mean) / sd @ load
                if unit:
                    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
                yield pa.record_batch([b.column("id"), _lists(y)], ["id", "vec"])

        return self.cells.mapInArrow(run, f"id {dict(self.cells.dtypes)['id']}, vec array<double>")

    def components(self, k: int, rounds: int = 6, seed: int = 42) -> np.ndarray:
        """The ``k`` leading principal axes, features by components."""
        q = min(k + 8, self.width)
        right = np.linalg.qr(np.random.default_rng(seed).normal(size=(self.width, q)))[0]
        for _ in range(rounds):
            right = np.linalg.qr(self.gram_times(right))[0]
        lam, vec = np.linalg.eigh(right.T @ self.gram_times(right))
        return right @ vec[:, np.argsort(-lam)[:k]]


def canonical_axes(a: Batch, b: Batch, k: int, rounds: int = 6, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(axes of a, axes of b, singular values) of the cross-product A B' of two standardised matrices, by subspace iteration.

    A times its axes are the left singular vectors, B times its own the right ones; the cells-by-cells matrix is never made.
    """
    q = min(k + 8, a.width)
    right = np.linalg.qr(np.random.default_rng(seed).normal(size=(a.width, q)))[0]
    for _ in range(rounds):
        right = np.linalg.qr(b.gram_times(a.gram_times(right)))[0]
    ar = a.gram_times(right)
    lam, vec = np.linalg.eigh((right.T @ ar + ar.T @ right) / 2)
    keep = lam > 1e-9 * max(lam.max(), 1e-300)
    basis = vec[:, keep] / np.sqrt(lam[keep])  # A right basis has orthonormal columns
    cross = ar @ basis
    gram = cross.T @ b.gram_times(cross)
    s2, w = np.linalg.eigh((gram + gram.T) / 2)
    order = [i for i in np.argsort(-s2)[:k] if s2[i] > 1e-12 * max(s2.max(), 1e-300)]
    sigma = np.sqrt(s2[order])
    return right @ basis @ w[:, order], cross @ w[:, order] / sigma, sigma


def spaces(a: Batch, b: Batch, reduction: str, dims: int) -> list[tuple[DataFrame, DataFrame]]:
    """Pairs (cells of a, cells of b) in the spaces where neighbours are looked for.

    ``cca``: the canonical variates, one space. ``rpca``: both batches on the axes of each. ``none``: the vectors as they are.
    """
    if reduction == "none":
        return [(a.cells, b.cells)]
    if reduction == "cca":
        la, lb, _ = canonical_axes(a, b, dims)
        return [(a.onto(la), b.onto(lb))]
    if reduction == "rpca":
        return [(a.onto(load), b.onto(load)) for load in (a.components(dims), b.components(dims))]
    raise ValueError(f"unknown reduction {reduction!r}: cca, rpca or none")


def find_anchors(places: list[tuple[DataFrame, DataFrame]], k: int = 5, k_score: int = 30) -> DataFrame:
    """(a, b, score): pairs among each other's ``k`` nearest, scored by the neighbours that both have in common.

    With two spaces, the neighbours in the other batch of a's cells are those in the space of b, and the reverse. The score
    is the number of common ones among the ``k_score`` nearest of each, in both batches, scaled so that the 1st and
    90th percentile become 0 and 1.
    """
    (a0, b0), (a1, b1) = places[0], places[-1]
    near = lambda q, r, n, me=True: knn(q, r, n, include_self=me).select("query", "neighbour", "rank")
    ab, ba = near(a1, b1, max(k, k_score)), near(b0, a0, max(k, k_score))
    pairs = ab.where(F.col("rank") <= k).select(F.col("query").alias("a"), F.col("neighbour").alias("b"))
    pairs = pairs.join(ba.where(F.col("rank") <= k).select(F.col("query").alias("b"), F.col("neighbour").alias("a")), ["a", "b"])
    ws = Workspace(a0.sparkSession, "anchors")
    pairs = ws.save(pairs, "pairs")

    def around(own: DataFrame, other: DataFrame, left: bool) -> DataFrame:
        """(cell, side, neighbour) of the ``k_score`` nearest in both batches."""
        side = F.lit("a" if left else "b")
        both = own.select("query", "neighbour", side.alias("side"), "rank").union(other.select("query", "neighbour", F.lit("b" if left else "a"), "rank"))
        return both.where(F.col("rank") <= k_score).drop("rank")

    of_a = around(near(a0, a0, k_score, False), ab, True).withColumnRenamed("query", "a")
    of_b = around(near(b1, b1, k_score, False), ba, False).withColumnRenamed("query", "b")
    shared = pairs.join(of_a, "a").join(of_b, ["b", "side", "neighbour"]).groupBy("a", "b").agg(F.count("*").alias("n"))
    scored = ws.save(pairs.join(shared, ["a", "b"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("double")), "scored")
    lo, hi = scored.agg(F.percentile("n", F.lit(0.01)), F.percentile("n", F.lit(0.9))).first()
    score = F.lit(1.0) if lo is None or hi <= lo else F.least(F.greatest((F.col("n") - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0))
    return scored.select("a", "b", score.alias("score"))


def _pulls(rate: float, kind: pa.DataType, some: int = 1 << 15):
    """For a block of near anchor cells (query, neighbour, w) and the anchors of these: (query, total, move), each query's sums of
    weights and of weighted differences."""
    shape = pa.schema([("query", kind), ("total", pa.float64()), ("move", pa.list_(pa.float64()))])

    def run(near: pa.Table, diffs: pa.Table) -> pa.Table:
        if not len(near) or not len(diffs):
            return shape.empty_table()
        diffs = diffs.sort_by("neighbour")
        held = diffs["neighbour"].combine_chunks().dictionary_encode()
        first = np.searchsorted(held.indices.to_numpy(), np.arange(len(held.dictionary) + 1))
        d, score = _matrix(diffs["diff"].combine_chunks(), len(diffs["diff"][0])), diffs["score"].to_numpy()
        at = pc.index_in(near["neighbour"].combine_chunks(), value_set=held.dictionary)
        near, at = near.filter(pc.is_valid(at)), at.drop_null().to_numpy()
        names = near["query"].combine_chunks().dictionary_encode()
        code = names.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        at, n = at[order], (first[1:] - first[:-1])[at[order]]
        row = np.repeat(np.arange(len(n)), n)
        anchor = np.arange(len(row)) - (np.cumsum(n) - n - first[at])[row]
        w = 1 - np.exp(-near["w"].to_numpy()[order][row] * score[anchor] * rate)
        code = code[order][row]
        move = np.zeros((len(names.dictionary), d.shape[1]))
        for i in range(0, len(row), some):
            c = code[i : i + some]
            starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            move[c[starts]] += np.add.reduceat(w[i : i + some, None] * d[anchor[i : i + some]], starts)
        return pa.Table.from_arrays([names.dictionary, pa.array(np.bincount(code, w, len(move))), _lists(move)], schema=shape)

    return run


def _moves(kind: pa.DataType):
    """(id, move) of the sums that a query has from several blocks; without weight it does not move."""
    shape = pa.schema([("id", kind), ("move", pa.list_(pa.float64()))])

    def run(t: pa.Table) -> pa.Table:
        names = t["query"].combine_chunks().dictionary_encode()
        code = names.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        starts = np.searchsorted(code[order], np.arange(len(names.dictionary)))
        move = np.add.reduceat(_matrix(t["move"].combine_chunks(), len(t["move"][0]))[order], starts)
        total = np.add.reduceat(t["total"].to_numpy()[order], starts)[:, None]
        return pa.Table.from_arrays([names.dictionary, _lists(np.divide(move, total, out=np.zeros_like(move), where=total > 0))], schema=shape)

    return run


def correction(a: Batch, b: Batch, anchors: DataFrame, place: DataFrame, k_weight: int = 100, sd: float = 1.0, near_block: int = 1 << 20, diff_bytes: int = 16 << 20) -> DataFrame:
    """(id, vec): cells of b moved by the weighted differences of their nearest anchors.

    A cell's anchors are those of the ``k_weight`` nearest anchor cells of b in ``place(id, vec)``. An anchor weighs
    (1 - d / d_k) times its score, put through 1 - exp(-w (sd / 2)^2) and scaled to a sum of 1; a cell whose weights are all
    0 stays. Blocks of about ``near_block`` near anchor cells meet blocks of ``diff_bytes`` of differences, and a task returns one sum a
    cell: a difference is never copied to the cells that it moves.
    """
    diff = anchors.join(a.cells.select(F.col("id").alias("a"), F.col("vec").alias("va")), "a").join(b.cells.select(F.col("id").alias("b"), F.col("vec").alias("vb")), "b")
    diff = diff.select(F.col("b").alias("neighbour"), F.col("score").cast("double").alias("score"), F.zip_with("va", "vb", lambda x, y: x - y).alias("diff"))
    held = place.join(anchors.select(F.col("b").alias("id")).distinct(), "id", "left_semi")
    near = knn(place, held, k_weight)
    row, shares = 8 * b.width + 16, lambda n, most: max(1, -(-n // most))
    n_a = shares(anchors.count() * row, diff_bytes)
    n_q = shares(near.count(), near_block * n_a)
    n_s = shares(place.count() * n_a * row, 4 * diff_bytes)
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    far = F.max("dist").over(Window.partitionBy("query"))
    near = near.withColumn("w", 1 - F.coalesce(F.try_divide("dist", far), F.lit(0.0)))
    near = near.select("query", "neighbour", "w", part("query", n_q).alias("q"), part("neighbour", n_a).alias("a"))
    diff = diff.withColumns({"q": F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))), "a": part("neighbour", n_a)})
    kind, arrow = dict(b.cells.dtypes)["id"], to_arrow_type(b.cells.schema["id"].dataType)
    sums = near.groupBy("q", "a").cogroup(diff.groupBy("q", "a")).applyInArrow(_pulls((sd / 2) ** 2, arrow), f"query {kind}, total double, move array<double>")
    moved = sums.groupBy(part("query", n_s).alias("s")).applyInArrow(_moves(arrow), f"id {kind}, move array<double>")
    return b.cells.join(moved, "id", "left").select("id", F.when(F.col("move").isNull(), F.col("vec")).otherwise(F.zip_with("vec", "move", lambda p, q: p + q)).alias("vec"))


def integrate_anchors(cells: DataFrame, reduction: str = "cca", dims: int = 30, k: int = 5, k_score: int = 30, k_weight: int = 100, reference: object = None) -> DataFrame:
    """``cells(id, batch, vec)`` with every batch moved onto the reference batch (by default the largest, first by name).

    Batches are few; each meets the growing whole of those before it, so that what is already joined serves as reference.
    Cells of null batch or vector are left out; a batch without anchors stays as it is.
    """
    ws = Workspace(cells.sparkSession, "integrated")
    x = ws.save(cells.where("batch is not null and vec is not null").select("id", "batch", F.col("vec").cast("array<double>").alias("vec")), "cells")
    sizes = {r["batch"]: r["count"] for r in x.groupBy("batch").count().collect()}
    order = sorted(sizes, key=lambda b: (b != reference, -sizes[b], str(b)))
    if not order:
        return x
    done = x.where(F.col("batch") == F.lit(order[0]))
    for i, name in enumerate(order[1:]):
        mine = x.where(F.col("batch") == F.lit(name))
        a, b = Batch(done.select("id", "vec")), Batch(mine.select("id", "vec"))
        places = [tuple(ws.save(p, f"place-{i}-{j}-{s}") for s, p in enumerate(pair)) for j, pair in enumerate(spaces(a, b, reduction, dims))]
        found = ws.save(find_anchors(places, k, k_score), f"anchors-{i}")
        moved = correction(a, b, found, places[-1][1], k_weight)
        done = ws.save(done.unionByName(moved.join(mine.select("id", "batch"), "id").select("id", "batch", "vec")), f"done-{i}")
    return done


def integrate_all(cells: DataFrame, methods: dict[str, Callable[[DataFrame], DataFrame]]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Each method's result, and (method, status, n_cells, message): a method that fails is reported and does not stop the others."""
    ws, done, rows = Workspace(cells.sparkSession, "methods"), {}, []
    for name, run in methods.items():
        try:
            done[name] = ws.save(run(cells), name)
            rows.append((name, "ok", done[name].count(), None))
        except Exception as e:  # whatever a method raises is its status
            rows.append((name, "failed", 0, str(e).splitlines()[0][:200] if str(e) else type(e).__name__))
    return done, cells.sparkSession.createDataFrame(rows, "method string, status string, n_cells long, message string")
