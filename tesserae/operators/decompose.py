"""Principal components of scaled sparse expression: zeros are counted, never made."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace


def select_genes(values: DataFrame, genes: DataFrame, gene: str = "gene") -> DataFrame:
    """The rows of the listed genes only."""
    return values.join(genes.select(gene).distinct(), gene, "left_semi")


def scaled_parts(values: DataFrame, moments: DataFrame, limit: float = 10.0, gene: str = "gene") -> tuple[DataFrame, DataFrame]:
    """Scaled expression as a sparse part and a row of zeros: (values with ``off``, (gene, zero)).

    A gene's absent cells all scale to ``zero`` = max(-mean / sd, -limit), and a stored value to ``zero + off``, cut at ``limit`` on
    either side. Genes without spread scale to 0 throughout.
    """
    sd = F.nullif(F.sqrt("variance"), F.lit(0.0))
    clip = lambda z: F.least(F.greatest(F.coalesce(z, F.lit(0.0)), F.lit(-limit)), F.lit(limit))
    m = moments.select(gene, "mean", "variance", clip(F.try_divide(-F.col("mean"), sd)).alias("zero"))
    off = clip(F.try_divide(F.col("value") - F.col("mean"), sd)) - F.col("zero")
    return values.join(m, gene).withColumn("off", off).drop("mean", "variance", "zero"), m.select(gene, "zero")


class _Numbered:
    """Genes as 0..n-1 and cells' sparse rows packed, one row of two arrays a cell."""

    def __init__(self, ws: Workspace, off: DataFrame, zero: DataFrame, cell: str, gene: str):
        names = zero.select(gene, "zero").orderBy(gene).collect()  # one number a selected gene
        self.genes = [r[gene] for r in names]
        self.zero = np.array([r["zero"] for r in names])
        at = off.sparkSession.createDataFrame([(g, i) for i, g in enumerate(self.genes)], f"{gene} {dict(zero.dtypes)[gene]}, j int")
        packed = off.join(F.broadcast(at), gene).groupBy(cell).agg(F.collect_list("j").alias("j"), F.collect_list("off").alias("x"))
        self.rows = ws.save(packed.select(F.col(cell).alias("cell"), "j", "x"), "rows")


def _csr(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each entry, gene, value) of a batch of packed cells."""
    j, x = b.column("j"), b.column("x")
    size = j.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(b)), size), j.flatten().to_numpy(), x.flatten().to_numpy()


def _times(rows: np.ndarray, genes: np.ndarray, x: np.ndarray, n: int, right: np.ndarray) -> np.ndarray:
    """Sparse rows times a thin matrix."""
    out = np.zeros((n, right.shape[1]))
    for k in range(right.shape[1]):
        out[:, k] = np.bincount(rows, x * right[genes, k], n)
    return out


def sparse_pca(values: DataFrame, cells: DataFrame, moments: DataFrame, k: int = 50, limit: float = 10.0, rounds: int = 4, extra: int = 10, seed: int = 42, cell: str = "cell", gene: str = "gene") -> tuple[DataFrame, DataFrame, list[float]]:
    """Principal components of the scaled expression of ``moments``' genes over all of ``cells``: (cell, pc), (gene, loading), variances.

    A randomized SVD by subspace iteration: in each round tasks send the product of their cells' sparse rows with a thin matrix and
    back (genes x (k + ``extra``) numbers, whatever the number of cells). Zeros scale to a row that all cells share, and the
    mean of the clipped values is taken off as a rank-one term, so no dense matrix is made. A cell without a stored value is placed
    too. ``moments(gene, mean, variance)`` names the selected genes (a panel of thousands, which the driver holds). Signs are
    fixed: the loading of greatest size of a component is positive.
    """
    spark = values.sparkSession
    ws = Workspace(spark, "pca")
    off, zero = scaled_parts(select_genes(values, moments, gene), moments, limit, gene)
    m = _Numbered(ws, off, zero, cell, gene)
    n, p = cells.select(cell).distinct().count(), len(m.genes)
    q = min(k + extra, p)
    if not n or not p:
        empty = cells.select(cell, F.array().cast("array<double>").alias("pc"))
        return empty, zero.select(gene, F.array().cast("array<double>").alias("loading")), []

    def pass_over(right: np.ndarray, square: bool) -> tuple[np.ndarray, np.ndarray]:
        """Sums over stored cells: S'(S R) (genes x q) and, with it, the sum of the rows of S R; or (S R)'(S R)."""
        shared = spark.sparkContext.broadcast(right)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            r = shared.value
            total, line = np.zeros((r.shape[1], r.shape[1]) if square else r.shape), np.zeros(r.shape[1])
            for b in batches:
                rows, genes, x = _csr(b)
                y = _times(rows, genes, x, len(b), r)
                line += y.sum(0)
                if square:
                    total += y.T @ y
                else:
                    for c in range(r.shape[1]):
                        total[:, c] += np.bincount(genes, x * y[rows, c], len(r))
            flat = np.concatenate([total.ravel(), line])
            yield pa.record_batch([pa.array(np.arange(len(flat), dtype=np.int64)), pa.array(flat)], ["i", "v"])

        got = m.rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        shared.unpersist()
        flat = np.zeros((right.shape[1] if square else p) * right.shape[1] + right.shape[1])
        flat[got["i"].to_numpy()] = got["v"].to_numpy()
        cut = len(flat) - right.shape[1]
        return flat[:cut].reshape(-1, right.shape[1]), flat[cut:]

    sums = m.rows.select(F.explode(F.arrays_zip("j", "x")).alias("e")).groupBy("e.j").agg(F.sum("e.x").alias("s")).toPandas()
    total = np.zeros(p)
    total[sums["j"].to_numpy()] = sums["s"].to_numpy()
    mean = total / n  # of the sparse part; the zeros' row shifts every cell alike and leaves with the mean
    right = np.linalg.qr(np.random.default_rng(seed).normal(size=(p, q)))[0]
    for _ in range(rounds):
        prod, line = pass_over(right, False)
        right = np.linalg.qr(prod - np.outer(total, mean @ right) - np.outer(mean, line) + n * np.outer(mean, mean @ right))[0]
    gram, line = pass_over(right, True)
    c = mean @ right
    gram = gram - np.outer(line, c) - np.outer(c, line) + n * np.outer(c, c)
    lam, vec = np.linalg.eigh(gram)
    order = np.argsort(-lam)[: min(k, q)]
    load = right @ vec[:, order]
    load *= np.sign(load[np.abs(load).argmax(0), np.arange(load.shape[1])])
    shift, variance = mean @ load, np.maximum(lam[order], 0) / max(n - 1, 1)
    shared = spark.sparkContext.broadcast(load)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, genes, x = _csr(b)
            y = _times(rows, genes, x, len(b), shared.value) - shift
            yield pa.record_batch([b.column("cell"), pa.array(list(y), pa.list_(pa.float64()))], ["cell", "pc"])

    placed = m.rows.mapInArrow(place, f"cell {dict(m.rows.dtypes)['cell']}, pc array<double>").withColumnRenamed("cell", cell)
    none = F.array(*(F.lit(float(-x)) for x in shift))
    out = cells.select(cell).distinct().join(placed, cell, "left").withColumn("pc", F.coalesce("pc", none))
    names = spark.createDataFrame([(g, [float(x) for x in row]) for g, row in zip(m.genes, load)], f"{gene} {dict(zero.dtypes)[gene]}, loading array<double>")
    return out, names, [float(x) for x in variance]
