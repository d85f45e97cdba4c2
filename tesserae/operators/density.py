"""Two-dimensional kernel density of points, read off a grid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace


def point_density(points: DataFrame, x: str = "x", y: str = "y", n: int = 200, least: int = 10) -> DataFrame:
    """``points`` with ``density``: a Gaussian kernel density, taken at the grid point at or below each point.

    The grid has ``n`` points from the least to the greatest value of each axis. A kernel's deviation is the normal reference
    bandwidth, 1.06 n^(-1/5) times the lesser of the deviation and the quartiles' distance over 1.34. The kernel is a product, so
    a task sums its points into one ``n`` x ``n`` matrix by a matrix product, and the sums of tasks are added: what is shuffled
    does not grow with the points of a task. Points without finite coordinates, fewer than ``least`` finite points, or an axis
    without spread have a null density.
    """
    ws = Workspace(points.sparkSession, "density")
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < float("inf"))
    ok = finite(x) & finite(y)
    both = points.where(ok).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    facts = [f(c) for c in ("x", "y") for f in (F.min, F.max, F.stddev_samp, lambda c: F.percentile(c, F.array(F.lit(0.25), F.lit(0.75))))]
    total, *r = both.agg(F.count("*"), *facts).first()
    if total < least or not r[2] or not r[6]:
        return points.withColumn("density", F.lit(None).cast("double"))

    def axis(lo: float, hi: float, sd: float, quarters: list[float]) -> tuple[np.ndarray, float]:
        spread = min(sd, (quarters[1] - quarters[0]) / 1.34) or sd
        return np.linspace(lo, hi, n), 1.06 * spread * total**-0.2

    (gx, hx), (gy, hy) = axis(*r[:4]), axis(*r[4:])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = np.zeros((n, n))
        for b in batches:
            px, py = (b.column(k).to_numpy() for k in (0, 1))
            for lo in range(0, len(px), 4096):
                u, v = (np.exp(-0.5 * ((g[:, None] - p[None, lo : lo + 4096]) / h) ** 2) for g, p, h in ((gx, px, hx), (gy, py, hy)))
                z += u @ v.T
        i, j = np.nonzero(z)
        yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(z[i, j])], ["_i", "_j", "_z"])

    grid = both.mapInArrow(sums, "_i int, _j int, _z double").groupBy("_i", "_j").agg((F.sum("_z") / F.lit(2 * np.pi * hx * hy * total)).alias("density"))
    grid = ws.save(grid, "grid")
    at = lambda c, g: F.least(F.greatest(F.floor((F.col(c).cast("double") - F.lit(float(g[0]))) / F.lit(float(g[1] - g[0]))), F.lit(0)), F.lit(n - 2)).cast("int")
    out = points.withColumns({"_i": F.when(ok, at(x, gx)), "_j": F.when(ok, at(y, gy))})
    return out.join(F.broadcast(grid), ["_i", "_j"], "left").select(*points.columns, "density")  # n squared rows at most
