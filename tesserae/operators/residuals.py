"""Residuals of a regularised negative-binomial model of counts, sample by sample, zeros included."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace, small_side


def fit_genes(counts: DataFrame, cells: DataFrame, bins: int = 256, bandwidth: float = 0.3, least_cells: int = 5, sample: str = "sample", cell: str = "cell", gene: str = "gene", part_rows: int = 1_000_000) -> DataFrame:
    """(sample, gene, mean, share, overdispersion, theta): a count model of each gene in each sample.

    A cell's expected count is its total times the gene's share of all counts. The inverse size theta solves the moment
    equation sum (x - mu)^2 = sum mu + sum mu^2 / theta over all cells; the absent ones have x = 0 and their part is a product of sums,
    so only stored rows are read. The overdispersion log10(1 + mean / theta) is then smoothed over log10 of the mean by a
    Gaussian kernel of ``bandwidth``, from ``bins`` sums of genes, and theta is taken from the smoothed value. Genes of fewer than
    ``least_cells`` cells are left out. ``cells(sample, cell)`` counts cells without any stored row too. Rows are gathered by cell, a
    cell's genes in one row, in partitions of about ``part_rows``.
    """
    ws = Workspace(counts.sparkSession, "nb-fit")
    c = counts.where("count > 0").select(sample, cell, gene, F.col("count").cast("double").alias("x"))
    # so many partitions that one holds about a million rows, however many there are; a cell's rows are together
    c = c.repartition(max(1, -(-c.count() // part_rows)), sample, cell)
    stored = ws.save(c.groupBy(sample, cell, gene).agg(F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx")).groupBy(sample, cell).agg(F.sum("sx").alias("t"), F.collect_list(F.struct(gene, "sx", "sxx")).alias("genes")), "cells")
    whole = stored.groupBy(sample).agg(F.sum("t").alias("all"), F.sum(F.col("t") * F.col("t")).alias("squares"))
    whole = whole.join(cells.groupBy(sample).agg(F.count_distinct(cell).cast("double").alias("n")), sample)
    flat = stored.select(sample, "t", F.explode("genes").alias("g")).select(sample, "t", f"g.{gene}", "g.sx", "g.sxx")
    per = flat.groupBy(sample, gene).agg(F.sum("sx").alias("sx"), F.sum("sxx").alias("sxx"), F.sum(F.col("sx") * F.col("t")).alias("sxt"), F.count("*").alias("k"))
    g = per.where(F.col("k") >= least_cells).join(F.broadcast(whole), sample)  # a row a sample
    share = F.col("sx") / F.col("all")
    mu2 = share * share * F.col("squares")
    spread = F.col("sxx") - 2 * share * F.col("sxt") + mu2
    excess = spread - F.col("sx")
    mean = F.col("sx") / F.col("n")
    raw = F.when(excess > 0, F.log10(1 + mean * excess / mu2)).otherwise(0.0)
    g = ws.save(g.select(sample, gene, mean.alias("mean"), share.alias("share"), raw.alias("overdispersion")), "genes")
    ends = g.groupBy(sample).agg(F.min(F.log10("mean")).alias("lo"), F.max(F.log10("mean")).alias("hi"))
    at = g.join(F.broadcast(ends), sample).withColumn("width", F.greatest((F.col("hi") - F.col("lo")) / bins, F.lit(1e-9)))
    at = at.withColumn("bin", F.least(F.floor((F.log10("mean") - F.col("lo")) / F.col("width")), F.lit(bins - 1)))
    sums = at.groupBy(sample, "width", "bin").agg(F.sum("overdispersion").alias("s"), F.count("*").alias("m"))
    d = (F.col("bin") - F.col("other")) * F.col("width") / F.lit(bandwidth)
    w = F.exp(-0.5 * d * d)
    smooth = sums.select(sample, "width", "bin").join(sums.select(sample, F.col("bin").alias("other"), "s", "m"), sample).groupBy(sample, "bin").agg((F.sum(w * F.col("s")) / F.sum(w * F.col("m"))).alias("smooth"))
    out = at.select(sample, gene, "mean", "share", "overdispersion", "bin").join(small_side(smooth, 64), [sample, "bin"])
    return out.select(sample, gene, "mean", "share", "overdispersion", (F.col("mean") / F.greatest(F.pow(F.lit(10.0), "smooth") - 1, F.lit(1e-8))).alias("theta"))


def residuals(counts: DataFrame, cells: DataFrame, model: DataFrame, genes: list, covariate: str | None = None, clip: float | None = None, sample: str = "sample", cell: str = "cell", gene: str = "gene") -> DataFrame:
    """(sample, cell, residual): Pearson residuals of the listed genes in their order, for all cells, zeros included.

    A residual is (x - mu) / sqrt(mu + mu^2 / theta) cut at ``clip`` (by default the root of the sample's cells); a gene that the
    sample's model lacks, or a cell without counts, has 0. With ``covariate``, a numeric column of ``cells``, its linear part is
    taken off gene by gene within the sample: tasks send sums whose size is the list's. The list is a panel of selected genes; each
    sample's parameters of them ride along as one array with its cells.
    """
    ws = Workspace(counts.sparkSession, "nb-residuals")
    spark, p = counts.sparkSession, len(genes)
    order = spark.createDataFrame([(g, i) for i, g in enumerate(genes)], f"{gene} {dict(counts.dtypes)[gene]}, j int")
    c = counts.where("count > 0").select(sample, cell, gene, F.col("count").cast("double").alias("x"))
    totals = c.groupBy(sample, cell).agg(F.sum("x").alias("t"))
    stored = c.join(F.broadcast(order), gene).groupBy(sample, cell, "j").agg(F.sum("x").alias("x")).groupBy(sample, cell).agg(F.collect_list("j").alias("j"), F.collect_list("x").alias("x"))
    fit = model.join(F.broadcast(order), gene).groupBy(sample).agg(F.collect_list(F.struct("j", "share", "theta")).alias("fit"))
    z = F.col(covariate).cast("double") if covariate else F.lit(0.0)
    who = cells.groupBy(sample, cell).agg(F.first(z, ignorenulls=True).alias("z"))
    n = who.groupBy(sample).agg(F.count("*").alias("n"))
    rows = who.join(totals, [sample, cell], "left").join(stored, [sample, cell], "left").join(F.broadcast(n), sample)
    rows = ws.save(rows.select(sample, cell, F.coalesce("z", F.lit(0.0)).alias("z"), F.coalesce("t", F.lit(0.0)).alias("t"), F.coalesce("j", F.array().cast("array<int>")).alias("j"), F.coalesce("x", F.array().cast("array<double>")).alias("x"), "n"), "rows")
    book = {r[sample]: r["fit"] for r in fit.collect()}  # samples by panel: what a stage's driver holds of each

    def table(s: object) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        share, theta, known = np.zeros(p), np.ones(p), np.zeros(p, bool)
        for f in book_of.value.get(s, []):
            share[f["j"]], theta[f["j"]], known[f["j"]] = f["share"], f["theta"], True
        return share, theta, known

    book_of = spark.sparkContext.broadcast(book)

    def dense(b: pa.RecordBatch) -> tuple[list, np.ndarray, np.ndarray]:
        """Samples, covariates and residuals of a batch of cells."""
        names, t, lim = b.column("s").to_pylist(), b.column("t").to_numpy(), np.sqrt(b.column("n").to_numpy()) if clip is None else np.full(len(b), clip)
        size = b.column("j").value_lengths().to_numpy(zero_copy_only=False)
        x = np.zeros((len(b), p))
        x[np.repeat(np.arange(len(b)), size), b.column("j").flatten().to_numpy()] = b.column("x").flatten().to_numpy()
        out = np.zeros((len(b), p))
        for s in dict.fromkeys(names):
            at = np.array([k for k, v in enumerate(names) if v == s])
            share, theta, known = table(s)
            mu = t[at, None] * share
            ok = known & (mu > 0)
            r = np.where(ok, (x[at] - mu) / np.sqrt(np.where(ok, mu + mu * mu / theta, 1.0)), 0.0)
            out[at] = np.clip(r, -lim[at, None], lim[at, None])
        return names, b.column("z").to_numpy(), out

    shape = rows.select(F.col(sample).alias("s"), F.col(cell).alias("c"), "z", "t", "j", "x", "n")
    kinds = dict(shape.dtypes)
    line: dict = {}
    if covariate and p:

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                names, zs, r = dense(b)
                for s in dict.fromkeys(names):
                    at = np.array([k for k, v in enumerate(names) if v == s])
                    flat = np.concatenate([r[at].sum(0), zs[at] @ r[at], [len(at), zs[at].sum(), zs[at] @ zs[at]]])
                    yield pa.record_batch([pa.array([s] * len(flat), b.schema.field("s").type), pa.array(np.arange(len(flat))), pa.array(flat)], ["s", "i", "v"])

        got = shape.mapInArrow(sums, f"s {kinds['s']}, i long, v double").groupBy("s", "i").agg(F.sum("v").alias("v")).collect()
        flat: dict = {}
        for r in got:
            flat.setdefault(r["s"], np.zeros(2 * p + 3))[r["i"]] = r["v"]
        for s, f in flat.items():
            sr, szr, (m, sz, szz) = f[:p], f[p : 2 * p], f[2 * p :]
            det = m * szz - sz * sz
            slope = (m * szr - sz * sr) / det if det > 1e-12 * max(m * szz, 1e-300) else np.zeros(p)
            line[s] = (slope, (sr - slope * sz) / m)
    fix = spark.sparkContext.broadcast(line)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 512):
                part = b.slice(lo, 512)
                names, zs, r = dense(part)
                for k, s in enumerate(names):
                    if s in fix.value:
                        slope, start = fix.value[s]
                        r[k] -= start + slope * zs[k]
                yield pa.record_batch([part.column("s"), part.column("c"), pa.array(list(r), pa.list_(pa.float64()))], ["s", "c", "residual"])

    return shape.mapInArrow(place, f"s {kinds['s']}, c {kinds['c']}, residual array<double>").toDF(sample, cell, "residual")
