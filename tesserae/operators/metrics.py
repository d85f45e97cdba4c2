"""Per-cell metrics and expression transforms on long counts ``(cell, gene, count)``; absent rows are zeros."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MITO = "(?i)^MT-"
RIBO = "(?i)^(RPL|RPS)"


def percent_of(count: Column, member: Column) -> Column:
    """Aggregate: percentage of the counts that fall on rows where ``member`` holds; 0 without any count."""
    return F.coalesce(F.try_divide(F.sum(F.when(member, count).otherwise(F.lit(0.0))) * 100, F.sum(count)), F.lit(0.0))


def cell_metrics(counts: DataFrame, cell: str | list[str] = "cell", sets: dict[str, Column] | None = None) -> DataFrame:
    """One row per cell: nCount, nFeature and a percentage for each gene set, in one map-side combined aggregation."""
    c = F.col("count").cast("double")
    extra = [percent_of(c, m).alias(k) for k, m in (sets or {}).items()]
    return counts.groupBy(cell).agg(F.sum(c).alias("nCount"), F.sum((c > 0).cast("long")).alias("nFeature"), *extra)


def normalize_log1p(counts: DataFrame, cell: str = "cell", target: float = 1e4) -> DataFrame:
    """``counts`` with ``value``: log(1 + count scaled to ``target`` per cell). A cell's genes share a partition, which
    a cell's panel of genes bounds."""
    total = F.sum(F.col("count").cast("double")).over(Window.partitionBy(cell))
    return counts.withColumn("value", F.log1p(F.try_divide(F.col("count") * F.lit(target), total)))


def gene_moments(values: DataFrame, n_cells: int, gene: str = "gene") -> DataFrame:
    """Mean and sample variance of ``value`` per gene over all ``n_cells`` cells, absent rows counting as zero."""
    s, q = F.sum("value"), F.sum(F.col("value") * F.col("value"))
    m = s / F.lit(float(n_cells))
    return values.groupBy(gene).agg(m.alias("mean"), (F.greatest(q - F.lit(float(n_cells)) * m * m, F.lit(0.0)) / F.lit(float(max(n_cells - 1, 1)))).alias("variance"), F.sum((F.col("value") > 0).cast("long")).alias("n_expressed"))


def highly_variable(moments: DataFrame, top: int = 3000, bins: int = 20, gene: str = "gene") -> DataFrame:
    """Genes ranked by dispersion (variance/mean) standardised within equal-width bins of the mean.

    A bin of one gene, or without spread, has the z-score 0. Ties go to the smaller gene name. Works on one row per
    gene, whatever the number of cells.
    """
    d = moments.where("mean > 0").withColumn("dispersion", F.col("variance") / F.col("mean"))
    lo, hi = d.agg(F.min("mean"), F.max("mean")).first()
    width = ((hi - lo) / bins if lo is not None and hi > lo else 1.0) or 1.0
    d = d.withColumn("bin", F.least(F.floor((F.col("mean") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int"))
    stats = d.groupBy("bin").agg(F.avg("dispersion").alias("m"), F.stddev_samp("dispersion").alias("s"))
    z = F.coalesce(F.try_divide(F.col("dispersion") - F.col("m"), F.nullif(F.col("s"), F.lit(0.0))), F.lit(0.0))
    out = d.join(F.broadcast(stats), "bin").select(gene, "mean", "dispersion", "bin", z.alias("z"))
    return out.orderBy(F.desc(F.round("z", 9)), gene).limit(top)


def log_dispersion_genes(moments: DataFrame, top: int = 3000, bins: int = 20, gene: str = "gene") -> DataFrame:
    """Genes ranked by normalised log dispersion: (gene, bin, mean, dispersion, z), the default flavour of the annotation step.

    ``moments`` are those of unlogged normalised values. The logs of variance over mean are standardised within ``bins``
    equal bins of log(1 + mean); a bin of one gene takes its own dispersion as spread and 0 as centre, so that its z is 1.
    Genes without counts or spread are left out. Ties go to the smaller name.
    """
    d = moments.where("mean > 0 and variance > 0").select(gene, F.log1p("mean").alias("mean"), F.log(F.col("variance") / F.col("mean")).alias("dispersion"))
    lo, hi = d.agg(F.min("mean"), F.max("mean")).first()
    width = (hi - lo) / bins if lo is not None and hi > lo else 1.0
    at = F.greatest(F.ceil((F.col("mean") - F.lit(lo)) / F.lit(width)), F.lit(1)) - 1  # bins are closed on the right
    d = d.withColumn("bin", F.least(at, F.lit(bins - 1)).cast("int"))
    stats = d.groupBy("bin").agg(F.avg("dispersion").alias("m"), F.stddev_samp("dispersion").alias("s"))
    z = F.when(F.col("s").isNull(), 1.0).otherwise(F.coalesce(F.try_divide(F.col("dispersion") - F.col("m"), F.nullif(F.col("s"), F.lit(0.0))), F.lit(0.0)))
    out = d.join(F.broadcast(stats), "bin").select(gene, "bin", "mean", "dispersion", z.alias("z"))
    return out.orderBy(F.desc(F.round("z", 9)), gene).limit(top)


def scale_clip(values: DataFrame, moments: DataFrame, limit: float = 10.0, gene: str = "gene") -> DataFrame:
    """``values`` with ``scaled``: (value - mean) / sd cut at ``limit``; without spread 0. Absent rows scale to -mean/sd."""
    z = F.coalesce(F.try_divide(F.col("value") - F.col("mean"), F.nullif(F.sqrt("variance"), F.lit(0.0))), F.lit(0.0))
    return values.join(moments.select(gene, "mean", "variance"), gene).withColumn("scaled", F.least(z, F.lit(limit))).drop("mean", "variance")


def pearson_residuals(counts: DataFrame, n_cells: int, theta: float = 100.0, cell: str = "cell", gene: str = "gene") -> DataFrame:
    """Analytic Pearson residuals of the stored counts, clipped to the root of the number of cells."""
    c = counts.withColumn("count", F.col("count").cast("double"))
    per_cell = c.groupBy(cell).agg(F.sum("count").alias("ct"))
    per_gene = c.groupBy(gene).agg(F.sum("count").alias("gt"))
    total = per_gene.agg(F.sum("gt")).first()[0] or 1.0
    mu = F.col("ct") * F.col("gt") / F.lit(total)
    lim = F.lit(float(n_cells) ** 0.5)
    r = (F.col("count") - mu) / F.sqrt(mu + mu * mu / F.lit(theta))
    return c.join(per_gene, gene).join(per_cell, cell).withColumn("residual", F.greatest(F.least(r, lim), -lim)).drop("ct", "gt")


def count_like(values: DataFrame, column: str = "count") -> DataFrame:
    """One row: least value, greatest distance from an integer, and whether the column may be raw counts. Exact."""
    v = F.col(column).cast("double")
    out = values.agg(F.min(v).alias("least"), F.max(F.abs(v - F.rint(v))).alias("off"))
    return out.withColumn("is_counts", F.coalesce((F.col("least") >= -1e-6) & (F.col("off") <= 1e-3), F.lit(False)))


def expressed_genes(counts: DataFrame, gene: str = "gene") -> DataFrame:
    """Genes with any positive count."""
    return counts.where("count > 0").select(gene).distinct()
