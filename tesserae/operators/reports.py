"""Summaries with TOTAL rows, funnels, compositions, confusion and the long tables behind figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pct(part: Column, whole: Column, digits: int | None = None) -> Column:
    """100 * part / whole, null for a zero whole."""
    p = F.try_divide(part.cast("double") * 100, whole)
    return p if digits is None else F.round(p, digits)


def with_total(df: DataFrame, by: str, sums: list[str], label: str = "TOTAL") -> DataFrame:
    """Rows of ``df`` (one per ``by``) and a TOTAL row: sums of ``sums``, all else null. Ratios come after."""
    total = df.agg(*(F.sum(c).alias(c) for c in sums)).withColumn(by, F.lit(label))
    return df.unionByName(total, allowMissingColumns=True)


def qc_summary(cells: DataFrame, by: str, metrics: list[str], keep: str = "keep") -> DataFrame:
    """Per dataset and in total: cells before and after, removed share, medians of each metric before and after.

    Datasets that lose all cells keep their row. Medians are exact; totals have none. Inflation is the ratio of the
    median nCount after to before.
    """
    k = F.col(keep)
    aggs = [F.count("*").alias("cells_raw"), F.count_if(k).alias("cells_filtered")]
    for m in metrics:
        aggs += [F.median(m).alias(f"median_{m}_raw"), F.median(F.when(k, F.col(m))).alias(f"median_{m}_filtered"), F.max(m).alias(f"max_{m}_raw"), F.max(F.when(k, F.col(m))).alias(f"max_{m}_filtered")]
    out = with_total(cells.groupBy(by).agg(*aggs), by, ["cells_raw", "cells_filtered"])
    out = out.withColumn("cells_removed", F.col("cells_raw") - F.col("cells_filtered")).withColumn("pct_cells_removed", pct(F.col("cells_removed"), F.col("cells_raw")))
    if "nCount" in metrics:
        out = out.withColumn("inflation", F.try_divide("median_nCount_filtered", "median_nCount_raw"))
        out = out.withColumn("flag", F.when(F.col("inflation") > 1.5, "over_filtering").when(F.col("inflation") < 1.05, "light"))
    return out


def funnel(raw: DataFrame, doublets: DataFrame, qc: DataFrame) -> DataFrame:
    """Full outer funnel by sample: raw(sample, cells_raw), doublets(sample, cells_after_ghost, doublets_found),
    qc(sample, cells_after_qc); stages, removals and percentages, and a TOTAL whose ratios come from its sums."""
    j = raw.join(doublets, "sample", "full").join(qc, "sample", "full")
    j = j.withColumn("cells_after_doublet_removal", F.col("cells_after_ghost") - F.col("doublets_found"))
    j = j.withColumn("removed_by_qc", F.col("cells_after_doublet_removal") - F.col("cells_after_qc")).withColumn("removed_total", F.col("cells_raw") - F.col("cells_after_qc"))
    out = with_total(j, "sample", [c for c in j.columns if c != "sample"])
    return out.withColumns({
        "pct_doublets": pct(F.col("doublets_found"), F.col("cells_after_ghost")),
        "pct_qc_removal": pct(F.col("removed_by_qc"), F.col("cells_after_doublet_removal")),
        "pct_total_removal": pct(F.col("removed_total"), F.col("cells_raw")),
    })


def qc_summary_detailed(cells: DataFrame, by: str, metrics: list[str], bounds: DataFrame, genes: DataFrame, methods: dict[str, str] | None = None, keep: str = "keep") -> DataFrame:
    """Per dataset and in total: cells and genes before and after, and for each metric its median, mean and maximum before
    and after, its cut-offs from ``bounds`` (by, lo_*, hi_*), and the methods that set them as algo_* columns.

    ``genes`` is (by, genes_raw, genes_filtered). In the TOTAL row cells are sums, the removed share comes from these, and all
    else is null. Datasets that lose all cells keep their row.
    """
    k = F.col(keep)
    aggs = [F.count("*").alias("cells_raw"), F.count_if(k).alias("cells_filtered")]
    for m in metrics:
        for name, f in (("median", F.median), ("mean", F.avg), ("max", F.max)):
            aggs += [f(F.col(m)).alias(f"{name}_{m}_raw"), f(F.when(k, F.col(m))).alias(f"{name}_{m}_filtered")]
    out = cells.groupBy(by).agg(*aggs).join(genes.select(by, "genes_raw", "genes_filtered"), by, "left")
    ends = [F.col(f"{side}_{m}").alias(f"cutoff_{m}_{name}") for m in metrics for side, name in (("lo", "lower"), ("hi", "upper")) if f"{side}_{m}" in bounds.columns]
    out = out.join(bounds.select(by, *ends), by, "left").withColumns({f"algo_{m}": F.lit(a) for m, a in (methods or {}).items()})
    out = with_total(out, by, ["cells_raw", "cells_filtered"])
    return out.withColumns({
        "cells_removed": F.col("cells_raw") - F.col("cells_filtered"),
        "pct_cells_removed": pct(F.col("cells_raw") - F.col("cells_filtered"), F.col("cells_raw")),
        "median_inflation_ratio": F.try_divide("median_nCount_filtered", "median_nCount_raw") if "nCount" in metrics else F.lit(None).cast("double"),
    })


def integrated_summary(raw: DataFrame, doublets: DataFrame, qc: DataFrame, of_raw: bool = False) -> DataFrame:
    """Full outer funnel by sample: raw(sample, cells_raw), doublets(sample, cells_after_ghost, dbr_used, doublets_found,
    ambiguous_found), qc(sample, cells_after_qc), with removals, percentages and a TOTAL whose ratios come from its sums.

    Percentages are of the cells that reach a step or, with ``of_raw``, of all cells at first; the rate has no total.
    """
    j = raw.join(doublets, "sample", "full").join(qc, "sample", "full")
    j = j.withColumn("cells_after_doublet_removal", F.col("cells_after_ghost") - F.col("doublets_found")).withColumn("total_cells_removal", F.col("cells_raw") - F.col("cells_after_qc"))
    out = with_total(j, "sample", [c for c in j.columns if c not in ("sample", "dbr_used")])
    seen, left = (F.col("cells_raw"), F.col("cells_raw")) if of_raw else (F.col("cells_after_ghost"), F.col("cells_after_doublet_removal"))
    return out.withColumns({
        "pct_doublets": pct(F.col("doublets_found"), seen),
        "pct_ambiguous": pct(F.col("ambiguous_found"), seen),
        "pct_qc_removal": pct(F.col("cells_after_doublet_removal") - F.col("cells_after_qc"), left),
        "pct_total_cells_removal": pct(F.col("total_cells_removal"), F.col("cells_raw")),
    })


def collapse_samples(df: DataFrame, by: str = "sample") -> DataFrame:
    """One row per sample: the maximum of each column (of texts too, so the result does not depend on row order)."""
    return df.groupBy(by).agg(*(F.max(c).alias(c) for c in df.columns if c != by))


def representative(column: Column) -> Column:
    """Aggregate: sorted distinct values joined by comma; ``Unknown`` without any."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.collect_set(column)), ", "), F.lit("")), F.lit("Unknown"))


def dataset_summary(cells: DataFrame, by: str, sample: str, describe: list[str]) -> DataFrame:
    """Per dataset: cells, samples and representative descriptions; largest first, then by name."""
    out = cells.groupBy(by).agg(F.count("*").alias("n_cells"), F.count_distinct(sample).alias("n_samples"), *(representative(F.col(c)).alias(c) for c in describe))
    return out.orderBy(F.desc("n_cells"), by)


def sample_summary(cells: DataFrame, study: str, sample: str) -> DataFrame:
    """Cells per sample with the rank of its study by size; ordered by study rank, cells, sample."""
    n = cells.groupBy(study, sample).agg(F.count("*").alias("n_cells"))
    s = n.groupBy(study).agg(F.sum("n_cells").alias("study_cells"))
    s = s.withColumn("study_rank", F.dense_rank().over(Window.orderBy(F.desc("study_cells"), study)))
    return n.join(F.broadcast(s), study).orderBy("study_rank", F.desc("n_cells"), sample)


def top_groups(df: DataFrame, by: str, value: str, n: int) -> DataFrame:
    """The ``n`` groups of greatest sum, ties to the smaller name."""
    return df.groupBy(by).agg(F.sum(value).alias("total")).orderBy(F.desc("total"), by).limit(n)


def composition(df: DataFrame, label: str) -> DataFrame:
    """label, n, fraction of all; counted first, so the window over all holds one row per label."""
    n = df.groupBy(label).agg(F.count("*").alias("n"))
    return n.withColumn("fraction", F.col("n") / F.sum("n").over(Window.partitionBy()))


def composition_by(df: DataFrame, sample: str, label: str) -> DataFrame:
    """sample, label, n, percentage within the sample."""
    n = df.groupBy(sample, label).agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.col("n") * 100 / F.sum("n").over(Window.partitionBy(sample)))


def confusion(df: DataFrame, truth: str, predicted: str, values: list[str]) -> DataFrame:
    """Cross-tab with the given predicted values as columns; pairs are counted before the pivot."""
    n = df.groupBy(truth, predicted).agg(F.count("*").alias("n"))
    return n.groupBy(truth).pivot(predicted, values).agg(F.sum("n")).fillna(0, values)


def similarity_stats(df: DataFrame, column: str, marks: tuple[float, ...] = (0.5, 0.7, 0.85)) -> DataFrame:
    """One row: mean, median and the percentages of values that reach each mark."""
    s = F.col(column)
    return df.agg(F.avg(s).alias("mean"), F.median(s).alias("median"), *((F.avg(F.when(s >= m, 100.0).otherwise(0.0))).alias(f"pct_{int(round(m * 100))}") for m in marks))


def doublet_summary(df: DataFrame, by: str) -> DataFrame:
    """Per sample: cells by status, percentages, and those retained (singlet and ambiguous)."""
    c = F.col("doublet_status")
    out = df.groupBy(by).agg(F.count("*").alias("total_cells"), F.count_if(c == "doublet").alias("doublets_found"), F.count_if(c == "ambiguous").alias("ambiguous_found"), F.count_if(c.isin("singlet", "ambiguous")).alias("cells_retained"))
    return out.withColumns({"pct_doublet": pct(F.col("doublets_found"), F.col("total_cells")), "pct_ambiguous": pct(F.col("ambiguous_found"), F.col("total_cells"))})


def to_long(df: DataFrame, ids: list[str], values: list[str], names: dict[str, str] | None = None) -> DataFrame:
    """ids..., stage, value; stages renamed by ``names``."""
    long = df.unpivot(ids, values, "stage", "value")
    if not names:
        return long
    m = F.create_map(*(F.lit(x) for kv in sorted(names.items()) for x in kv))
    return long.withColumn("stage", F.coalesce(F.try_element_at(m, F.col("stage")), F.col("stage")))


# fixed values: columns of clusterings and labels, which figures are not split by; patterns and whole names
UNSPLIT = (r"_res[0-9]", r"_res\.", "^SCT_snn_res", "^RNA_snn_res", r"^integrated\.", "(?i)^leiden_res", "^Level_", "_clusters$", "^celltype_final$", "^celltype$", "^seurat_clusters$", "^ident$")


def split_columns(df: DataFrame, preferred: list[str], low: int = 2, high: int = 24, excluded: tuple[str, ...] = UNSPLIT) -> DataFrame:
    """(column, n_levels) of text columns with ``low`` to ``high`` distinct non-empty values; preferred ones first."""
    texts = [c for c, t in df.dtypes if t in ("string", "boolean")]
    levels = df.agg(*(F.count_distinct(F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))).alias(c) for c in texts))
    long = levels.unpivot([], texts, "column", "n_levels")
    order = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for i, c in enumerate(preferred) for x in (c, i))), F.col("column")), F.lit(len(preferred))) if preferred else F.lit(0)
    return long.where(F.col("n_levels").between(low, high) & ~F.col("column").rlike("|".join(f"(?:{p})" for p in excluded) or "^$")).orderBy(order, "column")


def majority_map(df: DataFrame, source: str, target: str) -> DataFrame:
    """source -> its most frequent target (ties to the smaller)."""
    n = df.where(F.col(source).isNotNull() & F.col(target).isNotNull()).groupBy(source, target).agg(F.count("*").alias("n"))
    w = Window.partitionBy(source).orderBy(F.desc("n"), target)
    return n.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def subsample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by a hash of the key and the seed: the same rows in every run."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)


def run_totals(datasets: DataFrame, cells: str = "cells", genes: str = "genes") -> DataFrame:
    """One row: datasets, cells of all of them, and their mean number of genes."""
    return datasets.agg(F.count("*").alias("datasets"), F.coalesce(F.sum(cells), F.lit(0)).alias("total_cells"), F.avg(genes).alias("mean_genes"))


def stacked_compositions(parts: dict[str, DataFrame], label: str) -> DataFrame:
    """Compositions of several groups of cells in one table, with the group's name as ``group``."""
    out = None
    for name, df in parts.items():
        x = composition(df, label).withColumn("group", F.lit(name))
        out = x if out is None else out.unionByName(x)
    return out
