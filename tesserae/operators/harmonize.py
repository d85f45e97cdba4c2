"""Gene-space harmonisation on long counts: reference genes, alignment, zero fill, transgene names, sample metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.text import gene_key, or_unknown

# fixed values: manifest columns by their use
MANDATORY = ("data_path", "sample_id", "study", "source", "diff_protocol", "sc_protocol", "sequencing", "genome_build", "Age", "type")
CONTROL = ("file_prefix", "output_dir", "skip", "sample_dir", "run_cellbender", "cellbender_mode")


def gene_space(genes: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Distinct genes, with transgenes united, and their position in code-point order (a gene list is small)."""
    g = genes.select("gene").union(extra.select("gene")) if extra is not None else genes.select("gene")
    g = g.where("gene is not null").distinct()
    return g.withColumn("idx", F.row_number().over(Window.orderBy("gene")) - 1)


def harmonize(counts: DataFrame, genes: DataFrame, gene: str = "gene") -> DataFrame:
    """Counts of reference genes only; missing genes are zeros by being absent. Float counts, as stored."""
    return counts.join(genes.select(F.col("gene").alias(gene)), gene, "left_semi").withColumn("count", F.col("count").cast("float"))


def gene_overlap(counts: DataFrame, genes: DataFrame) -> DataFrame:
    """One row: n_reference, n_query, n_shared, n_missing (reference only), n_extra (query only), share."""
    q, r = counts.select("gene").distinct().withColumn("q", F.lit(1)), genes.select("gene").distinct().withColumn("r", F.lit(1))
    j = r.join(q, "gene", "full")
    out = j.agg(F.count("r").alias("n_reference"), F.count("q").alias("n_query"), F.count_if(F.col("r").isNotNull() & F.col("q").isNotNull()).alias("n_shared"))
    return out.select("*", (F.col("n_reference") - F.col("n_shared")).alias("n_missing"), (F.col("n_query") - F.col("n_shared")).alias("n_extra"), F.try_divide("n_shared", "n_reference").alias("share"))


def require_overlap(counts: DataFrame, genes: DataFrame, least: float = 0.5) -> None:
    share = gene_overlap(counts, genes).first()["share"] or 0.0
    if share < least:
        raise ValueError(f"only {share:.1%} of the reference genes are in the query; {least:.0%} are needed")


def zero_filled(counts: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """Dense (cell, gene, count) view of a set of cells: a row for each of their reference genes, absent ones 0.

    Meant for a bounded gene list (it is an array on each cell's row, exploded); the cells may be any number.
    """
    panel = genes.agg(F.sort_array(F.collect_set("gene")).alias("gs"))
    dense = cells.select("cell").distinct().join(F.broadcast(panel)).select("cell", F.explode("gs").alias("gene"))
    have = counts.groupBy("cell", "gene").agg(F.sum("count").alias("count"))
    return dense.join(have, ["cell", "gene"], "left").withColumn("count", F.coalesce("count", F.lit(0.0)))


def concat_samples(*parts: DataFrame) -> DataFrame:
    """All samples' counts, outer over genes and columns; barcodes repeated across samples stay apart by sample_id."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def unique_cells(cells: DataFrame, by: str = "barcode") -> DataFrame:
    """``cells`` with ``cell_id``: the barcode, and ``-1``, ``-2``.. on its repeats in order of sample_id."""
    n = F.row_number().over(Window.partitionBy(by).orderBy("sample_id")) - 1
    return cells.withColumn("cell_id", F.when(n > 0, F.concat(F.col(by), F.lit("-"), n.cast("string"))).otherwise(F.col(by)))


def resolve_transgenes(genes: DataFrame, requested: DataFrame) -> DataFrame:
    """(requested, resolved, how) for wanted gene names: exact, or the least variant that differs only by case and
    ``-_.`` and is not itself requested (so no wanted gene is renamed away), or missing."""
    want = requested.select(F.col("gene").alias("requested")).distinct()
    have = genes.select("gene").distinct()
    exact = want.join(have.withColumn("exact", F.lit(True)), want["requested"] == F.col("gene"), "left").drop("gene")
    free = have.join(want, have["gene"] == want["requested"], "left_anti").withColumn("key", gene_key(F.col("gene"))).groupBy("key").agg(F.min("gene").alias("variant"))
    out = exact.withColumn("key", gene_key(F.col("requested"))).join(free, "key", "left")
    resolved = F.when(F.col("exact"), F.col("requested")).otherwise(F.col("variant"))
    how = F.when(F.col("exact"), "exact").when(F.col("variant").isNotNull(), "variant").otherwise("missing")
    return out.select("requested", resolved.alias("resolved"), how.alias("how"))


def obs_columns(columns: list[str]) -> list[str]:
    """Manifest columns that go to cells: mandatory ones in their order, then extras; control columns never."""
    return [c for c in MANDATORY if c != "data_path"] + [c for c in columns if c not in MANDATORY and c not in CONTROL]


def manifest_problems(manifest: DataFrame) -> DataFrame:
    """(row, problem) of a manifest with its CSV row number ``row``: empty path or study, repeated sample."""
    m = manifest.where(F.coalesce(F.lower(F.trim("skip")) != "true", F.lit(True))) if "skip" in manifest.columns else manifest
    m = m.withColumn("_again", F.count("*").over(Window.partitionBy(F.trim("sample_id"))) > 1)
    flags = F.array(
        F.when(F.coalesce(F.trim("data_path"), F.lit("")) == "", "empty data_path"),
        F.when(F.coalesce(F.trim("study"), F.lit("")) == "", "empty study"),
        F.when(F.col("_again"), "duplicate sample_id"),
    )
    return m.select("row", F.explode(F.filter(flags, lambda x: x.isNotNull())).alias("problem"))


def broadcast_metadata(cells: DataFrame, samples: DataFrame, columns: list[str], on: str = "sample_id") -> DataFrame:
    """Cells with their sample's metadata as trimmed strings, blanks and unmatched as ``Unknown``."""
    meta = samples.select(on, *(or_unknown(F.col(c)).alias(c) for c in columns))
    out = cells.join(meta, on, "left")
    return out.withColumns({c: F.coalesce(c, F.lit("Unknown")) for c in columns})
