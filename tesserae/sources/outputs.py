"""What stages write for people and for later stages: tables as CSV or TSV with a header, summaries as JSON or text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.sources.tables import write_mtx, write_report

# fixed values: columns of a prediction table, in their order
PREDICTION_COLUMNS = ("study", "Level_3_prototype", "Level_3_pred", "Level_3_uncert", "Level_2_pred", "Level_1_pred")
# fixed values: a manifest's columns that only the pipeline reads, and those that every manifest has
PIPELINE_ONLY = ("sample_dir", "run_cellbender", "cellbender_mode", "skip", "output_dir")
MANDATORY = ("data_path", "sample_id", "study", "source", "diff_protocol", "sc_protocol", "sequencing", "genome_build", "Age", "type")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file in any folder that Spark reaches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def write_annotation(cells: DataFrame, assignments: DataFrame, root: str) -> None:
    """Annotated cells as Parquet, and the labels of all clusters at all resolutions as one CSV, by resolution and cluster.

    ``assignments`` has resolution and cluster first; a cluster's row is small, whatever its cells.
    """
    cells.write.mode("overwrite").parquet(f"{root}/annotated")
    head = ["resolution", "cluster"]
    write_report(assignments.select(*head, *(c for c in assignments.columns if c not in head)).orderBy(*head), f"{root}/assignments")


def export_markers(markers: DataFrame, path: str) -> None:
    """``markers(level, label, parent, gene)`` as a nested JSON file that ``read_markers`` reads back."""
    rows = markers.orderBy("level", "label", "gene").collect()  # a panel of markers, written by hand
    tree: dict = {}
    nodes: dict[tuple[int, str], dict] = {}
    for r in rows:
        key = (r["level"], r["label"])
        if key not in nodes:
            nodes[key] = {"marker_genes": [], "subtypes": {}}
            above = tree if r["level"] == 1 else nodes.setdefault((r["level"] - 1, r["parent"]), {"marker_genes": [], "subtypes": {}})["subtypes"]
            above[r["label"]] = nodes[key]
        nodes[key]["marker_genes"].append(r["gene"])
    write_text(markers.sparkSession, path, json.dumps(tree, indent=2, ensure_ascii=False))


def write_resolutions(scores: DataFrame, chosen: DataFrame, root: str) -> None:
    """Silhouettes, and the summary of all resolutions with the chosen one marked; ``chosen`` has one row or none."""
    write_report(scores.select("resolution", "silhouette").orderBy("resolution"), f"{root}/silhouette_scores")
    mark = chosen.select("resolution", F.lit(True).alias("selected"))
    out = scores.join(F.broadcast(mark), "resolution", "left").withColumn("selected", F.coalesce("selected", F.lit(False)))
    write_report(out.orderBy("resolution"), f"{root}/resolution_summary")


def write_metrics(metrics: DataFrame, root: str, unintegrated: str = "unintegrated") -> str | None:
    """Scores of methods as CSV, and the integrated method of greatest ``overall`` with its score as text; its name, if any."""
    write_report(metrics.orderBy("method"), f"{root}/scib_raw_metrics")
    good = metrics.where((F.col("method") != unintegrated) & F.col("overall").isNotNull() & ~F.isnan("overall"))
    best = good.orderBy(F.desc("overall"), "method").first()
    if best:
        write_text(metrics.sparkSession, f"{root}/best_method.txt", f"{best['method']}\t{best['overall']:.4f}\n")
    return best["method"] if best else None


def predictions(cells: DataFrame, id_: str, batch: str) -> DataFrame:
    """The columns of a prediction table that ``cells`` has."""
    return cells.select(id_, *(c for c in dict.fromkeys((batch, *PREDICTION_COLUMNS)) if c in cells.columns and c != id_))


def level_composition(cells: DataFrame, label: str = "Level_2_pred") -> DataFrame:
    """(label, n_cells), most cells first."""
    return cells.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_cells")).orderBy(F.desc("n_cells"), label)


def write_predictions(cells: DataFrame, root: str, stem: str, id_: str = "cell", batch: str = "sample_id") -> None:
    """Predictions of all cells as TSV parts, and the composition by the second level's label if there is one."""
    predictions(cells, id_, batch).write.mode("overwrite").csv(f"{root}/query_predictions_{stem}", header=True, sep="\t")
    if "Level_2_pred" in cells.columns:
        write_report(level_composition(cells), f"{root}/query_Level2_composition_{stem}", "\t")


def write_projection_summary(spark: SparkSession, stats: DataFrame, root: str, stem: str, facts: dict | None = None) -> dict:
    """The one row of similarity statistics as JSON, and within the projection's summary."""
    row = json.loads(stats.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).first()[0])
    write_text(spark, f"{root}/atlas_query_similarity_summary_{stem}.json", json.dumps(row, indent=2))
    summary = {**(facts or {}), "similarity": row}
    write_text(spark, f"{root}/projection_summary.json", json.dumps(summary, indent=2))
    return summary


def write_maps(majority: DataFrame, prototypes: DataFrame, root: str) -> None:
    """The majority map and the prototype map as TSV."""
    write_report(majority.orderBy(*majority.columns), f"{root}/majority_map", "\t")
    write_report(prototypes.orderBy(*prototypes.columns), f"{root}/prototype_map", "\t")


def write_benchmark_inputs(cells: DataFrame, kept: list[str], path: str, id_: str = "cell_id") -> None:
    """Cells' metadata as CSV: the id and those of the ``kept`` columns that there are."""
    cells.select(id_, *(c for c in kept if c in cells.columns and c != id_)).write.mode("overwrite").csv(path, header=True)


def write_matrix(counts: DataFrame, cells: DataFrame, folder: str) -> None:
    """Counts as a matrix, and the metadata of its cells beside it."""
    write_mtx(counts, folder)
    cells.write.mode("overwrite").csv(f"{folder}/obs", header=True)


def _join(*parts: Column) -> Column:
    return F.regexp_replace(F.concat_ws("/", *parts), "/+", "/")


def prepared_manifest(manifest: DataFrame, done: DataFrame, suffix: str, working_dir: str = "") -> DataFrame:
    """The manifest that harmonisation reads: where ambient RNA was removed (``done(sample_id)``), data_path is that output.

    It lies in the sample's folder: sample_dir if given, else the folder of a data file, else data_path. Relative paths are
    taken from ``working_dir``. Columns for the pipeline alone go, mandatory ones that are missing come as empty texts.
    """
    work = lambda p: F.when((F.lit(working_dir) != "") & ~p.startswith("/"), _join(F.lit(working_dir), p)).otherwise(p)
    path = F.trim("data_path")
    given = F.nullif(F.trim("sample_dir"), F.lit("")) if "sample_dir" in manifest.columns else F.lit(None).cast("string")
    folder = F.when(F.lower(path).rlike(r"\.(h5|h5ad|hdf5)$"), F.regexp_replace(path, "/?[^/]*$", "")).otherwise(path)
    sample = F.trim("sample_id")
    ran = done.select(F.trim("sample_id").alias("_done")).distinct()
    out = manifest.join(ran, sample == F.col("_done"), "left")
    swapped = F.when(F.col("_done").isNotNull(), _join(F.nullif(work(F.coalesce(given, folder)), F.lit("")), F.concat(sample, F.lit(suffix)))).otherwise(work(path))
    kept = [F.col(f"`{c}`") for c in manifest.columns if c not in (*PIPELINE_ONLY, "data_path")]
    return out.select(swapped.alias("data_path"), *kept, *(F.lit("").alias(c) for c in MANDATORY if c not in manifest.columns))
