"""Labels of clusters: parents, scores, overrides, mapping onto cells, tiered barcode matching, prototypes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.text import bare_barcode, is_missing, strip_barcode


def flatten_markers(tree: dict, level: int = 1, parent: str | None = None) -> list[tuple[int, str, str | None, str]]:
    """(level, label, parent, gene) rows of a marker tree ``{name: {marker_genes: [...], subtypes: {...}}}``."""
    rows = []
    for label, node in tree.items():
        if isinstance(node, dict):
            rows += [(level, label, parent, g) for g in node.get("marker_genes") or []]
            rows += flatten_markers(node.get("subtypes") or {}, level + 1, label)
    return rows


def propagate_labels(assignments: DataFrame, levels: list[str]) -> DataFrame:
    """Missing child labels take their parent's; what is still missing is ``Unassigned``."""
    out = assignments
    for parent, child in zip(levels, levels[1:], strict=False):
        out = out.withColumn(child, F.when(is_missing(F.col(child)), F.col(parent)).otherwise(F.col(child)))
    return out.withColumns({c: F.when(is_missing(F.col(c)), "Unassigned").otherwise(F.col(c)) for c in levels})


def propagate_scores(assignments: DataFrame, levels: list[str], metrics: tuple[str, ...] = ("score",)) -> DataFrame:
    """Where a child's label is its parent's and its metric is missing, the parent's metric; level by level."""
    out = assignments
    for parent, child in zip(levels, levels[1:], strict=False):
        for m in metrics:
            c, p = F.col(f"{child}_{m}"), F.col(f"{parent}_{m}")
            out = out.withColumn(f"{child}_{m}", F.when(c.isNull() & (F.col(child) == F.col(parent)), p).otherwise(c))
    return out


def override_labels(assignments: DataFrame, overrides: DataFrame, levels: list[str]) -> DataFrame:
    """``overrides(cluster, level, label)`` replace labels; level names match without case and underscores.

    Unknown clusters and levels change nothing; of repeated overrides the greatest label counts.
    """
    o = overrides.groupBy("cluster", F.lower(F.regexp_replace("level", "_", "")).alias("k")).agg(F.max("label").alias("label"))
    keys = {c: c.lower().replace("_", "") for c in levels}
    wide = o.groupBy("cluster").pivot("k", list(keys.values())).agg(F.max("label"))
    wide = wide.select("cluster", *(F.col(k).alias(f"_{c}") for c, k in keys.items()))
    out = assignments.join(wide, "cluster", "left")
    return out.withColumns({c: F.coalesce(f"_{c}", c) for c in levels}).select(*assignments.columns)


def map_labels(cells: DataFrame, assignments: DataFrame, levels: list[str], cluster: str = "cluster") -> DataFrame:
    """Cells with their cluster's labels and ``latest``: the deepest label, else the cluster id. Clusters are few, and
    Spark broadcasts their table by its size."""
    a = assignments.select(F.col("cluster").cast("string").alias("_c"), *levels).dropDuplicates(["_c"])
    out = cells.join(a, F.col(cluster).cast("string") == F.col("_c"), "left").drop("_c")
    return out.withColumn("latest", F.coalesce(*reversed(levels), F.col(cluster).cast("string")))


def last_per_cluster(metrics: DataFrame, seq: str = "seq") -> DataFrame:
    """Of repeated clusters, the row of greatest ``seq``."""
    w = Window.partitionBy("cluster").orderBy(F.desc(seq))
    return metrics.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def tiered_match(cells: DataFrame, labels: DataFrame, key: str = "barcode", value: str = "label", least: float = 0.5) -> DataFrame:
    """``cells`` with the label matched by barcode: exact; if fewer than ``least`` match, without ``-N``; if still
    fewer, by the token after the last underscore. Unmatched stay null; ``tier`` is the tier used (0 to 2).

    Of repeated right keys the least label counts. Each tier is one equi-join, tried only if needed.
    """
    tiers = (lambda c: c, strip_barcode, bare_barcode)
    for i, f in enumerate(tiers):
        right = labels.select(f(F.col(key)).alias("_k"), value).where("_k is not null").groupBy("_k").agg(F.min(value).alias(value))
        out = cells.join(right, f(F.col(key)) == F.col("_k"), "left").withColumn("tier", F.lit(i))
        if i < 2 and (out.agg(F.avg(F.col("_k").isNotNull().cast("double"))).first()[0] or 0.0) >= least:
            break
    return out.drop("_k")


def roll_up(predictions: DataFrame, bridge: DataFrame, upper: DataFrame | None = None) -> DataFrame:
    """Prototype -> label by ``bridge(prototype, label)``, unmapped prototypes as themselves; label -> ``upper_label``
    by ``upper(label, upper_label)``, null if unmapped."""
    out = predictions.join(bridge.withColumnRenamed("label", "_l"), "prototype", "left").withColumn("label", F.coalesce("_l", "prototype")).drop("_l")
    return out if upper is None else out.join(upper, "label", "left")
