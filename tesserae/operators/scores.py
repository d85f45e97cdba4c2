"""Agreement of two labelings, overall scores, choice of resolution, rank tests, marker scores, prototypes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.operators.running import sum_below


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n) of rows with both labels; all agreement scores need no more than this."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").cast("double").alias("n"))


def _pairs(n: Column) -> Column:
    return n * (n - 1) / 2


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row ``ari``; 1 where both labelings are trivial in the same way."""
    c = contingency(df, a, b)
    cells = c.agg(F.sum(_pairs(F.col("n"))).alias("ij"), F.sum("n").alias("total"))
    rows = c.groupBy("a").agg(F.sum("n").alias("n")).agg(F.sum(_pairs(F.col("n"))).alias("i"))
    cols = c.groupBy("b").agg(F.sum("n").alias("n")).agg(F.sum(_pairs(F.col("n"))).alias("j"))
    x = cells.join(F.broadcast(rows)).join(F.broadcast(cols))
    expected = F.try_divide(F.col("i") * F.col("j"), _pairs(F.col("total")))
    return x.select(F.coalesce(F.try_divide(F.col("ij") - expected, (F.col("i") + F.col("j")) / 2 - expected), F.lit(1.0)).alias("ari"))


def mutual_information(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row ``nmi``: mutual information over the mean of both entropies; 1 if both are constant."""
    c = contingency(df, a, b)
    total = c.agg(F.sum("n").alias("t"))

    def entropy(x: DataFrame, name: str) -> DataFrame:
        p = F.col("n") / F.col("t")
        return x.join(F.broadcast(total)).agg((-F.sum(p * F.log(p))).alias(name))

    ha, hb = (entropy(c.groupBy(k).agg(F.sum("n").alias("n")), f"h{k}") for k in "ab")
    x = entropy(c, "hab").join(F.broadcast(ha)).join(F.broadcast(hb))
    return x.select(F.coalesce(F.try_divide((F.col("ha") + F.col("hb") - F.col("hab")) * 2, F.col("ha") + F.col("hb")), F.lit(1.0)).alias("nmi"))


def mean_finite(columns: list[str]) -> Column:
    """Mean of the finite ones of several columns of a row; null without any."""
    good = F.filter(F.array(*(F.col(c).cast("double") for c in columns)), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.try_divide(F.aggregate(good, F.lit(0.0), lambda s, x: s + x), F.size(good))


def overall_score(metrics: DataFrame, bio: list[str], batch: list[str], bio_weight: float = 0.6, batch_weight: float = 0.4) -> DataFrame:
    """``metrics`` with ``overall``: weighted mean of the bio and batch means; one missing leaves the other alone."""
    b, t = mean_finite(bio), mean_finite(batch)
    both = (b * bio_weight + t * batch_weight) / (bio_weight + batch_weight)
    return metrics.withColumn("overall", F.when(b.isNotNull() & t.isNotNull(), both).otherwise(F.coalesce(b, t)))


def active_metrics(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, active): whether any method has a finite value."""
    ok = [F.coalesce(F.max((~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c)) < float("inf"))).cast("int")), F.lit(0)).alias(c) for c in columns]
    return metrics.agg(*ok).unpivot([], columns, "metric", "a").select("metric", (F.col("a") == 1).alias("active"))


def best_row(df: DataFrame, score: str, order: str) -> DataFrame:
    """The row of greatest finite score, first by ``order`` among ties."""
    return df.where(F.col(score).isNotNull() & ~F.isnan(score)).orderBy(F.desc(score), order).limit(1)


def best_resolution(scores: DataFrame, min_resolution: float = 0.4, min_clusters: int = 5) -> DataFrame:
    """Row of ``scores(resolution, silhouette, n_clusters)`` of greatest finite silhouette among resolutions and cluster
    counts that are large enough; a condition that nothing meets is waived, in that order."""
    ok = scores.where(F.col("silhouette").isNotNull() & ~F.isnan("silhouette"))
    a = F.col("resolution") >= min_resolution
    ok = ok.withColumn("_a", F.when(F.max(a).over(Window.partitionBy()), a).otherwise(True)).where("_a")
    c = F.col("n_clusters") >= min_clusters
    ok = ok.withColumn("_c", F.when(F.max(c).over(Window.partitionBy()), c).otherwise(True)).where("_c")
    return ok.drop("_a", "_c").orderBy(F.desc("silhouette"), "resolution").limit(1)


def average_ranks(df: DataFrame, value: str, group: str, by: list[str] | None = None) -> DataFrame:
    """by..., group, value, m (rows), r (their tie-averaged rank). Equal values are counted before they are ranked, so
    a sort holds distinct values only, and ranks add up over ranges of them."""
    by = by or []
    n = df.groupBy(*by, group, value).agg(F.count("*").alias("m"))
    t = n.groupBy(*by, value).agg(F.sum("m").alias("t"))
    t = sum_below(t, by, F.col(value), F.col("t")).withColumn("r", F.col("below") + (F.col("t") + 1) / F.lit(2.0)).drop("below")
    return n.join(t, [*by, value])


def rank_sums(df: DataFrame, value: str, group: str, by: list[str] | None = None) -> DataFrame:
    """by..., group, n1, n2, rank_sum, u, auroc, z (one-vs-rest Wilcoxon, tie-corrected)."""
    by = by or []
    r = average_ranks(df, value, group, by)
    g = r.groupBy(*by, group).agg(F.sum("m").alias("n1"), F.sum(F.col("r") * F.col("m")).alias("rank_sum"))
    ties = r.dropDuplicates([*by, value]).groupBy(*by).agg(F.sum("t").cast("double").alias("n"), F.sum(F.pow(F.col("t").cast("double"), F.lit(3)) - F.col("t")).alias("ties"))
    g = (g.join(ties, by) if by else g.join(F.broadcast(ties))).withColumn("n2", F.col("n") - F.col("n1"))
    g = g.withColumn("u", F.col("rank_sum") - F.col("n1") * (F.col("n1") + 1) / 2)
    var = F.col("n1") * F.col("n2") / 12 * (F.col("n") + 1 - F.try_divide(F.col("ties"), F.col("n") * (F.col("n") - 1)))
    return g.withColumns({"auroc": F.try_divide(F.col("u"), F.col("n1") * F.col("n2")), "z": F.try_divide(F.col("u") - F.col("n1") * F.col("n2") / 2, F.nullif(F.sqrt(var), F.lit(0.0)))})


def rank_genes(counts: DataFrame, cells: DataFrame, cluster: str = "cluster", gene: str = "gene") -> DataFrame:
    """(gene, cluster, n1, n2, rank_sum, auroc, z, pct_in, pct_out): one-vs-rest Wilcoxon test of every gene and cluster.

    ``counts(cell, gene, value)`` holds positive values; all other cells of ``cells(cell, cluster)`` count as zeros. The
    zeros of a gene are one block of ties, counted and never made. Genes without a positive value have no rows.
    """
    size = cells.groupBy(cluster).agg(F.count("*").alias("n1"))
    whole = size.agg(F.sum("n1").alias("total"))
    hit = counts.where("value > 0").join(cells, "cell")
    n = hit.groupBy(gene, cluster, "value").agg(F.count("*").alias("m"))
    t = sum_below(n.groupBy(gene, "value").agg(F.sum("m").alias("t")), [gene], F.col("value"), F.col("t"))
    cube = lambda c: F.pow(c.cast("double"), F.lit(3)) - c
    per = t.groupBy(gene).agg(F.sum("t").alias("some"), F.sum(cube(F.col("t"))).alias("ties")).join(F.broadcast(whole))
    per = per.withColumn("zeros", F.col("total") - F.col("some")).withColumn("ties", F.col("ties") + cube(F.col("zeros")))
    own = n.join(t, [gene, "value"]).groupBy(gene, cluster).agg(F.sum("m").alias("k"), F.sum(F.col("m") * (F.col("below") + (F.col("t") + 1) / 2.0)).alias("above"))
    x = per.join(F.broadcast(size)).join(own, [gene, cluster], "left").withColumns({"k": F.coalesce("k", F.lit(0)), "above": F.coalesce("above", F.lit(0.0))})
    x = x.withColumn("n2", F.col("total") - F.col("n1"))
    x = x.withColumn("rank_sum", F.col("above") + F.col("k") * F.col("zeros") + (F.col("n1") - F.col("k")) * (F.col("zeros") + 1) / 2.0)
    u = F.col("rank_sum") - F.col("n1") * (F.col("n1") + 1) / 2
    var = F.col("n1") * F.col("n2") / 12 * (F.col("total") + 1 - F.try_divide(F.col("ties"), F.col("total") * (F.col("total") - 1)))
    return x.select(gene, cluster, "n1", "n2", "rank_sum", F.try_divide(u, F.col("n1") * F.col("n2")).alias("auroc"), F.try_divide(u - F.col("n1") * F.col("n2") / 2, F.nullif(F.sqrt(var), F.lit(0.0))).alias("z"), (F.col("k") / F.col("n1")).alias("pct_in"), F.try_divide(F.col("some") - F.col("k"), F.col("n2")).alias("pct_out"))


def label_hierarchy(counts: DataFrame, cells: DataFrame, markers: DataFrame, cluster: str = "cluster", depth: int = 3) -> DataFrame:
    """(cluster, level_k, level_k_score, level_k_auc, level_k_expr for k from 1): best label of each cluster, level by level.

    ``markers(level, label, parent, gene)``; below the first level only the children of the label chosen before compete.
    Ties go to the smaller name; a label without children ends the descent, and the lower levels are null.
    """
    out = cells.select(cluster).distinct()
    for k in range(1, depth + 1):
        level = markers.where(F.col("level") == k)
        s = marker_scores(counts, cells, level.select("label", "gene"), cluster)
        if k > 1:
            tree = level.select("label", F.col("parent").alias(f"level_{k - 1}")).distinct()
            s = s.join(tree, "label").join(out.select(cluster, f"level_{k - 1}"), [cluster, f"level_{k - 1}"])
        rank = Window.partitionBy(cluster).orderBy(F.desc_nulls_last(F.round("score", 9)), "label")
        best = s.withColumn("_n", F.row_number().over(rank)).where("_n = 1")
        best = best.select(cluster, F.col("label").alias(f"level_{k}"), *(F.col(c).alias(f"level_{k}_{c}") for c in ("score", "auc", "expr")))
        out = out.join(best, cluster, "left")
    return out


def marker_scores(counts: DataFrame, cells: DataFrame, markers: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, label, auc, expr, score): AUROC of the mean marker expression of a cluster's cells against all others,
    share of expressed marker entries, and their product.

    ``counts(cell, gene, value)``, ``cells(cell, cluster)``, ``markers(label, gene)``. Cells without any marker count
    take part as zeros, which are counted and never made, neither a gene nor a label; a label that no cell shows has auc 0.5.
    """
    size = markers.groupBy("label").agg(F.count_distinct("gene").alias("k"))
    hit = counts.where("value > 0").join(markers.distinct(), "gene").groupBy("cell", "label").agg(F.sum("value").alias("s"), F.count_distinct("gene").alias("x"))
    hit = hit.join(F.broadcast(size), "label").select("cell", "label", (F.col("s") / F.col("k")).alias("value"), (F.col("x") / F.col("k")).alias("e"))
    ranks = rank_genes(hit.select("cell", "label", "value"), cells, cluster, "label").select("label", cluster, "auroc")
    shown = hit.join(cells, "cell").groupBy("label", cluster).agg(F.sum("e").alias("e"))
    n = cells.groupBy(cluster).agg(F.count("*").alias("n"))
    every = n.join(F.broadcast(n.agg(F.sum("n").alias("total")))).join(F.broadcast(size.select("label")))  # a row a cluster and label
    none = F.when(F.col("total") > F.col("n"), 0.5)  # a label that no cell shows: all cells tie
    out = every.join(ranks.withColumn("ranked", F.lit(True)), ["label", cluster], "left").join(shown, ["label", cluster], "left")
    out = out.select(cluster, "label", F.when(F.col("ranked"), F.col("auroc")).otherwise(none).alias("auc"), (F.coalesce("e", F.lit(0.0)) / F.col("n")).alias("expr"))
    return out.withColumn("score", F.col("auc") * F.col("expr"))


def centroids(points: DataFrame, label: str = "label", vec: str = "vec") -> DataFrame:
    """(label, centroid): mean vector of each label, summed componentwise with map-side combine."""
    c = points.select(F.col(label).alias("label"), F.posexplode(vec).alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return c.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centroid"))


def classify_prototypes(points: DataFrame, prototypes: DataFrame, id_: str = "id", vec: str = "vec") -> DataFrame:
    """(id, predicted, dist, uncertainty): nearest prototype by L2, and its distance scaled to [0, 1] over the query.

    Prototypes are one row per cell type; they ride along as one array, so points are not multiplied. The distances are scaled by
    their range; taking off the median and dividing by the quartiles' distance before, as a robust scaler does, is affine and
    would change nothing.
    """
    book = prototypes.agg(F.array_sort(F.collect_list(F.struct(F.col("label").alias("label"), F.col("centroid").alias("c")))).alias("book"))

    def dist(p):
        return F.sqrt(F.aggregate(F.zip_with(F.col("_v"), p["c"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))

    x = points.select(F.col(id_).alias("id"), F.col(vec).cast("array<double>").alias("_v")).join(F.broadcast(book))
    best = F.array_min(F.transform("book", lambda p: F.struct(dist(p).alias("d"), p["label"].alias("label"))))
    x = x.withColumn("b", best).select("id", F.col("b.label").alias("predicted"), F.col("b.d").alias("dist"))
    lo, hi = x.agg(F.min("dist"), F.max("dist")).first()
    return x.withColumn("uncertainty", F.coalesce(F.try_divide(F.col("dist") - F.lit(lo), F.nullif(F.lit(hi) - F.lit(lo), F.lit(0.0))), F.lit(0.0)))


def isolated_labels(df: DataFrame, label: str, batch: str) -> DataFrame:
    """(label, n_batches, isolated): labels found in the fewest batches."""
    n = df.groupBy(label).agg(F.count_distinct(batch).alias("n_batches"))
    least = n.agg(F.min("n_batches").alias("least"))
    return n.join(F.broadcast(least)).select(label, "n_batches", (F.col("n_batches") == F.col("least")).alias("isolated"))


def isolated_f1(df: DataFrame, cluster: str, label: str, batch: str) -> DataFrame:
    """(label, f1): for each label found in the fewest batches, the best F1 of a cluster taken as that label. From the contingency
    table alone; rows of a null label or cluster take no part in the counts."""
    c = contingency(df, label, cluster).withColumns({"n_label": F.sum("n").over(Window.partitionBy("a")), "n_cluster": F.sum("n").over(Window.partitionBy("b"))})
    best = c.groupBy(F.col("a").alias(label)).agg(F.max(2 * F.col("n") / (F.col("n_label") + F.col("n_cluster"))).alias("f1"))
    return best.join(isolated_labels(df, label, batch).where("isolated").select(label), label)


def isolated_asw(scores: DataFrame, cells: DataFrame, label: str, batch: str) -> DataFrame:
    """(label, asw): mean silhouette, scaled to [0, 1], of the cells of each label found in the fewest batches. ``scores`` has
    (id, label, silhouette) by label."""
    alone = isolated_labels(cells, label, batch).where("isolated").select(label)
    return scores.join(alone, label).groupBy(label).agg(((F.avg("silhouette") + 1) / 2).alias("asw"))
