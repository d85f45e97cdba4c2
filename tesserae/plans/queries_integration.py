"""Clustering, integration and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.operators import anchors, community, decompose, integration, metrics, neighbors, scores, selection
from tesserae.plans.registry import counts, query, table
from tesserae.plans.workspace import Workspace


def _vec(spark, d):
    return table(spark, d, "embeddings").selectExpr("vec_id as id", "embedding as vec", "label")


@query()
def modularity_clusters(spark, d):
    """Local-move clustering of the neighbour graph; not Leiden, so no oracle."""
    v = _vec(spark, d)
    return integration.modularity_clusters(neighbors.knn(v, v, 15, include_self=False).select("query", "neighbour"))


@query(
    """
WITH e AS (SELECT vec_id id, embedding::DOUBLE[] v, label FROM embeddings), k AS (SELECT q, n FROM (SELECT a.id q, b.id n, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) r FROM e a JOIN e b ON a.id <> b.id) WHERE r <= 10),
g AS (SELECT q a, n b FROM k UNION ALL SELECT n, q FROM k), x AS (SELECT p.label ca, r.label cb FROM g JOIN e p ON p.id = a JOIN e r ON r.id = b), t AS (SELECT count(*)::DOUBLE m2, count(*) FILTER (ca = cb)::DOUBLE i FROM x)
SELECT round(i / m2 - (SELECT sum(k * k) FROM (SELECT count(*)::DOUBLE k FROM x GROUP BY ca)) / (m2 * m2), 9) modularity FROM t"""
)
def label_modularity(spark, d):
    v = _vec(spark, d)
    e = neighbors.knn(v, v, 10, include_self=False).select("query", "neighbour")
    return integration.modularity(e, v.select(F.col("id").alias("node"), F.col("label").alias("cluster"))).select(F.round("modularity", 9).alias("modularity"))


@query()
def batch_correction(spark, d):
    """Harmony-style correction; iterative floating point, so no oracle."""
    v = _vec(spark, d).select("id", (F.col("id") % 4).alias("batch"), "vec")
    return integration.correct_batches(v, rounds=3)


@query(
    """
WITH e AS (SELECT vec_id id, embedding::DOUBLE[] v FROM embeddings), p AS (SELECT a.id a, b.id b, list_distance(a.v, b.v) d FROM e a JOIN e b ON a.id % 2 = 0 AND b.id % 2 = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d, b) ra, row_number() OVER (PARTITION BY b ORDER BY d, a) rb FROM p) SELECT a, b, round(d, 6) dist FROM r WHERE ra <= 5 AND rb <= 5"""
)
def mutual_neighbours(spark, d):
    """Anchors of two batches."""
    v = _vec(spark, d)
    return integration.mutual_neighbours(v.where("id % 2 = 0"), v.where("id % 2 = 1")).withColumn("dist", F.round("dist", 6))


@query(
    """
WITH c AS (SELECT o_orderpriority sample, l_partkey gene, sum(l_quantity) s, sum(l_quantity * l_quantity) q FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY q / s DESC, gene) r FROM c), t AS (SELECT gene, count(*) n_samples, median(r) median_rank FROM r WHERE r <= 200 GROUP BY 1)
SELECT * FROM t ORDER BY n_samples DESC, median_rank, gene LIMIT 200"""
)
def integration_features(spark, d):
    """E13."""
    o = table(spark, d, "orders").selectExpr("o_orderkey as cell", "o_orderpriority as sample")
    x = counts(spark, d).join(o, "cell").groupBy("sample", "gene").agg((F.sum(F.col("count") * F.col("count")) / F.sum("count")).alias("dispersion"))
    return integration.integration_features(x, 200)


@query("SELECT p_brand AS dataset, count(*) n FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 49 AND p_retailprice > 1000) GROUP BY 1")
def noisy_exclusion(spark, d):
    """P11 U8."""
    p = table(spark, d, "part").withColumnRenamed("p_brand", "dataset")
    return selection.exclude(p, p.where("p_size > 49 and p_retailprice > 1000")).groupBy("dataset").agg(F.count("*").alias("n"))


_DATASETS = "SELECT DISTINCT p_brand || CASE p_size % 3 WHEN 0 THEN '_singlets' WHEN 1 THEN '_with_doublet_calls' ELSE '' END dataset FROM part"


@query(f"WITH n AS ({_DATASETS}) SELECT dataset FROM n WHERE NOT (dataset LIKE '%\\_with\\_doublet\\_calls' ESCAPE '\\' AND (SELECT count(*) FROM n WHERE dataset LIKE '%\\_singlets' ESCAPE '\\') > 0)")
def singlet_preference(spark, d):
    """P12."""
    end = F.get(F.array(F.lit("_singlets"), F.lit("_with_doublet_calls"), F.lit("")), (F.col("p_size") % 3).cast("int"))
    return selection.prefer_singlets(table(spark, d, "part").select(F.concat("p_brand", end).alias("dataset")).distinct())


@query("SELECT c_custkey, coalesce(nullif(CASE WHEN c_mktsegment = 'MACHINERY' THEN ' ' ELSE c_mktsegment END, ' '), 'q1') sample_id, 'query' study FROM customer")
def condition_completion(spark, d):
    """G4 G5."""
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_mktsegment") == "MACHINERY", " ").otherwise(F.col("c_mktsegment")).alias("library_id"))
    return selection.complete_conditions(selection.complete_sample(c, "q1"), ["study", "sample_id"], "sample_id").select("c_custkey", "sample_id", "study")


@query("SELECT unnest([0.4, 0.6, 1.0])::DOUBLE resolution, (SELECT count(*) FROM embeddings) n_nodes, 0::BIGINT disconnected, true beats_labels, true beats_moves")
def leiden_sweep(spark, d):
    """Clusters of one neighbour graph at the annotation's resolutions hold together, and their modularity is not below that
    of the labels, nor at 1.0 below that of plain local moves."""
    v, ws = _vec(spark, d), Workspace(spark, "leiden-query")
    e = ws.save(neighbors.knn(v, v, 15, include_self=False).select("query", "neighbour"), "graph")
    c = ws.save(community.leiden(e, [0.4, 0.6, 1.0]), "clusters")
    given = v.select(F.explode(F.array(F.lit(0.4), F.lit(0.6), F.lit(1.0))).alias("resolution"), F.col("id").alias("node"), F.col("label").cast("string").alias("cluster"))
    q = community.modularities(e, c).join(community.modularities(e, given).withColumnRenamed("modularity", "given"), "resolution")
    moves = integration.modularity(e, integration.modularity_clusters(e)).first()["modularity"]
    n = c.groupBy("resolution").agg(F.count_distinct("node").alias("n_nodes"))
    out = n.join(community.disconnected(e, c), "resolution").join(q, "resolution")
    return out.select("resolution", "n_nodes", "disconnected", (F.col("modularity") >= F.col("given")).alias("beats_labels"), ((F.col("resolution") < 1) | (F.col("modularity") >= F.lit(moves))).alias("beats_moves"))


@query(
    """
WITH r(resolution, k) AS (VALUES (0.4::DOUBLE, 2), (0.6, 5), (1.0, 10)), c AS (SELECT resolution, label, CASE WHEN vec_id % 7 = 0 THEN 0 ELSE label % k END AS cluster, count(*)::DOUBLE n FROM embeddings, r GROUP BY ALL),
t AS (SELECT resolution, sum(n) t FROM c GROUP BY 1), h AS (SELECT resolution, -sum(n / t * ln(n / t)) h FROM c JOIN t USING (resolution) GROUP BY 1),
a AS (SELECT resolution, -sum(n / t * ln(n / t)) ha FROM (SELECT resolution, cluster, sum(n) n FROM c GROUP BY ALL) JOIN t USING (resolution) GROUP BY 1), b AS (SELECT resolution, -sum(n / t * ln(n / t)) hb FROM (SELECT resolution, label, sum(n) n FROM c GROUP BY ALL) JOIN t USING (resolution) GROUP BY 1),
m AS (SELECT resolution, round((ha + hb - h) * 2 / (ha + hb), 9) nmi FROM h JOIN a USING (resolution) JOIN b USING (resolution)),
k AS (SELECT resolution, count(DISTINCT cluster) n_clusters FROM c GROUP BY 1) SELECT resolution, n_clusters, nmi, row_number() OVER (ORDER BY nmi DESC, resolution) = 1 best FROM m JOIN k USING (resolution)"""
)
def resolution_by_nmi(spark, d):
    """B-RES A24: the resolution whose clusters tell most about the labels."""
    e = table(spark, d, "embeddings").withColumn("r", F.explode(F.array(*(F.struct(F.lit(r).alias("resolution"), F.lit(k).alias("k")) for r, k in ((0.4, 2), (0.6, 5), (1.0, 10))))))
    c = e.select("r.resolution", F.col("vec_id").alias("node"), F.when(F.col("vec_id") % 7 == 0, 0).otherwise(F.col("label") % F.col("r.k")).alias("cluster"))
    out = community.resolution_by_nmi(c, table(spark, d, "embeddings").select(F.col("vec_id").alias("node"), "label"))
    return out.join(community.cluster_counts(c), "resolution").select("resolution", "n_clusters", F.round("nmi", 9).alias("nmi"), "best")


@query(
    """
WITH n AS (SELECT count(DISTINCT l_orderkey)::DOUBLE n FROM lineitem), v AS (SELECT l_orderkey cell, l_partkey gene, ln(1 + l_quantity * 10000 / sum(l_quantity) OVER (PARTITION BY l_orderkey)) v FROM lineitem),
m AS (SELECT gene, sum(v) / n mean, sqrt(greatest(sum(v * v) - n * pow(sum(v) / n, 2), 0) / (n - 1)) sd FROM v, n WHERE gene < 20 GROUP BY gene, n),
o AS (SELECT cell, gene, greatest(-3, least(3, (v - mean) / sd)) - greatest(-3, -mean / sd) x FROM v JOIN m USING (gene)), s AS (SELECT cell, gene, sum(x) x FROM o GROUP BY ALL), u AS (SELECT gene, sum(x) t FROM s GROUP BY 1),
g AS (SELECT a.gene i, b.gene j, sum(a.x * b.x) p FROM s a JOIN s b USING (cell) GROUP BY ALL), c AS (SELECT (coalesce(p, 0) - a.t * b.t / n) / (n - 1) c, a.gene = b.gene same FROM n, u a JOIN u b ON true LEFT JOIN g ON i = a.gene AND j = b.gene)
SELECT (SELECT count(*) FROM m) n_components, (SELECT n::BIGINT FROM n) n_cells, round(sum(c) FILTER (same), 6) total_variance, round(sum(c * c), 6) squared_variance, round(sum(c) FILTER (same) * (SELECT n - 1 FROM n), 3) squared_length FROM c"""
)
def sparse_pca(spark, d):
    """All components of some genes' zero-aware scaled expression. Sums of variances and of their squares do not depend on
    signs or order, and SQL has them from the covariances."""
    values = metrics.normalize_log1p(counts(spark, d))
    cells = values.select("cell").distinct()
    n = cells.count()
    m = metrics.gene_moments(decompose.select_genes(values, spark.range(20).withColumnRenamed("id", "gene")), n)
    pcs, _, variance = decompose.sparse_pca(values, cells, m, k=20, limit=3.0)
    out = pcs.agg(F.count("*").alias("n_cells"), F.round(F.sum(F.aggregate("pc", F.lit(0.0), lambda s, x: s + x * x)), 3).alias("squared_length"))
    return out.select(F.lit(len(variance)).cast("long").alias("n_components"), "n_cells", F.lit(round(sum(variance), 6)).alias("total_variance"), F.lit(round(sum(x * x for x in variance), 6)).alias("squared_variance"), "squared_length")


@query(
    """
WITH s AS (SELECT vec_id id, vec_id % 2 side, embedding::DOUBLE[] v FROM embeddings),
d AS (SELECT a.id i, b.id j, a.side sa, b.side sb, row_number() OVER (PARTITION BY a.id, b.side ORDER BY list_distance(a.v, b.v), b.id) r FROM s a JOIN s b ON a.id <> b.id), n AS (SELECT i, j FROM d WHERE r <= 10),
m AS (SELECT x.i a, x.j b FROM d x JOIN d y ON x.i = y.j AND x.j = y.i WHERE x.sa = 0 AND x.sb = 1 AND x.r <= 5 AND y.r <= 5),
c AS (SELECT a, b, count(q.j)::DOUBLE n FROM m JOIN n p ON p.i = a LEFT JOIN n q ON q.i = b AND q.j = p.j GROUP BY 1, 2), l AS (SELECT quantile_cont(n, 0.01) lo, quantile_cont(n, 0.9) hi FROM c)
SELECT a, b, round(CASE WHEN hi <= lo THEN 1 ELSE least(greatest((n - lo) / (hi - lo), 0), 1) END, 9) score FROM c, l"""
)
def anchor_scores(spark, d):
    """Anchors of two batches and their scores by shared neighbours."""
    v = _vec(spark, d)
    a, b = anchors.Batch(v.where("id % 2 = 0")), anchors.Batch(v.where("id % 2 = 1"))
    return anchors.find_anchors(anchors.spaces(a, b, "none", 0), k=5, k_score=10).withColumn("score", F.round("score", 9))


@query("SELECT m AS method, CASE WHEN m = 'none' THEN 'failed' ELSE 'ok' END status, CASE WHEN m = 'none' THEN 0 ELSE (SELECT count(*) FROM embeddings) END n_cells, m <> 'none' closer FROM (SELECT unnest(['cca', 'rpca', 'none']) m)")
def integration_methods(spark, d):
    """Two batches, one of them shifted, by canonical and by reciprocal anchors, and a method that fails; whether the batches came closer."""
    shift = F.transform("vec", lambda x, i: x.cast("double") + F.when((F.col("id") % 2 == 1) & (i < 16), 0.5).otherwise(0.0))
    cells = _vec(spark, d).select("id", F.when(F.col("id") % 2 == 1, "q").otherwise("p").alias("batch"), shift.alias("vec"))

    def gap(df):
        m = df.select("batch", F.posexplode("vec").alias("i", "x")).groupBy("i").agg((F.avg(F.when(F.col("batch") == "p", F.col("x"))) - F.avg(F.when(F.col("batch") == "q", F.col("x")))).alias("g"))
        return m.agg(F.sqrt(F.sum(F.col("g") * F.col("g")))).first()[0]

    methods = {"cca": lambda c: anchors.integrate_anchors(c, "cca", dims=20), "rpca": lambda c: anchors.integrate_anchors(c, "rpca", dims=20), "none": lambda c: anchors.integrate_anchors(c, "missing")}
    done, status = anchors.integrate_all(cells, methods)
    before = gap(cells)
    near = [n for n, df in done.items() if gap(df) < 0.7 * before]
    return status.select("method", "status", "n_cells", F.col("method").isin(near).alias("closer"))


@query(
    """
WITH e AS (SELECT label, vec_id % (1 + label % 3) batch, CASE WHEN vec_id % 5 = 0 THEN (label + 1) % 10 ELSE label END AS cluster FROM embeddings), b AS (SELECT label, count(DISTINCT batch) k FROM e GROUP BY 1),
c AS (SELECT label, cluster, count(*) n FROM e GROUP BY ALL), f AS (SELECT label, 2 * n / (sum(n) OVER (PARTITION BY label) + sum(n) OVER (PARTITION BY cluster)) f FROM c)
SELECT label, round(max(f), 9) f1 FROM f WHERE label IN (SELECT label FROM b WHERE k = (SELECT min(k) FROM b)) GROUP BY 1"""
)
def isolated_f1(spark, d):
    """B-ISO: best F1 of a cluster for each label of the fewest batches."""
    e = table(spark, d, "embeddings").select("label", (F.col("vec_id") % (1 + F.col("label") % 3)).alias("batch"), F.when(F.col("vec_id") % 5 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("cluster"))
    return scores.isolated_f1(e, "cluster", "label", "batch").withColumn("f1", F.round("f1", 9))


@query(
    """
WITH e AS (SELECT vec_id id, embedding::DOUBLE[] v, label, vec_id % (1 + label % 3) batch FROM embeddings), b AS (SELECT label, count(DISTINCT batch) k FROM e GROUP BY 1),
p AS (SELECT a.id, a.label la, c.label lb, sum(list_distance(a.v, c.v)) s, count(*) n FROM e a, e c GROUP BY ALL), m AS (SELECT id, la, min(CASE WHEN la = lb THEN s / (n - 1) END) a, min(CASE WHEN la <> lb THEN s / n END) b FROM p GROUP BY ALL)
SELECT la AS label, round((avg((b - a) / greatest(a, b)) + 1) / 2, 9) asw FROM m WHERE la IN (SELECT label FROM b WHERE k = (SELECT min(k) FROM b)) GROUP BY 1"""
)
def isolated_asw(spark, d):
    """B-ISO: silhouettes of the labels of the fewest batches."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label", (F.col("vec_id") % (1 + F.col("label") % 3)).alias("batch"))
    return scores.isolated_asw(neighbors.silhouettes(e), e, "label", "batch").withColumn("asw", F.round("asw", 9))
