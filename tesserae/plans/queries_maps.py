"""Expression transforms, rank tests, neighbour graphs, integration scores and projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.operators import density, metrics, neighbors, residuals, scores
from tesserae.plans.registry import counts, query, table

_N = "(SELECT count(DISTINCT l_orderkey) FROM lineitem)"
_V = "v AS (SELECT l_orderkey cell, l_partkey gene, ln(1 + l_quantity * 10000 / sum(l_quantity) OVER (PARTITION BY l_orderkey)) v FROM lineitem)"


def _values(spark, d):
    return metrics.normalize_log1p(counts(spark, d))


def _n_cells(spark, d):
    return counts(spark, d).select("cell").distinct().count()


@query(f"WITH {_V} SELECT cell, count(*) n, round(sum(v), 6) total, round(max(v), 6) top FROM v GROUP BY 1")
def normalize_log1p(spark, d):
    """E1 F13."""
    return _values(spark, d).groupBy("cell").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"), F.round(F.max("value"), 6).alias("top"))


_M = f"{_V}, m AS (SELECT gene, sum(v) / {_N} mean, greatest(sum(v * v) - {_N} * pow(sum(v) / {_N}, 2), 0) / ({_N} - 1) variance FROM v GROUP BY 1)"


@query(
    f"""
WITH {_M}, d AS (SELECT *, variance / mean AS dispersion, min(mean) OVER () lo, max(mean) OVER () hi FROM m WHERE mean > 0),
b AS (SELECT *, least(floor((mean - lo) / ((hi - lo) / 20)), 19)::INT bin FROM d),
z AS (SELECT *, coalesce((dispersion - avg(dispersion) OVER (PARTITION BY bin)) / nullif(stddev_samp(dispersion) OVER (PARTITION BY bin), 0), 0) z FROM b)
SELECT gene, bin, round(mean, 6) mean, round(z, 6) z FROM z ORDER BY round(z, 9) DESC, gene LIMIT 100"""
)
def hvg_dispersion(spark, d):
    """Top genes by dispersions of logged values."""
    m = metrics.gene_moments(_values(spark, d), _n_cells(spark, d))
    return metrics.highly_variable(m, 100).select("gene", "bin", F.round("mean", 6).alias("mean"), F.round("z", 6).alias("z"))


@query(f"WITH {_M} SELECT gene, count(*) n, round(sum(least((v - mean) / sqrt(variance), 10)), 5) scaled FROM v JOIN m USING (gene) GROUP BY 1")
def scale_clip(spark, d):
    """E3."""
    v = _values(spark, d)
    s = metrics.scale_clip(v, metrics.gene_moments(v, _n_cells(spark, d)))
    return s.groupBy("gene").agg(F.count("*").alias("n"), F.round(F.sum("scaled"), 5).alias("scaled"))


@query(
    f"""
WITH c AS (SELECT l_orderkey cell, sum(l_quantity) ct FROM lineitem GROUP BY 1), g AS (SELECT l_partkey gene, sum(l_quantity) gt FROM lineitem GROUP BY 1), t AS (SELECT sum(l_quantity) t FROM lineitem),
r AS (SELECT l_partkey gene, (l_quantity - ct * gt / t) / sqrt(ct * gt / t + pow(ct * gt / t, 2) / 100) r, sqrt({_N}) lim FROM lineitem JOIN c ON cell = l_orderkey JOIN g ON gene = l_partkey, t)
SELECT gene, round(sum(greatest(least(r, lim), -lim)), 5) residual FROM r GROUP BY 1"""
)
def pearson_residuals(spark, d):
    """E12, as analytic residuals."""
    r = metrics.pearson_residuals(counts(spark, d), _n_cells(spark, d))
    return r.groupBy("gene").agg(F.round(F.sum("residual"), 5).alias("residual"))


@query("SELECT DISTINCT l_partkey AS gene FROM lineitem WHERE l_quantity > 49")
def expressed_genes(spark, d):
    """P17."""
    return metrics.expressed_genes(counts(spark, d).where("count > 49"))


@query()
def pca_embedding(spark, d):
    """Principal components by Spark ML; signs are arbitrary, so no SQL oracle."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    e = table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("x"))
    return PCA(k=10, inputCol="x", outputCol="pc").fit(e).transform(e).select("vec_id", vector_to_array("pc").alias("pc"))


_RANK = """
WITH n AS (SELECT event_type, value, count(*) m FROM events GROUP BY 1, 2), t AS (SELECT value, sum(m) t FROM n GROUP BY 1),
r AS (SELECT value, t, sum(t) OVER (ORDER BY value ROWS UNBOUNDED PRECEDING) - t + (t + 1) / 2.0 r FROM t),
g AS (SELECT event_type, sum(m)::BIGINT n1, sum(r * m)::DOUBLE rank_sum FROM n JOIN r USING (value) GROUP BY 1), a AS (SELECT sum(t)::DOUBLE n, sum(pow(t::DOUBLE, 3) - t) ties FROM t)
SELECT event_type, n1, rank_sum, round((rank_sum - n1 * (n1 + 1) / 2) / (n1 * (n - n1)), 9) auroc, round((rank_sum - n1 * (n1 + 1) / 2 - n1 * (n - n1) / 2) / sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / (n * (n - 1)))), 6) z FROM g, a"""


@query(_RANK)
def wilcoxon_ranks(spark, d):
    """One-vs-rest rank sums with ties."""
    r = scores.rank_sums(table(spark, d, "events"), "value", "event_type")
    return r.select("event_type", "n1", F.col("rank_sum").cast("double").alias("rank_sum"), F.round("auroc", 9).alias("auroc"), F.round("z", 6).alias("z"))


@query(
    """
WITH c AS (SELECT o_orderkey cell, o_orderstatus cluster FROM orders), s AS (SELECT cluster, count(*) n1 FROM c GROUP BY 1), w AS (SELECT count(*) total FROM c),
h AS (SELECT l_partkey gene, cell, cluster, sum(l_quantity) v FROM lineitem JOIN c ON cell = l_orderkey WHERE l_partkey <= 100 GROUP BY 1, 2, 3),
f AS (SELECT g.gene, c.cell, c.cluster, coalesce(h.v, 0) v FROM (SELECT DISTINCT gene FROM h) g CROSS JOIN c LEFT JOIN h ON h.gene = g.gene AND h.cell = c.cell),
n AS (SELECT gene, cluster, v, count(*) m FROM f GROUP BY 1, 2, 3), t AS (SELECT gene, v, sum(m) t FROM n GROUP BY 1, 2),
r AS (SELECT gene, v, t, sum(t) OVER (PARTITION BY gene ORDER BY v ROWS UNBOUNDED PRECEDING) - t + (t + 1) / 2.0 r FROM t),
k AS (SELECT gene, sum(pow(t::DOUBLE, 3) - t) ties FROM t GROUP BY 1),
x AS (SELECT gene, cluster, sum(r * m)::DOUBLE rs, coalesce(sum(m) FILTER (v > 0), 0) k FROM n JOIN r USING (gene, v) GROUP BY 1, 2), y AS (SELECT gene, sum(k) a FROM x GROUP BY 1)
SELECT gene, cluster, n1, (total - n1)::BIGINT n2, rs rank_sum, round((rs - n1 * (n1 + 1) / 2) / (n1 * (total - n1)), 9) auroc,
round((rs - n1 * (n1 + 1) / 2 - n1 * (total - n1) / 2) / sqrt(n1 * (total - n1) / 12 * (total + 1 - ties / (total::DOUBLE * (total - 1)))), 6) z, round(k / n1, 9) pct_in, round((a - k) / (total - n1), 9) pct_out
FROM x JOIN y USING (gene) JOIN k USING (gene) JOIN s USING (cluster), w"""
)
def rank_genes(spark, d):
    """One-vs-rest test of each gene with its zeros."""
    c = counts(spark, d).where("gene <= 100").groupBy("cell", "gene").agg(F.sum("count").alias("value"))
    cells = table(spark, d, "orders").selectExpr("o_orderkey as cell", "o_orderstatus as cluster")
    return scores.rank_genes(c, cells).withColumns({x: F.round(x, p) for x, p in (("auroc", 9), ("z", 6), ("pct_in", 9), ("pct_out", 9))})


_MARK = [("reds", "red ring"), ("reds", "red widget"), ("blues", "blue bolt"), ("blues", "blue ring"), ("hots", "hot bolt")]


@query(
    f"""
WITH k(label, gene) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in _MARK)}),
s AS (SELECT label, count(DISTINCT gene) k FROM k GROUP BY 1),
h AS (SELECT l_orderkey cell, label, sum(l_quantity) s, count(DISTINCT gene) x FROM lineitem JOIN part ON l_partkey = p_partkey JOIN k ON gene = p_name GROUP BY 1, 2),
f AS (SELECT s.label, o_orderpriority AS cluster, coalesce(h.s, 0) / s.k v, coalesce(h.x, 0) / s.k e FROM orders CROSS JOIN s LEFT JOIN h ON h.cell = o_orderkey AND h.label = s.label),
n AS (SELECT label, cluster, v, count(*) m FROM f GROUP BY 1, 2, 3), t AS (SELECT label, v, sum(m) t FROM n GROUP BY 1, 2),
r AS (SELECT label, v, sum(t) OVER (PARTITION BY label ORDER BY v ROWS UNBOUNDED PRECEDING) - t + (t + 1) / 2.0 r, sum(t) OVER (PARTITION BY label) n FROM t),
a AS (SELECT label, cluster, sum(m) n1, sum(r * m) rs, any_value(r.n) n FROM n JOIN r USING (label, v) GROUP BY 1, 2),
x AS (SELECT label, cluster, avg(e) expr FROM f GROUP BY 1, 2)
SELECT cluster, label, round((rs - n1 * (n1 + 1) / 2) / (n1 * (n - n1)), 9) auc, round(expr, 9) expr, round((rs - n1 * (n1 + 1) / 2) / (n1 * (n - n1)) * expr, 9) score FROM a JOIN x USING (label, cluster)"""
)
def marker_score(spark, d):
    """Hierarchical labelling's scores of one level."""
    c = counts(spark, d, "name").withColumnRenamed("count", "value")
    cells = table(spark, d, "orders").selectExpr("o_orderkey as cell", "o_orderpriority as cluster")
    m = scores.marker_scores(c, cells, spark.createDataFrame(_MARK, "label string, gene string"))
    return m.select("cluster", "label", *(F.round(x, 9).alias(x) for x in ("auc", "expr", "score")))


_E = "e AS (SELECT vec_id id, embedding::DOUBLE[] v, label FROM embeddings)"
_KNN = _E + ", k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, n) r FROM (SELECT a.id q, b.id n, a.label lq, b.label ln, list_distance(a.v, b.v) d FROM e a, e b))"


def _vec(spark, d):
    return table(spark, d, "embeddings").selectExpr("vec_id as id", "embedding as vec", "label")


@query(f"WITH {_KNN} SELECT q AS query, n AS neighbour, r::INT AS rank, round(d, 6) dist FROM k WHERE r <= 20")
def knn_graph(spark, d):
    """E5 W9 D9."""
    v = _vec(spark, d)
    return neighbors.knn(v, v, 20).withColumn("dist", F.round("dist", 6))


@query(
    f"""
WITH {_E}, p AS (SELECT a.id, a.label la, b.label lb, sum(list_distance(a.v, b.v)) s, count(*) n FROM e a, e b GROUP BY 1, 2, 3),
m AS (SELECT id, la, min(CASE WHEN la = lb THEN s / (n - 1) END) a, min(CASE WHEN la <> lb THEN s / n END) b FROM p GROUP BY 1, 2)
SELECT id, la AS label, round((b - a) / greatest(a, b), 6) silhouette FROM m"""
)
def silhouette(spark, d):
    """E16 B-ASW."""
    return neighbors.silhouettes(_vec(spark, d)).select("id", "label", F.round("silhouette", 6).alias("silhouette"))


@query(
    """
WITH e AS (SELECT vec_id id, embedding::DOUBLE[] v, label FROM embeddings), r(resolution, k) AS (VALUES (0.2::DOUBLE, 2), (0.5, 5), (1.0, 10)),
x AS (SELECT p.id, q.label lb, p.label la, list_distance(p.v, q.v) d, p.id <> q.id other FROM e p, e q),
c AS (SELECT resolution, id, la % k a, lb % k b, sum(d) s, count(*) n FROM x, r GROUP BY ALL),
m AS (SELECT resolution, id, a label, min(CASE WHEN a = b THEN s / (n - 1) END) own, min(CASE WHEN a <> b THEN s / n END) near FROM c GROUP BY ALL),
s AS (SELECT resolution, round(avg((near - own) / greatest(near, own)), 9) silhouette, count(DISTINCT label)::INT n_clusters FROM m GROUP BY 1)
SELECT * FROM s WHERE resolution >= 0.4 AND n_clusters >= 5 ORDER BY silhouette DESC, resolution LIMIT 1"""
)
def best_resolution(spark, d):
    """Silhouettes of three clusterings of the embeddings choose."""
    sizes = {0.2: "k2", 0.5: "k5", 1.0: "k10"}
    c = _vec(spark, d).withColumns({k: F.col("label") % int(k[1:]) for k in sizes.values()})
    resolution = F.element_at(F.create_map(*(F.lit(x) for r, k in sizes.items() for x in (k, r))), F.col("labelling"))
    s = neighbors.silhouettes(c, label=list(sizes.values())).groupBy(resolution.alias("resolution")).agg(F.round(F.avg("silhouette"), 9).alias("silhouette"), F.count_distinct("label").cast("int").alias("n_clusters"))
    return scores.best_resolution(s)


@query(
    """
WITH c AS (SELECT l_returnflag a, l_linestatus b, count(*)::DOUBLE n FROM lineitem GROUP BY 1, 2),
x AS (SELECT sum(n * (n - 1) / 2) ij, sum(n) t FROM c), i AS (SELECT sum(n * (n - 1) / 2) i FROM (SELECT sum(n) n FROM c GROUP BY a)), j AS (SELECT sum(n * (n - 1) / 2) j FROM (SELECT sum(n) n FROM c GROUP BY b))
SELECT round((ij - i * j / (t * (t - 1) / 2)) / ((i + j) / 2 - i * j / (t * (t - 1) / 2)), 9) ari FROM x, i, j"""
)
def ari(spark, d):
    """B-ARI."""
    return scores.adjusted_rand(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus").select(F.round("ari", 9).alias("ari"))


@query(
    """
WITH c AS (SELECT event_type a, user_id % 7 b, count(*)::DOUBLE n FROM events GROUP BY 1, 2), t AS (SELECT sum(n) t FROM c),
ha AS (SELECT -sum(n / t * ln(n / t)) h FROM (SELECT sum(n) n FROM c GROUP BY a), t), hb AS (SELECT -sum(n / t * ln(n / t)) h FROM (SELECT sum(n) n FROM c GROUP BY b), t), hab AS (SELECT -sum(n / t * ln(n / t)) h FROM c, t)
SELECT round(2 * (ha.h + hb.h - hab.h) / (ha.h + hb.h), 9) nmi FROM ha, hb, hab"""
)
def nmi(spark, d):
    """B-NMI."""
    e = table(spark, d, "events").withColumn("u", F.col("user_id") % 7)
    return scores.mutual_information(e, "event_type", "u").select(F.round("nmi", 9).alias("nmi"))


@query(
    f"""
WITH {_KNN}, c AS (SELECT q, ln, count(*)::DOUBLE n FROM k WHERE r <= 90 GROUP BY 1, 2), p AS (SELECT q, pow(sum(n), 2) / sum(n * n) l FROM c GROUP BY 1), x AS (SELECT avg(l) l, (SELECT count(DISTINCT label) FROM e) n FROM p)
SELECT round(l, 9) lisi, round((l - 1) / (n - 1), 9) ilisi, round((n - l) / (n - 1), 9) clisi FROM x"""
)
def lisi(spark, d):
    """B-LISI, both scalings."""
    v = _vec(spark, d)
    s = neighbors.lisi(neighbors.knn(v, v, 90), v)
    return s.select(*(F.round(c, 9).alias(c) for c in s.columns))


@query(
    f"""
WITH RECURSIVE {_KNN}, g AS MATERIALIZED (SELECT q a, n b FROM k WHERE r <= 4 AND lq = ln UNION SELECT n, q FROM k WHERE r <= 4 AND lq = ln),
w AS (SELECT id, id c FROM e UNION SELECT g.b, w.c FROM w JOIN g ON w.id = g.a), m AS (SELECT id, min(c) c FROM w GROUP BY 1), s AS (SELECT label, c, count(*) n FROM m JOIN e USING (id) GROUP BY 1, 2)
SELECT label, sum(n)::BIGINT n, max(n) largest, max(n) / sum(n) connectivity FROM s GROUP BY 1"""
)
def graph_connectivity(spark, d):
    """B-GC: components by alternating stars on written edge tables."""
    v = _vec(spark, d)
    return neighbors.graph_connectivity(neighbors.knn(v, v, 4).select("query", "neighbour"), v)


@query("SELECT label, n_batches, n_batches = min(n_batches) OVER () isolated FROM (SELECT label, count(DISTINCT vec_id % 4) n_batches FROM embeddings GROUP BY 1)")
def isolated_labels(spark, d):
    """B-ISO: labels found in the fewest batches."""
    return scores.isolated_labels(table(spark, d, "embeddings").withColumn("batch", F.col("vec_id") % 4), "label", "batch")


# metrics of methods: types of parts stand in for methods; one lacks a metric, one has a metric that is not a number
_MET = """m AS (SELECT p_type AS method, avg(p_size) / 50 ARI, avg(p_retailprice) / 2000 NMI, CASE WHEN p_type <> 'ECONOMY' THEN min(p_size) / 50.0 END::DOUBLE cLISI,
CASE WHEN p_type = 'SMALL' THEN 'nan'::DOUBLE ELSE avg(p_size % 7) / 7 END ASW_batch, max(p_size) / 60.0::DOUBLE iLISI FROM part GROUP BY 1)"""
_BIO, _BATCH = ["ARI", "NMI", "cLISI"], ["ASW_batch", "iLISI"]


def _metrics(spark, d):
    size = F.col("p_size")
    return table(spark, d, "part").groupBy(F.col("p_type").alias("method")).agg(
        (F.avg(size) / 50).alias("ARI"), (F.avg("p_retailprice") / 2000).alias("NMI"), F.when(F.col("method") != "ECONOMY", F.min(size) / 50.0).alias("cLISI"),
        F.when(F.col("method") == "SMALL", float("nan")).otherwise(F.avg(size % 7) / 7).alias("ASW_batch"), (F.max(size) / 60.0).alias("iLISI"),
    )


_OVERALL = f"WITH {_MET}, o AS (SELECT method, 0.6 * list_avg(list_filter([ARI, NMI, cLISI], lambda x: isfinite(x))) + 0.4 * list_avg(list_filter([ASW_batch, iLISI], lambda x: isfinite(x))) overall FROM m)"


@query(f"{_OVERALL} SELECT method, round(overall, 9) overall FROM o")
def overall_score(spark, d):
    """A27 K17."""
    return scores.overall_score(_metrics(spark, d), _BIO, _BATCH).select("method", F.round("overall", 9).alias("overall"))


@query(f"{_OVERALL} SELECT method, round(overall, 9) overall FROM o ORDER BY round(overall, 9) DESC, method LIMIT 1")
def best_method(spark, d):
    """The method of the greatest overall score."""
    m = scores.overall_score(_metrics(spark, d), _BIO, _BATCH).select("method", F.round("overall", 9).alias("overall"))
    return scores.best_row(m, "overall", "method")


@query(f"WITH {_MET} SELECT unnest(['ARI', 'NMI', 'cLISI', 'ASW_batch', 'iLISI', 'zero']) metric, unnest([bool_or(isfinite(ARI)), bool_or(isfinite(NMI)), bool_or(isfinite(cLISI)), bool_or(isfinite(ASW_batch)), bool_or(isfinite(iLISI)), false]) active FROM m")
def active_metrics(spark, d):
    """A28."""
    return scores.active_metrics(_metrics(spark, d).withColumn("zero", F.lit(float("nan"))), [*_BIO, *_BATCH, "zero"])


@query(
    f"""
WITH {_E}, h AS (SELECT *, ('0x' || substr(md5(id::VARCHAR), 1, 4))::INT % 5 > 0 ref FROM e), a AS (SELECT id, v, v[1] x, v[2] y FROM h WHERE ref), q AS (SELECT id, v FROM h WHERE NOT ref),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, n) r FROM (SELECT q.id q, a.id n, x, y, list_distance(q.v, a.v) d FROM q, a)),
o AS (SELECT quantile_cont(d, 0.95) ref FROM (SELECT d, row_number() OVER (PARTITION BY i ORDER BY d, j) r FROM (SELECT a.id i, b.id j, list_distance(a.v, b.v) d FROM a, a b)) WHERE r = 5)
SELECT q AS query, round(sum(x / (d + 1e-6)) / sum(1 / (d + 1e-6)), 6) x, round(sum(y / (d + 1e-6)) / sum(1 / (d + 1e-6)), 6) y, round(min(d), 6) d1, round(least(greatest(1 - min(d) / (SELECT greatest(ref, 1e-6) FROM o), 0), 1), 6) similarity FROM k WHERE r <= 30 GROUP BY 1"""
)
def knn_projection(spark, d):
    """A fifth of the points, by a hash, placed on the map of the others."""
    v = _vec(spark, d).withColumns({"x": F.col("vec")[0].cast("double"), "y": F.col("vec")[1].cast("double")})
    ref = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 4), 16, 10).cast("int") % 5 > 0
    p = neighbors.project(v.where(~ref), v.where(ref))
    return p.select("query", *(F.round(c, 6).alias(c) for c in ("x", "y", "d1", "similarity")))


@query(
    f"""
WITH {_E}, c AS (SELECT label, list(m ORDER BY i) c FROM (SELECT label, i, avg(v[i]) m FROM e, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1),
d AS (SELECT id, c.label, list_distance(v, c) d FROM e, c), b AS (SELECT id, arg_min(label, (d, label)) predicted, min(d) d FROM d GROUP BY 1)
SELECT id, predicted, round(d, 6) dist, round((d - min(d) OVER ()) / (max(d) OVER () - min(d) OVER ()), 6) uncertainty FROM b"""
)
def prototype_classify(spark, d):
    """Centroids as prototypes."""
    v = _vec(spark, d)
    p = scores.classify_prototypes(v, scores.centroids(v))
    return p.select("id", "predicted", F.round("dist", 6).alias("dist"), F.round("uncertainty", 6).alias("uncertainty"))


@query(f"WITH {_E} SELECT label, i::INT AS dim, round(median(v[i]), 9) median FROM e, range(1, 3) t(i) GROUP BY 1, 2")
def cluster_centers(spark, d):
    """Label positions of a map: median coordinates of each cluster."""
    v = _vec(spark, d).select("label", F.posexplode(F.slice("vec", 1, 2)).alias("i", "x"))
    return v.groupBy("label", (F.col("i") + 1).alias("dim")).agg(F.round(F.median(F.col("x").cast("double")), 9).alias("median"))


@query("SELECT label AS cluster_a, (vec_id % 3)::BIGINT cluster_b, count(*) n FROM embeddings GROUP BY 1, 2")
def clustree(spark, d):
    """Cells shared by the clusters of neighbouring resolutions."""
    return scores.contingency(table(spark, d, "embeddings").withColumn("b", F.col("vec_id") % 3), "label", "b").select(F.col("a").alias("cluster_a"), F.col("b").alias("cluster_b"), F.col("n").cast("long").alias("n"))


_GRID = 12


@query(
    f"""
WITH p AS (SELECT vec_id, embedding[1]::DOUBLE x, embedding[2]::DOUBLE y FROM embeddings),
s AS (SELECT count(*) n, min(x) ax, max(x) bx, min(y) ay, max(y) b_y, 1.06 * least(stddev_samp(x), (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / 1.34) * pow(count(*), -0.2) hx,
  1.06 * least(stddev_samp(y), (quantile_cont(y, 0.75) - quantile_cont(y, 0.25)) / 1.34) * pow(count(*), -0.2) hy FROM p),
g AS (SELECT i, j, sum(exp(-0.5 * pow((ax + i * (bx - ax) / {_GRID - 1} - x) / hx, 2) - 0.5 * pow((ay + j * (b_y - ay) / {_GRID - 1} - y) / hy, 2))) / (2 * pi() * any_value(hx * hy * n)) z FROM p, s, range({_GRID}) a(i), range({_GRID}) b(j) GROUP BY ALL)
SELECT vec_id, round(z, 6) density FROM p, s JOIN g ON i = least(greatest(floor((x - ax) / ((bx - ax) / {_GRID - 1})), 0), {_GRID - 2}) AND j = least(greatest(floor((y - ay) / ((b_y - ay) / {_GRID - 1})), 0), {_GRID - 2})"""
)
def point_density(spark, d):
    """Density of the first two components at each point."""
    p = table(spark, d, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return density.point_density(p, n=_GRID).select("vec_id", F.round("density", 6).alias("density"))


@query(
    """
WITH v AS (SELECT l_partkey gene, l_quantity * 10000 / sum(l_quantity) OVER (PARTITION BY l_orderkey) v FROM lineitem), n AS (SELECT count(DISTINCT l_orderkey)::DOUBLE n FROM lineitem),
m AS (SELECT gene, sum(v) / n mean, (sum(v * v) - n * pow(sum(v) / n, 2)) / (n - 1) variance FROM v, n GROUP BY gene, n), d AS (SELECT gene, ln(1 + mean) mean, ln(variance / mean) dispersion FROM m WHERE mean > 0 AND variance > 0),
b AS (SELECT *, least(greatest(ceil((mean - min(mean) OVER ()) / ((max(mean) OVER () - min(mean) OVER ()) / 20)), 1) - 1, 19)::INT bin FROM d),
z AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY bin) = 1 THEN 1 ELSE coalesce((dispersion - avg(dispersion) OVER (PARTITION BY bin)) / nullif(stddev_samp(dispersion) OVER (PARTITION BY bin), 0), 0) END z FROM b)
SELECT gene, bin, round(mean, 6) mean, round(dispersion, 6) dispersion, round(z, 6) z FROM z ORDER BY round(z, 9) DESC, gene LIMIT 100"""
)
def log_dispersion_genes(spark, d):
    """Variable genes by the default flavour, from unlogged normalised values."""
    v = _values(spark, d).withColumn("value", F.expm1("value"))
    return metrics.log_dispersion_genes(metrics.gene_moments(v, _n_cells(spark, d)), 100).select("gene", "bin", *(F.round(c, 6).alias(c) for c in ("mean", "dispersion", "z")))


@query(
    """
WITH c AS (SELECT o_orderpriority sample, l_orderkey cell, l_partkey gene, l_quantity::DOUBLE x FROM lineitem JOIN orders ON l_orderkey = o_orderkey), t AS (SELECT sample, cell, sum(x) t FROM c GROUP BY ALL),
w AS (SELECT sample, sum(t) al, sum(t * t) sq FROM t GROUP BY 1), n AS (SELECT o_orderpriority sample, count(*)::DOUBLE n FROM orders GROUP BY 1),
p AS (SELECT sample, gene, sum(x) sx, sum(x * x) sxx, sum(x * t) sxt, count(DISTINCT cell) k FROM c JOIN t USING (sample, cell) GROUP BY ALL),
g AS (SELECT sample, gene, sx / n mean, sx / al share, sxx - 2 * sx / al * sxt + pow(sx / al, 2) * sq - sx excess, pow(sx / al, 2) * sq mu2 FROM p JOIN w USING (sample) JOIN n USING (sample) WHERE k >= 5),
o AS (SELECT *, CASE WHEN excess > 0 THEN log10(1 + mean * excess / mu2) ELSE 0 END od FROM g), e AS (SELECT *, greatest((max(log10(mean)) OVER (PARTITION BY sample) - min(log10(mean)) OVER (PARTITION BY sample)) / 64, 1e-9) width, min(log10(mean)) OVER (PARTITION BY sample) lo FROM o),
b AS (SELECT *, least(floor((log10(mean) - lo) / width), 63) bin FROM e), s AS (SELECT sample, width, bin, sum(od) s, count(*) m FROM b GROUP BY ALL),
k AS (SELECT a.sample, a.bin, sum(exp(-0.5 * pow((a.bin - z.bin) * a.width / 0.3, 2)) * z.s) / sum(exp(-0.5 * pow((a.bin - z.bin) * a.width / 0.3, 2)) * z.m) smooth FROM s a JOIN s z USING (sample) GROUP BY ALL)
SELECT sample, gene, round(mean, 9) mean, round(share, 12) share, round(od, 6) overdispersion, round(log10(mean / greatest(pow(10, smooth) - 1, 1e-8)), 4) log_theta FROM b JOIN k USING (sample, bin)"""
)
def nb_gene_model(spark, d):
    """Regularised negative-binomial model of each gene in each sample."""
    o = table(spark, d, "orders").selectExpr("o_orderkey as cell", "o_orderpriority as sample")
    m = residuals.fit_genes(counts(spark, d).join(o, "cell"), o, bins=64)
    return m.select("sample", "gene", F.round("mean", 9).alias("mean"), F.round("share", 12).alias("share"), F.round("overdispersion", 6).alias("overdispersion"), F.round(F.log10("theta"), 4).alias("log_theta"))
