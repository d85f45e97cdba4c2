"""Quality control: metrics, thresholds, filters, summaries, rates, doublets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.operators import doublets, metrics, qc, quantiles, rates, reports, thresholds
from tesserae.plans.registry import counts, query, table
from tesserae.plans.workspace import Workspace

_CELLS = """
WITH m AS (SELECT o.o_orderpriority sample, l.l_orderkey cell, sum(l_quantity) nCount, count(*) FILTER (l_quantity > 0) nFeature,
  100 * sum(CASE WHEN p_name LIKE 'red %' THEN l_quantity ELSE 0 END) / sum(l_quantity) pct_mito
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2)"""


def _cells(spark, d):
    c = metrics.cell_metrics(counts(spark, d, "name"), sets={"pct_mito": F.col("gene").rlike("^red ")})
    return c.join(table(spark, d, "orders").selectExpr("o_orderkey as cell", "o_orderpriority as sample"), "cell")


@query(
    _CELLS
    + """,
b AS (SELECT *, ln(1 + nCount) lc, ln(1 + nFeature) lf FROM m),
md AS (SELECT sample, median(lc) mc, median(lf) mf, median(pct_mito) mm FROM b GROUP BY 1),
ad AS (SELECT b.sample, any_value(mc) mc, any_value(mf) mf, any_value(mm) mm, 1.4826 * median(abs(lc - mc)) ac, 1.4826 * median(abs(lf - mf)) af, 1.4826 * median(abs(pct_mito - mm)) am FROM b JOIN md USING (sample) GROUP BY 1),
t AS (SELECT sample, CASE WHEN ac = 0 THEN exp(mc) - 1 ELSE greatest(exp(mc - 3 * ac) - 1, 0) END cl, CASE WHEN ac = 0 THEN exp(mc) - 1 ELSE exp(mc + 3 * ac) - 1 END ch,
  greatest(CASE WHEN af = 0 THEN exp(mf) - 1 ELSE greatest(exp(mf - 3 * af) - 1, 0) END, 2) fl, CASE WHEN af = 0 THEN exp(mf) - 1 ELSE exp(mf + 3 * af) - 1 END fh, CASE WHEN am = 0 THEN mm ELSE mm + 3 * am END mh FROM ad),
k AS (SELECT b.*, nCount BETWEEN cl - 1e-9 AND ch + 1e-9 AND nFeature BETWEEN fl - 1e-9 AND fh + 1e-9 AND pct_mito <= mh + 1e-9 keep FROM b JOIN t USING (sample)),
s AS (SELECT sample, count(*) cells_raw, count(*) FILTER (keep) cells_filtered, median(nCount) median_nCount_raw, median(nCount) FILTER (keep) median_nCount_filtered, median(nFeature) median_nFeature_raw, median(nFeature) FILTER (keep) median_nFeature_filtered FROM k GROUP BY 1
  UNION ALL SELECT 'TOTAL', count(*), count(*) FILTER (keep), NULL, NULL, NULL, NULL FROM k)
SELECT sample, cells_raw, cells_filtered, cells_raw - cells_filtered cells_removed, round(100.0 * (cells_raw - cells_filtered) / cells_raw, 6) pct_cells_removed,
  median_nCount_raw, median_nCount_filtered, median_nFeature_raw, median_nFeature_filtered FROM s"""
)
def qc_mad_filter_summary(spark, d):
    """MAD bounds per sample, hard floor, inclusive keep, summary with TOTAL."""
    cells = Workspace(spark, "qc").save(_cells(spark, d), "cells")
    bounds = qc.mad_bounds(qc.drop_empty(cells), "sample", {"nCount": True, "nFeature": True, "pct_mito": False})
    kept = qc.mark_kept(cells, qc.raise_floors(bounds, {"nFeature": 2.0}), "sample")
    out = reports.qc_summary(kept, "sample", ["nCount", "nFeature"])
    keys = ["sample", "cells_raw", "cells_filtered", "cells_removed", "median_nCount_raw", "median_nCount_filtered", "median_nFeature_raw", "median_nFeature_filtered"]
    return out.select(*keys, F.round("pct_cells_removed", 6).alias("pct_cells_removed"))


_FOUR = ("nCount", "nFeature", "pct_mito", "pct_ribo")


@query(
    f"""
WITH m AS (SELECT o.o_orderpriority sample, l.l_orderkey cell, sum(l_quantity) nCount, count(*) FILTER (l_quantity > 0) nFeature,
  100 * sum(CASE WHEN p_name LIKE 'red %' THEN l_quantity ELSE 0 END) / sum(l_quantity) pct_mito, 100 * sum(CASE WHEN p_name LIKE 'blue %' THEN l_quantity ELSE 0 END) / sum(l_quantity) pct_ribo
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2),
q AS (SELECT *, nCount BETWEEN 50 AND 250 AND nFeature BETWEEN 2 AND 6 AND pct_mito <= 40 keep FROM m),
g AS (SELECT sample, count(DISTINCT p_name) genes_raw, count(DISTINCT CASE WHEN keep THEN p_name END) genes_filtered FROM q JOIN lineitem ON l_orderkey = cell JOIN part ON l_partkey = p_partkey GROUP BY 1),
s AS (SELECT sample, count(*) cells_raw, count(*) FILTER (keep) cells_filtered, {", ".join(f"round({f}({c}), 6) {n}_{c}_raw, round({f}({c}) FILTER (keep), 6) {n}_{c}_filtered" for c in _FOUR for n, f in (("median", "median"), ("mean", "avg"), ("max", "max")))} FROM q GROUP BY 1),
t AS (SELECT s.*, genes_raw, genes_filtered, 50.0::DOUBLE cutoff_nCount_lower, 250.0::DOUBLE cutoff_nCount_upper, 2.0::DOUBLE cutoff_nFeature_lower, 6.0::DOUBLE cutoff_nFeature_upper, 40.0::DOUBLE cutoff_pct_mito_upper, 'manual' algo_nCount FROM s JOIN g USING (sample)),
u AS (SELECT * FROM t UNION ALL BY NAME SELECT 'TOTAL' sample, sum(cells_raw)::BIGINT cells_raw, sum(cells_filtered)::BIGINT cells_filtered FROM t)
SELECT *, cells_raw - cells_filtered cells_removed, round(100.0 * (cells_raw - cells_filtered) / cells_raw, 6) pct_cells_removed, round(median_nCount_filtered / median_nCount_raw, 6) median_inflation_ratio FROM u"""
)
def qc_summary_detailed(spark, d):
    """K8 A3 A4: the whole report of a filter with fixed bounds."""
    c = Workspace(spark, "qc").save(counts(spark, d, "name"), "counts")
    sample = table(spark, d, "orders").selectExpr("o_orderkey as cell", "o_orderpriority as sample")
    cells = metrics.cell_metrics(c, sets={"pct_mito": F.col("gene").rlike("^red "), "pct_ribo": F.col("gene").rlike("^blue ")}).join(sample, "cell")
    ends = {"lo_nCount": 50.0, "hi_nCount": 250.0, "lo_nFeature": 2.0, "hi_nFeature": 6.0, "hi_pct_mito": 40.0}
    bounds = sample.select("sample").distinct().withColumns({k: F.lit(x) for k, x in ends.items()})
    kept = Workspace(spark, "qc").save(qc.mark_kept(cells, bounds, "sample"), "kept")
    genes = c.join(kept.select("cell", "sample", "keep"), "cell").groupBy("sample").agg(F.count_distinct("gene").alias("genes_raw"), F.count_distinct(F.when(F.col("keep"), F.col("gene"))).alias("genes_filtered"))
    out = reports.qc_summary_detailed(kept, "sample", list(_FOUR), bounds, genes, {"nCount": "manual"})
    return out.withColumns({x: F.round(x, 6) for x, t in out.dtypes if t == "double"})


def _funnel_sql(seen: str, left: str) -> str:
    return f"""
WITH r AS (SELECT c_nationkey::VARCHAR sample, count(*) cells_raw FROM customer GROUP BY 1),
b AS (SELECT c_nationkey::VARCHAR sample, count(*) cells_after_ghost, 0.05::DOUBLE dbr_used, count(*) FILTER (c_acctbal < 0) doublets_found, count(*) FILTER (c_acctbal BETWEEN 0 AND 500) ambiguous_found FROM customer WHERE c_custkey % 10 > 0 GROUP BY 1),
q AS (SELECT s_nationkey::VARCHAR sample, count(*) cells_after_qc FROM supplier GROUP BY 1),
j AS (SELECT sample, cells_raw, cells_after_ghost, dbr_used, doublets_found, ambiguous_found, cells_after_qc, cells_after_ghost - doublets_found cells_after_doublet_removal, cells_raw - cells_after_qc total_cells_removal FROM r FULL JOIN b USING (sample) FULL JOIN q USING (sample)),
u AS (SELECT * FROM j UNION ALL SELECT 'TOTAL', sum(cells_raw)::BIGINT, sum(cells_after_ghost)::BIGINT, NULL, sum(doublets_found)::BIGINT, sum(ambiguous_found)::BIGINT, sum(cells_after_qc)::BIGINT, sum(cells_after_doublet_removal)::BIGINT, sum(total_cells_removal)::BIGINT FROM j)
SELECT *, round(100.0 * doublets_found / {seen}, 6) pct_doublets, round(100.0 * ambiguous_found / {seen}, 6) pct_ambiguous, round(100.0 * (cells_after_doublet_removal - cells_after_qc) / {left}, 6) pct_qc_removal, round(100.0 * total_cells_removal / cells_raw, 6) pct_total_cells_removal FROM u"""


def _integrated(spark, d, of_raw):
    c = table(spark, d, "customer").withColumn("sample", F.col("c_nationkey").cast("string"))
    b = F.col("c_acctbal")
    doublet = c.where("c_custkey % 10 > 0").groupBy("sample").agg(F.count("*").alias("cells_after_ghost"), F.lit(0.05).alias("dbr_used"), F.count_if(b < 0).alias("doublets_found"), F.count_if(b.between(0, 500)).alias("ambiguous_found"))
    left = table(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("sample")).agg(F.count("*").alias("cells_after_qc"))
    out = reports.integrated_summary(c.groupBy("sample").agg(F.count("*").alias("cells_raw")), doublet, left, of_raw)
    return out.withColumns({x: F.round(x, 6) for x in out.columns if x.startswith("pct_")})


@query(_funnel_sql("cells_after_ghost", "cells_after_doublet_removal"))
def integrated_summary(spark, d):
    """K9 A5 A7 A8."""
    return _integrated(spark, d, False)


@query(_funnel_sql("cells_raw", "cells_raw"))
def integrated_summary_of_raw(spark, d):
    """A6."""
    return _integrated(spark, d, True)


@query(
    _CELLS
    + """, b AS (SELECT sample, ln(1 + nCount) v FROM m), md AS (SELECT sample, median(v) med FROM b GROUP BY 1)
SELECT sample, round(any_value(med), 6) med, round(1.4826 * median(abs(v - med)), 6) mad, round(exp(any_value(med) + 3 * 1.4826 * median(abs(v - med))) - 1, 6) threshold FROM b JOIN md USING (sample) GROUP BY sample"""
)
def mad_thresholds(spark, d):
    t = thresholds.mad_threshold(_cells(spark, d), ["sample"], "nCount", 3, "upper", True)
    return t.select("sample", *(F.round(c, 6).alias(c) for c in ("med", "mad", "threshold")))


@query("SELECT l_returnflag, quantile_cont(l_quantity, 0.05) q05, quantile_cont(l_quantity, 0.95) q95, CASE WHEN median(l_quantity) >= 10 THEN quantile_cont(l_quantity, 0.05) ELSE 0 END plot_low, max(l_quantity) plot_high FROM lineitem GROUP BY 1")
def quantile_bounds(spark, d):
    """Bounds of a plot by exact quantiles, without a group's values in one task."""
    li = table(spark, d, "lineitem")
    q = quantiles.exact_quantiles(li, ["l_returnflag"], "l_quantity", [0.05, 0.5, 0.95]).groupBy("l_returnflag")
    q = q.agg(*(F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(c) for p, c in ((0.05, "q05"), (0.5, "q50"), (0.95, "q95"))))
    q = q.join(li.groupBy("l_returnflag").agg(F.max("l_quantity").alias("plot_high")), "l_returnflag")
    return q.select("l_returnflag", "q05", "q95", F.when(F.col("q50") >= 10, F.col("q05")).otherwise(0.0).alias("plot_low"), "plot_high")


@query("WITH m AS (SELECT event_type, median(value) med FROM events GROUP BY 1) SELECT event_type, round(any_value(med), 9) median, round(1.4826 * median(abs(value - med)), 9) mad FROM events JOIN m USING (event_type) GROUP BY event_type")
def exact_mad(spark, d):
    """M1 A3: medians and deviations by selection."""
    return quantiles.exact_mad(table(spark, d, "events"), ["event_type"], "value").select("event_type", F.round("median", 9).alias("median"), F.round("mad", 9).alias("mad"))


_HIST = """
WITH s AS (SELECT event_type, min(value) lo, max(value) hi, count(*) total, (max(value) - min(value)) / 256.0 width FROM events GROUP BY 1),
c AS (SELECT e.event_type, CASE WHEN width > 0 THEN least(floor((value - lo) / width), 255) ELSE 0 END::INT bin, count(*) n FROM events e JOIN s USING (event_type) GROUP BY 1, 2),
h AS (SELECT s.*, r.bin::INT bin, coalesce(n, 0) n FROM s CROSS JOIN range(256) r(bin) LEFT JOIN c ON c.event_type = s.event_type AND c.bin = r.bin)"""


@query(
    _HIST
    + """,
p AS (SELECT event_type, arg_max(bin, (n, -bin)) pb, max(n) pn, max(n) FILTER (bin = 255) en FROM h GROUP BY 1),
z AS (SELECT h.*, pb, pn, CASE WHEN pb = 255 THEN 0 ELSE abs((en - pn) * (bin - pb) - (255 - pb) * (n - pn)) / sqrt(((255 - pb) * (255 - pb) + (en - pn) * (en - pn))::DOUBLE) END dist FROM h JOIN p USING (event_type) WHERE bin >= pb),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY round(dist, 9) DESC, bin) rn FROM z)
SELECT event_type, round(lo + (CASE WHEN pb = 255 THEN pb ELSE bin END + 0.5) * width, 6) threshold FROM r WHERE rn = 1"""
)
def threshold_triangle(spark, d):
    return thresholds.triangle_threshold(table(spark, d, "events"), ["event_type"], "value", "higher").select("event_type", F.round("threshold", 6).alias("threshold"))


@query(
    """
WITH e AS (SELECT event_type, value v, count(*) m FROM events WHERE value > 0 GROUP BY 1, 2),
r AS (SELECT *, sum(m) OVER w - m + 1 AS first, sum(m) OVER (PARTITION BY event_type) n FROM e WINDOW w AS (PARTITION BY event_type ORDER BY v DESC ROWS UNBOUNDED PRECEDING)),
x AS (SELECT *, log10(first) / log10(n) x, log10(v + 1) y FROM r),
z AS (SELECT *, round(x + (y - min(y) OVER (PARTITION BY event_type)) / (max(y) OVER (PARTITION BY event_type) - min(y) OVER (PARTITION BY event_type)) - 1, 9) dist FROM x)
SELECT event_type, arg_max(v, (dist, v)) threshold FROM z GROUP BY 1"""
)
def threshold_knee(spark, d):
    return thresholds.knee_threshold(table(spark, d, "events"), ["event_type"], "value")


@query(
    _HIST
    + """,
q AS (SELECT *, n / total p FROM h),
w AS (SELECT *, sum(p) OVER o s, sum(p * p) OVER o q, sum(p) OVER g st, sum(p * p) OVER g qt FROM q WINDOW o AS (PARTITION BY event_type ORDER BY bin ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY event_type)),
e AS (SELECT *, round(-ln(q / (s * s) + 1e-12) - ln((qt - q) / ((st - s) * (st - s)) + 1e-12), 9) e FROM w WHERE bin < 255 AND s > 1e-12 AND st - s > 1e-12),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY e DESC, bin) rn FROM e)
SELECT event_type, bin, round(lo + (bin + 0.5) * width, 6) threshold FROM r WHERE rn = 1"""
)
def threshold_renyi(spark, d):
    return thresholds.renyi_threshold(table(spark, d, "events"), ["event_type"], "value").select("event_type", "bin", F.round("threshold", 6).alias("threshold"))


@query(
    "WITH m AS (SELECT event_type, median(value) med FROM events GROUP BY 1) SELECT event_type, 'mad3' AS method, round(med + 3 * 1.4826 * median(abs(value - med)), 6) threshold FROM events JOIN m USING (event_type) GROUP BY event_type, med "
    "UNION ALL SELECT event_type, 'quantile_0.9', round(quantile_cont(value, 0.9), 6) FROM events GROUP BY 1 UNION ALL SELECT DISTINCT event_type, 'manual_12.5', 12.5 FROM events UNION ALL SELECT DISTINCT event_type, 'none', 'Infinity'::DOUBLE FROM events"
)
def threshold_methods(spark, d):
    """The method mini-language."""
    e = table(spark, d, "events")
    parts = [thresholds.threshold(e, ["event_type"], "value", m, "upper").select("event_type", F.lit(m).alias("method"), F.when(F.abs("threshold") < float("inf"), F.round("threshold", 6)).otherwise(F.col("threshold")).alias("threshold")) for m in ("mad3", "quantile_0.9", "manual_12.5", "none")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


RATES = [("v3", 500.0, 0.004), ("v3", 1000.0, 0.008), ("v3", 2000.0, 0.016), ("v3", 5000.0, 0.039), ("v3", 8000.0, 0.061), ("v4", 1000.0, 0.004), ("v4", 4000.0, 0.016), ("v4", 9000.0, 0.04)]


@query(
    f"""
WITH r(chemistry, cells, rate) AS (VALUES {", ".join(f"('{c}', {x}::DOUBLE, {y}::DOUBLE)" for c, x, y in RATES)}),
s AS (SELECT chemistry, cells x0, rate y0, lead(cells) OVER w x1, lead(rate) OVER w y1, min(cells) OVER (PARTITION BY chemistry) lo, max(cells) OVER (PARTITION BY chemistry) hi FROM r WINDOW w AS (PARTITION BY chemistry ORDER BY cells)),
g AS (SELECT *, (y1 - y0) / (x1 - x0) k FROM s WHERE x1 IS NOT NULL),
c AS (SELECT c_custkey, c_acctbal x, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'v4' ELSE 'v3' END chemistry FROM customer)
SELECT c_custkey, c.chemistry, round(CASE WHEN x <= 0 THEN NULL WHEN x BETWEEN lo AND hi THEN y0 + k * (x - x0) ELSE least(greatest(y0 + k * (x - x0), 0), 0.3) END, 9) rate
FROM c LEFT JOIN g ON g.chemistry = c.chemistry AND ((x >= x0 OR x0 = lo) AND (x < x1 OR x1 = hi))"""
)
def dbr_interpolate(spark, d):
    """M7 M8: rates from chemistry tables, edge slopes outside."""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("cells"), F.when(F.col("c_mktsegment") == "MACHINERY", "v4").otherwise("v3").alias("chemistry"))
    out = rates.interpolate_rates(c, spark.createDataFrame(RATES, "chemistry string, cells double, rate double"))
    return out.select("c_custkey", "chemistry", F.round("rate", 9).alias("rate"))


@query("SELECT n_name, round(sum(c_acctbal * c_custkey) / sum(c_custkey), 6) weighted_mean FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def dbr_weighted_mean(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation").selectExpr("n_nationkey as c_nationkey", "n_name"), "c_nationkey")
    return rates.weighted_mean(c, ["n_name"], "c_acctbal", "c_custkey").withColumn("weighted_mean", F.round("weighted_mean", 6))


@query(
    """
WITH c AS (SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN '10x' WHEN 'FURNITURE' THEN 'dropseq' ELSE 'other' END platform, CASE WHEN c_acctbal BETWEEN 0 AND 300 THEN c_acctbal / 1000 WHEN c_acctbal > 9000 THEN 0.9 END user_rate, c_acctbal / 100000 rate FROM customer)
SELECT c_custkey, CASE WHEN user_rate > 0 AND user_rate <= 0.3 THEN user_rate WHEN platform = '10x' THEN rate WHEN platform = 'dropseq' THEN 0.05 ELSE rate END dbr,
CASE WHEN user_rate > 0 AND user_rate <= 0.3 THEN 'user' WHEN platform = '10x' THEN 'table' WHEN platform = 'dropseq' THEN 'platform' ELSE 'fallback' END dbr_source FROM c"""
)
def dbr_resolution(spark, d):
    """M9: override, table, platform, fallback, with the source of each rate."""
    b = F.col("c_acctbal")
    c = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "MACHINERY", "10x").when(F.col("c_mktsegment") == "FURNITURE", "dropseq").otherwise("other").alias("platform"),
        F.when(b.between(0, 300), b / 1000).when(b > 9000, 0.9).alias("user_rate"), (b / 100000).alias("rate"),
    )
    return rates.resolve_rate(c, {"dropseq": 0.05}).select("c_custkey", "dbr", "dbr_source")


@query("SELECT count(*) n_cells, count(*) FILTER (n > 100 AND f > 3) n_kept, count(*) FILTER (n > 0 AND f > 0) n_nonzero FROM (SELECT l_orderkey, sum(l_quantity) n, count(*) FILTER (l_quantity > 0) f FROM lineitem GROUP BY 1)")
def ghost_filter(spark, d):
    """P6 P7."""
    c = metrics.cell_metrics(counts(spark, d))
    n = F.count("*")
    parts = (c.agg(n.alias("n_cells")), qc.drop_ghosts(c, 100, 3).agg(n.alias("n_kept")), qc.drop_empty(c).agg(n.alias("n_nonzero")))
    return parts[0].join(F.broadcast(parts[1])).join(F.broadcast(parts[2]))


@query(_CELLS + " SELECT cell, nCount, nFeature, round(pct_mito, 6) pct_mito FROM m")
def pct_feature_set(spark, d):
    return _cells(spark, d).select("cell", "nCount", "nFeature", F.round("pct_mito", 6).alias("pct_mito"))


@query("SELECT min(l_quantity) least, max(abs(l_quantity - round(l_quantity))) AS off, min(l_quantity) >= -1e-6 AND max(abs(l_quantity - round(l_quantity))) <= 1e-3 is_counts FROM lineitem")
def raw_count_guard(spark, d):
    """P13 P14 F17."""
    return metrics.count_like(table(spark, d, "lineitem"), "l_quantity")


_STATUS = "CASE WHEN l_discount BETWEEN 0.04 AND 0.06 THEN 'ambiguous' WHEN l_returnflag = 'R' AND l_discount > 0.06 THEN 'doublet' ELSE 'singlet' END"


@query(f"SELECT l_shipyear, count(*) total_cells, count(*) FILTER (s = 'doublet') doublets_found, count(*) FILTER (s = 'ambiguous') ambiguous_found, count(*) FILTER (s <> 'doublet') cells_retained, round(100.0 * count(*) FILTER (s = 'doublet') / count(*), 6) pct_doublet, round(100.0 * count(*) FILTER (s = 'ambiguous') / count(*), 6) pct_ambiguous FROM (SELECT year(l_shipdate)::INTEGER l_shipyear, {_STATUS} s FROM lineitem) GROUP BY 1")
def doublet_status(spark, d):
    """M14 A15 P10 K6."""
    li = table(spark, d, "lineitem").select(F.year("l_shipdate").alias("l_shipyear"), F.col("l_discount").alias("score"), F.when(F.col("l_returnflag") == "R", "doublet").otherwise("singlet").alias("class"))
    out = reports.doublet_summary(doublets.call_status(li, "score", "class", 0.04, 0.06), "l_shipyear")
    return out.withColumns({c: F.round(c, 6) for c in ("pct_doublet", "pct_ambiguous")})


@query("SELECT label, count(*) n, count(*) < 50 small, sum(CASE WHEN cnt < 50 THEN 0 ELSE vec_id END)::BIGINT score_sum FROM (SELECT label, vec_id, count(*) OVER (PARTITION BY label) cnt FROM embeddings) GROUP BY 1")
def small_sample_guard(spark, d):
    """Samples too small for scoring are all singlets with score 0."""
    e = table(spark, d, "embeddings").select("label", F.col("vec_id").cast("double").alias("score"), F.lit("doublet").alias("class"))
    g = doublets.guard_small(e, "label", 50)
    return g.groupBy("label").agg(F.count("*").alias("n"), (F.count_if(F.col("class") == "singlet") > 0).alias("small"), F.sum("score").cast("long").alias("score_sum"))


@query(
    """
WITH x AS (SELECT CASE WHEN event_type IN ('error', 'purchase') THEN 'doublet' ELSE 'singlet' END k, CASE WHEN event_type IN ('error', 'purchase') THEN sqrt(value / 500) ELSE value / 500 END s FROM events),
p AS (SELECT k, count(*) n, stddev_samp(s) sd, quantile_cont(s, 0.75) - quantile_cont(s, 0.25) iqr FROM x GROUP BY 1),
b AS (SELECT k, n, greatest(0.9 * CASE WHEN iqr > 0 THEN least(sd, iqr / 1.34) ELSE sd END * pow(n, -0.2), 1e-4) bw FROM p),
m AS (SELECT k, round(s, 4) s, count(*) m FROM x GROUP BY 1, 2),
g AS (SELECT i / 511.0::DOUBLE g FROM range(512) r(i)),
d AS (SELECT m.k, g, sum(m * exp(-0.5 * pow((g - s) / bw, 2))) d FROM m JOIN b USING (k), g GROUP BY 1, 2),
o AS (SELECT g FROM d JOIN (SELECT k, max(d) t FROM d GROUP BY 1) USING (k) WHERE d >= 0.05 * t GROUP BY 1 HAVING count(*) = 2)
SELECT round(min(g), 9) lo, round(max(g), 9) hi, (SELECT n FROM b WHERE k = 'singlet') n_singlet, (SELECT n FROM b WHERE k = 'doublet') n_doublet FROM o"""
)
def kde_overlap_zone(spark, d):
    """M13."""
    two = F.col("event_type").isin("error", "purchase")
    e = table(spark, d, "events").select(F.when(two, "doublet").otherwise("singlet").alias("k"), F.when(two, F.sqrt(F.col("value") / 500)).otherwise(F.col("value") / 500).alias("s"))
    return doublets.overlap_zone(e, "s", "k").select(F.round("lo", 9).alias("lo"), F.round("hi", 9).alias("hi"), "n_singlet", "n_doublet")


_PAIRS = """
WITH c AS (SELECT label g, vec_id::VARCHAR id, embedding::DOUBLE[] v, row_number() OVER (PARTITION BY label ORDER BY md5(vec_id::VARCHAR)) - 1 place, count(*) OVER (PARTITION BY label) n FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT x.g, 'p' || x.id id, [(z[1] + z[2]) / 2 for z in list_zip(a.v, b.v)] v FROM c x
  JOIN c a ON a.g = x.g AND a.place = ('0x' || substr(md5(x.id || ',42,1'), 1, 12))::BIGINT % x.n
  JOIN c b ON b.g = x.g AND b.place = ('0x' || substr(md5(x.id || ',42,2'), 1, 12))::BIGINT % x.n),
m AS (SELECT g, 'c' || id id, v FROM c UNION ALL SELECT * FROM p),
d AS (SELECT q.g, q.id, m.id other, row_number() OVER (PARTITION BY q.g, q.id ORDER BY list_distance(q.v, m.v), m.id) r FROM m q JOIN m ON q.g = m.g AND q.id <> m.id WHERE q.id[1] = 'c'),
s AS (SELECT g, id, avg((other[1] = 'p')::INT) score FROM d WHERE r <= 15 GROUP BY 1, 2),
f AS (SELECT g, quantile_cont(score, 0.92) cut FROM s GROUP BY 1)
SELECT g AS label, substr(id, 2)::BIGINT cell_id, round(score, 9) score, CASE WHEN score > cut THEN 'doublet' ELSE 'singlet' END AS class FROM s JOIN f USING (g)"""


@query(_PAIRS)
def doublet_scores(spark, d):
    """Simulate-and-neighbour scores per batch."""
    e = table(spark, d, "embeddings").select("label", F.col("vec_id").alias("cell_id"), F.col("embedding").alias("vec"))
    return doublets.score_doublets(e, "label", 0.08).withColumn("score", F.round("score", 9))


@query("SELECT o_orderstatus, count(DISTINCT o_orderpriority) n_samples, count(DISTINCT o_orderstatus) n_protocols, CASE WHEN count(DISTINCT o_orderpriority) > 1 THEN 'o_orderpriority' END batch_column FROM orders GROUP BY 1")
def batch_select(spark, d):
    """M10 A25 M16 I3."""
    return rates.select_batch(table(spark, d, "orders").withColumn("protocol", F.col("o_orderstatus")), "o_orderstatus", "o_orderpriority", "protocol")


@query("SELECT o_orderstatus, o_orderpriority, n FROM (SELECT o_orderstatus, o_orderpriority, count(*) n, row_number() OVER (PARTITION BY o_orderstatus ORDER BY count(*) DESC, o_orderpriority) r FROM orders GROUP BY 1, 2) WHERE r = 1")
def modal_protocol(spark, d):
    """A17."""
    return rates.modal(table(spark, d, "orders"), ["o_orderstatus"], "o_orderpriority")
