"""Manifests, gene spaces, metadata, reports and label tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.functions import text
from tesserae.operators import harmonize, labels, rates, reports, selection
from tesserae.plans.registry import counts, query, table
from tesserae.sources import outputs

# what stages append to names, and spellings of protocols; rows of the tables take them in turn
SUFFIXES = ["_harmonized_singlets ", "_harmonized_filtered.rds", ".RDS", "_with_doublet_calls", "_filtered_singlets", "", None]
PROTOCOLS = ["10x_3_v3.1", "10X_5", "10x_5'_v2", "Drop-seq", "dropseq", "PIPseq V4", "10x v1", "10x_v4", "10x", "Smart-seq2", None]


def _in_turn(values, key):
    """The value whose turn it is by a row's key."""
    return F.get(F.array(*(F.lit(v) for v in values)), (F.col(key) % len(values)).cast("int"))


def _turn_sql(values, key):
    return "list_extract([" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + f"], ({key} % {len(values)} + 1)::INT)"


def _values(rows):
    return ", ".join("(" + ", ".join("NULL" if v is None else "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


@query(
    f"SELECT c_custkey, regexp_replace(regexp_replace(lower(trim(' ' || c_name || {_turn_sql(SUFFIXES, 'c_custkey')})), '\\.rds$', ''), '(_(harmonized_filtered|harmonized|filtered|with_doublet_calls|singlets))+$', '') canonical FROM customer"
)
def canon_name(spark, d):
    """Suffixes stripped to a fixpoint."""
    raw = F.concat(F.lit(" "), "c_name", _in_turn(SUFFIXES, "c_custkey"))
    return table(spark, d, "customer").select("c_custkey", text.canonical_sample(raw).alias("canonical"))


@query(
    f"""
WITH r AS (SELECT p_partkey, {_turn_sql(PROTOCOLS, "p_partkey")} t, p_size FROM part), s AS (SELECT p_partkey, lower(trim(CASE WHEN p_size % 2 = 0 THEN t ELSE ' ' || upper(t) || ' ' END)) s FROM r),
v AS (SELECT *, regexp_extract(s, 'v[0-9]+(\\.[0-9]+)?') v FROM s)
SELECT p_partkey, CASE WHEN regexp_matches(s, 'drop.?seq') THEN 'dropseq' WHEN contains(s, 'pipseq') THEN 'pipseq' WHEN starts_with(s, '10x') THEN '10x' ELSE s END platform,
CASE WHEN regexp_matches(s, 'drop.?seq') OR contains(s, 'pipseq') OR NOT starts_with(s, '10x') THEN NULL WHEN regexp_matches(s, '_5($|[_''])') THEN '5p' WHEN v = 'v3.1' THEN 'v3' WHEN v = 'v1' THEN 'v2' WHEN v <> '' THEN v WHEN s IS NOT NULL THEN 'v3' END chemistry FROM v"""
)
def protocol_parse(spark, d):
    """F2."""
    t = _in_turn(PROTOCOLS, "p_partkey")
    raw = F.when(F.col("p_size") % 2 == 0, t).otherwise(F.concat(F.lit(" "), F.upper(t), F.lit(" ")))
    x = table(spark, d, "part").select("p_partkey", text.parse_protocol(raw).alias("p"))
    return x.select("p_partkey", "p.platform", "p.chemistry")


@query(
    """SELECT p_partkey, upper(regexp_replace(p_name, '[-_.]', '', 'g')) gene_key, regexp_replace(p_brand, '[^A-Za-z0-9_-]', '_', 'g') safe, regexp_replace(p_name || '-' || p_size, '-[0-9]+$', '') bare,
lower(trim(p_type)) IN ('', 'nan', 'none', 'na', 'null', 'unassigned', 'unknown', '<na>') missing, list_extract(['#aa0000', '#00aa00'], CASE p_type WHEN 'SMALL' THEN 1 WHEN 'ECONOMY' THEN 2 END) color, printf('%.1f', p_size / 10.0) tag FROM part"""
)
def label_functions(spark, d):
    """F3 F4 F5 F6 F10 F11."""
    p = table(spark, d, "part")
    return p.select(
        "p_partkey", text.gene_key(F.col("p_name")).alias("gene_key"), text.safe_label(F.col("p_brand")).alias("safe"), text.strip_barcode(F.concat("p_name", F.lit("-"), "p_size")).alias("bare"),
        text.is_missing(F.col("p_type")).alias("missing"), text.lookup_color(F.col("p_type"), {"SMALL": "#aa0000", "ECONOMY": "#00aa00"}, None).alias("color"), text.resolution_tag(F.col("p_size") / 10).alias("tag"),
    )


@query("SELECT count(*) n_rows, sum(l_quantity) total, count(DISTINCT l_partkey) n_genes, count(DISTINCT l_orderkey) n_cells FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 25 OR p_name = 'red ring'")
def harmonize_genes(spark, d):
    """Gene space with transgenes, and counts within it."""
    part = table(spark, d, "part")
    space = harmonize.gene_space(part.where("p_size <= 25").selectExpr("p_partkey as gene"), part.where("p_name = 'red ring'").selectExpr("p_partkey as gene"))
    h = harmonize.harmonize(counts(spark, d), space)
    return h.agg(F.count("*").alias("n_rows"), F.sum(F.col("count").cast("double")).alias("total"), F.count_distinct("gene").alias("n_genes"), F.count_distinct("cell").alias("n_cells"))


@query("WITH r AS (SELECT p_partkey g FROM part WHERE p_size <= 25), q AS (SELECT DISTINCT l_partkey g FROM lineitem WHERE l_quantity > 45) SELECT (SELECT count(*) FROM r) n_reference, (SELECT count(*) FROM q) n_query, (SELECT count(*) FROM r JOIN q USING (g)) n_shared, (SELECT count(*) FROM r ANTI JOIN q USING (g)) n_missing, (SELECT count(*) FROM q ANTI JOIN r USING (g)) n_extra, (SELECT count(*) FROM r JOIN q USING (g)) / (SELECT count(*) FROM r) AS share")
def gene_overlap(spark, d):
    """P5 J14."""
    return harmonize.gene_overlap(counts(spark, d).where("count > 45"), table(spark, d, "part").where("p_size <= 25").selectExpr("p_partkey as gene"))


@query("SELECT o_orderkey AS cell, p_partkey AS gene, coalesce(sum(l_quantity), 0) AS count FROM orders CROSS JOIN part LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_partkey = p_partkey WHERE p_partkey < 10 AND o_totalprice > 400000 GROUP BY 1, 2")
def zero_filled_profile(spark, d):
    """P4 dense view of a small panel."""
    panel = table(spark, d, "part").where("p_partkey < 10").selectExpr("p_partkey as gene")
    cells = table(spark, d, "orders").where("o_totalprice > 400000").selectExpr("o_orderkey as cell")
    return harmonize.zero_filled(counts(spark, d), cells, panel)


@query("SELECT study, count(*) n_rows, count(DISTINCT gene) n_genes, sum(x) total FROM (SELECT 'a' study, l_partkey gene, l_quantity x FROM lineitem WHERE l_linestatus = 'O' UNION ALL SELECT 'b', l_partkey, l_quantity FROM lineitem WHERE l_linestatus = 'F' AND l_partkey < 1000) GROUP BY 1")
def concat_outer(spark, d):
    """Samples concatenated, outer over genes."""
    li = table(spark, d, "lineitem")
    a = li.where("l_linestatus = 'O'").selectExpr("'a' as study", "l_partkey as gene", "l_quantity as x")
    b = li.where("l_linestatus = 'F' and l_partkey < 1000").selectExpr("'b' as study", "l_quantity as x", "l_partkey as gene")
    return harmonize.concat_samples(a, b).groupBy("study").agg(F.count("*").alias("n_rows"), F.count_distinct("gene").alias("n_genes"), F.sum("x").alias("total"))


WANTED = ["small ring", "SMALL-RING", "Red.Widget", "blue bolt", "no such gene"]


@query(
    f"""
WITH g AS (SELECT DISTINCT replace(p_name, ' ', '') gene FROM part), w AS (SELECT replace(r, ' ', '') requested FROM (VALUES {_values([(n,) for n in WANTED])}) t(r)),
f AS (SELECT upper(regexp_replace(gene, '[-_.]', '', 'g')) k, min(gene) variant FROM g WHERE gene NOT IN (SELECT requested FROM w) GROUP BY 1)
SELECT requested, CASE WHEN gene IS NOT NULL THEN requested ELSE variant END resolved, CASE WHEN gene IS NOT NULL THEN 'exact' WHEN variant IS NOT NULL THEN 'variant' ELSE 'missing' END how
FROM w LEFT JOIN g ON gene = requested LEFT JOIN f ON k = upper(regexp_replace(requested, '[-_.]', '', 'g'))"""
)
def transgene_resolve(spark, d):
    """A requested gene is never renamed away."""
    genes = table(spark, d, "part").select(F.replace("p_name", F.lit(" "), F.lit("")).alias("gene"))
    return harmonize.resolve_transgenes(genes, spark.createDataFrame([(n.replace(" ", ""),) for n in WANTED], "gene string"))


@query("SELECT c_custkey, c_name, coalesce(nullif(trim(n_name), ''), 'Unknown') n_name, coalesce(r_name, 'Unknown') r_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def metadata_broadcast(spark, d):
    """Sample metadata on every cell."""
    n = table(spark, d, "nation").where("n_nationkey < 20").join(table(spark, d, "region").selectExpr("r_regionkey as n_regionkey", "r_name"), "n_regionkey")
    out = harmonize.broadcast_metadata(table(spark, d, "customer").withColumnRenamed("c_nationkey", "k"), n.withColumnRenamed("n_nationkey", "k"), ["n_name", "r_name"], "k")
    return out.select("c_custkey", "c_name", "n_name", "r_name")


@query(
    """
WITH m AS (SELECT c_custkey AS row, CASE WHEN c_custkey % 50 = 0 THEN ' ' ELSE c_name END data_path, CASE WHEN c_custkey % 70 = 0 THEN NULL ELSE 's' END study, (c_custkey // 2)::VARCHAR sample_id, c_custkey % 2 = 1 AND c_custkey % 10 <> 1 skip FROM customer),
k AS (SELECT *, count(*) OVER (PARTITION BY sample_id) c FROM m WHERE NOT skip)
SELECT row, 'empty data_path' problem FROM k WHERE trim(data_path) = '' UNION ALL SELECT row, 'empty study' FROM k WHERE coalesce(trim(study), '') = '' UNION ALL SELECT row, 'duplicate sample_id' FROM k WHERE c > 1"""
)
def manifest_validate(spark, d):
    """Problems of a manifest."""
    k = F.col("c_custkey")
    m = table(spark, d, "customer").select(
        k.alias("row"), F.when(k % 50 == 0, " ").otherwise(F.col("c_name")).alias("data_path"), F.when(k % 70 == 0, None).otherwise("s").alias("study"),
        F.floor(k / 2).cast("string").alias("sample_id"), F.when((k % 2 == 1) & (k % 10 != 1), " TRUE ").otherwise("").alias("skip"),
    )
    return harmonize.manifest_problems(m)


_FUNNEL = """
WITH r AS (SELECT c_nationkey sample, count(*) * 10 cells_raw FROM customer WHERE c_nationkey < 20 GROUP BY 1),
b AS (SELECT s_nationkey sample, count(*) * 30 cells_after_ghost, count(*) * 2 doublets_found FROM supplier WHERE s_nationkey > 3 GROUP BY 1),
q AS (SELECT c_nationkey sample, count(*) cells_after_qc FROM customer WHERE c_acctbal > 0 GROUP BY 1),
j AS (SELECT coalesce(r.sample, b.sample, q.sample)::VARCHAR sample, cells_raw, cells_after_ghost, doublets_found, cells_after_qc FROM r FULL JOIN b ON r.sample = b.sample FULL JOIN q ON coalesce(r.sample, b.sample) = q.sample),
f AS (SELECT *, cells_after_ghost - doublets_found cells_after_doublet_removal, cells_after_ghost - doublets_found - cells_after_qc removed_by_qc, cells_raw - cells_after_qc removed_total FROM j),
t AS (SELECT * FROM f UNION ALL SELECT 'TOTAL', sum(cells_raw)::BIGINT, sum(cells_after_ghost)::BIGINT, sum(doublets_found)::BIGINT, sum(cells_after_qc)::BIGINT, sum(cells_after_doublet_removal)::BIGINT, sum(removed_by_qc)::BIGINT, sum(removed_total)::BIGINT FROM f)"""


def _funnel(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    raw = c.where("c_nationkey < 20").groupBy(F.col("c_nationkey").cast("string").alias("sample")).agg((F.count("*") * 10).alias("cells_raw"))
    dbl = s.where("s_nationkey > 3").groupBy(F.col("s_nationkey").cast("string").alias("sample")).agg((F.count("*") * 30).alias("cells_after_ghost"), (F.count("*") * 2).alias("doublets_found"))
    qc = c.where("c_acctbal > 0").groupBy(F.col("c_nationkey").cast("string").alias("sample")).agg(F.count("*").alias("cells_after_qc"))
    return reports.funnel(raw, dbl, qc)


_STAGES = "cells_raw cells_after_ghost doublets_found cells_after_qc cells_after_doublet_removal removed_by_qc removed_total".split()


@query(_FUNNEL + f" SELECT sample, {', '.join(f'{c}::DOUBLE {c}' for c in _STAGES)}, round(100.0 * doublets_found / nullif(cells_after_ghost, 0), 6) pct_doublets, round(100.0 * removed_by_qc / nullif(cells_after_doublet_removal, 0), 6) pct_qc_removal, round(100.0 * removed_total / nullif(cells_raw, 0), 6) pct_total_removal FROM t")
def funnel_outer_join(spark, d):
    """J1 J2 A5 A6 A7 K9."""
    rounded = {c: F.round(c, 6) for c in ("pct_doublets", "pct_qc_removal", "pct_total_removal")}
    return _funnel(spark, d).withColumns(rounded | {c: F.col(c).cast("double") for c in _STAGES})


@query(_FUNNEL + " SELECT sample, 'raw' stage, cells_raw::DOUBLE AS value FROM t UNION ALL SELECT sample, 'singlets', cells_after_doublet_removal FROM t UNION ALL SELECT sample, 'final', cells_after_qc FROM t")
def funnel_long(spark, d):
    """R1 R3 and the tables behind the funnel figures."""
    out = reports.to_long(_funnel(spark, d), ["sample"], ["cells_raw", "cells_after_doublet_removal", "cells_after_qc"], {"cells_raw": "raw", "cells_after_doublet_removal": "singlets", "cells_after_qc": "final"})
    return out.withColumn("value", F.col("value").cast("double"))


@query("SELECT c_nationkey AS sample, max(c_acctbal) c_acctbal, max(c_mktsegment) c_mktsegment, max(c_custkey) c_custkey FROM customer GROUP BY 1")
def sample_collapse(spark, d):
    """A8 A9."""
    return reports.collapse_samples(table(spark, d, "customer").selectExpr("c_nationkey as sample", "c_acctbal", "c_mktsegment", "c_custkey"))


_ORD = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def _orders(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey as o_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, d, "nation").selectExpr("n_nationkey as c_nationkey", "n_name", "n_regionkey")
    r = table(spark, d, "region").selectExpr("r_regionkey as n_regionkey", "r_name")
    return table(spark, d, "orders").join(c, "o_custkey").join(n, "c_nationkey").join(r, "n_regionkey")


@query(f"SELECT r_name, count(*) n_cells, count(DISTINCT o_custkey) n_samples, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) c_mktsegment, string_agg(DISTINCT o_orderstatus, ', ' ORDER BY o_orderstatus) o_orderstatus FROM {_ORD} GROUP BY 1")
def dataset_summary(spark, d):
    """A10 A11 O1."""
    return reports.dataset_summary(_orders(spark, d), "r_name", "o_custkey", ["c_mktsegment", "o_orderstatus"])


@query(f"WITH n AS (SELECT r_name, n_name, count(*) n_cells FROM {_ORD} GROUP BY 1, 2), s AS (SELECT r_name, sum(n_cells)::BIGINT study_cells FROM n GROUP BY 1) SELECT r_name, n_name, n_cells, study_cells, dense_rank() OVER (ORDER BY study_cells DESC, r_name)::INTEGER study_rank FROM n JOIN s USING (r_name)")
def sample_summary(spark, d):
    """A12 W5 O2."""
    return reports.sample_summary(_orders(spark, d), "r_name", "n_name")


@query("SELECT o_orderpriority, count(*)::BIGINT total FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def age_top_n(spark, d):
    """A13 O3."""
    return reports.top_groups(table(spark, d, "orders").withColumn("one", F.lit(1)), "o_orderpriority", "one", 3)


@query("SELECT o_orderpriority, count(*) n, count(*) / sum(count(*)) OVER () AS fraction FROM orders GROUP BY 1")
def composition(spark, d):
    """A19 A22 W4."""
    return reports.composition(table(spark, d, "orders"), "o_orderpriority")


@query("SELECT o_orderstatus, o_orderpriority, count(*) n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) percent FROM orders GROUP BY 1, 2")
def composition_by_sample(spark, d):
    """A20 A26 R2."""
    return reports.composition_by(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority").withColumn("percent", F.round("percent", 6))


@query("SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') F, count(*) FILTER (l_linestatus = 'O') O FROM lineitem GROUP BY 1")
def confusion_matrix(spark, d):
    """A21 R2."""
    return reports.confusion(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


@query("SELECT round(avg(x), 6) mean, round(median(x), 6) median, round(100.0 * count(*) FILTER (x >= 0.02) / count(*), 6) pct_2, round(100.0 * count(*) FILTER (x >= 0.07) / count(*), 6) pct_7 FROM (SELECT l_discount x FROM lineitem)")
def similarity_stats(spark, d):
    """A23."""
    s = reports.similarity_stats(table(spark, d, "lineitem"), "l_discount", (0.02, 0.07))
    return s.select(*(F.round(c, 6).alias(c) for c in s.columns))


@query("SELECT col AS \"column\", n_levels FROM (SELECT unnest(['o_orderstatus', 'o_orderpriority']) col, unnest([count(DISTINCT nullif(trim(o_orderstatus), '')), count(DISTINCT nullif(trim(o_orderpriority), ''))]) n_levels FROM orders) WHERE n_levels BETWEEN 2 AND 24")
def split_columns(spark, d):
    """P16 O8 B-KEY."""
    return reports.split_columns(table(spark, d, "orders"), ["o_orderpriority"])


@query("SELECT o_custkey, o_orderpriority, n FROM (SELECT o_custkey, o_orderpriority, count(*) n, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) r FROM orders GROUP BY 1, 2) WHERE r = 1")
def majority_map(spark, d):
    """A18 W3 K20."""
    return reports.majority_map(table(spark, d, "orders"), "o_custkey", "o_orderpriority")


@query("SELECT vec_id, label FROM embeddings ORDER BY md5(vec_id::VARCHAR || ':42'), vec_id LIMIT 100")
def pseudorandom_subsample(spark, d):
    """The draw is a hash, so no SQL oracle."""
    return reports.subsample(table(spark, d, "embeddings").select("vec_id", "label"), "vec_id", 100)


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT k FROM events")
def json_metadata(spark, d):
    """F21 D14."""
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


ASSIGN = [("0", "Neuron", "Excitatory", None), ("1", "Glia", "nan", "Unassigned"), ("2", None, None, None), ("3", "Neuron", "unassigned", "L5"), ("4", "Stem", "", "")]
_A = f"WITH a(cluster, level_1, level_2, level_3) AS (VALUES {_values(ASSIGN)})"
_MISS = "({0} IS NULL OR lower(trim({0})) IN ('', 'nan', 'none', 'na', 'null', 'unassigned', 'unknown', '<na>'))"


def _assign(spark):
    return spark.createDataFrame(ASSIGN, "cluster string, level_1 string, level_2 string, level_3 string")


# labels of parts with gaps, as clusters' labels come
_B = """WITH a AS (SELECT p_partkey::VARCHAR AS cluster, CASE WHEN p_size % 10 = 0 THEN ' NaN' ELSE p_type END level_1, CASE WHEN p_size % 3 = 1 THEN 'Unassigned' WHEN p_size % 3 = 2 THEN p_brand END level_2,
CASE WHEN p_size % 4 = 0 THEN p_name ELSE '' END level_3, p_retailprice level_1_score, CASE WHEN p_size % 5 = 0 THEN p_size / 10.0 END::DOUBLE level_2_score FROM part)"""
_LEVELS = ["level_1", "level_2", "level_3"]


def _part_labels(spark, d):
    n = F.col("p_size")
    level_2 = F.when(n % 3 == 1, "Unassigned").when(n % 3 == 2, F.col("p_brand"))
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("cluster"), F.when(n % 10 == 0, " NaN").otherwise(F.col("p_type")).alias("level_1"), level_2.alias("level_2"), F.when(n % 4 == 0, F.col("p_name")).otherwise("").alias("level_3"),
        F.col("p_retailprice").alias("level_1_score"), F.when(n % 5 == 0, n / 10.0).alias("level_2_score"), F.lit(None).cast("double").alias("level_3_score"),
    )


_PROP = (
    _B
    + f""", b AS (SELECT * REPLACE (CASE WHEN {_MISS.format("level_2")} THEN level_1 ELSE level_2 END AS level_2) FROM a),
c AS (SELECT * REPLACE (CASE WHEN {_MISS.format("level_3")} THEN level_2 ELSE level_3 END AS level_3) FROM b),
p AS (SELECT cluster, {", ".join(f"CASE WHEN {_MISS.format(c)} THEN 'Unassigned' ELSE {c} END {c}" for c in _LEVELS)}, level_1_score, level_2_score FROM c)"""
)


@query(_PROP + " SELECT cluster, level_1, level_2, level_3 FROM p")
def label_propagate(spark, d):
    """W7."""
    return labels.propagate_labels(_part_labels(spark, d), _LEVELS).select("cluster", *_LEVELS)


@query(
    _PROP
    + """, t AS (SELECT * REPLACE (CASE WHEN level_2_score IS NULL AND level_2 = level_1 THEN level_1_score ELSE level_2_score END AS level_2_score) FROM p)
SELECT cluster, level_1_score, level_2_score, CASE WHEN level_3 = level_2 THEN level_2_score END level_3_score FROM t"""
)
def score_propagate(spark, d):
    """W8."""
    a = labels.propagate_labels(_part_labels(spark, d), _LEVELS)
    return labels.propagate_scores(a, _LEVELS).select("cluster", *(f"{c}_score" for c in _LEVELS))


@query(_PROP + ", q AS (SELECT cluster, level_1, level_2, level_2_score, level_2_score + 1 seq FROM p WHERE level_2_score IS NOT NULL UNION ALL SELECT cluster, level_1, level_2, level_1_score, level_1_score FROM p) SELECT cluster, max_by(level_2_score, seq) score FROM q GROUP BY 1")
def last_metric_row(spark, d):
    """Of repeated metrics rows of a cluster, the last."""
    a = _part_labels(spark, d)
    rows = a.where("level_2_score is not null").selectExpr("cluster", "level_2_score as score", "level_2_score + 1 as seq").union(a.selectExpr("cluster", "level_1_score", "level_1_score"))
    return labels.last_per_cluster(rows).select("cluster", "score")


SPELT = ["Level2", "LEVEL_1", "level_9", "Level_3"]


@query(
    _B
    + f""", o AS (SELECT s_suppkey::VARCHAR AS cluster, lower(replace({_turn_sql(SPELT, "s_suppkey")}, '_', '')) k, s_name FROM supplier)
SELECT cluster, {", ".join(f"coalesce((SELECT max(s_name) FROM o WHERE o.cluster = a.cluster AND k = 'level{i}'), level_{i}) level_{i}" for i in (1, 2, 3))} FROM a"""
)
def manual_override(spark, d):
    """Labels given by hand, suppliers standing in for the file."""
    o = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("cluster"), _in_turn(SPELT, "s_suppkey").alias("level"), F.col("s_name").alias("label"))
    return labels.override_labels(_part_labels(spark, d), o, _LEVELS).select("cluster", *_LEVELS)


@query(_A + " SELECT vec_id, level_1, level_2, level_3, coalesce(level_3, level_2, level_1, label::VARCHAR) latest FROM embeddings LEFT JOIN a ON a.cluster = label::VARCHAR")
def cluster_label_map(spark, d):
    """J5 J7 E10."""
    out = labels.map_labels(table(spark, d, "embeddings").select("vec_id", "label"), _assign(spark), ["level_1", "level_2", "level_3"], "label")
    return out.select("vec_id", "level_1", "level_2", "level_3", "latest")


@query(
    """
WITH q AS (SELECT doc_id, 'run_' || doc_id || '-1' barcode FROM documents), r AS (SELECT doc_id::VARCHAR || '-2' barcode, quality::VARCHAR AS label FROM labels),
t AS (SELECT q.doc_id, min(r.label) AS label FROM q LEFT JOIN r ON regexp_replace(r.barcode, '-[0-9]+$', '') = regexp_extract(regexp_replace(q.barcode, '-[0-9]+$', ''), '[^_]*$') GROUP BY 1)
SELECT doc_id, label, 2 AS tier FROM t"""
)
def tiered_match(spark, d):
    """Exact and suffix-free barcodes match nothing here, so the third tier decides."""
    q = table(spark, d, "documents").select("doc_id", F.concat(F.lit("run_"), "doc_id", F.lit("-1")).alias("barcode"))
    r = table(spark, d, "labels").select(F.concat(F.col("doc_id").cast("string"), F.lit("-2")).alias("barcode"), F.col("quality").cast("string").alias("label"))
    return labels.tiered_match(q, r).select("doc_id", "label", "tier")


@query("SELECT vec_id, coalesce(CASE label WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'A' END, label::VARCHAR) AS label, CASE WHEN label IN (0, 2) THEN 'top' END upper_label FROM embeddings")
def prototype_roll_up(spark, d):
    """J7 S22 G-labels."""
    p = table(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("prototype"))
    bridge = spark.createDataFrame([("0", "A"), ("1", "B"), ("2", "A")], "prototype string, label string")
    return labels.roll_up(p, bridge, spark.createDataFrame([("A", "top")], "label string, upper_label string")).select("vec_id", "label", "upper_label")


@query(
    """
WITH m AS (SELECT c_custkey, c_name, c_mktsegment study, CASE c_custkey % 3 WHEN 0 THEN ' raw/' || c_name || '.H5' WHEN 1 THEN '/abs/' || c_name || '/' ELSE 'dir/' || c_name END data_path, CASE WHEN c_custkey % 5 = 0 THEN 's/' || c_custkey ELSE ' ' END sample_dir, c_acctbal > 0 done FROM customer),
f AS (SELECT *, trim(data_path) p, coalesce(nullif(trim(sample_dir), ''), CASE WHEN regexp_matches(lower(trim(data_path)), '\\.(h5|h5ad|hdf5)$') THEN regexp_replace(trim(data_path), '/?[^/]*$', '') ELSE trim(data_path) END) d FROM m),
o AS (SELECT *, CASE WHEN done THEN (CASE WHEN starts_with(d, '/') THEN d ELSE '/w/' || d END) || '/' || c_name || '_clean.h5' WHEN starts_with(p, '/') THEN p ELSE '/w/' || p END path FROM f)
SELECT CASE WHEN done THEN regexp_replace(path, '/+', '/', 'g') ELSE path END data_path, ' ' || c_name || ' ' sample_id, study, '' AS source FROM o"""
)
def prepared_manifest(spark, d):
    """The manifest with paths swapped where ambient RNA was removed."""
    key = F.col("c_custkey")
    path = F.when(key % 3 == 0, F.concat(F.lit(" raw/"), "c_name", F.lit(".H5"))).when(key % 3 == 1, F.concat(F.lit("/abs/"), "c_name", F.lit("/"))).otherwise(F.concat(F.lit("dir/"), "c_name"))
    folder = F.when(key % 5 == 0, F.concat(F.lit("s/"), key.cast("string"))).otherwise(" ")
    m = table(spark, d, "customer").select(path.alias("data_path"), F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("sample_id"), F.col("c_mktsegment").alias("study"), folder.alias("sample_dir"), F.lit("false").alias("skip"), "c_acctbal")
    done = m.where("c_acctbal > 0").select("sample_id")
    return outputs.prepared_manifest(m, done, "_clean.h5", "/w").select("data_path", "sample_id", "study", "source")


@query("SELECT count(*) datasets, sum(cells)::BIGINT total_cells, round(avg(genes), 9) mean_genes FROM (SELECT c_nationkey, count(*) cells, sum(c_custkey % 100) genes FROM customer GROUP BY 1)")
def run_totals(spark, d):
    """A14."""
    per = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("cells"), F.sum(F.col("c_custkey") % 100).alias("genes"))
    return reports.run_totals(per).withColumn("mean_genes", F.round("mean_genes", 9))


@query("WITH f AS (SELECT upper(trim(p_name)) k, min(p_name) gene FROM part WHERE p_size > 10 GROUP BY 1) SELECT DISTINCT upper(p_name) wanted, gene FROM part JOIN f ON k = upper(trim(p_name)) WHERE p_size % 2 = 0")
def match_features(spark, d):
    """Names looked up without regard to case."""
    p = table(spark, d, "part")
    return selection.match_features(p.where("p_size % 2 = 0").select(F.upper("p_name").alias("gene")), p.where("p_size > 10").select(F.col("p_name").alias("gene")))


@query("SELECT o_orderpriority AS label, row_number() OVER (ORDER BY CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 4 END, o_orderpriority)::INT AS position FROM (SELECT DISTINCT o_orderpriority FROM orders)")
def ordered_labels(spark, d):
    """A fixed order first, the rest by name."""
    return selection.ordered_labels(table(spark, d, "orders").select(F.col("o_orderpriority").alias("label")), ["3-MEDIUM", "1-URGENT", "absent"])


@query("SELECT p_brand AS study, min('out/' || p_brand || '_' || p_partkey || '_filtered.h5ad') FILTER (p_size > 40) path FROM part GROUP BY 1")
def first_artefact(spark, d):
    """A study's first file by name; no study takes the files of one whose name begins with its own."""
    p = table(spark, d, "part")
    files = p.where("p_size > 40").select(F.concat(F.lit("out/"), "p_brand", F.lit("_"), "p_partkey", F.lit("_filtered.h5ad")).alias("path"))
    return selection.first_artefact(p.select(F.col("p_brand").alias("study")), files, "_filtered.h5ad")


@query("SELECT 'x/doublet_summary_' || strftime(max(o_orderdate), '%Y%m%d_%H%M%S') || '.csv' path FROM orders")
def latest_summary(spark, d):
    """The last file by the stamp in its name."""
    o = table(spark, d, "orders")
    files = o.select(F.concat(F.lit("x/doublet_summary_"), text.stamp(F.col("o_orderdate")), F.lit(".csv")).alias("path")).union(o.select(F.lit("x/zz_other.csv")))
    return selection.latest_by_name(files, r"^doublet_summary_.*\.csv$")


@query("SELECT CASE WHEN value > 100 THEN 'query' ELSE 'atlas' END \"group\", event_type, count(*) n, round(count(*) / sum(count(*)) OVER (PARTITION BY value > 100), 9) fraction FROM events GROUP BY value > 100, event_type")
def stacked_compositions(spark, d):
    """Compositions of two groups of cells in one table."""
    e = table(spark, d, "events")
    return reports.stacked_compositions({"query": e.where("value > 100"), "atlas": e.where("value <= 100")}, "event_type").withColumn("fraction", F.round("fraction", 9))


@query("WITH c AS (SELECT c_custkey sample_id, c_mktsegment barcode, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 n FROM customer) SELECT sample_id, CASE WHEN n > 0 THEN barcode || '-' || n ELSE barcode END cell_id FROM c")
def unique_cells(spark, d):
    """Repeated barcodes numbered."""
    return harmonize.unique_cells(table(spark, d, "customer").select(F.col("c_custkey").alias("sample_id"), F.col("c_mktsegment").alias("barcode"))).select("sample_id", "cell_id")


CHEMISTRIES = ["v4", " 5prime", "5'", "V2", "other", None, "5P"]


@query(f"WITH c AS (SELECT p_partkey, lower(trim({_turn_sql(CHEMISTRIES, 'p_partkey')})) c FROM part) SELECT p_partkey, CASE WHEN c = 'v4' THEN 'v4' WHEN c IN ('5p', '5prime', '5''') THEN '5p' ELSE 'v3' END chemistry FROM c")
def table_chemistry(spark, d):
    """M8: the table of rates that a chemistry uses."""
    return table(spark, d, "part").select("p_partkey", rates.table_chemistry(_in_turn(CHEMISTRIES, "p_partkey")).alias("chemistry"))
