"""The training-data queries, one for each operator, and their DuckDB oracles where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.audit import filter_audit
from tesserae.llm.covertree import top_k
from tesserae.llm.decontam import contamination
from tesserae.llm.htmltext import extract_pages
from tesserae.llm.langid import fit_languages, identify
from tesserae.llm.minhash import near_duplicates
from tesserae.llm.mixing import mix
from tesserae.llm.ppm import score_language
from tesserae.llm.quality import fit_quality, score_quality
from tesserae.llm.runs import detect_runs
from tesserae.llm.secrets import fit_forest, labelled_findings, scan
from tesserae.llm.toxicity import fit_toxicity, score_toxicity
from tesserae.llm.warc import page_records, resolve_revisits


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = scan(docs, fit_forest(labelled_findings(spark), docs))
    return found.select("doc_id", "finding", "start", "kind", F.length("value").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"), "probability", "is_secret")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), n=3, num=85, den=100)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_language(_table(spark, sf_dir, "documents"), folds=7, held=2)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), t=10)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(_table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("probability", "weight")})


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), every=50, k=5)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, _table(spark, sf_dir, "labels")), threshold=0.3)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = fit_languages(docs.where(~held))
    return identify(docs, model).select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve_revisits(page_records(_table(spark, sf_dir, "pages")))
    fields = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), F.coalesce(h["value"], F.lit("")))), "\n")
    return out.select("record_id", "url_key", "response_id", "state", "digest", fields.alias("headers"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_runs(_table(spark, sf_dir, "documents"), plant=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")), threshold=0.7)
    return found.select("doc_id", "held_out", "score", "predicted", F.size("spans").cast("long").alias("n_spans"))


#: Items' and documents' words in SQL: A-Z folded, runs of 0-9, a-z and all that is not ASCII.
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op4_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) w FROM documents),
i AS (SELECT DISTINCT item_id, {_WORDS} w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') win FROM
  (SELECT item_id, w, least(len(w), 10) m, unnest(range(1, greatest(len(w) - 9, 1) + 1)) p FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, p, m, array_to_string(w[p:p + m - 1], ' ') win FROM
  (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) p FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
h AS (SELECT doc_id, p, dw.m, item_id FROM dw JOIN iw USING (m, win)),
n AS (SELECT doc_id, count(DISTINCT q) n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) q FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) sha FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT n_words, coalesce(n_hit, 0)::BIGINT n_hit, coalesce(n_items, 0)::BIGINT n_items, coalesce(sha, sha256('')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)""",
    "op7_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id query_id, d.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * d.e[i]))::BIGINT score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id AND len(d.e) = len(q.e)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op2_minhash_near_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
e AS MATERIALIZED (SELECT x.a, x.b FROM (SELECT p.doc_id a, q.doc_id b, count(*) i FROM s p JOIN s q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY 1, 2) x
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON r.doc_id = e.a),
m AS (SELECT doc_id, min(c) c FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT n_shingles, c component_id, d.doc_id = c kept FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.doc_id = d.doc_id""",
}


def _mixing_sql(rounds: int = 8, power: float = 0.9, seed: int = 17) -> str:
    topic = """CASE WHEN text IS NULL OR NOT regexp_matches(text, '\\S') THEN 'empty' WHEN contains(text, ' | ') THEN 'table' WHEN regexp_matches(text, '[*#$%&]{3}') THEN 'markup'
 WHEN contains(text, '!!') THEN 'promotion' WHEN regexp_matches(text, '[Ll]icen[sc]e|[Cc]opyright') THEN 'legal' WHEN regexp_matches(text, '\\w@\\w') THEN 'contact' ELSE 'prose' END"""
    parts = [
        f"d AS MATERIALIZED (SELECT doc_id, coalesce(source, '(none)') source, coalesce(lang, '(none)') lang, {topic} topic, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT n_tokens FROM documents)",
        "c0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::BIGINT t, sum(n_tokens)::DOUBLE w FROM d GROUP BY ALL HAVING sum(n_tokens) > 0)",
    ]
    dims = ("source", "lang", "topic")
    for dim in dims:
        parts.append(f"t_{dim} AS MATERIALIZED (SELECT {dim}, pow(sum(t)::DOUBLE, {power}) / sum(pow(sum(t)::DOUBLE, {power})) OVER () AS target FROM c0 GROUP BY {dim})")
    at = 0
    for _ in range(rounds):
        for dim in dims:
            parts.append(f"c{at + 1} AS MATERIALIZED (SELECT source, lang, topic, t, w * target / sum(w) OVER (PARTITION BY {dim}) w FROM c{at} JOIN t_{dim} USING ({dim}))")
            at += 1
    return f"""WITH {", ".join(parts)},
r AS (SELECT doc_id, source, lang, topic, n_tokens, CASE WHEN n_tokens > 0 THEN coalesce(w * (SELECT sum(t) FROM c0) / t, 0) ELSE 1 END rate FROM d LEFT JOIN c{at} USING (source, lang, topic))
SELECT doc_id, source, lang, topic, n_tokens, round(least(1.0, rate), 6) probability, round(greatest(1.0, rate), 6) weight,
('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{seed}'), 1, 8))::BIGINT / 4294967296.0 < rate sampled FROM r"""


ORACLES["op6_mixing"] = _mixing_sql()
_KEY = r"""CASE WHEN host <> '' THEN host || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END"""
ORACLES["op10_warc_revisits"] = rf"""
WITH u AS (SELECT page_id, url, md5(html) digest, strlen(html)::VARCHAR size, '"' || substr(md5(html), 1, 16) || '"' etag, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i)https?://', '') rest FROM pages),
k AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '') host,
  list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|fbclid|gclid|msclkid|sessionid|ref)='))) q FROM u),
p AS (SELECT *, {_KEY} url_key FROM k),
v AS (SELECT page_id * 2 + 1 record_id, page_id + 500 ts, * EXCLUDE (digest) FROM p),
m AS (SELECT v.record_id, v.url_key, v.etag, v.size, r.page_id rp, r.digest, r.etag re, r.size rs,
  row_number() OVER (PARTITION BY v.record_id ORDER BY r.page_id DESC) n
  FROM v LEFT JOIN p r ON r.url_key = v.url_key AND r.digest IS NOT NULL AND (r.page_id, r.page_id * 2) < (v.ts, v.record_id))
SELECT record_id, url_key, rp * 2 response_id, CASE WHEN rp IS NULL THEN 'orphan' WHEN etag = re THEN 'resolved' ELSE 'mismatch' END state, CASE WHEN etag = re THEN digest END digest,
CASE WHEN etag = re THEN 'Content-Type: text/html' || chr(10) || 'Content-Length: ' || rs || chr(10) || 'ETag: ' || etag || chr(10) || 'Age: 500' || chr(10) || 'Cache-Control: max-age=60'
ELSE 'Content-Length: 0' || chr(10) || 'ETag: ' || coalesce(etag, '') || chr(10) || 'Age: 500' || chr(10) || 'Cache-Control: max-age=60' END headers FROM m WHERE n = 1"""

ORACLES["op11_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') part, coalesce(text, '') t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w, coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) late FROM d),
g AS (SELECT doc_id, max((quality = 1)::INT) good, max((toxic = 1)::INT) toxic FROM labels GROUP BY 1),
m AS (SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t))::INT
  + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * late::INT mask, count(*) n, coalesce(sum(good), 0) good, coalesce(sum(toxic), 0) toxic FROM w LEFT JOIN g USING (doc_id) GROUP BY ALL),
l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) l(x, b)),
o AS (SELECT concat(p.x, q.x, r.x, s.x, t.x) filter_order, [p.b, q.b, r.b, s.b, t.b] b FROM l p, l q, l r, l s, l t WHERE p.b | q.b | r.b | s.b | t.b = 31),
k AS (SELECT filter_order, step::INTEGER step, b[step] own, coalesce(list_sum(b[1:step - 1]), 0)::INT prior FROM o, range(1, 6) x(step)),
c AS (SELECT part, filter_order, step, own, sum(CASE WHEN mask & (own | prior) = 0 THEN n ELSE 0 END) kept, sum(CASE WHEN mask & own > 0 AND mask & prior = 0 THEN n ELSE 0 END) removed,
  sum(CASE WHEN mask & own > 0 AND mask & prior > 0 THEN n ELSE 0 END) redundant, sum(CASE WHEN mask = own THEN n ELSE 0 END) unique_fails,
  sum(CASE WHEN mask & own > 0 AND mask & prior = 0 THEN good ELSE 0 END) good_lost, sum(CASE WHEN mask & own > 0 AND mask & prior = 0 THEN toxic ELSE 0 END) toxic_lost FROM m, k GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT kept, removed::BIGINT removed, redundant::BIGINT redundant, unique_fails::BIGINT unique_fails, good_lost::BIGINT good_lost, toxic_lost::BIGINT toxic_lost,
(sum(removed) OVER (PARTITION BY part, own))::BIGINT shapley FROM c"""


def queries() -> dict:
    found = (op1_secret_scans, op2_minhash_near_dedup, op3_lm_scoring, op4_benchmark_decontamination, op5_html_extraction, op6_mixing, op7_exact_top_k, op8_quality_classifier, op9_language_id, op10_warc_revisits, op11_filter_audit, op12_periodic_runs, op13_toxicity)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
