"""A training corpus from ``documents``: quality, near-duplicates, benchmark passages, secrets, mixture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.decontam import contamination
from tesserae.llm.minhash import near_duplicates
from tesserae.llm.mixing import mix
from tesserae.llm.quality import fit_quality, keep_quality
from tesserae.llm.secrets import fit_forest, labelled_findings, redact
from tesserae.plans.workspace import Workspace, small_side


def _named(columns: list[str]) -> list[Column]:
    """Columns by their whole names, dots and backticks included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def _rows(spark: SparkSession, docs: DataFrame, label: str) -> tuple[DataFrame, bool]:
    """``docs`` and False or, if any row is odd (its doc_id is null or repeated), (row, doc_id, text, odd) of them and True.

    That ``doc_id`` tells the rows apart: an odd row has a hash of its id and text, above all ids that are met, so that rejecting
    one text of an id leaves the others.
    """
    n, distinct = docs.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if n == distinct:
        return docs, False
    rows = docs.select(F.struct(*_named(docs.columns)).alias("row")).select("row", F.col("row.doc_id").cast("long").alias("id"), F.col("row.text").alias("text"))
    odd = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null").select(F.col("id").alias("odd_id"), F.lit(True).alias("odd"))
    odd = Workspace(spark, label).save(odd, "odd")
    key = F.lit(1 << 62) + F.xxhash64("id", "text").bitwiseAND((1 << 60) - 1)
    rows = rows.join(small_side(odd, 16), F.col("id").eqNullSafe(F.col("odd_id")), "left")
    return rows.select("row", F.when(F.col("odd"), key).otherwise(F.col("id")).alias("doc_id"), "text", F.coalesce("odd", F.lit(False)).alias("odd")), True


def _without(spark: SparkSession, rows: DataFrame, rejected: DataFrame, label: str) -> DataFrame:
    """``rows`` less the rejected doc_ids (few, and broadcast only if counted so)."""
    ids = Workspace(spark, label).save(rejected.select("doc_id").distinct(), "rejected")
    return rows.join(small_side(ids, 16), "doc_id", "left_anti")


def _release(spark: SparkSession) -> None:
    """Let go of the shuffles and broadcasts of the stage before, whose result is written."""
    Workspace(spark, "pipeline").release()


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    _release(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_quality(docs, fit_quality(docs, labels), 0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each near-duplicate group (five-word shingles, similarity of 0.8 or more).

    Rows without an id or with a repeated one are told apart by their texts, and of equal rows one stays.
    """
    _release(spark)
    rows, odd = _rows(spark, docs, "dedup")
    kept = _without(spark, rows, near_duplicates(rows, n=5, num=80, den=100).where("not kept"), "dedup")
    if not odd:
        return kept.select(*_named(docs.columns))
    return kept.where("not odd").unionByName(kept.where("odd").dropDuplicates(["doc_id"])).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item; each row is judged by its own text."""
    _release(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, odd = _rows(spark, docs, "decontaminate")
    kept = _without(spark, rows, contamination(rows, items, t=10).where("contaminated"), "decontaminate")
    return kept.select("row.*") if odd else kept.select(*_named(docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with confirmed secrets replaced in their texts."""
    _release(spark)
    return redact(docs, fit_forest(labelled_findings(spark), docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target mixture, with their training weight as ``mix_weight`` (``mix_weight_2``, 3, ... if taken)."""
    _release(spark)
    drawn = mix(docs, carry=True).where("sampled")
    taken, name, n = {c.lower() for c in docs.columns}, "mix_weight", 1
    while name in taken:
        n += 1
        name = f"mix_weight_{n}"
    return drawn.select("row.*", drawn["weight"].alias(name))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("mixture", mixture)]

#: The classifier and the forest are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again before the next."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
