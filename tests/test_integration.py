"""Clustering, batch correction and selection."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import integration, neighbors, scores, selection


def blobs(spark):
    rng = np.random.default_rng(0)
    rows = [(i, i % 2, i % 3, [float(x) for x in rng.normal(scale=0.3, size=3) + np.eye(3)[i % 3] * 8 + (i % 2) * 1.5]) for i in range(90)]
    return spark.createDataFrame(rows, "id long, batch long, kind long, vec array<double>")


def test_clusters_find_the_blobs(spark):
    v = blobs(spark)
    e = neighbors.knn(v, v, 10, include_self=False).select("query", "neighbour")
    c = integration.modularity_clusters(e, rounds=8)
    both = c.join(v.select(F.col("id").alias("node"), "kind"), "node")
    assert scores.adjusted_rand(both, "cluster", "kind").first()["ari"] > 0.5
    assert integration.modularity(e, c).first()["modularity"] > 0.4


def test_correction_brings_batches_together(spark):
    v = blobs(spark)
    out = integration.correct_batches(v, clusters=3, rounds=4)

    def gap(df):
        m = {r["batch"]: np.array(r["m"]) for r in df.groupBy("batch").agg(F.array(*(F.avg(F.col("vec")[i]) for i in range(3))).alias("m")).collect()}
        return np.linalg.norm(m[0] - m[1])

    assert out.count() == 90 and gap(out) < 0.5 * gap(v)
    assert integration.integrable(v, "batch") is None and "batches" in integration.integrable(v.where("batch = 0"), "batch")
    assert integration.correct_batches(v.limit(0)).count() == 0


def test_selection_guards(spark):
    v = blobs(spark)
    assert selection.join_shared(v.select("id"), v.select("id").where("id < 3"), "id") is None
    assert selection.join_shared(v.select("id"), v.select("id", "kind"), "id").count() == 90
    df = spark.createDataFrame([("nan", " ", "x")], "a string, b string, c string")
    assert selection.first_usable(df, ["a", "b", "z", "c"]) == "c" and selection.first_usable(df, ["a"]) is None
    with pytest.raises(ValueError):
        selection.complete_conditions(df, ["study"], "none")
