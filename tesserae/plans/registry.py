"""Registration of queries with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function under its name."""

    def deco(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counts(spark: SparkSession, sf_dir: str, gene: str = "part") -> DataFrame:
    """Surrogate counts: cell = order, gene = part (its key, or with ``gene="name"`` its name), count = quantity."""
    li = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as cell", "l_partkey", "l_quantity as count")
    if gene == "part":
        return li.withColumnRenamed("l_partkey", "gene")
    part = table(spark, sf_dir, "part").selectExpr("p_partkey as l_partkey", "p_name as gene")
    return li.join(part, "l_partkey").select("cell", "gene", "count")
