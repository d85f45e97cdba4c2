"""Running sums and row numbers over large ordered groups: ranges of rows, sums of ranges, and sums within a range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace


def sum_below(df: DataFrame, by: list[str], order: Column, weight: Column) -> DataFrame:
    """``df`` with ``below``: the sum of ``weight`` over the rows of its group that come before it by ``order``.

    Rows are dealt into ranges of (group, order) and written, so a group of any size lies in several tasks; a range knows
    the sums of the ranges before it. ``order`` must tell the rows of a group apart.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_order", order).withColumn("_weight", weight)
    rows = keyed.repartitionByRange(parts, *by, "_order").withColumn("_part", F.spark_partition_id())
    rows = Workspace(spark, "running").save(rows, "rows")
    sums = rows.groupBy("_part", *by).agg(F.sum("_weight").alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_part", *by, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    match = F.lit(True)
    for c in ("_part", *by):
        match = match & F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}"))
    own = Window.partitionBy("_part", *by).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_own", F.coalesce(F.sum("_weight").over(own), F.lit(0)))
    joined = rows.alias("_l").join(sums.alias("_r"), match)
    return joined.select(*(F.col(f"_l.`{c}`") for c in df.columns), (F.col("_own") + F.col("_before")).alias("below"))


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """``df`` with ``name``: the row's place from 1 by ``order``, which must be distinct."""
    return sum_below(df, [], F.col(order), F.lit(1)).withColumn(name, F.col("below") + 1).drop("below")
