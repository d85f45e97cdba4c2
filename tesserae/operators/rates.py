"""Doublet rates: interpolation in user-supplied chemistry tables, resolution order, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CAP = 0.30


def segments(rates: DataFrame) -> DataFrame:
    """``rates(chemistry, cells, rate)`` -> linear pieces (chemistry, x0, x1, y0, slope, outside) covering all x > 0.

    The first and last slopes are carried on beyond the table; those pieces are marked outside.
    """
    w = Window.partitionBy("chemistry").orderBy("cells")
    s = rates.withColumns({"x1": F.lead("cells").over(w), "y1": F.lead("rate").over(w), "i": F.row_number().over(w)}).where("x1 is not null")
    last = F.max("i").over(Window.partitionBy("chemistry"))
    s = s.withColumn("slope", (F.col("y1") - F.col("rate")) / (F.col("x1") - F.col("cells"))).withColumn("last", last)
    inner = s.select("chemistry", F.col("cells").alias("x0"), "x1", F.col("cells").alias("ax"), F.col("rate").alias("ay"), "slope", F.lit(False).alias("outside"))
    low = s.where("i = 1").select("chemistry", F.lit(float("-inf")).alias("x0"), F.col("cells").alias("x1"), F.col("cells").alias("ax"), F.col("rate").alias("ay"), "slope", F.lit(True).alias("outside"))
    high = s.where("i = last").select("chemistry", F.col("x1").alias("x0"), F.lit(float("inf")).alias("x1"), F.col("x1").alias("ax"), F.col("y1").alias("ay"), "slope", F.lit(True).alias("outside"))
    return inner.unionByName(low).unionByName(high)


def interpolate_rates(df: DataFrame, rates: DataFrame, cells: str = "cells", chemistry: str = "chemistry") -> DataFrame:
    """``df`` with ``rate``: linear between table points, edge slopes outside, clamped to [0, 0.30] outside only.

    Null for a null or non-positive x and for a chemistry without table. The pieces are a few dozen rows of
    configuration; rows join on chemistry and pick their piece.
    """
    seg = F.broadcast(segments(rates).groupBy("chemistry").agg(F.collect_list(F.struct("x0", "x1", "ax", "ay", "slope", "outside")).alias("seg")).withColumnRenamed("chemistry", chemistry))
    x = F.col(cells).cast("double")
    inside = F.filter("seg", lambda s: ((x >= s["x0"]) & (x < s["x1"]) & ~s["outside"]) | ((x < s["x1"]) & s["outside"] & (s["x0"] == float("-inf"))) | ((x >= s["x0"]) & s["outside"] & (s["x1"] == float("inf"))))
    p = F.element_at(inside, 1)
    y = p["ay"] + p["slope"] * (x - p["ax"])
    # the last table point belongs to the outer piece, whose clamp must not touch it
    y = F.when(p["outside"] & (x != p["ax"]), F.least(F.greatest(y, F.lit(0.0)), F.lit(CAP))).otherwise(y)
    return df.join(seg, chemistry, "left").withColumn("rate", F.when((x > 0) & (F.size("seg") > 0), y)).drop("seg")


def table_chemistry(chemistry: Column) -> Column:
    """Table that a chemistry uses: v2 shares v3's, 5' equals 5p; null and unknown use v3."""
    c = F.lower(F.trim(chemistry))  # fixed values: the spellings of chemistries
    return F.when(c == "v4", "v4").when(c.isin("5p", "5prime", "5'"), "5p").otherwise("v3")


def resolve_rate(df: DataFrame, platform_rates: dict[str, float]) -> DataFrame:
    """``df(platform, user_rate, rate)`` with ``dbr`` and ``dbr_source``: valid override > table > platform > 10x fallback."""
    valid = (F.col("user_rate") > 0) & (F.col("user_rate") <= CAP)
    fixed = F.create_map(*(F.lit(x) for kv in sorted(platform_rates.items()) for x in kv)) if platform_rates else F.lit(None).cast("map<string,double>")
    platform = F.try_element_at(fixed, F.col("platform"))
    return df.withColumn("dbr", F.when(valid, F.col("user_rate")).when((F.col("platform") == "10x") & F.col("rate").isNotNull(), F.col("rate")).otherwise(F.coalesce(platform, F.col("rate")))).withColumn(
        "dbr_source", F.when(valid, "user").when((F.col("platform") == "10x") & F.col("rate").isNotNull(), "table").when(platform.isNotNull(), "platform").when(F.col("rate").isNotNull(), "fallback").otherwise("none")
    )


def weighted_mean(df: DataFrame, by: list[str], value: str, weight: str) -> DataFrame:
    """by..., mean of finite values weighted by ``weight``; null without any."""
    ok = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & (F.abs(F.col(value)) < float("inf"))
    x = df.where(ok)
    return x.groupBy(*by).agg(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias("weighted_mean"))


def select_batch(cells: DataFrame, dataset: str, sample: str, protocol: str) -> DataFrame:
    """dataset, n_samples, n_protocols, batch_column: the sample column if it has several levels, else the protocol's."""
    n = cells.groupBy(dataset).agg(F.count_distinct(F.nullif(F.trim(sample), F.lit(""))).alias("n_samples"), F.count_distinct(F.nullif(F.trim(protocol), F.lit(""))).alias("n_protocols"))
    return n.withColumn("batch_column", F.when(F.col("n_samples") > 1, sample).when(F.col("n_protocols") > 1, protocol))


def modal(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by..., value, n: the most frequent value of each group, ties to the smaller; counted before it is ranked."""
    n = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by).orderBy(F.desc("n"), value)
    return n.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
