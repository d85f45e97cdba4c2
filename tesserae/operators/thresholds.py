"""Robust thresholds per group: MAD, triangle, Renyi entropy, knee, quantile, manual; and the method mini-language."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.operators.running import sum_below


@dataclass(frozen=True)
class Method:
    kind: str
    param: float | None = None


def parse_method(text: str) -> Method:
    """``lower_tri | upper_tri | renyi | knee | mad<int> | none | manual_<number> | quantile_<q>``; else an error."""
    s = text.strip()
    if s in ("lower_tri", "upper_tri", "renyi", "knee", "none"):
        return Method(s)
    if m := re.fullmatch(r"mad(\d+)", s):
        return Method("mad", float(int(m[1]) or 3))
    if m := re.fullmatch(r"(manual|quantile)_(-?\d+(?:\.\d+)?(?:[eE]-?\d+)?)", s):
        return Method(m[1], float(m[2]))
    raise ValueError(f"unknown threshold method {text!r}")


def mad_threshold(df: DataFrame, by: list[str], value: str, nmads: float, bound: str, log: bool) -> DataFrame:
    """median +- nmads * 1.4826 * MAD per group, on log1p scale if ``log``; the median itself where the MAD is 0.

    Lower bounds are not negative. Two exact medians; each keeps a group's distinct values, as exact medians must.
    """
    v = F.log1p(F.col(value).cast("double")) if log else F.col(value).cast("double")
    x = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*by, v.alias("v"))
    med = x.groupBy(*by).agg(F.median("v").alias("med"))
    joined = x.join(med, by) if by else x.withColumn("med", F.lit(med.first()[0]))
    mad = joined.groupBy(*by, "med").agg((F.median(F.abs(F.col("v") - F.col("med"))) * 1.4826).alias("mad"))
    t = F.when(F.coalesce(F.col("mad"), F.lit(0.0)) == 0, F.col("med")).otherwise(F.col("med") + (1 if bound == "upper" else -1) * F.lit(float(nmads)) * F.col("mad"))
    t = F.expm1(t) if log else t
    return mad.select(*by, "med", "mad", (F.greatest(t, F.lit(0.0)) if bound == "lower" else t).alias("threshold"))


def histogram(df: DataFrame, by: list[str], value: str, bins: int = 256) -> DataFrame:
    """Equal-width, left-closed histogram per group with its empty bins: by..., lo, width, bin (from 0), n.

    Values are counted before the shuffle; from here on a group has ``bins`` rows whatever its size.
    """
    x = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("v"))
    span = x.groupBy(*by).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count_distinct("v").alias("distinct"), F.count("*").alias("total"))
    span = span.withColumn("width", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    bin_ = F.when(F.col("width") > 0, F.least(F.floor((F.col("v") - F.col("lo")) / F.col("width")), F.lit(bins - 1))).otherwise(0).cast("int")
    joined = x.join(span, by) if by else x.join(F.broadcast(span))
    n = joined.groupBy(*by, bin_.alias("bin")).agg(F.count("*").alias("n"))
    spine = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return spine.join(n, [*by, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _first(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """The first row of each group of a histogram (at most ``bins`` rows each)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_rn = 1").drop("_rn")


def triangle_threshold(df: DataFrame, by: list[str], value: str, side: str, bins: int = 256) -> DataFrame:
    """Bin middle farthest from the line between the histogram's peak and its first (``lower``) or last bin.

    Fewer than five distinct values: the greatest for ``lower``, else the least; peak at the end: the peak's middle.
    """
    h = histogram(df, by, value, bins)
    g = Window.partitionBy(*by)
    peak = F.max(F.struct(F.col("n"), (-F.col("bin")).alias("nb"))).over(g)
    h = h.withColumn("pn", peak["n"]).withColumn("pb", -peak["nb"])
    end = 0 if side == "lower" else bins - 1
    h = h.withColumn("en", F.max(F.when(F.col("bin") == end, F.col("n"))).over(g))
    inside = (F.col("bin") <= F.col("pb")) if side == "lower" else (F.col("bin") >= F.col("pb"))
    dx, dy = F.lit(end) - F.col("pb"), F.col("en") - F.col("pn")
    dist = F.abs(dy * (F.col("bin") - F.col("pb")) - dx * (F.col("n") - F.col("pn"))) / F.sqrt((dx * dx + dy * dy).cast("double"))
    h = h.where(inside).withColumn("dist", F.when(F.col("pb") == end, 0.0).otherwise(dist))
    best = _first(h, by, [F.desc(F.round("dist", 9)), F.asc("bin")])
    at = F.when(F.col("pb") == end, F.col("pb")).otherwise(F.col("bin"))
    mid = F.col("lo") + (at + 0.5) * F.col("width")
    few = F.col("hi") if side == "lower" else F.col("lo")
    return best.select(*by, F.when(F.col("distinct") < 5, few).otherwise(mid).alias("threshold"))


def renyi_threshold(df: DataFrame, by: list[str], value: str, bins: int = 256) -> DataFrame:
    """Split of the histogram with the greatest sum of both sides' entropies of order 2; prefix sums give all splits."""
    h = histogram(df, by, value, bins).withColumn("p", F.col("n") / F.col("total"))
    w = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    g = Window.partitionBy(*by)
    h = h.withColumns({"s": F.sum("p").over(w), "q": F.sum(F.col("p") * F.col("p")).over(w)})
    h = h.withColumns({"sr": F.sum("p").over(g) - F.col("s"), "qr": F.sum(F.col("p") * F.col("p")).over(g) - F.col("q")})
    h = h.where(F.col("bin") < bins - 1).where("s > 1e-12 and sr > 1e-12")

    def entropy(q, s):
        return -F.log(F.col(q) / (F.col(s) * F.col(s)) + 1e-12)

    h = h.withColumn("e", F.round(entropy("q", "s") + entropy("qr", "sr"), 9))
    best = _first(h, by, [F.desc("e"), F.asc("bin")])
    return best.select(*by, "bin", (F.col("lo") + (F.col("bin") + 0.5) * F.col("width")).alias("threshold"))


def knee_threshold(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Value at the knee of the descending log-log rank curve; with fewer than five distinct values, the median.

    Only distinct positive values are ranked, with their multiplicities, range by range, so no task holds a whole group.
    """
    x = df.where(F.col(value) > 0).select(*by, F.col(value).cast("double").alias("v"))
    d = x.groupBy(*by, "v").agg(F.count("*").alias("m"))
    d = sum_below(d, by, -F.col("v"), F.col("m")).withColumns({"x": F.log10(F.col("below") + 1), "y": F.log10(F.col("v") + 1)})
    span = d.groupBy(*by).agg(F.log10(F.sum("m")).alias("nx"), F.max("y").alias("sy"), F.min("y").alias("ly"))
    d = d.join(span, by) if by else d.join(F.broadcast(span))
    dist = F.round(F.try_divide(F.col("x"), F.col("nx")) + F.try_divide(F.col("y") - F.col("ly"), F.col("sy") - F.col("ly")) - 1, 9)
    best = d.groupBy(*by).agg(F.max(F.struct(dist.alias("dist"), F.col("v"))).alias("best")).select(*by, F.col("best.v").alias("v"))
    few = x.groupBy(*by).agg(F.median("v").alias("med"), F.count_distinct("v").alias("distinct"))
    best = best.join(few, by) if by else best.join(F.broadcast(few))
    return best.select(*by, F.when(F.col("distinct") < 5, F.col("med")).otherwise(F.col("v")).alias("threshold"))


def quantile_threshold(df: DataFrame, by: list[str], value: str, q: float) -> DataFrame:
    """Exact quantile with linear interpolation."""
    return df.groupBy(*by).agg(F.percentile(value, F.lit(q)).alias("threshold"))


def threshold(df: DataFrame, by: list[str], value: str, method: str, bound: str, metric: str = "generic") -> DataFrame:
    """by..., threshold by a method text. ``none`` is plus or minus infinity; an unknown method is an error."""
    m = parse_method(method)
    if m.kind == "mad":
        return mad_threshold(df, by, value, m.param, bound, metric in ("feature", "count")).select(*by, "threshold")
    if m.kind in ("lower_tri", "upper_tri"):
        return triangle_threshold(df, by, value, "lower" if m.kind == "lower_tri" else "higher")
    if m.kind == "renyi":
        return renyi_threshold(df, by, value).select(*by, "threshold")
    if m.kind == "knee":
        return knee_threshold(df, by, value)
    if m.kind == "quantile":
        return quantile_threshold(df, by, value, m.param)
    fixed = m.param if m.kind == "manual" else float("inf") * (1 if bound == "upper" else -1)
    return df.select(*by).distinct().withColumn("threshold", F.lit(fixed))
