"""Exact quantiles of groups of any size: histograms around each wanted rank are refined until one value is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace, small_side


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: list[float], bins: int = 512, most: int = 400) -> DataFrame:
    """(by..., prob, quantile): linearly interpolated quantiles of ``value`` in each group, as exact as a sort's.

    A quantile lies between the values of two ranks. Each rank keeps an interval that holds its value; a pass counts the
    values within, in ``bins`` parts, with their extremes, and keeps the part of the rank. Parts are equal in turn by
    value and by its logarithm from the lower end, so that far outliers cost no more passes. A pass reads the column and
    shuffles at most groups x ranks x parts rows of counts; no task holds a group's values. Null and NaN values take no part;
    groups are matched as they are, null being a group of its own.
    """
    ws = Workspace(df.sparkSession, "quantiles")
    v = F.col(value).cast("double")
    keys = [f"_g{i}" for i in range(len(by))]
    x = df.where(v.isNotNull() & ~F.isnan(v)).select(*(F.col(c).alias(k) for c, k in zip(by, keys)), v.alias("_v"))
    n = x.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).where("n > 0")
    want = n.withColumn("prob", F.explode(F.array(*(F.lit(float(p)) for p in probs))))
    at = F.col("prob") * (F.col("n") - 1)
    want = ws.save(want.select(*keys, "prob", F.floor(at).cast("long").alias("below"), F.least(F.floor(at) + 1, F.col("n") - 1).cast("long").alias("above"), (at - F.floor(at)).alias("part")), "want")
    ranks = want.select(*keys, F.explode(F.array("below", "above")).alias("rank")).distinct()

    def same(a: str, b: str, columns: list[str]):
        out = F.lit(True)
        for c in columns:
            out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
        return out

    first = ranks.alias("r").join(n.alias("n"), same("r", "n", keys)).select(*(F.col(f"r.{k}") for k in keys), "r.rank", "n.lo", "n.hi", F.lit(0).cast("long").alias("before"))
    state, done = ws.save(first, "state0"), None
    for i in range(most):
        found = state.where("lo = hi").select(*keys, "rank", F.col("lo").alias("v"))
        done = found if done is None else done.unionByName(found)
        done, state = ws.save(done, f"done{i}"), state.where("lo < hi")
        if not state.count():
            break
        span = F.col("hi") - F.col("lo")
        u = (F.col("_v") - F.col("lo")) / span
        u = F.log1p(u * 1e15) / F.log1p(F.lit(1e15)) if i % 2 else u
        held = x.alias("x").join(small_side(state, 64).alias("s"), same("x", "s", keys) & (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
        part = F.least(F.floor(F.coalesce(u, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int")
        hist = held.select(*(F.col(f"s.{k}").alias(k) for k in keys), "rank", "before", "_v", part.alias("part")).groupBy(*keys, "rank", "before", "part").agg(F.count("*").alias("c"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        w = Window.partitionBy(*keys, "rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("before", F.col("before") + F.coalesce(F.sum("c").over(w), F.lit(0)))
        state = ws.save(hist.where("before <= rank and rank < before + c").select(*keys, "rank", "lo", "hi", "before"), f"state{i + 1}")
    else:
        raise RuntimeError(f"quantiles did not settle in {most} passes")
    one = lambda side: done.select(*keys, F.col("rank").alias(side), F.col("v").alias(f"v_{side}"))
    out = want.alias("w").join(one("below").alias("a"), same("w", "a", [*keys, "below"])).join(one("above").alias("b"), same("w", "b", [*keys, "above"]))
    q = F.col("v_below") + F.col("part") * F.when(F.col("v_above") == F.col("v_below"), 0.0).otherwise(F.col("v_above") - F.col("v_below"))
    return out.select(*(F.col(f"w.{k}").alias(c) for c, k in zip(by, keys)), "w.prob", q.alias("quantile"))


def exact_mad(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by..., median, mad): median and scaled median deviation of groups of any size, in two selections."""
    med = exact_quantiles(df, by, value, [0.5]).select(*by, F.col("quantile").alias("median"))
    med = Workspace(df.sparkSession, "mad").save(med, "median")
    m, match = med.alias("m"), F.lit(True)
    for c in by:
        match = match & F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}"))
    off = df.alias("d").join(small_side(med, 64).alias("m"), match).select(*(F.col(f"d.{c}").alias(c) for c in by), F.abs(F.col(f"d.{value}").cast("double") - F.col("m.median")).alias("_off"))
    dev = exact_quantiles(off, by, "_off", [0.5]).alias("d")
    return m.join(dev, match).select(*(F.col(f"m.{c}").alias(c) for c in by), "m.median", (F.col("d.quantile") * 1.4826).alias("mad"))
