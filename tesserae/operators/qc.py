"""Cell filters of quality control: ghost and empty cells, bounds from median deviations, hard floors, the keep predicate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_ghosts(cells: DataFrame, counts: float = 100, features: float = 50) -> DataFrame:
    """Cells with more than ``counts`` counts and more than ``features`` features, both strictly."""
    return cells.where((F.col("nCount") > counts) & (F.col("nFeature") > features))


def drop_empty(cells: DataFrame) -> DataFrame:
    """Cells with any count and any feature."""
    return drop_ghosts(cells, 0, 0)


def mad_bounds(cells: DataFrame, by: str, metrics: dict[str, bool], nmads: float = 3) -> DataFrame:
    """(by, and for each metric lo_, hi_): median -+ ``nmads`` scaled median deviations, on log1p scale where marked true.

    All medians come from one aggregation and all deviations from a second. Without deviation both bounds are the median;
    lower bounds are not negative.
    """
    v = {m: F.log1p(F.col(m).cast("double")) if log else F.col(m).cast("double") for m, log in metrics.items()}
    med = cells.groupBy(by).agg(*(F.median(c).alias(f"med_{m}") for m, c in v.items()))
    mad = cells.join(med, by).groupBy(by, *(f"med_{m}" for m in v)).agg(*((F.median(F.abs(c - F.col(f"med_{m}"))) * 1.4826).alias(f"mad_{m}") for m, c in v.items()))
    out = []
    for m, log in metrics.items():
        for side, sign in (("lo", -1), ("hi", 1)):
            t = F.col(f"med_{m}") + sign * F.lit(float(nmads)) * F.coalesce(f"mad_{m}", F.lit(0.0))
            t = F.expm1(t) if log else t
            out.append((F.greatest(t, F.lit(0.0)) if side == "lo" else t).alias(f"{side}_{m}"))
    return mad.select(by, *out)


def raise_floors(bounds: DataFrame, floors: dict[str, float]) -> DataFrame:
    """Bounds whose lower ones are at least the hard floors; upper ones stay, and a floor of 0 is none."""
    return bounds.withColumns({f"lo_{m}": F.greatest(f"lo_{m}", F.lit(float(x))) for m, x in floors.items()})


def mark_kept(cells: DataFrame, bounds: DataFrame, by: str, both: tuple[str, ...] = ("nFeature", "nCount"), upper: tuple[str, ...] = ("pct_mito",), slack: float = 1e-9) -> DataFrame:
    """``cells`` with their bounds and ``keep``: inside both bounds of ``both`` and under that of ``upper``, inclusive.

    ``slack`` is for the rounding of bounds that went through a logarithm. Cells of a group without bounds are not kept.
    """
    ok = F.lit(True)
    for m in both:
        ok = ok & F.col(m).between(F.col(f"lo_{m}") - slack, F.col(f"hi_{m}") + slack)
    for m in upper:
        ok = ok & (F.col(m) <= F.col(f"hi_{m}") + slack)
    return cells.join(bounds, by, "left").withColumn("keep", F.coalesce(ok, F.lit(False)))
