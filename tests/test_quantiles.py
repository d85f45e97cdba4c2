"""Exact quantiles by refinement against numpy."""

import numpy as np
import pytest

from tesserae.operators import quantiles


@pytest.mark.parametrize("bins", [16, 512])
def test_quantiles_equal_numpy(spark, bins):
    rng = np.random.default_rng(6)
    groups = {"a": rng.normal(size=700), "b": 2.0 ** rng.integers(-300, 300, 400), "c": np.repeat([1.0, 2.0], 90), None: rng.normal(size=31), "one": np.array([5.0]), "far": np.array([-1e300, 1e-300, 0.0, 1.0, 1e300])}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("a", None), ("a", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    got = {(r["g"], r["prob"]): r["quantile"] for r in quantiles.exact_quantiles(df, ["g"], "x", [0.0, 0.05, 0.5, 0.95, 1.0], bins=bins).collect()}
    assert set(got) == {(g, p) for g in groups for p in (0.0, 0.05, 0.5, 0.95, 1.0)}
    for (g, p), q in got.items():
        assert np.isclose(q, np.quantile(groups[g], p), rtol=1e-12, atol=0), (g, p)


def test_quantiles_of_the_whole_and_of_nothing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    assert [tuple(r) for r in quantiles.exact_quantiles(df, [], "x", [0.25]).collect()] == [(0.25, 2.25)]
    assert quantiles.exact_quantiles(df.limit(0), [], "x", [0.5]).count() == 0


def test_median_deviation(spark):
    rng = np.random.default_rng(7)
    x = {g: rng.exponential(size=n) for g, n in (("a", 301), ("b", 40))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in x.items() for v in vs], "g string, x double")
    for r in quantiles.exact_mad(df, ["g"], "x").collect():
        m = np.median(x[r["g"]])
        assert np.isclose(r["median"], m) and np.isclose(r["mad"], 1.4826 * np.median(np.abs(x[r["g"]] - m)))
