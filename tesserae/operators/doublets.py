"""Doublet status: guards, score-overlap zone by kernel densities, three-way call, and a simulate-and-neighbour scorer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.operators.neighbors import knn
from tesserae.operators.running import sum_below
from tesserae.plans.workspace import Workspace


def overlap_zone(df: DataFrame, score: str, klass: str, least: float = 0.05, points: int = 512, digits: int = 4) -> DataFrame:
    """One row (lo, hi, n_singlet, n_doublet): first and last grid point where both classes' densities, each scaled to
    its own peak, reach ``least``. Null without five scores in each class or if the zone is narrower than 0.01.

    Gaussian kernels, bandwidth 0.9 min(sd, IQR/1.34) n^-0.2 (at least 1e-4). Scores are summed to multiplicities at
    ``digits`` decimals first, so the grid meets at most 10^digits + 1 rows of a class and never the cells.
    """
    x = df.where(F.col(score).isNotNull() & F.col(klass).isin("singlet", "doublet")).select(F.col(klass).alias("k"), F.col(score).cast("double").alias("s"))
    iqr = F.percentile("s", F.lit(0.75)) - F.percentile("s", F.lit(0.25))
    spread = x.groupBy("k").agg(F.count("*").alias("n"), F.stddev_samp("s").alias("sd"), iqr.alias("iqr"))
    narrow = F.when(F.col("iqr") > 0, F.least("sd", F.col("iqr") / 1.34)).otherwise(F.col("sd"))
    spread = spread.withColumn("bw", F.greatest(0.9 * narrow * F.pow("n", F.lit(-0.2)), F.lit(1e-4)))
    mass = x.groupBy("k", F.round("s", digits).alias("s")).agg(F.count("*").alias("m"))
    grid = df.sparkSession.range(points).select((F.col("id") / F.lit(float(points - 1))).alias("g"))
    u = (F.col("g") - F.col("s")) / F.col("bw")
    dens = mass.join(F.broadcast(spread), "k").join(F.broadcast(grid)).groupBy("k", "g").agg(F.sum(F.col("m") * F.exp(-0.5 * u * u)).alias("d"))
    peak = dens.groupBy("k").agg(F.max("d").alias("top"))
    ok = dens.join(F.broadcast(peak), "k").where(F.col("d") >= F.lit(least) * F.col("top")).groupBy("g").agg(F.count("*").alias("c")).where("c = 2")
    zone = ok.agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
    n = x.agg(F.count_if(F.col("k") == "singlet").alias("n_singlet"), F.count_if(F.col("k") == "doublet").alias("n_doublet"))
    use = (F.col("n_singlet") >= 5) & (F.col("n_doublet") >= 5) & (F.col("hi") - F.col("lo") >= 0.01)
    return n.join(F.broadcast(zone)).select(F.when(use, F.col("lo")).alias("lo"), F.when(use, F.col("hi")).alias("hi"), "n_singlet", "n_doublet")


def call_status(df: DataFrame, score: str, klass: str, lo: float | None, hi: float | None) -> DataFrame:
    """``df`` with ``doublet_status``: inside the zone ambiguous, doublets above it doublet, else singlet."""
    s = F.col(score)
    if lo is None or hi is None:
        return df.withColumn("doublet_status", F.when(F.col(klass) == "doublet", "doublet").otherwise("singlet"))
    return df.withColumn("doublet_status", F.when((s >= lo) & (s <= hi), "ambiguous").when((F.col(klass) == "doublet") & (s > hi), "doublet").otherwise("singlet"))


def guard_small(df: DataFrame, sample: str, least_cells: int = 25, skip: tuple[str, ...] = ()) -> DataFrame:
    """``df(score, class)`` with samples of fewer than ``least_cells`` cells, or listed ones, all singlet with score 0."""
    n = df.groupBy(sample).agg(F.count("*").alias("_n"))
    small = (F.col("_n") < least_cells) | F.col(sample).isin(*skip) if skip else F.col("_n") < least_cells
    out = df.join(n, sample)
    return out.withColumns({"score": F.when(small, 0.0).otherwise(F.col("score")), "class": F.when(small, "singlet").otherwise(F.col("class"))}).drop("_n")


def simulated_pairs(latent: DataFrame, batch: str, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(cells, pairs), both (batch, id, vec): a batch's cells with ids ``c...``, and as many means of two random ones, ``p...``.

    Pairs are drawn by MD5 of id, seed and turn, so they are the same in every run.
    """
    cells = sum_below(latent.select(batch, "cell_id", F.col("vec").cast("array<double>").alias("vec")), [batch], F.md5(F.col("cell_id").cast("string")), F.lit(1))
    cells = cells.withColumnRenamed("below", "at").withColumn("id", F.col("cell_id").cast("string"))
    n = cells.groupBy(batch).agg(F.count("*").alias("n"))
    drawn = cells.join(n, batch).select(batch, "id", *((F.conv(F.substring(F.md5(F.concat_ws(",", "id", F.lit(seed), F.lit(i))), 1, 12), 16, 10).cast("long") % F.col("n")).alias(f"at{i}") for i in (1, 2)))
    for i in (1, 2):
        drawn = drawn.join(cells.select(batch, F.col("at").alias(f"at{i}"), F.col("vec").alias(f"vec{i}")), [batch, f"at{i}"])
    pairs = drawn.select(batch, F.concat(F.lit("p"), "id").alias("id"), F.zip_with("vec1", "vec2", lambda x, y: (x + y) / 2).alias("vec"))
    return cells.select(batch, "cell_id", F.concat(F.lit("c"), "id").alias("id"), "vec"), pairs


def _called(scored: DataFrame, batch: str, rate: float) -> DataFrame:
    cut = scored.groupBy(batch).agg(F.percentile("score", F.lit(1 - rate)).alias("cut"))
    return scored.join(cut, batch).select(batch, "cell_id", "score", F.when(F.col("score") > F.col("cut"), "doublet").otherwise("singlet").alias("class"))


def score_doublets(latent: DataFrame, batch: str, rate: float, k: int = 15, seed: int = 42) -> DataFrame:
    """(batch, cell_id, score, class): share of simulated doublets among a cell's neighbours.

    As many random pairs as a batch has cells are averaged, the nearest ``k`` of the
    batch's cells and pairs are counted, and scores above the batch's exact quantile 1 - ``rate`` are doublets. A batch of any
    size is scored as a whole, block by block.
    """
    ws = Workspace(latent.sparkSession, "doublet-scores")
    cells, pairs = simulated_pairs(latent, batch, seed)
    cells, pairs = ws.save(cells, "cells"), ws.save(pairs, "pairs")
    mine = cells.drop("cell_id")
    near = knn(mine, mine.unionByName(pairs), k, include_self=False, by=batch)
    score = near.groupBy(batch, F.col("query").alias("id")).agg(F.avg(F.col("neighbour").startswith("p").cast("double")).alias("score"))
    return _called(cells.join(score, [batch, "id"], "left").select(batch, "cell_id", F.coalesce("score", F.lit(0.0)).alias("score")), batch, rate)


def boosted_doublets(latent: DataFrame, batch: str, rate: float, ks: tuple[int, ...] = (5, 15, 40), rounds: int = 2, trees: int = 20, depth: int = 2, leaf: int = 20, step: float = 0.1, seed: int = 42, sample: int = 200_000) -> DataFrame:
    """(batch, cell_id, score, class): the probability that a cell is like a simulated doublet, by boosted trees.

    Cells and simulated pairs are described by their neighbours: for each of ``ks`` the share of pairs among that many,
    weighted by nearness and plain, and how far off the neighbours are for their batch. Trees learn to tell pairs from cells;
    real doublets are among the cells, so in each further round the share ``rate`` of a batch's cells that score highest is left out of the
    training. Trees are fitted on at most ``sample`` rows of either kind, drawn by a hash; all cells are scored. On planted
    doublets it has not done better than ``score_doublets`` (README), which stays the default.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    ws = Workspace(latent.sparkSession, "doublets")
    cells, pairs = simulated_pairs(latent, batch, seed)
    cells, pairs = ws.save(cells, "cells"), ws.save(pairs, "pairs")
    both = cells.drop("cell_id").unionByName(pairs)
    near = ws.save(knn(both, both, max(ks), include_self=False, by=batch), "near")
    pair = F.col("neighbour").startswith("p").cast("double")
    closeness = F.exp(-F.col("dist") / F.greatest(F.avg("dist").over(Window.partitionBy(batch, "query")), F.lit(1e-12)))
    near = near.withColumns({"pair": pair, "w": closeness})
    facts = []
    for k in ks:
        here = F.col("rank") <= k
        facts += [F.avg(F.when(here, F.col("pair"))).alias(f"share_{k}"), F.try_divide(F.sum(F.when(here, F.col("pair") * F.col("w"))), F.sum(F.when(here, F.col("w")))).alias(f"near_{k}"), F.avg(F.when(here, F.col("dist"))).alias(f"far_{k}")]
    x = near.groupBy(batch, F.col("query").alias("id")).agg(*facts)
    typical = x.groupBy(batch).agg(*(F.avg(f"far_{k}").alias(f"typical_{k}") for k in ks))
    x = x.join(typical, batch).withColumns({f"far_{k}": F.coalesce(F.try_divide(f"far_{k}", f"typical_{k}"), F.lit(1.0)) for k in ks})
    names = [f"{f}_{k}" for k in ks for f in ("share", "near", "far")]
    x = ws.save(x.select(batch, "id", F.col("id").startswith("p").cast("double").alias("label"), *(F.coalesce(c, F.lit(0.0)).alias(c) for c in names)), "features")
    n = {r["label"]: r["count"] for r in x.groupBy("label").count().collect()}
    if len(n) < 2:
        return _called(cells.select(batch, "cell_id", F.lit(0.0).alias("score")), batch, rate)
    x = VectorAssembler(inputCols=names, outputCol="x").transform(x)
    some = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < F.lit(int(min(1.0, sample / max(n.values())) * (1 << 30)))
    train, scored = x.where(some), None
    for i in range(rounds):
        model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=trees, maxDepth=depth, minInstancesPerNode=leaf, stepSize=step, subsamplingRate=0.7, seed=seed).fit(train.select("x", "label"))
        scored = model.transform(x.where("label = 0")).select(batch, "id", vector_to_array("probability")[1].alias("score"))
        scored = ws.save(scored, f"scored{i}")
        cut = scored.groupBy(batch).agg(F.percentile("score", F.lit(1 - rate)).alias("cut"))
        suspect = scored.join(cut, batch).where("score > cut").select(batch, "id")
        train = x.where(some).join(suspect, [batch, "id"], "left_anti")
    return _called(cells.join(scored, [batch, "id"], "left").select(batch, "cell_id", F.coalesce("score", F.lit(0.0)).alias("score")), batch, rate)
