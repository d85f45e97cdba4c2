"""Mixing sources to target weights by iterative proportional fitting. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.plans.workspace import Workspace, small_side

DIMS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    """A coarse topic by the form of a text; the first that fits, ``empty`` for null and blank texts."""
    return (
        F.when(text.isNull() | ~text.rlike(r"\S"), "empty")
        .when(text.contains(" | "), "table")
        .when(text.rlike(r"[*#$%&]{3}"), "markup")
        .when(text.contains("!!"), "promotion")
        .when(text.rlike(r"[Ll]icen[sc]e|[Cc]opyright"), "legal")
        .when(text.rlike(r"\w@\w"), "contact")
        .otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    """Words of the whole text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def smoothed_targets(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(dim, target): shares of a dimension's tokens raised to ``power``, summing to 1. 1 keeps them, 0 levels them."""
    m = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("s")).where("s > 0")
    return m.select(dim, (F.col("s") / F.lit(m.agg(F.sum("s")).first()[0])).alias("target"))


def rake(ws: Workspace, cells: DataFrame, targets: dict[str, DataFrame], rounds: int, most: int = 100_000) -> DataFrame:
    """``cells(dims..., tokens)`` -> with ``w``: cell weights summing to 1 whose marginals are the targets'.

    Starts from the cells' shares; in each round each dimension in turn is scaled to its target. A category without
    target or tokens gets 0. Only cells move, never documents. Up to ``most`` cells, counted first, are raked in one task,
    all rounds in one plan, by sums over windows that need no exchange; beyond that, marginals are map-side combined
    sums, joined back round by round.
    """
    cur = cells.where("tokens > 0").withColumn("w", F.col("tokens").cast("double"))
    if cur.count() <= most:
        cur = cur.coalesce(1)
        for dim, target in targets.items():
            met = target.join(cells.select(dim).distinct(), dim, "left_semi")  # no more categories than cells
            cur = cur.join(F.broadcast(met.withColumnRenamed("target", f"to_{dim}")), dim)
        for _ in range(rounds):
            for dim in targets:
                have = F.sum("w").over(Window.partitionBy(dim))
                cur = cur.withColumn("w", F.when(have > 0, F.col("w") * F.col(f"to_{dim}") / have).otherwise(0.0))
        return ws.save(cur.select(*cells.columns, "w"), "raked")
    for i in range(rounds):
        for dim, target in targets.items():
            have = cur.groupBy(dim).agg(F.sum("w").alias("have")).join(target, dim)
            cur = cur.join(have.select(dim, F.when(F.col("have") > 0, F.col("target") / F.col("have")).otherwise(0.0).alias("k")), dim).withColumn("w", F.col("w") * F.col("k")).drop("k")
        cur = ws.save(cur.select(*cells.columns, "w"), f"raked{i + 1}")
        ws.drop(f"raked{i}")
    return cur


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, power: float = 0.9, rounds: int = 8, seed: int = 17, carry: bool = False) -> DataFrame:
    """Sample ``docs(doc_id, text, lang, source)`` to target shares of tokens by source, language and topic.

    ``targets`` gives, for each of source, lang and topic, a DataFrame (that column, ``target``) summing to 1; where
    none is given, the corpus shares to ``power``. A cell (source, lang, topic) of raked share w and corpus share s has
    the rate w / s; its documents are kept with probability min(1, rate) and weigh max(1, rate) in training, so the
    expected weighted tokens meet the targets. Draws are hashes of doc_id and ``seed``: the same in every run.

    Returns a row for each row, with doc_id, source, lang, topic, n_tokens, probability, weight, sampled, and with
    ``carry`` the whole input row as struct ``row``. A null source or language is a category ``(none)``; documents
    without words are kept as they are. Repeated rows are drawn alike. An empty table gives an empty result; other
    columns are ignored. A hot source is one cell like any other: documents are summed before the shuffle, never
    gathered by source, and get their rates from a broadcast of the cells if these are small.
    """
    ws = Workspace(docs.sparkSession, "mix")
    none = F.lit("(none)")
    whole = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", none).alias("source"), F.coalesce("lang", none).alias("lang"), topic_of(F.col("text")).alias("topic"), tokens_of(F.col("text")).alias("n_tokens"), *whole)
    cells = ws.save(src.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    wanted = {d: (targets or {}).get(d, None) for d in DIMS}
    wanted = {d: ws.save(smoothed_targets(cells, d, power) if t is None else t.select(d, F.col("target").cast("double").alias("target")), f"target-{d}") for d, t in wanted.items()}
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    raked = rake(ws, cells, wanted, rounds)
    rate = raked.select(*DIMS, (F.col("w") * F.lit(float(total)) / F.col("tokens")).alias("rate"))
    out = src.join(small_side(rate, 256), list(DIMS), "left")
    rate = F.when(F.col("n_tokens") > 0, F.coalesce("rate", F.lit(0.0))).otherwise(1.0)
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("double") / 2.0**32
    return out.select("doc_id", *DIMS, "n_tokens", F.least(F.lit(1.0), rate).alias("probability"), F.greatest(F.lit(1.0), rate).alias("weight"), (draw < rate).alias("sampled"), *(["row"] if carry else []))
