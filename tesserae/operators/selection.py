"""Choosing datasets, columns and cells: exclusions, singlet preference, key completion, joins with a guard."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.text import is_missing


def exclude(datasets: DataFrame, noisy: DataFrame, on: str = "dataset") -> DataFrame:
    """Datasets that are not listed as noisy."""
    return datasets.join(noisy.select(on).distinct(), on, "left_anti")


def prefer_singlets(datasets: DataFrame, on: str = "dataset") -> DataFrame:
    """If any dataset is of singlets, those with doublet calls are left out."""
    name = F.lower(on)
    any_ = datasets.agg(F.coalesce(F.max(name.endswith("_singlets").cast("int")), F.lit(0)).alias("_any"))
    out = datasets.join(F.broadcast(any_))
    return out.where((F.col("_any") == 0) | ~name.contains("_with_doublet_calls")).drop("_any")


# fixed values: columns that name a cell's sample, in the order in which they are tried
SAMPLE_ALIASES = ("sample_id", "sample", "donor_id", "batch", "orig.ident", "library_id")


def complete_sample(cells: DataFrame, fallback: str, aliases: tuple[str, ...] = SAMPLE_ALIASES) -> DataFrame:
    """Cells with ``sample_id``: the first present alias that is not missing, else a constant."""
    have = [F.when(~is_missing(F.col(f"`{c}`").cast("string")), F.col(f"`{c}`").cast("string")) for c in aliases if c in cells.columns]
    return cells.withColumn("sample_id", F.coalesce(*have, F.lit(fallback)))


def complete_conditions(cells: DataFrame, keys: list[str], batch: str, study: str = "query") -> DataFrame:
    """Cells with every condition key: ``study`` filled by a constant, others by the batch column, which must exist."""
    if batch not in cells.columns:
        raise ValueError(f"batch column {batch} is missing")
    return cells.withColumns({k: F.lit(study) if k == "study" else F.col(batch) for k in keys if k not in cells.columns})


def first_usable(df: DataFrame, candidates: list[str]) -> str | None:
    """The first candidate column with a non-missing value; one aggregation over all of them."""
    have = [c for c in candidates if c in df.columns]
    if not have:
        return None
    r = df.agg(*(F.max((~is_missing(F.col(f"`{c}`").cast("string"))).cast("int")).alias(str(i)) for i, c in enumerate(have))).first()
    return next((c for i, c in enumerate(have) if r[i]), None)


def join_shared(left: DataFrame, right: DataFrame, on: str, least: int = 10) -> DataFrame | None:
    """Inner join by cell, never by position; None, so that the method is passed over, with fewer than ``least`` shared cells."""
    out = left.join(right, on)
    return out if out.select(on).distinct().limit(least).count() >= least else None


def match_features(wanted: DataFrame, features: DataFrame, name: str = "gene") -> DataFrame:
    """(wanted, gene): the feature of each wanted name without regard to case; of several, the first by name. Blank names and
    names without a feature have no row."""
    key = F.upper(F.trim(name))
    have = features.where(F.trim(name) != "").groupBy(key.alias("_k")).agg(F.min(name).alias(name))
    want = wanted.where(F.trim(name) != "").select(F.trim(name).alias("wanted"), key.alias("_k")).distinct()
    return want.join(have, "_k").select("wanted", name)


def ordered_labels(labels: DataFrame, first: list[str], label: str = "label") -> DataFrame:
    """(label, position from 1): labels of a fixed order first, the others after them by name. Labels are few."""
    x = labels.where(F.col(label).isNotNull()).select(label).distinct()
    place = F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(v) for v in first)).cast("array<string>"), F.col(label).cast("string")), F.lit(0)), F.lit(len(first) + 1))
    return x.withColumn("position", F.row_number().over(Window.orderBy(place, label)))


def first_artefact(studies: DataFrame, files: DataFrame, suffix: str, study: str = "study", path: str = "path") -> DataFrame:
    """(study, path): the first file by name whose name is the study followed by anything and ``suffix``; null without one.

    A name belongs to the longest study that it begins with, so that study ``a`` does not take the files of ``ab``. All
    beginnings of a name meet the studies in an equi-join.
    """
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.substring(name, F.lit(1), F.length(name) - len(suffix))
    f = files.where(name.endswith(suffix)).select(F.col(path), stem.alias("_stem"))
    f = f.withColumn("_head", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("_stem"), F.lit(1))), lambda n: F.substring(F.col("_stem"), F.lit(1), n))))
    own = f.join(studies.select(F.col(study).alias("_head")).distinct(), "_head").groupBy(path).agg(F.max_by("_head", F.length("_head")).alias(study))
    return studies.select(study).distinct().join(own.groupBy(study).agg(F.min(path).alias(path)), study, "left")


def latest_by_name(files: DataFrame, pattern: str, path: str = "path") -> DataFrame:
    """The last by name of the files whose name matches; no row without one."""
    return files.where(F.element_at(F.split(path, "/"), -1).rlike(pattern)).agg(F.max(path).alias(path)).where(F.col(path).isNotNull())
