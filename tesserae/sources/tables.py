"""Readers and writers: manifests, gene annotation, 10x matrices, configurations, reports."""

from __future__ import annotations

import configparser
import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.operators.harmonize import MANDATORY, manifest_problems
from tesserae.operators.running import numbered


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Sample manifest CSV as trimmed strings with its CSV row number ``row``; errors list what is wrong.

    The delimiter is ``;`` if the header holds more of them than commas. Rows with skip=true go. A missing mandatory
    column, an empty data_path or study, a repeated sample_id or an empty result raise ValueError.
    """
    head = (spark.read.text(path).first() or [""])[0] or ""
    sep = ";" if head.count(";") > head.count(",") else ","
    names = [c.strip().strip('"').lstrip("﻿") for c in head.split(sep)]
    if missing := [c for c in MANDATORY if c not in names]:
        raise ValueError(f"manifest lacks columns {missing}")
    schema = ", ".join(f"`{c}` string" for c in names)
    df = spark.read.csv(path, sep=sep, header=True, schema=schema, enforceSchema=True, nullValue="\u0000")
    df = df.select(*(F.trim(F.coalesce(f"`{c}`", F.lit(""))).alias(c) for c in names))
    # a manifest is one small file: its rows are numbered in file order
    df = df.withColumn("row", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())) + 1)
    if problems := [f"row {r['row']}: {r['problem']}" for r in manifest_problems(df).orderBy("row", "problem").take(50)]:
        raise ValueError("; ".join(problems))
    out = df.where(F.lower("skip") != "true") if "skip" in names else df
    if out.isEmpty():
        raise ValueError("no sample left in the manifest")
    return out


def read_genes(spark: SparkSession, path: str, biotypes: tuple[str, ...] = ("protein_coding", "lncRNA")) -> DataFrame:
    """Distinct gene names of a GTF file (plain or gz): feature ``gene`` of the given biotypes; none is an error."""
    f = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(f) >= 9).where(F.get(f, F.lit(2)) == "gene")
    attr = F.get(f, F.lit(8))

    def value(key: str):
        return F.regexp_extract(attr, rf'(?:^|;)\s*{key} "([^"]*)"', 1)

    kind = F.coalesce(F.nullif(value("gene_biotype"), F.lit("")), value("gene_type"))
    genes = lines.where(kind.isin(*biotypes)).select(value("gene_name").alias("gene")).where("gene <> ''").distinct()
    if genes.isEmpty():
        raise ValueError(f"no gene of {biotypes} in {path}")
    return genes


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one small text file with their number from 1."""
    return spark.read.text(path).withColumn("n", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


def _files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the files of a folder of parts by name."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = [str(f.getPath()) for f in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    return sorted(f for f in found if f.rsplit("/", 1)[1][0] not in "_.")


def _matrix_lines(spark: SparkSession, paths: list[str], header: bool) -> DataFrame:
    return spark.read.csv(paths, schema="value string", header=header, enforceSchema=True, comment="%", sep="\u0001", quote="")


def read_mtx(spark: SparkSession, folder: str, sample_id: str, prefix: str = "") -> DataFrame:
    """10x triplet (matrix.mtx, barcodes.tsv, features.tsv or genes.tsv, each also .gz) as (sample_id, cell, gene, count).

    The gene name is the second column if there is one. Matrix lines are split and joined to both small name tables. Each
    of the three may be a folder of parts, as ``write_mtx`` makes them.
    """

    def pick(*names: str) -> str:
        root = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for n in names:
            for end in (".gz", ""):
                p = f"{folder.rstrip('/')}/{prefix}{n}{end}"
                if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p)):
                    return p
        raise FileNotFoundError(f"none of {names} in {folder}")

    matrix = pick("matrix.mtx")
    if spark.read.text(matrix).where(~F.col("value").startswith("%")).first() is None:
        raise ValueError(f"{folder}: empty matrix")
    # the first line that is no comment holds the dimensions: it goes as a header does, by its place and not by its numbers
    first, *rest = _files(spark, matrix)
    lines = _matrix_lines(spark, [first], header=True)
    lines = lines.unionByName(_matrix_lines(spark, rest, header=False)) if rest else lines
    part = F.split(F.trim("value"), r"\s+")
    rows = lines.select(F.get(part, F.lit(0)).cast("long").alias("g"), F.get(part, F.lit(1)).cast("long").alias("c"), F.get(part, F.lit(2)).cast("float").alias("count"))
    cols = F.split("value", "\t")
    cells = _numbered(spark, pick("barcodes.tsv")).select(F.col("n").alias("c"), F.trim("value").alias("cell"))
    genes = _numbered(spark, pick("features.tsv", "genes.tsv")).select(F.col("n").cast("long").alias("g"), F.coalesce(F.get(cols, F.lit(1)), F.get(cols, F.lit(0))).alias("gene"))
    return rows.join(cells, "c").join(genes, "g").select(F.lit(sample_id).alias("sample_id"), "cell", "gene", "count")


def write_mtx(counts: DataFrame, folder: str) -> None:
    """Counts (cell, gene, count) as a 10x triplet folder of text: matrix.mtx, barcodes.tsv, features.tsv parts.

    Names are numbered over sorted distinct names, range by range, and make one file each, as their line numbers count;
    the matrix body stays distributed, in parts of one directory.
    """
    cells, genes = (numbered(counts.select(x).distinct(), x, x[0]) for x in ("cell", "gene"))
    summed = counts.groupBy("cell", "gene").agg(F.sum("count").alias("count"))
    n, nc, ng = summed.count(), cells.count(), genes.count()
    body = summed.join(cells, "cell").join(genes, "gene").select(F.concat_ws(" ", "g", "c", F.format_string("%.6g", F.col("count").cast("double"))).alias("value"))
    head = counts.sparkSession.createDataFrame([("%%MatrixMarket matrix coordinate real general",), (f"{ng} {nc} {n}",)], "value string").coalesce(1)
    head.unionAll(body).write.mode("overwrite").text(f"{folder}/matrix.mtx")
    cells.orderBy("c").select("cell").coalesce(1).write.mode("overwrite").text(f"{folder}/barcodes.tsv")
    genes.orderBy("g").select(F.concat_ws("\t", "gene", "gene")).coalesce(1).write.mode("overwrite").text(f"{folder}/features.tsv")


def read_table(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A CSV of known columns; a missing, empty or header-only file is an empty table."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.csv(path, sep=sep, header=True, schema=schema, mode="PERMISSIVE")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise


def read_sample_list(spark: SparkSession, path: str) -> list[str]:
    """Names of a small list file in order, once each; ``#`` begins a comment."""
    names = [r[0].split("#")[0].strip() for r in spark.read.text(path).collect()]
    return list(dict.fromkeys(n for n in names if n))


def read_bridge(spark: SparkSession, path: str) -> DataFrame:
    """Prototype bridge TSV: its first two columns as (prototype, label)."""
    df = spark.read.csv(path, sep="\t", header=True)
    a, b = df.columns[:2]
    return df.select(F.col(a).alias("prototype"), F.col(b).alias("label")).dropDuplicates(["prototype"])


def read_samples(spark: SparkSession, manifest: DataFrame, root: str = ".") -> DataFrame:
    """Counts of all samples of a manifest: a folder is a 10x triplet, ``.parquet`` a counts table; others are errors.

    HDF5 and RDS files need libraries that are not Spark's; convert them to a triplet or Parquet first.
    """
    out = None
    for r in manifest.select("sample_id", "data_path", *(["file_prefix"] if "file_prefix" in manifest.columns else [])).collect():
        path = r["data_path"] if os.path.isabs(r["data_path"]) or "://" in r["data_path"] else f"{root}/{r['data_path']}"
        if path.endswith((".h5", ".hdf5", ".h5ad", ".rds")):
            raise ValueError(f"{path}: convert to a 10x triplet or Parquet")
        df = spark.read.parquet(path).select(F.lit(r["sample_id"]).alias("sample_id"), "cell", "gene", F.col("count").cast("float")) if path.endswith(".parquet") else read_mtx(spark, path, r["sample_id"], r.asDict().get("file_prefix") or "")
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError("empty manifest")
    return out


def write_counts(counts: DataFrame, path: str, by: str = "study") -> None:
    """Counts as Parquet by study, rows of a sample together."""
    counts.repartition(by, "sample_id").sortWithinPartitions("sample_id").write.mode("overwrite").partitionBy(by).parquet(path)


def write_report(df: DataFrame, path: str, sep: str = ",") -> None:
    """A report (a row per sample, study or label) as one CSV with a header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True, sep=sep)


def write_embeddings(df: DataFrame, path: str, dims: int = 30, id_: str = "cell_id", vec: str = "vec") -> None:
    """The first ``dims`` components of each cell as CSV columns dim_1..; the number is that of the first vector."""
    n = min(dims, len((df.select(vec).first() or [[]])[0]))
    df.select(id_, *(F.get(vec, F.lit(i)).alias(f"dim_{i + 1}") for i in range(n))).write.mode("overwrite").csv(path, header=True)


def parse_dcf(text: str) -> dict[str, str]:
    """Lenient key: value text; lines without a colon go on with the last key; ``#`` begins a comment line."""
    out: dict[str, str] = {}
    key = None
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        name, colon, value = line.partition(":")
        if colon and name.strip() and not line[0].isspace():
            key = name.strip()
            out[key] = value.strip()
        elif key:
            out[key] = f"{out[key]}\n{line.strip()}".strip()
    return out


def read_config(path: str, overrides: dict | None = None, env: str = "TESSERAE_") -> dict:
    """Configuration of an INI, DCF, JSON or YAML file; environment variables go over the file, overrides over both."""
    text = Path(path).read_text()
    if path.endswith(".json"):
        conf = json.loads(text)
    elif path.endswith((".yaml", ".yml")):
        import yaml

        conf = yaml.safe_load(text) or {}
    elif path.endswith((".ini", ".config", ".cfg")):
        ini = configparser.ConfigParser()
        ini.read_string(text)
        conf = {k: v for s in ini.sections() for k, v in ini[s].items()}
    else:
        conf = parse_dcf(text)
    conf |= {k[len(env) :].lower(): v for k, v in os.environ.items() if k.startswith(env)}
    return conf | {k: v for k, v in (overrides or {}).items() if v is not None}


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """Marker tree of a YAML or JSON file as (level, label, parent, gene); an empty tree is an error."""
    from tesserae.operators.labels import flatten_markers

    rows = flatten_markers(read_config(path, env="\u0000"))
    if not rows:
        raise ValueError(f"no markers in {path}")
    return spark.createDataFrame(rows, "level int, label string, parent string, gene string")


def qc_decisions(spark: SparkSession, datasets: list[str], path: str | None = None, default: str = "mad3") -> DataFrame:
    """Threshold methods of each dataset: from a CSV of six columns, or ``default`` for all; names without a row are
    looked up with ``_singlets``."""
    # fixed values: the columns of a decisions file
    cols = ["Dataset_Name", "Lower_Feature_Method", "Upper_Feature_Method", "Lower_Count_Method", "Upper_Count_Method", "Upper_Mito_Method"]
    if path is None:
        return spark.createDataFrame([(d, *[default] * 5) for d in datasets], ", ".join(f"{c} string" for c in cols))
    t = spark.read.csv(path, header=True)
    if missing := [c for c in cols if c not in t.columns]:
        raise ValueError(f"decisions lack columns {missing}")
    names = spark.createDataFrame([(d,) for d in datasets], "name string")
    by = {c: F.col(f"b.{c}") for c in cols[1:]}
    t1, t2 = t.alias("a"), t.alias("b")
    j = names.join(t1, F.col("name") == F.col("a.Dataset_Name"), "left").join(t2, F.concat("name", F.lit("_singlets")) == F.col("b.Dataset_Name"), "left")
    return j.select(F.col("name").alias(cols[0]), *(F.coalesce(F.col(f"a.{c}"), by[c]).alias(c) for c in cols[1:]))
