"""The stage graph, what stages write, and small readers and parsers."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tesserae.functions import text
from tesserae.operators import harmonize, neighbors, reports, selection
from tesserae.plans.stages import Run, Stage, needs_label_refresh, validate
from tesserae.sources import outputs, tables


def frame(spark, n=1):
    return lambda: spark.range(n).withColumnRenamed("id", "x")


def test_a_change_upstream_makes_later_units_stale(spark, tmp_path):
    def go(a, b):
        r = Run(spark, str(tmp_path))
        r.unit("harmonize", "s", {"a": a}, frame(spark, a))
        r.unit("qc", "s", {"b": b}, frame(spark, b), after=[("harmonize", "s")])
        r.unit("annotate", "s", {}, frame(spark), after=[("qc", "s")])
        return [s[2] for s in r.status]

    assert go(1, 1) == ["done"] * 3 and go(1, 1) == ["skipped"] * 3
    assert go(1, 2) == ["skipped", "done", "done"]
    assert go(2, 2) == ["done"] * 3 and go(2, 2) == ["skipped"] * 3
    assert go(1, 2) == ["done"] * 3  # the marks of earlier parameters are gone
    r = Run(spark, str(tmp_path), dry_run=True)
    r.unit("harmonize", "s", {"a": 9}, frame(spark))
    r.unit("qc", "s", {"b": 2}, frame(spark), after=[("harmonize", "s")])
    assert [s[2] for s in r.status] == ["planned", "planned"]


def test_a_run_stops_at_a_failed_stage(spark, tmp_path):
    seen = []

    def fail():
        raise ValueError("broken input")

    def qc(r):
        r.unit("qc", "good", {}, frame(spark))
        r.unit("qc", "bad", {}, fail)
        r.unit("qc", "child", {}, frame(spark), after=[("qc", "bad")])

    r = Run(spark, str(tmp_path))
    assert not r.stages({"qc": qc, "annotate": lambda r: seen.append(1)}) and not seen and r.exit_code == 1
    assert {s[1]: s[2] for s in r.status} == {"good": "done", "bad": "failed", "child": "blocked"}
    assert r.remove("qc") == []  # nothing goes after a failure
    r = Run(spark, str(tmp_path))
    assert r.stages({"qc": lambda r: r.unit("qc", "good", {}, frame(spark)), "annotate": lambda r: seen.append(1)}) and seen == [1]
    r.unit("qc", "more", {}, frame(spark))
    assert r.remove("qc", keep=["more"]) == ["good"]
    assert [x.name for x in (tmp_path / "qc").iterdir() if x.is_dir()] == ["unit=more"] and r.complete("qc", "more", {}) and not r.complete("qc", "good", {})
    assert not Run(spark, str(tmp_path)).stages({"x": lambda r: fail()})


def test_label_refresh_and_validation(tmp_path):
    assert needs_label_refresh(["Level_1"], True) and not needs_label_refresh(["Level_3"], True)
    assert not needs_label_refresh(None, True) and not needs_label_refresh([], False)
    with pytest.raises(ValueError, match="gtf_file, output_root"):
        validate({"sample_info_csv": "x", "gtf_file": " "}, [Stage.QC], lambda p: True)
    good = {"sample_info_csv": "a", "gtf_file": "b", "output_root": "c"}
    validate(good, [Stage.QC], lambda p: True)
    with pytest.raises(FileNotFoundError, match="gtf_file"):
        validate(good, [Stage.QC], lambda p: p != "b")
    with pytest.raises(ValueError, match="projection_atlas_h5ad, projection_model_dir"):
        validate(good, [Stage.PROJECT], lambda p: True)


def read(spark, path, sep=","):
    return [tuple(r) for r in spark.read.csv(str(path), header=True, sep=sep).collect()]


def test_tables_of_annotation_and_benchmark(spark, tmp_path):
    a = spark.createDataFrame([("B", "0.6", "1"), ("A", "0.4", "0")], "level_1 string, resolution string, cluster string")
    outputs.write_annotation(spark.range(3), a, str(tmp_path))
    assert read(spark, tmp_path / "assignments") == [("0.4", "0", "A"), ("0.6", "1", "B")] and spark.read.parquet(str(tmp_path / "annotated")).count() == 3
    s = spark.createDataFrame([(0.4, 0.2, 5), (1.0, 0.3, 9)], "resolution double, silhouette double, n_clusters int")
    outputs.write_resolutions(s, s.where("resolution = 1.0"), str(tmp_path))
    assert read(spark, tmp_path / "resolution_summary") == [("0.4", "0.2", "5", "false"), ("1.0", "0.3", "9", "true")]
    assert read(spark, tmp_path / "silhouette_scores") == [("0.4", "0.2"), ("1.0", "0.3")]
    m = spark.createDataFrame([("unintegrated", 0.9), ("rpca", 0.7), ("cca", 0.7), ("x", float("nan"))], "method string, overall double")
    assert outputs.write_metrics(m, str(tmp_path)) == "cca" and outputs.read_text(spark, f"{tmp_path}/best_method.txt") == "cca\t0.7000\n"
    assert outputs.write_metrics(m.where("method = 'unintegrated'"), str(tmp_path / "none")) is None
    assert len(read(spark, tmp_path / "scib_raw_metrics")) == 4


def test_markers_round_trip(spark, tmp_path):
    tree = {"Nephron": {"marker_genes": ["B", "A"], "subtypes": {"Podocyte": {"marker_genes": ["NPHS1"], "subtypes": {}}}}, "Stroma": {"marker_genes": ["C"]}}
    (tmp_path / "in.json").write_text(json.dumps(tree))
    m = tables.read_markers(spark, str(tmp_path / "in.json"))
    outputs.export_markers(m, str(tmp_path / "out.json"))
    assert sorted(map(str, tables.read_markers(spark, str(tmp_path / "out.json")).collect())) == sorted(map(str, m.collect()))


def test_tables_of_projection(spark, tmp_path):
    c = spark.createDataFrame([(1, "s", "P", 0.1, "X"), (2, "s", "Q", 0.2, "X"), (3, "t", "Q", 0.3, None)], "cell long, sample_id string, Level_3_pred string, Level_3_uncert double, Level_2_pred string")
    outputs.write_predictions(c, str(tmp_path), "q")
    assert sorted(read(spark, tmp_path / "query_predictions_q", "\t"))[0] == ("1", "s", "P", "0.1", "X")
    assert read(spark, tmp_path / "query_Level2_composition_q", "\t") == [("X", "2")]
    stats = reports.similarity_stats(spark.createDataFrame([(0.2,), (0.9,)], "similarity double"), "similarity")
    got = outputs.write_projection_summary(spark, stats, str(tmp_path), "q", {"n_query_cells": 2})
    assert json.loads(outputs.read_text(spark, f"{tmp_path}/projection_summary.json")) == got and got["n_query_cells"] == 2
    assert json.loads(outputs.read_text(spark, f"{tmp_path}/atlas_query_similarity_summary_q.json")) == got["similarity"]
    outputs.write_maps(spark.createDataFrame([("b", "x"), ("a", "y")], "source string, target string"), spark.createDataFrame([("p", "l")], "prototype string, label string"), str(tmp_path))
    assert read(spark, tmp_path / "majority_map", "\t") == [("a", "y"), ("b", "x")]
    assert [tuple(r) for r in tables.read_bridge(spark, str(tmp_path / "prototype_map")).collect()] == [("p", "l")]
    outputs.write_benchmark_inputs(c, ["sample_id", "absent"], str(tmp_path / "meta"), "cell")
    assert sorted(read(spark, tmp_path / "meta")) == [("1", "s"), ("2", "s"), ("3", "t")]


def test_prepared_manifest_keeps_the_rest(spark):
    m = spark.createDataFrame([("d/a.h5", "a", "S", "x", "true"), ("d/b", "b", "S", "y", "false")], "data_path string, sample_id string, study string, extra string, run_cellbender string")
    out = outputs.prepared_manifest(m, m.where("sample_id = 'a'"), "_c.h5")
    assert sorted((r["data_path"], r["extra"], r["Age"]) for r in out.collect()) == [("d/a_c.h5", "x", ""), ("d/b", "y", "")]
    assert "run_cellbender" not in out.columns and set(outputs.MANDATORY) <= set(out.columns)
    again = out.select("sample_id", F.col("data_path"))
    assert outputs.prepared_manifest(m, again.limit(0), "_c.h5").where("data_path like '%_c.h5'").count() == 0


def test_parsers():
    assert text.parse_resolutions("0.4; 0.6,1") == [0.4, 0.6, 1.0] and text.parse_resolutions(None) == [0.4, 0.6, 1.0] and text.parse_resolutions(2) == [2.0] and text.parse_resolutions([1]) == [1.0]
    with pytest.raises(ValueError, match="no resolutions"):
        text.parse_resolutions(" , ")
    assert text.parse_dims("1:4") == [1, 2, 3, 4] and text.parse_dims("3:2") == [3, 2] and text.parse_dims("1, 5") == [1, 5] and text.parse_dims(7) == [7]
    with pytest.raises(ValueError, match="invalid dimensions"):
        text.parse_dims("1:2:3")
    assert text.parse_list(" a, b ") == ["a", "b"] and text.parse_list(" ") == text.parse_list(None) == []


def test_small_readers(spark, tmp_path):
    (tmp_path / "names.txt").write_text("b\n# all\na # first\n\nb\n")
    assert tables.read_sample_list(spark, str(tmp_path / "names.txt")) == ["b", "a"]
    cols = harmonize.obs_columns(["extra", "study", "skip", "data_path"])
    assert cols[0] == "sample_id" and cols[-1] == "extra" and "skip" not in cols and "data_path" not in cols
    placed = spark.createDataFrame([(0.5,), (0.1,)], "similarity double")
    assert neighbors.require_similarity(placed) == pytest.approx(0.3)
    with pytest.raises(ValueError, match="below 0.9"):
        neighbors.require_similarity(placed, 0.9)
    assert spark.range(1).select(text.stamp(F.lit(datetime(2024, 1, 31, 23, 59, 58)))).first()[0] == "20240131_235958"


def test_selections_of_awkward_names(spark):
    names = spark.createDataFrame([("egfp",), (" EGFP ",), ("",), (None,), ("nope",)], "gene string")
    have = spark.createDataFrame([("eGFP",), ("EGFP",), (None,)], "gene string")
    assert {tuple(r) for r in selection.match_features(names, have).collect()} == {("egfp", "EGFP"), ("EGFP", "EGFP")}
    studies = spark.createDataFrame([("a",), ("ab",), ("z",)], "study string")
    files = spark.createDataFrame([("p/ab_1_x.h",), ("p/ab_0_x.h",), ("p/a_x.h",), ("p/a_x.txt",)], "path string")
    assert {tuple(r) for r in selection.first_artefact(studies, files, "_x.h").collect()} == {("a", "p/a_x.h"), ("ab", "p/ab_0_x.h"), ("z", None)}
    assert selection.latest_by_name(files, "nothing").count() == 0
