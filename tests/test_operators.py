"""Hand-computed edges and properties of the operators."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tesserae.functions import text
from tesserae.operators import components, doublets, harmonize, labels, metrics, neighbors, qc, rates, reports, running, scores, thresholds
from tesserae.plans.stages import Run, Stage, stages_between
from tesserae.plans.workspace import Workspace
from tesserae.sources import tables
from tesserae.streaming import landing

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(df, col):
    return df.first()[col]


def test_mad_zero_is_the_median(spark):
    df = spark.createDataFrame([("a", 5.0)] * 9 + [("a", 100.0), ("b", None)], "g string, v double")
    t = thresholds.mad_threshold(df, ["g"], "v", 3, "upper", False)
    assert [(r["g"], r["threshold"]) for r in t.collect()] == [("a", 5.0)]


def test_mad_lower_is_not_negative_and_grows_with_n(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(50)], "g string, v double")
    low = one(thresholds.mad_threshold(df, ["g"], "v", 5, "lower", False), "threshold")
    up = [one(thresholds.mad_threshold(df, ["g"], "v", n, "upper", True), "threshold") for n in (1, 2, 3)]
    assert low == 0.0 and up == sorted(up)


@pytest.mark.parametrize("bad", ["mad2.5", "", "lower", "manual_x", "MAD3"])
def test_unknown_method_is_an_error(bad):
    with pytest.raises(ValueError):
        thresholds.parse_method(bad)


def test_methods():
    assert thresholds.parse_method(" mad0 ") == thresholds.Method("mad", 3.0)
    assert thresholds.parse_method("manual_-1.5").param == -1.5


def test_few_distinct_values(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 1.0, 2.0, 3.0)], "g string, v double")
    assert one(thresholds.triangle_threshold(df, ["g"], "v", "lower"), "threshold") == 3.0
    assert one(thresholds.triangle_threshold(df, ["g"], "v", "higher"), "threshold") == 1.0
    assert one(thresholds.knee_threshold(df, ["g"], "v"), "threshold") == 1.5
    const = spark.createDataFrame([("a", 2.0)] * 3, "g string, v double")
    assert one(thresholds.triangle_threshold(const, ["g"], "v", "lower"), "threshold") == 2.0
    assert thresholds.knee_threshold(const.limit(0), ["g"], "v").count() == 0


def test_rates_below_on_between_above(spark):
    table = spark.createDataFrame([("v3", 100.0, 0.01), ("v3", 200.0, 0.03), ("v3", 400.0, 0.04)], "chemistry string, cells double, rate double")
    xs = [0.0, 10.0, 100.0, 150.0, 200.0, 400.0, 600.0, 9000.0, None]
    df = spark.createDataFrame([(i, x, "v3") for i, x in enumerate(xs)] + [(99, 5.0, "zz")], "i int, cells double, chemistry string")
    got = {r["i"]: r["rate"] for r in rates.interpolate_rates(df, table).collect()}
    want = [None, 0.0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.30, None]
    for i, w in enumerate(want):
        assert got[i] is None if w is None else math.isclose(got[i], w, abs_tol=1e-12)
    assert got[99] is None


def test_no_zone_without_five_of_each(spark):
    df = spark.createDataFrame([("singlet", 0.1)] * 20 + [("doublet", 0.9)] * 4, "k string, s double")
    r = doublets.overlap_zone(df, "s", "k").first()
    assert (r["lo"], r["hi"], r["n_doublet"]) == (None, None, 4)


def test_status_partition(spark):
    df = spark.range(100).select((F.col("id") / 100).alias("s"), F.when(F.col("id") > 50, "doublet").otherwise("singlet").alias("k"))
    n = {r["doublet_status"]: r["count"] for r in doublets.call_status(df, "s", "k", 0.4, 0.6).groupBy("doublet_status").count().collect()}
    assert n == {"singlet": 40, "ambiguous": 21, "doublet": 39}
    assert {r[0] for r in doublets.call_status(df, "s", "k", None, None).select("doublet_status").distinct().collect()} == {"singlet", "doublet"}


@SLOW
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=20))
def test_components(spark, edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long") if edges else spark.createDataFrame([], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(Workspace(spark, "t"), df, "x").collect()}
    assert got == {x: find(x) for x in root}


def test_harmonize_is_idempotent_and_keeps_sums(spark):
    c = spark.createDataFrame([("c1", "A", 2.0), ("c1", "Z", 9.0), ("c2", "B", 1.0)], "cell string, gene string, count double")
    g = harmonize.gene_space(spark.createDataFrame([("B",), ("A",), ("C",), ("A",), (None,)], "gene string"))
    assert [(r["gene"], r["idx"]) for r in g.orderBy("idx").collect()] == [("A", 0), ("B", 1), ("C", 2)]
    once = harmonize.harmonize(c, g)
    assert one(once.agg(F.sum("count").alias("s")), "s") == 3.0
    assert harmonize.harmonize(once, g).exceptAll(once).count() == 0
    assert harmonize.zero_filled(c, c, g).count() == 6
    with pytest.raises(ValueError):
        harmonize.require_overlap(c, spark.createDataFrame([("Q",)], "gene string"))


def test_requested_gene_is_never_stolen(spark):
    genes = spark.createDataFrame([("EGFP",), ("m-Cherry",)], "gene string")
    want = spark.createDataFrame([("EGFP",), ("eGFP",), ("mCherry",)], "gene string")
    got = {r["requested"]: (r["resolved"], r["how"]) for r in harmonize.resolve_transgenes(genes, want).collect()}
    assert got == {"EGFP": ("EGFP", "exact"), "eGFP": (None, "missing"), "mCherry": ("m-Cherry", "variant")}


def test_all_cells_removed_keeps_the_row(spark):
    df = spark.createDataFrame([("a", 1.0, False), ("b", 2.0, True)], "s string, nCount double, keep boolean")
    got = {r["s"]: (r["cells_raw"], r["cells_filtered"], r["median_nCount_filtered"]) for r in reports.qc_summary(df, "s", ["nCount"]).collect()}
    assert got == {"a": (1, 0, None), "b": (1, 1, 2.0), "TOTAL": (2, 1, None)}


def test_canonical_names(spark):
    df = spark.createDataFrame([("X_harmonized_singlets",), ("x",)], "n string").select(text.canonical_sample(F.col("n")).alias("n"))
    assert [r["n"] for r in df.collect()] == ["x", "x"]


def test_functions(spark):
    r = spark.range(1).select(
        text.parse_bool(F.lit(" Yes ")).alias("yes"), text.parse_bool(F.lit(None).cast("string"), True).alias("default"), text.bare_barcode(F.lit("a_b_ACGT-1")).alias("bare"),
        text.or_unknown(F.lit("  ")).alias("unknown"), text.plot_title(F.lit("Level_2_res_0.6")).alias("title"), text.study_short_name(F.lit("study_A_filtered")).alias("short"), text.clip01(F.lit(7.0)).alias("clip"),
        text.parse_number(F.lit("x"), 2.0).alias("number"), F.length(text.params_digest(F.lit(1).alias("a"))).alias("n"), F.size(text.first_dims(F.array(*map(F.lit, range(40))))).alias("dims"),
    ).first()
    assert tuple(r) == (True, True, "ACGT", "Unknown", "Level 2 (resolution 0.6)", "a", 1.0, 2.0, 64, 30)


def test_tiers(spark):
    cells = spark.createDataFrame([("A-1",), ("B-1",), ("C-1",)], "barcode string")
    right = spark.createDataFrame([("A", "x"), ("A", "w"), ("B", "y"), (None, "z")], "barcode string, label string")
    got = sorted(tuple(r) for r in labels.tiered_match(cells, right).collect())
    assert [(b, x) for b, x, _ in got if x] == [("A-1", "w"), ("B-1", "y")] and {t for *_, t in got} == {1}


def test_ari_properties(spark):
    df = spark.range(60).select((F.col("id") % 3).alias("a"), (F.col("id") % 3 + 7).alias("b"), (F.col("id") % 4).alias("c"))
    assert math.isclose(one(scores.adjusted_rand(df, "a", "b"), "ari"), 1.0)
    assert math.isclose(one(scores.adjusted_rand(df, "a", "c"), "ari"), one(scores.adjusted_rand(df, "c", "a"), "ari"))
    assert math.isclose(one(scores.mutual_information(df, "a", "b"), "nmi"), 1.0)


def test_knn_ties_and_blocks(spark):
    pts = spark.createDataFrame([(i, [float(i // 2), 0.0]) for i in range(30)], "id long, vec array<double>")
    small = neighbors.knn(pts, pts, 3, include_self=False, q_block=7, a_block=5)
    big = neighbors.knn(pts, pts, 3, include_self=False)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    first = {r["query"]: r["neighbour"] for r in big.where("rank = 1").collect()}
    assert first[4] == 5 and first[5] == 4
    assert neighbors.knn(pts.limit(0), pts, 3).count() == 0 and neighbors.knn(pts, pts, 100).count() == 900


def test_silhouette_of_one_cluster_is_empty(spark):
    pts = spark.createDataFrame([(i, [float(i)], "a") for i in range(5)], "id long, vec array<double>, label string")
    assert neighbors.silhouettes(pts).count() == 0


def test_lisi_bounds(spark):
    pts = spark.createDataFrame([(i, [float(i)], str(i % 2)) for i in range(20)], "id long, vec array<double>, label string")
    r = neighbors.lisi(neighbors.knn(pts, pts, 4), pts).first()
    assert 0 <= r["ilisi"] <= 1 and math.isclose(r["ilisi"] + r["clisi"], 1)


def test_metrics_without_genes_of_the_set(spark):
    c = spark.createDataFrame([("c", "A", 1.0), ("d", "MT-1", 3.0), ("d", "mt-2", 1.0)], "cell string, gene string, count double")
    got = {r["cell"]: (r["nCount"], r["nFeature"], r["mito"]) for r in metrics.cell_metrics(c, sets={"mito": F.col("gene").rlike(metrics.MITO)}).collect()}
    assert got == {"c": (1.0, 1, 0.0), "d": (4.0, 2, 100.0)}


HEAD = "data_path,sample_id,study,source,diff_protocol,sc_protocol,sequencing,genome_build,Age,type,skip,disease"


def test_manifest(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text(HEAD.replace(",", " ;") + "\nx;s1;st;;;;;;;;;flu\ny;s2;st;;;;;;;;TRUE;\n")
    m = tables.read_manifest(spark, str(p))
    assert [(r["sample_id"], r["disease"], r["row"]) for r in m.collect()] == [("s1", "flu", 2)]
    p.write_text(HEAD + "\nx,s1, ,,,,,,,,,\nx,s1,st,,,,,,,,,\n")
    with pytest.raises(ValueError, match="duplicate sample_id"):
        tables.read_manifest(spark, str(p))
    p.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="lacks columns"):
        tables.read_manifest(spark, str(p))


def test_gtf(spark, tmp_path):
    rows = [("gene", 'gene_id "g1"; gene_name "AAA"; gene_biotype "protein_coding";'), ("gene", 'gene_name "BBB"; gene_biotype "pseudogene";'), ("transcript", 'gene_name "CCC"; gene_biotype "lncRNA";'), ("gene", 'gene_id "x"; gene_biotype "lncRNA"; gene_name "DDD"'), ("gene", 'gene_biotype "lncRNA";')]
    p = tmp_path / "g.gtf"
    p.write_text("#!x\n" + "".join(f"1\ts\t{k}\t1\t2\t.\t+\t.\t{a}\n" for k, a in rows))
    assert sorted(r["gene"] for r in tables.read_genes(spark, str(p)).collect()) == ["AAA", "DDD"]


def test_mtx_round_trip(spark, tmp_path):
    c = spark.createDataFrame([("c1", "A", 2.0), ("c2", "B", 1.0), ("c2", "A", 3.0)], "cell string, gene string, count double")
    tables.write_mtx(c, str(tmp_path / "m"))
    back = tables.read_mtx(spark, str(tmp_path / "m"), "s")
    assert sorted((r["cell"], r["gene"], r["count"]) for r in back.collect()) == [("c1", "A", 2.0), ("c2", "A", 3.0), ("c2", "B", 1.0)]


@pytest.mark.parametrize("entries", ["3", "16777217", "4294967297"])
def test_mtx_of_ordinary_files(spark, tmp_path, entries):
    (tmp_path / "matrix.mtx").write_text(f"%%MatrixMarket matrix coordinate integer general\n% a comment\n2 2 {entries}\n1 1 5\n2  2\t7\n2 2 {entries}\n")
    (tmp_path / "barcodes.tsv").write_text("c1\nc2\n")
    (tmp_path / "features.tsv").write_text("g1\tA\ng2\tB\n")
    back = tables.read_mtx(spark, str(tmp_path), "s").collect()
    assert sorted((r["cell"], r["gene"], r["count"]) for r in back) == sorted([("c1", "A", 5.0), ("c2", "B", 7.0), ("c2", "B", float(__import__("numpy").float32(entries)))])
    (tmp_path / "matrix.mtx").write_text("%only comments\n")
    with pytest.raises(ValueError):
        tables.read_mtx(spark, str(tmp_path), "s")


def test_readers_and_writers(spark, tmp_path):
    c = spark.createDataFrame([("x", "s1", "c1", "A", 2.0), ("x", "s1", "c2", "B", 1.0), ("y", "s2", "c1", "A", 3.0)], "study string, sample_id string, cell string, gene string, count double")
    tables.write_counts(c, str(tmp_path / "counts"))
    back = spark.read.parquet(str(tmp_path / "counts")).select(c.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, c.collect()))
    c.drop("study").where("sample_id = 's1'").write.parquet(str(tmp_path / "a.parquet"))
    tables.write_mtx(c.where("sample_id = 's2'"), str(tmp_path / "m"))
    manifest = spark.createDataFrame([("s1", "a.parquet"), ("s2", "m")], "sample_id string, data_path string")
    got = sorted((r["sample_id"], r["cell"], r["gene"], r["count"]) for r in tables.read_samples(spark, manifest, str(tmp_path)).collect())
    assert got == [("s1", "c1", "A", 2.0), ("s1", "c2", "B", 1.0), ("s2", "c1", "A", 3.0)]
    with pytest.raises(ValueError):
        tables.read_samples(spark, spark.createDataFrame([("s", "x.h5ad")], "sample_id string, data_path string"))
    v = spark.createDataFrame([("c1", [1.0, 2.0, 3.0])], "cell_id string, vec array<double>")
    tables.write_embeddings(v, str(tmp_path / "e"), dims=2)
    assert spark.read.csv(str(tmp_path / "e"), header=True).collect()[0].asDict() == {"cell_id": "c1", "dim_1": "1.0", "dim_2": "2.0"}
    head = "Dataset_Name,Lower_Feature_Method,Upper_Feature_Method,Lower_Count_Method,Upper_Count_Method,Upper_Mito_Method\n"
    (tmp_path / "q.csv").write_text(head + "a,mad3,mad3,none,knee,mad5\nb_singlets,renyi,mad3,none,knee,mad5\n")
    got = {r["Dataset_Name"]: r["Lower_Feature_Method"] for r in tables.qc_decisions(spark, ["a", "b", "c"], str(tmp_path / "q.csv")).collect()}
    assert got == {"a": "mad3", "b": "renyi", "c": None}
    for content in (None, "", head):
        if content is not None:
            (tmp_path / "t.csv").write_text(content)
        assert tables.read_table(spark, str(tmp_path / "t.csv"), "a string, b int").count() == 0


def test_running_sums_over_ranges(spark):
    import random

    rng = random.Random(2)
    rows = [(rng.choice("ab") if i % 7 else None, i, rng.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, w int").orderBy(F.rand(3))
    got = {r["i"]: r["below"] for r in running.sum_below(df, ["g"], F.col("i"), F.col("w")).collect()}
    assert got == {i: sum(w for h, j, w in rows if h == g and j < i) for g, i, _ in rows}
    assert sorted((r["i"], r["n"]) for r in running.numbered(df.select("i"), "i", "n").collect()) == [(i, i + 1) for i in range(500)]
    assert running.numbered(df.select("i").limit(0), "i", "n").count() == 0


def test_silhouettes_in_blocks(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x, lab = rng.normal(size=(60, 3)), rng.integers(0, 3, 60)
    lab[0] = 9
    pts = spark.createDataFrame([(i, [float(y) for y in x[i]], int(lab[i]), i % 2) for i in range(60)], "id long, vec array<double>, label int, half int")
    got = {r["id"]: r["silhouette"] for r in neighbors.silhouettes(pts, block=7).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))

    def plain(i, among):
        own = [j for j in among if lab[j] == lab[i] and j != i]
        b = min(d[i][[j for j in among if lab[j] == z]].mean() for z in set(lab[among]) - {lab[i]})
        return (b - d[i][own].mean()) / max(b, d[i][own].mean()) if own else 0.0

    assert got.keys() == set(range(60)) and all(math.isclose(got[i], plain(i, np.arange(60)), abs_tol=1e-9) for i in got)
    half = {r["id"]: r["silhouette"] for r in neighbors.silhouettes(pts, by="half", block=7).collect()}
    assert all(math.isclose(half[i], plain(i, np.arange(i % 2, 60, 2)), abs_tol=1e-9) for i in half)
    assert neighbors.silhouettes(pts, sample=10).count() <= 10 and 0 <= one(neighbors.batch_asw(pts, "label", "half"), "asw_batch") <= 1


def test_doublet_scores_of_a_whole_batch(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(60, 4)), rng.normal(size=(60, 4)) + 20
    mixed = (a[:10] + b[:10]) / 2
    rows = [("s", f"c{i}", [float(y) for y in v]) for i, v in enumerate([*a, *b, *mixed])] + [("t", "only", [0.0] * 4)]
    latent = spark.createDataFrame(rows, "batch string, cell_id string, vec array<double>")
    out = {(r["batch"], r["cell_id"]): r for r in doublets.score_doublets(latent, "batch", 0.1, k=8).collect()}
    assert len(out) == 131 and np.mean([out["s", f"c{i}"]["score"] for i in range(120, 130)]) > np.mean([out["s", f"c{i}"]["score"] for i in range(120)]) + 0.3
    assert sum(r["class"] == "doublet" for r in out.values()) <= 14


def test_label_hierarchy(spark):
    markers = spark.createDataFrame([(1, "A", None, "a"), (1, "B", None, "b"), (2, "A1", "A", "x"), (2, "A2", "A", "y"), (2, "B1", "B", "x")], "level int, label string, parent string, gene string")
    cells = spark.createDataFrame([(i, i // 10) for i in range(30)], "cell int, cluster int")
    rows = [(i, g, 5.0) for i in range(30) for g in {0: "ax", 1: "ay", 2: "b"}[i // 10]]
    counts = spark.createDataFrame(rows, "cell int, gene string, value double")
    got = {r["cluster"]: (r["level_1"], r["level_2"], r["level_3"]) for r in scores.label_hierarchy(counts, cells, markers).collect()}
    assert got == {0: ("A", "A1", None), 1: ("A", "A2", None), 2: ("B", "B1", None)}


def test_qc_filters(spark):
    cells = spark.createDataFrame([(i, "s", float(100 + i), i % 60, 1.0) for i in range(100)] + [(200, "s", 1e6, 55, 90.0), (201, "u", 0.0, 0, 0.0)], "cell int, sample string, nCount double, nFeature int, pct_mito double")
    assert qc.drop_ghosts(cells).count() == cells.where("nCount > 100 and nFeature > 50").count() and qc.drop_empty(cells).count() == cells.where("nCount > 0 and nFeature > 0").count()
    bounds = qc.raise_floors(qc.mad_bounds(cells.where("sample = 's'"), "sample", {"nCount": True, "nFeature": False, "pct_mito": False}), {"nFeature": 20.0, "nCount": 0.0})
    r = bounds.first()
    assert r["lo_nFeature"] >= 20 and r["lo_pct_mito"] == r["hi_pct_mito"] == 1.0
    kept = qc.mark_kept(cells, bounds, "sample")
    assert not any(x["keep"] for x in kept.where("cell >= 200 or nFeature < 20").collect()) and kept.where("keep").count() > 50


def test_configurations(spark, tmp_path, monkeypatch):
    assert tables.parse_dcf("# c\na: 1\n  more\nb:2\n") == {"a": "1\nmore", "b": "2"}
    p = tmp_path / "c.ini"
    p.write_text("[x]\nk = 1\nz = 0\n")
    monkeypatch.setenv("TESSERAE_K", "2")
    assert tables.read_config(str(p), {"z": 0, "n": None}) == {"k": "2", "z": 0}
    m = tmp_path / "m.json"
    m.write_text('{"N": {"marker_genes": ["A"], "subtypes": {"E": {"marker_genes": ["B", "C"]}}}, "note": null}')
    assert sorted(map(tuple, tables.read_markers(spark, str(m)).collect()), key=str) == [(1, "N", None, "A"), (2, "E", "N", "B"), (2, "E", "N", "C")]
    assert tables.read_table(spark, str(tmp_path / "no.csv"), "a string").count() == 0
    assert tables.qc_decisions(spark, ["d"]).first()["Upper_Mito_Method"] == "mad3"


def test_runs_resume_by_digest(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    def broken():
        raise RuntimeError("no")

    r = Run(spark, str(tmp_path))
    assert r.unit("qc", "S1", {"n": 3}, make).count() == 3 and r.unit("qc", "S1", {"n": 3}, make).count() == 3
    assert len(made) == 1 and not r.complete("qc", "S1", {"n": 4}) and not r.complete("qc", "S10", {"n": 3})
    assert r.unit("qc", "S2", {}, broken) is None and r.exit_code == 1
    assert [x[2] for x in r.status] == ["done", "skipped", "failed"] and r.report().count() == 3
    assert Run(spark, str(tmp_path), dry_run=True).unit("qc", "S9", {}, make) is None
    assert stages_between("qc", "integrate") == (Stage.QC, Stage.ANNOTATE, Stage.INTEGRATE)
    assert Stage.PROJECT in stages_between("qc", "project")


def test_landing_stream(spark, tmp_path):
    src = spark.createDataFrame([("s", "c1", "A", 2.0), ("s", "c1", "B", 1.0), ("t", "c1", "A", 5.0)], landing.COUNTS)
    src.write.parquet(str(tmp_path / "in"))
    q = landing.keep_metrics(landing.landed_counts(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["sample_id"], r["nCount"]) for r in got.collect()) == [("s", 3.0), ("t", 5.0)]
