import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from scquarry.operators import checks, frames
from scquarry.plans import pipeline


@pytest.fixture(scope="module")
def data(spark):
    """240 cells of two kinds in four samples and two batches; three bad cells; one small library."""
    r = np.random.default_rng(11)
    x = r.poisson(0.8, (240, 150)).astype(float)
    kind = np.arange(240) // 8 % 2
    x[kind == 0, :30] += r.poisson(3, ((kind == 0).sum(), 30))
    x[kind == 1, 30:60] += r.poisson(3, ((kind == 1).sum(), 30))
    x[:3] = 0
    x[:3, 0] = 1
    counts = spark.createDataFrame([(f"c{i:03d}", f"g{j:03d}", float(x[i, j])) for i, j in zip(*x.nonzero())], "cell_id string, gene_id string, value double")
    lib = lambda i: "small" if i >= 230 else f"L{i % 2}"
    cells = spark.createDataFrame([(f"c{i:03d}", f"S{i % 4}", "T" if i % 4 < 2 else "N", lib(i), str(kind[i]), f"B{i // 4 % 2}") for i in range(240)], "cell_id string, sample string, grp string, library_id string, cluster string, batch string")
    genes = spark.createDataFrame([(f"g{j:03d}", j % 10 == 9, False, j % 17 == 3) for j in range(150)], "gene_id string, mt boolean, hb boolean, rp boolean")
    return counts, cells, genes


def test_workflows(spark, data):
    counts, cells, genes = data
    s = pipeline.Settings(thresholds={"nfeature_min": 10, "nfeature_max": 140, "ncount_min": 50, "ncount_max": 1000, "pmt_max": 60, "phb_max": 10, "prp_max": 60}, doublet_min_cells=40, variable_genes=60, max_pcs=10, resolutions=(0.3, 0.8))
    qc = pipeline.quality_control(counts, cells, genes, {"pmt": "mt", "phb": "hb", "prp": "rp"}, s, kept_samples=("S2",))
    assert qc["cells"].filter("NOT retained").count() == 3
    final = qc["final_cells"].toPandas()
    assert set(final[final["df_adj"] == "NotEvaluated"]["sample"]) == {"S2"} and (final["df_adj"] != "Doublet").all()
    d = qc["doublets"].agg(F.sum("df_doublets"), F.sum("df_adj_doublets"), F.sum("input_cells")).first()
    assert d[2] == 237 and 0 < d[1] <= d[0]
    assert qc["corrected"].count() == qc["counts"].count()
    assert qc["contamination"].agg(F.sum("cells")).first()[0] == len(final)
    f = pipeline.formal_analysis(qc["counts"], qc["final_cells"], "batch", s)
    n = len(final)
    assert f["scores"].count() == f["representation"].count() == n
    assert rows(checks.embedding_violations(f["scores"], qc["final_cells"], 10)) == sorted([(r, 0) for r in ("LENGTH", "NOT_FINITE", "REPEATED", "CELL_WITHOUT_VECTOR", "UNKNOWN_CELL")], key=repr)
    assert {r[1] for r in rows(checks.clustering_violations(f["clusters"], qc["final_cells"], [0.3, 0.8]))} == {0}
    assert f["design"].filter("field = 'batch'").first()["decision"] == "ELIGIBLE"
    assert f["layout"].count() == f["layout_before"].count() == n and f["mixing_before"].count() == f["mixing"].count() == 3
    truth = f["clusters"].filter("resolution = 0.3").join(qc["final_cells"].select("cell_id", F.col("cluster").alias("kind")), "cell_id").groupBy("cluster", "kind").count()
    assert truth.groupBy("cluster").agg(F.max("count").alias("m")).agg(F.sum("m")).first()[0] >= 0.97 * n
    again = pipeline.regression_review(qc["counts"], qc["final_cells"], f, "ncount", 0.3, s).first()
    assert again["recommendation"] in ("SIMILAR_RESULTS", "BASELINE_PREFERRED", "USER_REVIEW_REQUIRED")
    assert pipeline.regression_review(qc["counts"], qc["final_cells"], f, "absent", 0.3, s).first()["status"] == "SKIPPED_MISSING_METADATA"


def test_other_kernels_and_an_observer(spark, data):
    counts, cells, genes = data
    s = pipeline.Settings(thresholds={"nfeature_min": 10, "nfeature_max": 140, "ncount_min": 50, "ncount_max": 1000, "pmt_max": 60, "phb_max": 10, "prp_max": 60}, doublet_min_cells=40)
    seen = []
    score = lambda kept, lib, min_cells, seed: lib.select("library_id", "cell_id", F.length("cell_id").cast("double").alias("pann"), F.lit(0.1).alias("pk"))
    correct = lambda kept, c: kept.select("cell_id", "gene_id", (F.col("value") / 2).alias("value"), F.lit(0.5).alias("contamination"))
    qc = pipeline.quality_control(counts, cells, genes, {"pmt": "mt", "phb": "hb", "prp": "rp"}, s, score_doublets=score, correct=correct, observe=lambda name, df: seen.append((name, df.count())))
    assert [n for n, _ in seen] == ["flagged", "called", "corrected"] and seen[0][1] == 240
    one = qc["contamination"].agg(F.sum("original_umi"), F.sum("corrected_umi")).first()
    assert one[1] == one[0] / 2


def test_frames(spark):
    points = spark.createDataFrame([("a", 0.0, 0.0), ("b", 10.0, 2.0)], "cell_id string, x double, y double")
    assert tuple(frames.limits(points).first()) == pytest.approx((-0.3, 10.3, -0.06, 2.06))
    cells = spark.createDataFrame([("a", "S", "Doublet", 3.0), ("b", "S", "Singlet", None)], "cell_id string, sample string, df string, pmt double")
    assert rows(frames.panel(points, cells, "df", "Doublet").select("cell_id", "drawn")) == [("a", 1), ("b", 0)]
    assert rows(frames.subset_panel(points, cells.filter("df = 'Singlet'"))) == [("b", 10.0, 2.0)]
    assert rows(frames.violins(cells)) == [("S", "pmt", 0, 3.0, "before"), ("S", "pmt", 0, None, "before")]
    assert frames.pages([str(i) for i in range(10)]) == [[str(i) for i in range(9)], ["9"]] and frames.point_size(500) > frames.point_size(10**6)
    e = frames.elbow(spark.createDataFrame([(1, 3.0), (2, 1.0)], "pc int, stdev double"), 1).orderBy("pc").collect()
    assert [r["cumulative_sd_share"] for r in e] == [75.0, 100.0] and [r["variance_explained"] for r in e] == [90.0, 10.0] and [r["selected"] for r in e] == [True, False]


def test_checks(spark):
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [1.0]), ("z", [float("nan"), 1.0])], "cell_id string, vec array<double>")
    c = spark.createDataFrame([("a",), ("b",)], "cell_id string")
    assert dict(rows(checks.embedding_violations(v, c, 2))) == {"LENGTH": 1, "NOT_FINITE": 1, "REPEATED": 1, "CELL_WITHOUT_VECTOR": 1, "UNKNOWN_CELL": 1}
    a = spark.createDataFrame([("a", 0.5, "0"), ("a", 0.5, "1"), ("b", 0.9, " ")], "cell_id string, resolution double, cluster string")
    assert dict(rows(checks.clustering_violations(a, c, [0.5]))) == {"MISSING": 1, "REPEATED": 1, "BLANK": 1, "UNKNOWN_RESOLUTION": 1}
    x = spark.createDataFrame([(1, 2, 3, 4)], "`RNA_snn_res.1` int, seurat_clusters int, `cluster_res.0.2` int, pmt int")
    assert checks.drop_derived(x).columns == ["pmt"]
    assert set(checks.compact({"umap": c, "alias": c, "other": v}, ["alias", "other"])) == {"umap", "other"}
    m = spark.createDataFrame([("S1_a", "S1", "P1"), ("S1_a", "S1", "P1"), ("b", "S1", "P1"), ("S2_c", "S2", "P1"), ("S3_d", "S3", "P9")], "Cell string, sample string, patient string")
    known = spark.createDataFrame([("S1", "P1"), ("S2", "P2")], "sample string, patient string")
    assert rows(checks.pooled_metadata_problems(m, known)) == [("PATIENT_DIFFERS", "S2_c"), ("PREFIX", "b"), ("REPEATED_CELL", "S1_a"), ("UNKNOWN_SAMPLE", "S3")]
    assert checks.merge_config({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 5}}) == {"a": {"b": 5, "c": 2}, "d": 3}
    with pytest.raises(ValueError):
        checks.merge_config({"a": 1}, {"z": 1})
    assert checks.missing_packages(["json", "no_such_package_"]) == ["no_such_package_"] and checks.missing_packages(["x"], lambda n: True) == []
    assert checks.evidence_files(["a.csv", "cell_QC_all.csv", "metadata.csv", "b.txt"]) == ["a.csv"]
