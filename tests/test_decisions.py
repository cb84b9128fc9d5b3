"""Settings, decisions, small files, the precheck and checkpoints."""

import csv
import gzip
import json

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from scquarry.kernels import layout
from scquarry.operators import checks, matrix, precheck, review, settings
from scquarry.sources import files

CONFIG = {
    "seed": 1, "nfeatures": 2000, "max_pcs": 50, "risk_correlation": 0.5, "pc_cumulative_variance": 90, "pc_individual_variance": 5, "pc_elbow_drop": 0.1, "assay": "RNA", "sensitivity": ["rna_total"],
    "regression_review": {"cluster_eta_warning": 0.5, "similar_ari": 0.9, "similar_subspace": 0.9, "association_tolerance": 0.05, "auto_numeric": True, "comparison_resolution": 0.4},
    "resolutions": [0.8, 0.2], "cluster_reduction": "auto", "harmony": {"enabled": True, "allow_sample": True, "batch_field": "sample", "technical_fields": []},
}


def test_analysis_config():
    got = settings.analysis_config(CONFIG)
    assert got["resolutions"] == [0.2, 0.8] and got["sensitivity"] == ["count"]
    bad = [
        {"seed": -1}, {"nfeatures": 2.5}, {"max_pcs": True}, {"risk_correlation": 1.1}, {"pc_elbow_drop": 101}, {"assay": ""}, {"sensitivity": ["x"]}, {"regression_review": {}}, {"resolutions": [0.2]}, {"resolutions": [0.2, 0.2]},
        {"resolutions": [0.2, -1]}, {"cluster_reduction": "x"}, {"regression_decision": {"scheme": "count", "confirmed_by": "user", "user_statement": " "}}, {"harmony": {"enabled": 1}}, {"harmony": {**CONFIG["harmony"], "batch_field": "group"}},
    ]
    for b in bad:
        with pytest.raises(ValueError):
            settings.analysis_config({**CONFIG, **b})
    assert settings.ambient_thresholds({"p95_warning": 0.9})["p95_warning"] == 0.9
    with pytest.raises(ValueError):
        settings.ambient_thresholds({"p95_warning": 1.9})


def test_decisions():
    d = {"confirmed_by": "user", "user_statement": "yes", "decision_type": ["remove_low_cell_samples"], "affected_samples": ["A"], "removed_samples": ["A"]}
    assert settings.qc_decision(None, ["A"]) == {} and settings.qc_decision(d, ["A", "B"])["removed_samples"] == ["A"]
    wider = {**d, "decision_type": ["remove_low_cell_samples", "accept_qc_removal"], "affected_samples": ["A", "B"], "accept_qc_removal": True}
    assert settings.qc_decision(wider, ["A", "B"])["kept_low_cell_samples"] == []
    for b in ({"confirmed_by": "tool"}, {"user_statement": " "}, {"decision_type": []}, {"affected_samples": ["A", "A"]}, {"affected_samples": ["A", "B"]}, {"removed_samples": ["Z"]}, {"decision_type": ["other"]}, {"decision_type": ["accept_default_conflicts"]}, {"parameter_overrides": {"x": 1}}, {"accept_qc_removal": True}):
        with pytest.raises(ValueError):
            settings.qc_decision({**d, **b}, ["A", "B"])
    assert settings.resolution_decision({**d, "resolution": 0.4})["resolution"] == 0.4
    for r in (0, True, None, "0.4"):
        with pytest.raises(ValueError):
            settings.resolution_decision({**d, "resolution": r})


def test_files(tmp_path):
    files.write_once(tmp_path / "a" / "x.txt", "one")
    files.write_once(tmp_path / "a" / "x.txt", "one")
    with pytest.raises(ValueError):
        files.write_once(tmp_path / "a" / "x.txt", "two")
    files.replace_text(tmp_path / "a" / "x.txt", "one", "two")
    with pytest.raises(ValueError):
        files.replace_text(tmp_path / "a" / "x.txt", "one", "three")
    source, target = tmp_path / "s", tmp_path / "t" / "s"
    source.write_text("data")
    waits, calls = [], []

    def copy(a, b):
        calls.append(a)
        if len(calls) < 2:
            raise TimeoutError("slow")
        b.write_bytes(source.read_bytes())

    record = files.fetch(source, target, copy=copy, sleep=waits.append)
    assert (record["retry"], record["status"], waits) == (1, "DOWNLOADED", [2]) and not (tmp_path / "t" / "s.part").exists()
    assert files.fetch(source, target, previous=record, copy=None)["status"] == "REUSED"
    for kw in ({}, {"previous": {**record, "source": "other"}}, {"previous": record, "expected": "0" * 64}):
        with pytest.raises(ValueError):
            files.fetch(source, target, **kw)
    with pytest.raises(FileNotFoundError):
        files.fetch(tmp_path / "none", tmp_path / "u", sleep=waits.append)
    assert waits == [2, 2, 5, 10]
    assert files.first_existing([tmp_path / "none", source]) == source.resolve()
    with pytest.raises(ValueError):
        files.first_existing([source], tmp_path / "none")
    for v, identity in (("v1", "i"), ("v2", "i"), ("v3", "j")):
        (tmp_path / "area" / v).mkdir(parents=True)
        (tmp_path / "area" / v / "out.csv").write_text(v)
        (tmp_path / "area" / v / "audit_inputs.json").write_text(json.dumps({"identity": identity, "outputs": {"out.csv": files.sha256(tmp_path / "area" / v / "out.csv")}}))
    assert files.saved_version(tmp_path / "area", "i", ["out.csv"]).name == "v2" and files.saved_version(tmp_path / "area", "k", []) is None
    (tmp_path / "area" / "v2" / "out.csv").write_text("changed")
    with pytest.raises(ValueError):
        files.saved_version(tmp_path / "area", "i", ["out.csv"])


def test_confirmation(tmp_path):
    report, approval, output = (tmp_path / n for n in ("report.csv", "approval.json", "manifest.csv"))
    with report.open("w", newline="") as f:
        w = csv.DictWriter(f, ["sample", "tissue"])
        w.writeheader()
        w.writerows({"sample": s, "tissue": "t"} for s in ("S2", "S1", "S3"))
    say = lambda **d: approval.write_text(json.dumps({"confirmed_by": "user", "user_statement": "S1 is A", **d}))
    say(groups={"S1": "A", "S2": "B", "S3": "A"})
    assert [(r["sample"], r["group"]) for r in files.confirm(report, approval, output)] == [("S2", "B"), ("S1", "A"), ("S3", "A")]
    say(groups={"S1": "A", "S2": "B"}, selected_samples=["S2", "S1"])
    assert len(files.confirm(report, approval, output)) == 2 and files.verify_confirmation(output)["selected_samples"] == ["S2", "S1"]
    receipt = output.with_suffix(".confirmation.json")
    receipt.write_text(receipt.read_text().replace('"S1"', '"S3"'))
    with pytest.raises(ValueError, match="selected samples differ"):
        files.verify_confirmation(output)
    output.write_text(output.read_text() + "\n")
    with pytest.raises(ValueError, match="changed"):
        files.verify_confirmation(output)
    for d in ({"groups": {}}, {"groups": {"S1": "A", "S9": "B"}, "selected_samples": ["S1", "S9"]}, {"groups": {"S1": " "}, "selected_samples": ["S1"]}):
        say(**d)
        with pytest.raises(ValueError):
            files.confirm(report, approval, output)


def test_inspection(tmp_path):
    sample = lambda i: {"accession": f"S{i}", "title": f"t{i}", "characteristics": [{"key": "tissue", "value": "liver"}, {"key": "patient", "value": "P"}, {"key": "tumor", "value": "yes"}]}
    path = tmp_path / "i.json"
    path.write_text(json.dumps({"gse": "G", "complete": True, "samples": [sample(1), sample(2)]}))
    assert files.load_inspection(path, "G", 2, {"liver": "L"}, {"tumor": "yes"})["t2"] == {"gsm": "S2", "patient": "P", "site": "L"}
    for args in (("H", 2, {"liver": "L"}, {}), ("G", 3, {"liver": "L"}, {}), ("G", 2, {}, {}), ("G", 2, {"liver": "L"}, {"tumor": "no"})):
        with pytest.raises(ValueError):
            files.load_inspection(path, *args)


def test_widths(spark, tmp_path):
    cells = spark.createDataFrame([("c1",), ("c2",)], "cell_id string")
    good = tmp_path / "m.tsv.gz"
    good.write_bytes(gzip.compress("﻿c1\tc2\ng1\t1\t2\ng2\t0\t0\n".encode()))
    assert files.verify_widths(spark, good, cells) == 2
    for text in ("c1\tc3\ng1\t1\t2\n", "c1\tc2\ng1\t1\n", "c1\tc2\n", "c1\tc1\ng1\t1\t2\n"):
        bad = tmp_path / "b.tsv"
        bad.write_text(text)
        with pytest.raises(ValueError):
            files.verify_widths(spark, bad, cells)
    counts = spark.createDataFrame([("c1", "g1", 1.0), ("c2", "g1", 0.0)], "cell_id string, gene_id string, value double")
    assert files.built(counts, counts, cells) == {"genes": 1, "cells": 2, "nonzero": 1}


@pytest.fixture(scope="module")
def dataset(spark):
    r = np.random.default_rng(1)
    names = ["MT-A", "RPL1", "HBB", "HBP1"] + [f"S{i}" for i in range(6)] + [f"M{i}" for i in range(6)] + [f"G{i}" for i in range(14)]
    counts = [(f"c{c}", f"g{g}", float(1 + r.integers(0, 9))) for c in range(60) for g in range(30) if g > 2 or c % 3 == 0]
    cells = [(f"c{c}", f"S{c // 30}", "A" if c < 30 else "B", f"L{c // 30}") for c in range(60)]
    return spark.createDataFrame(counts, "cell_id string, gene_id string, value double"), spark.createDataFrame(cells, "cell_id string, sample string, grp string, library_id string"), spark.createDataFrame([(f"g{i}", n) for i, n in enumerate(names)], "gene_id string, gene_name string")


def test_precheck_results(dataset):
    counts, cells, genes = dataset
    limits = {"nfeature_min": 5, "nfeature_max": 100, "ncount_min": 5, "ncount_max": 10000, "pmt_max": 50, "phb_max": 50, "prp_max": 50}
    sets = {"S": [f"s{i}" for i in range(6)], "G2M": [f"m{i}" for i in range(6)]}
    run = lambda c=counts, m=cells, g=genes, t=limits, **kw: precheck.precheck(c, m, g, t, **{"min_cells": 20, "cycle_sets": sets, **kw})
    needs = lambda status, report: (status, report.filter("metric = 'status'").first()["note"])
    status, report = run()
    assert status == "PASS" and report.filter("status = 'NEEDS_USER_DECISION'").isEmpty()
    assert run(packages=["surely_absent"])[0] == "FAILED_INPUT"
    assert run(c=counts.withColumn("value", F.col("value") / 2))[0] == "FAILED_INPUT"
    assert run(m=cells.withColumn("grp", F.when(F.col("cell_id") == "c1", "B").otherwise(F.col("grp"))))[0] == "FAILED_INPUT"
    assert run(removed=["S0", "S1"])[0] == "FAILED_INPUT"
    assert run(c=counts.filter("false"))[0] == "FAILED_INPUT"
    assert "features absent" in needs(*run(g=genes.withColumn("gene_name", F.lower("gene_name"))))[1]
    assert "Unsupported species" in needs(*run(species="yeast"))[1]
    assert "conflicts with QC config" in needs(*run(m=cells.withColumn("species", F.lit("Mouse"))))[1]
    assert "snRNA-seq" in needs(*run(m=cells.withColumn("modality", F.lit("single-nucleus"))))[1]
    assert run(m=cells.withColumn("modality", F.lit("single-nucleus")), defaults_accepted=True)[0] == "PASS"
    assert "fewer than five" in needs(*run(cycle_sets={"S": ["s1"]}))[1] and run(cycle_sets={"S": ["s1"]}, doublets=False)[0] == "PASS"
    tight = {**limits, "nfeature_min": 28}
    note = needs(*run(t=tight))[1]
    assert "nfeature_min conflicts" in note and "ALL predicted QC removal" in note and "L0 (" in note
    assert run(t=tight, overrides=["nfeature_min"], accepted=["S0", "S1"], kept=["S0", "S1"])[0] == "PASS"
    assert "Cell QC would empty" in needs(*run(t={**limits, "nfeature_min": 40}))[1]
    assert run(m=cells.drop("library_id").withColumn("technology", F.lit("multiplexed")))[0] == "NEEDS_USER_DECISION"
    with pytest.raises(ValueError):
        precheck.family_flags(genes, "yeast")


def test_checkpoints(dataset):
    counts, cells, _ = dataset
    m = matrix.cell_totals(counts, cells, {"pmt": F.col("gene_id") == "g0", "prp": F.col("gene_id") == "g1", "phb": F.col("gene_id") == "g2"})
    full = m.withColumns({c: F.lit(0.0) for c in ("s_score", "g2m_score", "cc_difference", "pann", "contamination")}).withColumns({"phase": F.lit("G1"), "df": F.lit("Singlet"), "df_adj": F.lit("Singlet"), "doublet_status": F.lit("x")})
    broken = lambda *a, **kw: {r["rule"] for r in checks.checkpoint_violations(*a, **kw).filter("n > 0").collect()}
    assert broken(counts, m, "qc1") == set() and broken(counts, m, "qc2") == {"MISSING_COLUMNS"}
    state = {"stage": "qc3", "configuration": {"ambient": 1}, "user_decision": {"d": 1}}
    assert broken(counts, full, "qc3", counts, counts, state, {"ambient": 1}, {"d": 1}) == set()
    assert broken(counts, full, "qc3", counts, counts, state, {"ambient": 2}, {"d": 2}) == {"SETTINGS_DIFFER", "DECISION_DIFFERS"}
    assert broken(counts, full, "qc3") == {"NO_CORRECTION"}
    fewer = counts.filter("gene_id <> 'g5'")
    assert broken(counts, full.withColumn("contamination", F.lit(2.0)), "qc3", corrected=fewer.withColumn("value", -F.col("value")).union(counts.limit(1).withColumn("gene_id", F.lit("new")))) == {"CONTAMINATION_RANGE", "CORRECTED_VALUES", "OTHER_ENTRIES"}
    assert "LOST_COUNTS" in broken(fewer, full, "qc3", counts, fewer)
    assert rows(checks.contract_columns(full).limit(0)) == [] and set(checks.contract_columns(full).columns) == {"cell_id", "sample", "grp", "library_id"}


def test_parts_of_a_map(dataset, spark):
    counts, cells, _ = dataset
    mapping = matrix.named_map(cells.select(F.col("cell_id").alias("barcode"), F.col("sample").alias("author"), "grp"), "barcode", "author")
    assert mapping.columns == ["cell_id", "sample"]
    some, flagged, totals = matrix.select_mapped(counts, cells, mapping, ["S0"], confirmed=True)
    assert some.select("cell_id").distinct().count() == 30 and flagged.count() == 60
    assert rows(totals) == [("S0", 30, True), ("S1", 30, False)]
    for kw in ({"samples": ["S0"]}, {"samples": ["S0", "S1", "S2"]}):
        with pytest.raises(ValueError):
            matrix.select_mapped(counts, cells, mapping, **kw)
    with pytest.raises(ValueError):
        matrix.select_mapped(counts, cells, mapping.filter("cell_id <> 'c1'"), ["S0", "S1"])


def test_layout_keeps_neighbours(spark):
    r = np.random.default_rng(1)
    kind = r.integers(0, 6, 900)
    x = 3 * r.normal(size=(6, 12))[kind] + r.normal(size=(900, 12))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9999, None)], "cell_id bigint, vec array<double>")
    got = {row["cell_id"]: (row["x"], row["y"]) for row in layout.umap_layout(df, landmarks=400, epochs=120).collect()}
    assert set(got) == set(range(900))
    y = np.array([got[i] for i in range(900)])
    _, near = layout.nearest_of(y, y, 10, True)
    assert np.isfinite(y).all() and (kind[near] == kind[:, None]).mean() > 0.9
    assert layout.umap_layout(df.filter("cell_id < 2")).count() == 2 and layout.umap_layout(df.filter("false")).count() == 0


def test_final_diagnostics_of_nothing(spark):
    cells = spark.createDataFrame([], "cell_id string, sample string, ncount double")
    empty = review.final_diagnostics(spark.createDataFrame([], "cell_id string, gene_id string, data double"), spark.createDataFrame([], "cell_id string, resolution double, cluster string"), cells, spark.createDataFrame([], "gene_id string"), spark.createDataFrame([("m",)], "marker string"), 0.4)
    assert rows(empty["markers"]) == [("m", "MARKER_ABSENT")] and empty["sizes"].count() == empty["composition"].count() == empty["distributions"].count() == 0


def test_storage_and_audits(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "a.bin").write_bytes(b"123")
    (tmp_path / "d" / "e" / "b.bin").write_bytes(b"4567")
    assert files.storage_inventory(spark, tmp_path / "d").count() == 2 and files.total_bytes(spark, tmp_path / "d") == 7
    entries = [{"path": "d/a.bin", "sha256": files.sha256(tmp_path / "d" / "a.bin")}, {"path": "d/none", "sha256": "0"}]
    assert files.verified_reference(entries, tmp_path).name == "a.bin"
    with pytest.raises(ValueError):
        files.verified_reference(entries[1:], tmp_path)
    assert files.dataset_root([tmp_path / "x", tmp_path / "d"]) == tmp_path / "d" and files.dataset_root([tmp_path / "x"]) == tmp_path / "x"
    with pytest.raises(ValueError):
        files.dataset_root([tmp_path, tmp_path / "d"])
    files.log_line(tmp_path / "l" / "x.log", "one")
    files.log_line(tmp_path / "l" / "x.log", "two")
    assert [x.split(" ", 1)[1] for x in (tmp_path / "l" / "x.log").read_text().splitlines()] == ["one", "two"]
    report = spark.createDataFrame([("A", " "), ("B", "own")], "sample string, disease string")
    assert rows(files.expand_report(report, {"disease": "HCC", "site": "liver"})) == [("A", "HCC", "liver"), ("B", "own", "liver")]
    audit = spark.createDataFrame([("s", "m", "1")], "stage string, metric string, value string")
    warn = spark.createDataFrame([("X", "WARNING"), ("X", "WARNING")], "category string, status string")
    got = files.write_audit(audit, warn, tmp_path / "audit", {"a.csv": "h"})
    assert got["warnings"] == [{"category": "X", "status": "WARNING", "n": 2}] and "| X | WARNING | 2 |" in (tmp_path / "audit" / "audit.md").read_text()
    assert files.write_audit(audit.limit(0), warn, tmp_path / "audit", {"a.csv": "h"}) == got
    (tmp_path / "audit" / "audit.md").write_text("changed")
    with pytest.raises(ValueError):
        files.write_audit(audit, warn, tmp_path / "audit", {"a.csv": "h"})
    assert files.sample_report([{"sample": "A", "x": "1", "y": ""}], "READY") == "READY\n\nA\n  x: 1\n"


def test_raw_objects_and_gates(spark):
    from scquarry.sources import routing

    counts = spark.createDataFrame([("A_1", "g", 1.0), ("B_1", "g", 2.0)], "cell_id string, gene_id string, value double")
    cells = spark.createDataFrame([("A_1", "A", "x", "A", "D"), ("B_1", "B", "x", "B", "D")], "cell_id string, sample string, grp string, orig_ident string, database string")
    broken = lambda *a, **kw: {r["rule"] for r in checks.raw_object_violations(*a, **kw).filter("n > 0").collect()}
    assert broken(counts, cells, "D", ["A", "B"]) == set()
    bad = cells.withColumn("orig_ident", F.lit("A")).withColumn("sample", F.lit("A")).withColumn("seurat_clusters", F.lit("1"))
    assert broken(counts, bad, "E", ["B"]) == {"CELL_PREFIX", "OTHER_ACCESSION", "UNKNOWN_SAMPLE", "SAMPLE_WITHOUT_CELLS", "DERIVED_COLUMNS"}
    assert "OTHER_IDENTITY" in broken(counts, cells.withColumn("orig_ident", F.lit(None).cast("string")))
    flagged = spark.createDataFrame([("A", True, False), ("A", False, False), ("B", False, False), ("C", False, True)], "sample string, retained boolean, removed_sample boolean")
    assert checks.emptied_samples(flagged) == ["B"]
    assert rows(checks.config_rows(spark, {"a": {"b": 1, "c": [1, 2]}}).select("metric", "value")) == [("a.b", "1"), ("a.c", "1;2")]
    issues = spark.createDataFrame([("QC", "ACTION_REQUIRED"), ("NEW", "ACTION_REQUIRED"), ("QC", "FAILED")], "category string, class string")
    assert rows(checks.resolved_gates(issues, True, ["QC"])) == [("NEW", "ACTION_REQUIRED"), ("QC", "FAILED"), ("QC", "RESOLVED")]
    assert rows(checks.resolved_gates(issues, False, ["QC"])) == rows(issues)
    barcodes = spark.createDataFrame([("AC-1",), ("AG-2",), ("AT-2",)], "cell_id string")
    assert [checks.suffix_mapping(barcodes, 2), checks.suffix_mapping(barcodes, 2, "said"), checks.suffix_mapping(barcodes, 3), checks.suffix_mapping(cells, 2)] == ["EVIDENCE_REQUIRED", "MAPPED", "COUNT_DIFFERS", "NO_SUFFIXES"]
    routing.enforce_single_cell({"t": ["single cell RNA"]})
    with pytest.raises(ValueError):
        routing.enforce_single_cell({"t": ["bulk RNA"]})
    assert routing.required_routes([{"file_type": "h5ad"}, {"file_type": "text"}]) == ["hdf5"] and routing.required_routes([{"file_type": "10x_mtx"}]) == []
    assert routing.safe_name("GSE1.a-b") == "GSE1.a-b"
    for name in ("", "../x", "a/b", ".a", "a..b"):
        with pytest.raises(ValueError):
            routing.safe_name(name)


def test_diagnostic_layout(dataset):
    counts, cells, _ = dataset
    assert layout.diagnostic_layout(counts, matrix.cell_totals(counts, cells.select("cell_id")), 5, 20).count() == 60
