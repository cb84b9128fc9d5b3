import gzip
import hashlib
import json
import tarfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from scquarry.sources import bundles, matrices, routing


def trio(d, features, size="2 2 3", entries=("1 1 3", "2 1 1", "2 2 3")):
    d.mkdir()
    (d / "matrix.mtx.gz").write_bytes(gzip.compress(("%%MatrixMarket matrix coordinate integer general\n% note\n" + "\n".join([size, *entries]) + "\n").encode()))
    (d / "features.tsv").write_text("\n".join(features) + "\n")
    (d / "barcodes.tsv.gz").write_bytes(gzip.compress(b"AAAA-1\nCCCC-1\n"))
    return d


def test_trio(spark, tmp_path):
    d = trio(tmp_path / "t", ["ENSG1\tA1BG\tGene Expression", "NA\tNA\tGene Expression"])
    counts, genes, cells = matrices.read_trio(spark, d, "S_")
    assert rows(counts) == [("S_AAAA-1", "ENSG1", 3.0), ("S_AAAA-1", "unannotated_feature_2", 1.0), ("S_CCCC-1", "unannotated_feature_2", 3.0)]
    assert cells.count() == 2 and genes.count() == 2
    assert matrices.probe_trio(d, spark)["missing_gene_names"] == 1
    with pytest.raises(ValueError, match="mismatch"):
        matrices.probe_trio(trio(tmp_path / "u", ["ENSG1\tA1BG"], "3 2 3"), spark)
    (d / "matrix.mtx").write_text("again")
    with pytest.raises(ValueError):
        routing.detect_trio(d)


def test_text(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('gene_id,AAACCTGAGGCTACGA-1,AAACCTGAGGTTCCTA-1,note\nG1,0,2,1\n"G,2",1,0,1\n')
    s = matrices.sniff_text(p)
    assert (s["delimiter"], s["orientation"], s["feature_column"], s["text_header_missing_id"]) == ("comma", "genes_by_cells", "gene_id", False)
    assert rows(matrices.read_text(spark, p, drop_columns=["note"])) == [("AAACCTGAGGCTACGA-1", "G,2", 1.0), ("AAACCTGAGGTTCCTA-1", "G1", 2.0)]
    q = tmp_path / "b.txt.gz"
    q.write_bytes(gzip.compress(b"AAACCTGAGGCTACGA-1\tAAACCTGAGGTTCCTA-1\nA1BG\t0\t2\nA2M\t1\t0\n"))
    s = matrices.sniff_text(q)
    assert (s["delimiter"], s["feature_column"], s["text_header_missing_id"]) == ("tab", "__row_names__", True)
    assert rows(matrices.read_text(spark, q, "tab", missing_id=True)) == [("AAACCTGAGGCTACGA-1", "A2M", 1.0), ("AAACCTGAGGTTCCTA-1", "A1BG", 2.0)]
    c = tmp_path / "c.tsv"
    c.write_text("cell\tG1\tG2\nAAACCTGAGGCTACGA-1\t1\t0\nAAACCTGAGGTTCCTA-1\t0\t5\n")
    assert matrices.sniff_text(c)["orientation"] == "cells_by_genes"
    assert rows(matrices.read_text(spark, c, "tab", "cells_by_genes")) == [("AAACCTGAGGCTACGA-1", "G1", 1.0), ("AAACCTGAGGTTCCTA-1", "G2", 5.0)]
    bad = tmp_path / "d.tsv"
    bad.write_text("Gene\tAAACCTGAGGCTACGA-1\nENSG1\t0.25\n")
    with pytest.raises(ValueError, match="Normalized"):
        matrices.sniff_text(bad)
    bad.write_text("Gene\tAAACCTGAGGCTACGA-1\nENSG1\t-2\n")
    with pytest.raises(Exception, match="no count|negative"):
        matrices.read_text(spark, bad, "tab").count()
    wide = tmp_path / "w.csv"
    wide.write_text("gene_id," + ",".join(f"AAACCTGAGGCTACGA-{i:05d}" for i in range(9000)) + "\nG1," + ",".join(["0"] * 9000) + "\n")
    assert matrices.sniff_text(wide)["delimiter"] == "comma"


def test_combine(spark):
    m = lambda c: spark.createDataFrame([(c, "g1", 1.0)], "cell_id string, gene_id string, value double")
    assert matrices.combine([m("a"), m("b")]).count() == 2
    with pytest.raises(ValueError):
        matrices.combine([m("a"), m("a")])
    other = m("b").withColumn("gene_id", F.lit("g2"))
    with pytest.raises(ValueError, match="genes"):
        matrices.combine([m("a"), other])
    both = spark.createDataFrame([("g1",), ("g2",)], "gene_id string")
    assert matrices.combine([m("a"), other], [both, both]).count() == 2
    genes = spark.createDataFrame([("g1",)], "gene_id string")
    assert rows(matrices.empty_droplets({"L": m("a")}, genes)) == [("L", "L::background::a", "g1", 1.0)]
    with pytest.raises(ImportError):
        matrices.read_binary("x.h5ad")


def test_routing(tmp_path):
    t = routing.file_type
    assert [t("x.h5ad.gz"), t("x_filtered_feature_bc_matrix.h5"), t("r.fastq.gz"), t("r.sra"), t("m.csv.gz"), t("matrix.mtx.gz"), t("o.rds")] == ["h5ad", "10x_h5_candidate", "raw_reads", "raw_reads", "text", "10x_mtx", "rds"]
    assert routing.choose_filtered(["a_raw_x.h5", "a_filtered_x.h5"]) == "a_filtered_x.h5"
    with pytest.raises(ValueError):
        routing.choose_filtered(["a_filtered_x.h5", "b_filtered_x.h5"])
    assert routing.select_text_reader(25127, 82168, 32 * 1024**3)[:2] == ("streaming", 25127 * 82168 * 8)
    assert routing.select_text_reader(2, 2, 10**9)[0] == "dense"
    for path in ("../x", "C:/x", "a/../../x", "a\\b", "/abs"):
        with pytest.raises(ValueError):
            routing.safe_path(tmp_path, path)
    shared = {"raw_counts_id": "s:UMI", "same_counts_evidence": "stated"}
    text = dict(shared, url="raw.txt.gz", verified_raw_counts=True)
    dense = dict(shared, url="raw.rds.gz", validated_evidence={"raw_counts": True, "sparse": False, "estimated_memory_bytes": 24_747_485_896})
    chosen, attempts = routing.select_candidate([text, {"url": "normalized_log2TPM.rds.gz"}, dense], lambda c: pytest.fail("not inspected"), 32_000_000_000, tmp_path / "audit.json")
    assert chosen is text and [a["status"] for a in attempts] == ["excluded", "rejected", "selected"]
    with pytest.raises(ValueError, match="raw_counts_id"):
        routing.rank_candidates([text, dict(dense, raw_counts_id="other")])
    r = routing.parse_soft("^SAMPLE = GSM1\n!Sample_characteristics_ch1 = disease: PDAC\n!Sample_characteristics_ch1 = tissue: pancreas")
    assert r[0]["id"] == "GSM1" and len(r[0]["fields"]["Sample_characteristics_ch1"]) == 2
    assert routing.is_single_cell({"t": ["10x Genomics single-cell RNA"]}) and not routing.is_single_cell({"t": ["Expression array"]})
    assert routing.propose_input("GSM1", ["GSM1_matrix.mtx.gz", "GSM1_features.tsv.gz", "GSM1_barcodes.tsv.gz"])["file_type"] == "10x_mtx"


def test_archives_and_parts(tmp_path):
    (tmp_path / "m.mtx").write_bytes(b"counts")
    with tarfile.open(tmp_path / "a.tar", "w") as t:
        t.add(tmp_path / "m.mtx", "sample/matrix.mtx")
    assert routing.extract_member(tmp_path / "a.tar", "sample/matrix.mtx", tmp_path / "o").read_bytes() == b"counts"
    with pytest.raises(ValueError):
        routing.extract_member(tmp_path / "a.tar", "../x", tmp_path / "o")
    whole = gzip.compress(b"gene,a,b\ng1,1,0\ng2,0,3\n")
    for i, b in enumerate((whole[:20], whole[20:])):
        (tmp_path / f"p{i}").write_bytes(b)
    parts = [tmp_path / "p0", tmp_path / "p1"]
    out = routing.assemble_parts(parts, tmp_path / "w.csv.gz", [hashlib.sha256(p.read_bytes()).hexdigest() for p in parts])
    assert out.read_bytes() == whole
    with pytest.raises(ValueError):
        routing.assemble_parts(parts, tmp_path / "v", ["0" * 64, None])


def test_bundles(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), (None, None)], "k string, v double")
    m = bundles.write_bundle({"t": df}, tmp_path / "b", {"from": "test"})
    assert m["tables"]["t"]["rows"] == 2 and rows(bundles.read_bundle(spark, tmp_path / "b")["t"]) == rows(df)
    bundles.write_bundle({"t": df.repartition(3)}, tmp_path / "b")
    with pytest.raises(FileExistsError):
        bundles.write_bundle({"t": df.filter("k = 'a'")}, tmp_path / "b")
    bundles.write_table(df, tmp_path / "t.csv", ["k"])
    (tmp_path / "u.csv").write_bytes(b"\xef\xbb\xbf" + "k,v\n组,1\n".encode())
    assert rows(bundles.read_table(spark, tmp_path / "u.csv")) == [("组", "1")]
    assert sorted(map(repr, rows(bundles.read_table(spark, tmp_path / "t.csv")))) == ["('a', '1.5')", "(None, None)"]


def test_manifest(spark):
    base = dict.fromkeys(bundles.MANIFEST, "x") | {"file_type": "text", "local_path": "raw/a"}
    make = lambda *r: spark.createDataFrame([{**base, **x} for x in r])
    assert bundles.validate_manifest(make({"sample": "1"}), "/tmp") == []
    assert any("Duplicate" in p for p in bundles.validate_manifest(make({}, {})))
    assert any("Shared" in p for p in bundles.validate_manifest(make({"sample": "1"}, {"sample": "2"})))
    assert any("Unsupported" in p for p in bundles.validate_manifest(make({"file_type": "raw_reads"})))
    assert any("blank group" in p for p in bundles.validate_manifest(make({"group": " "})))
    assert any("unsafe" in p for p in bundles.validate_manifest(make({"local_path": "../x"}), "/tmp"))
    assert bundles.read_signature(make({"sample": "1"}, {"sample": "2", "count_source": "y"})).count() == 1


def test_large_manifest_is_checked_as_a_whole(spark):
    n = 12_000
    line = {c: F.lit("x") for c in bundles.MANIFEST} | {"sample": (F.col("id") % (n - 30)).cast("string"), "file_type": F.concat(F.lit("kind"), F.col("id") % 25)}
    rows = spark.range(n).select(*[c.alias(k) for k, c in (line | {"local_path": F.concat(F.lit("../"), F.col("id") % (n - 40))}).items()])
    problems = bundles.validate_manifest(rows, "/tmp")
    assert sum(p.startswith("unsafe path: ") for p in problems) == n - 40
    for what, count in (("Duplicate sample", 30), ("Unsupported file_type", 25), ("Shared input without a cell map", 40)):
        assert f"{what}: {count} in all" in problems and sum(p.startswith(what) for p in problems) == 21


def test_streams(spark, tmp_path):
    from scquarry.model import COUNTS
    from scquarry.operators.matrix import cell_totals
    from scquarry.streaming import totals

    data = [(f"c{i % 5}", f"g{i}", float(i % 4)) for i in range(40)]
    df = spark.createDataFrame(data, COUNTS)
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    totals.run_once(totals.running_totals(totals.read_counts(spark, str(tmp_path / "in"), 1)), "run", str(tmp_path / "cp"))
    batch = cell_totals(df, df.select("cell_id").distinct())
    assert rows(spark.table("run")) == rows(batch)


def test_text_matrix_of_fractions_is_no_count_matrix(spark, tmp_path):
    (tmp_path / "m.csv").write_text("id,c1,c2\n" + "".join(f"g{i},1,2\n" for i in range(80)) + "g80,1.5,0\n")
    with pytest.raises(Exception, match="no count: 1.5"):
        matrices.read_text(spark, tmp_path / "m.csv").collect()


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from scquarry.session import shared_dir

    unset = SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    fake = lambda master: SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master=master, getConf=lambda: unset))
    assert shared_dir(fake("local[4]")).startswith("file://") and shared_dir(fake("local"))
    for master in ("spark://host:7077", "yarn", "local-cluster[3,4,1024]"):
        with pytest.raises(RuntimeError):
            shared_dir(fake(master))


def test_atomic_json(tmp_path):
    bundles.atomic_json(tmp_path / "a" / "x.json", {"k": "ü"})
    assert json.loads((tmp_path / "a" / "x.json").read_text(encoding="utf-8")) == {"k": "ü"}
    with pytest.raises(TypeError):
        bundles.atomic_json(tmp_path / "a" / "x.json", {"k": object()})
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["x.json"] and json.loads((tmp_path / "a" / "x.json").read_text())


def test_written_tables_are_discarded(spark):
    import os

    from scquarry import session

    kept, session._WRITTEN[:] = list(session._WRITTEN), []
    session.materialize(spark.range(3), "x")
    path = session._WRITTEN[0].removeprefix("file://")
    assert os.path.isdir(path) and session.discard(spark) == 1 and not os.path.exists(path) and session.discard(spark) == 0
    session._WRITTEN[:] = kept
