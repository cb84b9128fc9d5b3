"""Checks of results: embeddings, clusterings, compacted copies, columns of earlier runs, pooled metadata."""

from __future__ import annotations

import importlib.util
import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that earlier analyses leave behind.
DERIVED = r"_snn_res\.|^seurat_clusters$|^cluster_res[._]"


def embedding_violations(vectors: DataFrame, cells: DataFrame, dims: int) -> DataFrame:
    """rule, n: cells without a vector, vectors without a cell, repeated ones, wrong lengths and numbers that aren't finite."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    one = vectors.agg(F.count(F.when(F.col("vec").isNull() | (F.size("vec") != dims), 1)).alias("LENGTH"), F.count(F.when(bad, 1)).alias("NOT_FINITE")).unpivot([], ["LENGTH", "NOT_FINITE"], "rule", "n")
    count = lambda df, name: df.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("n"))
    return (
        one.union(count(vectors.groupBy("cell_id").count().filter("count > 1"), "REPEATED"))
        .union(count(cells.join(vectors.select("cell_id"), "cell_id", "left_anti"), "CELL_WITHOUT_VECTOR"))
        .union(count(vectors.join(cells.select("cell_id"), "cell_id", "left_anti"), "UNKNOWN_CELL"))
    )


def clustering_violations(assignments: DataFrame, cells: DataFrame, resolutions: Sequence[float]) -> DataFrame:
    """rule, n: cells that lack a cluster at a resolution or have two, blank clusters, resolutions that were not asked for."""
    each = cells.select("cell_id", F.explode(F.array(*[F.lit(float(r)) for r in resolutions])).alias("resolution"))
    count = lambda df, name: df.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("n"))
    return (
        count(each.join(assignments.select("cell_id", "resolution"), ["cell_id", "resolution"], "left_anti"), "MISSING")
        .union(count(assignments.groupBy("cell_id", "resolution").count().filter("count > 1"), "REPEATED"))
        .union(count(assignments.filter("cluster IS NULL OR trim(cluster) = ''"), "BLANK"))
        .union(count(assignments.filter(~F.col("resolution").isin([float(r) for r in resolutions])).select("resolution").distinct(), "UNKNOWN_RESOLUTION"))
    )


def drop_derived(cells: DataFrame, pattern: str = DERIVED) -> DataFrame:
    """cells without the columns of earlier analyses."""
    return cells.drop(*[c for c in cells.columns if re.search(pattern, c)])


def equal_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    columns = sorted(a.columns)
    return columns == sorted(b.columns) and a.select(columns).exceptAll(b.select(columns)).isEmpty() and b.select(columns).exceptAll(a.select(columns)).isEmpty()


def compact(bundle: dict[str, DataFrame], droppable: Iterable[str]) -> dict[str, DataFrame]:
    """A bundle without the droppable tables that equal another one that stays."""
    out = dict(bundle)
    for name in droppable:
        if name in out and any(n != name and sorted(x.columns) == sorted(out[name].columns) and equal_rows(x, out[name]) for n, x in out.items()):
            del out[name]
    return out


def pooled_metadata_problems(metadata: DataFrame, samples: DataFrame, cell: str = "Cell", sample: str = "sample", patient: str = "patient") -> DataFrame:
    """problem, key of pooled metadata: repeated cells, cells without their sample's prefix, unknown samples, patients that differ from the samples'."""
    m = metadata.select(F.col(cell).alias("c"), F.col(sample).alias("s"), F.col(patient).alias("p"))
    known = samples.select(F.col("sample").alias("_s"), F.col("patient").alias("_p"))
    j = m.join(known, m["s"] == known["_s"], "left")
    return (
        m.groupBy("c").count().filter("count > 1").select(F.lit("REPEATED_CELL").alias("problem"), F.col("c").alias("key"))
        .union(m.filter(~F.coalesce(F.col("c").startswith(F.concat("s", F.lit("_"))), F.lit(False))).select(F.lit("PREFIX"), "c"))
        .union(j.filter("_s IS NULL").select(F.lit("UNKNOWN_SAMPLE"), "s").distinct())
        .union(j.filter(F.col("_s").isNotNull() & ~F.col("p").eqNullSafe(F.col("_p"))).select(F.lit("PATIENT_DIFFERS"), "c"))
    )


def merge_config(defaults: dict, overrides: dict, allowed: dict | None = None) -> dict:
    """defaults with overrides; a key that defaults don't have, or that isn't allowed, is an error."""
    out = dict(defaults)
    for k, v in overrides.items():
        if k not in defaults or (allowed is not None and k not in allowed):
            raise ValueError(f"unknown setting: {k}")
        out[k] = merge_config(defaults[k], v, allowed.get(k) if isinstance(allowed, dict) and isinstance(allowed.get(k), dict) else None) if isinstance(defaults[k], dict) and isinstance(v, dict) else v
    return out


def missing_packages(names: Sequence[str], available: Callable[[str], bool] = lambda n: importlib.util.find_spec(n) is not None) -> list[str]:
    return [n for n in names if not available(n)]


def evidence_files(names: Sequence[str]) -> list[str]:
    """The summary tables among file names: tables with a row per cell are no evidence."""
    cell_level = ("cell_qc_all", "cell_level", "per_cell", "cell_contamination", "decontx_cells", "doublet_cells", "cell_cycle_cells", "cluster_assignments")
    return sorted(n for n in names if n.lower().endswith(".csv") and n.lower() != "metadata.csv" and not any(w in n.lower() for w in cell_level))


#: Columns of a doublet and cycle checkpoint, and the calls that may be left in it.
CHECKPOINT = ("pmt", "prp", "phb", "s_score", "g2m_score", "phase", "cc_difference", "pann", "df", "df_adj", "doublet_status")
CALLS = ("Singlet", "NotEvaluated")


def checkpoint_violations(
    counts: DataFrame, cells: DataFrame, step: str, parent: DataFrame | None = None, corrected: DataFrame | None = None, provenance: dict | None = None, configuration: dict | None = None, decision: dict | None = None, tables: Iterable[str] = ()
) -> DataFrame:
    """rule, n: what a checkpoint of quality control (step qc1, qc2 or qc3) breaks; n is 0 for a rule that holds.

    Metrics must be those of the counts. From qc2 on the columns of CHECKPOINT must be there, calls be one of CALLS, and cells that
    weren't evaluated carry their skip marker. At qc3 the corrected matrix has the same cells and genes, finite numbers that
    aren't negative, and contamination (column contamination) from 0 to 1. Counts must be those of the parent on the checkpoint's cells
    and genes, all of them at qc3. Stored settings and decisions (in provenance) must be the current ones, without the ambient
    settings before qc3. tables are names of tables; those that analyses leave behind must not be among them.
    """
    from scquarry.operators.matrix import child_violations

    spark = counts.sparkSession
    one = lambda name, df: df.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("n"))
    plain = lambda *rows: spark.createDataFrame(list(rows), "rule string, n bigint")
    sums = counts.groupBy("cell_id").agg(F.sum("value").alias("_n"), F.count(F.when(F.col("value") > 0, 1)).alias("_f"))
    m = cells.join(sums, "cell_id", "left")
    out = one("METRICS_DIFFER", m.filter(~F.coalesce((F.abs(F.col("ncount") - F.coalesce("_n", F.lit(0.0))) <= 1e-8) & (F.col("nfeature") == F.coalesce("_f", F.lit(0))), F.lit(False))))
    out = out.union(plain(("TEMPORARY_STATE", sum(bool(re.search(r"^(pca|umap|nn|snn|neighbors|graph)", t)) for t in tables))))
    if step in ("qc2", "qc3"):
        missing = [c for c in CHECKPOINT if c not in cells.columns]
        out = out.union(plain(("MISSING_COLUMNS", len(missing))))
        if not missing:
            out = out.union(one("REJECTED_CELLS", cells.filter(~F.coalesce(F.col("df_adj").isin(*CALLS), F.lit(False)))))
            out = out.union(one("NO_SKIP_MARKER", cells.filter((F.col("df_adj") == "NotEvaluated") & ~F.coalesce(F.col("doublet_status") == "SKIPPED_LOW_CELL", F.lit(False)))))
    if step == "qc3":
        if corrected is None or "contamination" not in cells.columns:
            out = out.union(plain(("NO_CORRECTION", 1)))
        else:
            keys = ["cell_id", "gene_id"]
            out = out.union(one("OTHER_ENTRIES", corrected.select(keys).join(counts.filter("value > 0").select(keys), keys, "left_anti")))
            out = out.union(one("CORRECTED_VALUES", corrected.filter("value IS NULL OR isnan(value) OR value < 0 OR value = double('Infinity')")))
            out = out.union(one("CONTAMINATION_RANGE", cells.filter("contamination IS NULL OR isnan(contamination) OR contamination < 0 OR contamination > 1")))
    if parent is not None:
        out = out.union(one("CHANGED_COUNTS", child_violations(parent, counts)))
        if step == "qc3":
            lost = parent.select("cell_id", "gene_id").join(counts.select("cell_id", "gene_id"), ["cell_id", "gene_id"], "left_anti")
            out = out.union(one("LOST_COUNTS", lost))
    if configuration is not None or decision is not None:
        stored = provenance or {}
        strip = lambda c: {k: v for k, v in (c or {}).items() if k != "ambient" or step == "qc3"}
        settings = configuration is not None and strip(stored.get("configuration")) != strip(configuration)
        decided = decision is not None and stored.get("user_decision") is not None and stored["user_decision"] != decision
        out = out.union(plain(("SETTINGS_DIFFER", int(settings)), ("DECISION_DIFFERS", int(decided)), ("OTHER_STEP", int(stored.get("stage") != step))))
    return out


def report_dimensions(report: DataFrame, n_cells: int, n_genes: int) -> DataFrame:
    """metric, reported, found, equal of final_cells and final_genes; the last row of a metric (by its place, column n) counts."""
    rows = report.filter((F.col("section") == "RUN") & F.col("metric").isin("final_cells", "final_genes")).groupBy("metric").agg(F.max_by("value", "n").alias("reported"))
    found = F.when(F.col("metric") == "final_cells", F.lit(n_cells)).otherwise(F.lit(n_genes))
    both = report.sparkSession.createDataFrame([("final_cells",), ("final_genes",)], "metric string").join(rows, "metric", "left")
    number = F.expr("try_cast(reported AS BIGINT)")
    return both.withColumn("found", found.cast("bigint")).withColumn("equal", F.coalesce(number == F.col("found"), F.lit(False)))


#: Columns that describe cells where they come from; all others are the work of earlier analyses.
SOURCE = ("cell_id", "database", "sample", "grp", "group_name", "tissue", "disease", "source_type", "patient", "specimen", "cohort", "treatment", "library_id", "capture_id", "sequencing_run", "pool_id", "technology", "species")


def contract_columns(cells: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """cells with the columns of SOURCE (and extra) that they have: normalized values, components and clusters of others stay behind."""
    return cells.select(*[c for c in cells.columns if c in (*SOURCE, *extra)])


def raw_object_violations(counts: DataFrame, cells: DataFrame, accession: str | None = None, manifest: Sequence[str] | None = None) -> DataFrame:
    """rule, n for a freshly built object: the contract of counts and cells, cells named after their sample (sample_...), the identity
    (orig_ident, if there) equal to the sample, one database, the accession, samples of the manifest only, and no columns of analyses."""
    from scquarry.operators.matrix import contract_violations

    spark = counts.sparkSession
    one = lambda name, df: df.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("n"))
    out = contract_violations(counts, cells).union(one("CELL_PREFIX", cells.filter(~F.coalesce(F.col("cell_id").startswith(F.concat("sample", F.lit("_"))), F.lit(False)))))
    if "orig_ident" in cells.columns:
        out = out.union(one("OTHER_IDENTITY", cells.filter(~F.col("orig_ident").eqNullSafe(F.col("sample")))))
    if accession is not None:
        out = out.union(one("OTHER_ACCESSION", cells.filter(~F.coalesce(F.col("database") == accession, F.lit(False)))))
    if manifest is not None:
        out = out.union(one("UNKNOWN_SAMPLE", cells.filter(~F.coalesce(F.col("sample").isin(*manifest), F.lit(False))).select("sample").distinct()))
        seen = spark.createDataFrame([(m,) for m in manifest], "sample string")
        out = out.union(one("SAMPLE_WITHOUT_CELLS", seen.join(cells.select("sample").distinct(), "sample", "left_anti")))
    derived = sum(bool(re.search(DERIVED, c)) for c in cells.columns)
    return out.union(spark.createDataFrame([("DERIVED_COLUMNS", derived)], "rule string, n bigint"))


def emptied_samples(flagged: DataFrame) -> list[str]:
    """Samples that lose all their cells, though they aren't removed as a whole; filtering them is an error."""
    lost = flagged.groupBy("sample").agg(F.bool_or("retained").alias("kept"), F.bool_and("removed_sample").alias("removed")).filter("NOT kept AND NOT removed")
    return [r["sample"] for r in lost.orderBy("sample").collect()]


def config_rows(spark: SparkSession, config: dict) -> DataFrame:
    """Settings as rows of a report: section CONFIG, the path of each value as its metric, lists joined by semicolons."""
    rows: list[tuple] = []

    def walk(prefix: str, v) -> None:
        if isinstance(v, dict):
            for k, x in v.items():
                walk(f"{prefix}.{k}" if prefix else str(k), x)
        else:
            rows.append(("CONFIG", "", prefix, ";".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v), "PASS", ""))

    walk("", config)
    return spark.createDataFrame(rows, "section string, sample string, metric string, value string, status string, note string")


def resolved_gates(issues: DataFrame, verified: bool, historical: Sequence[str]) -> DataFrame:
    """issues (category, class) with gates of earlier steps (historical categories) RESOLVED once the final object is verified, not before."""
    gate = F.col("category").isin(*historical) & (F.col("class") == "ACTION_REQUIRED") & F.lit(verified)
    return issues.withColumn("class", F.when(gate, "RESOLVED").otherwise(F.col("class")))


def suffix_mapping(cells: DataFrame, n_samples: int, evidence: str | None = None) -> str:
    """Whether barcode suffixes (-1, -2, ...) may tell samples apart: NO_SUFFIXES, COUNT_DIFFERS, EVIDENCE_REQUIRED or MAPPED.

    As many suffixes as samples aren't enough: which is which must be said by evidence.
    """
    groups = cells.select(F.regexp_extract("cell_id", r"-(\d+)$", 1).alias("s")).filter("s <> ''").distinct().count()
    if not groups:
        return "NO_SUFFIXES"
    if groups != n_samples:
        return "COUNT_DIFFERS"
    return "MAPPED" if evidence and evidence.strip() else "EVIDENCE_REQUIRED"
