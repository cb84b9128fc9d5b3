"""The check of a dataset before quality control: one result, and a report of what it rests on."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scquarry.operators import matrix, quality
from scquarry.session import materialize

#: Patterns of the names of mitochondrial, ribosomal and haemoglobin genes by species.
PATTERNS = {
    "human": {"pmt": "^MT-", "prp": "^RP[SL]", "phb": "^HB[^(P)]"},
    "mouse": {"pmt": "^mt-", "prp": "^Rp[sl]", "phb": "^Hb[^(p)]"},
}
#: Genes of each cycle set that must be there, share of cells failing one rule beyond which its threshold is in doubt.
CYCLE_GENES, RULE_SHARE = 5, 0.5
REPORT = "section string, sample string, metric string, value string, status string, note string"


def family_flags(genes: DataFrame, species: str, name: str = "gene_name") -> DataFrame:
    """genes with one flag per family (pmt, prp, phb) by the species' patterns; a gene without a name is in none."""
    if species not in PATTERNS:
        raise ValueError(f"no patterns for species: {species}")
    return genes.withColumns({n: F.coalesce(F.col(name).rlike(p), F.lit(False)) for n, p in PATTERNS[species].items()})


def precheck(
    counts: DataFrame,
    cells: DataFrame,
    genes: DataFrame,
    thresholds: dict[str, float],
    species: str = "human",
    removed: Sequence[str] = (),
    kept: Sequence[str] = (),
    accepted: Sequence[str] = (),
    defaults_accepted: bool = False,
    overrides: Sequence[str] = (),
    min_cells: int = 100,
    removal_limit: float = 0.15,
    cycle_sets: dict[str, Sequence[str]] | None = None,
    doublets: bool = True,
    packages: Sequence[str] = (),
    available: Callable[[str], bool] = lambda n: importlib.util.find_spec(n) is not None,
) -> tuple[str, DataFrame]:
    """PASS, NEEDS_USER_DECISION or FAILED_INPUT for a dataset, and the report (REPORT) that says why.

    counts: cell_id, gene_id, value; cells: cell_id, sample, grp and what hints at species, nuclei and libraries; genes: gene_id and
    gene_name. removed and kept name samples whose removal or missing doublet scores were decided, accepted those whose predicted
    loss was, overrides rules whose thresholds were changed on purpose; defaults_accepted stands for all rules. doublets says
    whether doublets are to be called: then cycle_sets (names of genes by set) and capture libraries count too.

    Input that breaks its contract fails: missing packages, counts that are no counts, cells without metadata, samples of
    two groups, all samples removed. What a user must decide: unknown or contradicting species, nuclei under default thresholds,
    gene families without genes, too few cycle genes, ambiguous libraries, a rule that most cells fail, samples that lose more than
    removal_limit of their cells or all, libraries left with fewer than min_cells. Only totals by sample, library and rule come to
    the driver.
    """
    spark = counts.sparkSession
    rows: list[tuple] = []
    needs: list[str] = []

    def add(section: str, metric: str, value, sample: str = "", status: str = "PASS", note: str = "") -> None:
        rows.append((section, sample, metric, str(value), status, note))

    def finish(status: str, note: str = "") -> tuple[str, DataFrame]:
        add("RUN", "status", status, status=status, note=note)
        return status, spark.createDataFrame(rows, REPORT)

    def doubt(section: str, metric: str, value, need: str, sample: str = "", note: str = "", status: str = "NEEDS_USER_DECISION") -> None:
        add(section, metric, value, sample, status, note)
        needs.append(need)

    missing = [p for p in packages if not available(p)]
    for p in missing:
        add("RUN", "missing_package", p, status="FAILED_INPUT")
    if missing:
        return finish("FAILED_INPUT", "required package missing")
    broken = {r["rule"]: r["n"] for r in matrix.contract_violations(counts, cells).filter("n > 0 AND rule <> 'CELL_WITHOUT_COUNTS'").collect()}
    for rule, n in sorted(broken.items()):
        add("INPUT", rule, n, status="FAILED_INPUT")
    if broken or counts.isEmpty():
        return finish("FAILED_INPUT", "; ".join(sorted(broken)) or "no counts")

    if species not in PATTERNS:
        doubt("CONFIG", "species", species, "Unsupported species")
    if "species" in cells.columns:
        seen = sorted(str(r[0] or "").strip().lower() for r in cells.select("species").distinct().orderBy("species").limit(10).collect())
        if seen != [species]:
            doubt("CONFIG", "species_metadata", ";".join(seen), "Species metadata conflicts with QC config")
    clues = [c for c in ("source_type", "modality", "technology") if c in cells.columns]
    nuclei = F.lit(False)
    for c in clues:
        nuclei |= F.coalesce(F.lower(F.col(c).cast("string")).rlike("snrna|single[- ]nucle|nuclei"), F.lit(False))
    if not defaults_accepted and not overrides and not cells.filter(nuclei).isEmpty():
        doubt("CELL_QC", "modality", "snRNA-seq", "snRNA-seq thresholds require confirmation")
    flags = family_flags(genes, species if species in PATTERNS else "human")
    hits = flags.agg(*[F.count(F.when(F.col(n), 1)).alias(n) for n in PATTERNS["human"]], *[F.countDistinct(F.when(F.upper("gene_name").isin([x.upper() for x in v]), F.upper("gene_name"))).alias(f"cycle_{k}") for k, v in (cycle_sets or {}).items()]).first()
    for n in PATTERNS["human"]:
        if hits[n]:
            add("CELL_QC", f"{n}_matched_features", hits[n])
        else:
            doubt("CELL_QC", f"{n}_matched_features", 0, f"{n} features absent")
    for k in (cycle_sets or {}) if doublets else ():
        n = hits[f"cycle_{k}"]
        if n >= CYCLE_GENES:
            add("CELL_CYCLE", f"{k}_features_matched", n)
        else:
            doubt("CELL_CYCLE", f"{k}_features_matched", n, f"{k} cell-cycle genes matched fewer than five")

    if doublets:
        try:
            cells, source = quality.capture_libraries(cells)
        except ValueError as e:
            return finish("NEEDS_USER_DECISION", str(e))
        add("CAPTURE_LIBRARY", "mapping_source", source, status="PASS" if source != "sample" else "CAPTURE_MAPPING_WARNING")
    families = {n: n for n in PATTERNS["human"]}
    metrics = matrix.cell_totals(counts.join(flags.select("gene_id", *families), "gene_id", "left"), cells, families)
    flagged = materialize(quality.flag_cells(metrics, thresholds, list(removed)), "flagged")
    groups = {r["sample"]: (r["n"], r["groups"], r["grp"]) for r in flagged.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("grp").alias("groups"), F.max("grp").alias("grp")).collect()}
    for s, (n, several, grp) in sorted(groups.items()):
        if several != 1:
            return finish("FAILED_INPUT", f"Sample has mixed group: {s}")
        add("SAMPLE", "group", grp, s)
        add("SAMPLE", "input_cells", n, s)
        if s in removed:
            add("SAMPLE", "decision", "removed", s, "USER_CONFIRMED_REMOVAL")
    if not set(groups) - set(removed):
        return finish("FAILED_INPUT", "All samples would be removed")
    for r in quality.rule_fractions(flagged).orderBy("rule").collect():
        share = r["fraction_outside"] or 0.0
        if share > RULE_SHARE and not defaults_accepted and r["rule"] not in overrides:
            doubt("CELL_QC", f"{r['rule']}_fraction_outside", round(share, 4), f"Default {r['rule']} conflicts with data distribution")
        else:
            add("CELL_QC", f"{r['rule']}_fraction_outside", round(share, 4))
    for r in quality.filter_reasons(flagged).orderBy("sample").collect():
        for c in r.asDict():
            if c != "sample":
                add("FILTER_REASONS", c, r[c], r["sample"])
    for r in quality.predicted_removal(flagged, removal_limit).orderBy("sample").collect():
        need = set(groups) - set(removed) if r["sample"] == "ALL" else {r["sample"]}
        over = r["over_limit"] and not need <= set(accepted)
        for c in ("input_cells", "predicted_after_qc_cells", "predicted_removed_cells"):
            add("CELL_QC", c, r[c], r["sample"])
        share = round(r["predicted_removed_fraction"], 4)
        if over:
            doubt("CELL_QC", "predicted_removed_fraction", share, f"{r['sample']} predicted QC removal exceeds {removal_limit}", r["sample"])
        else:
            add("CELL_QC", "predicted_removed_fraction", share, r["sample"])
        if r["sample"] != "ALL" and not r["predicted_after_qc_cells"]:
            doubt("CELL_QC", "predicted_after_qc_cells", 0, f"Cell QC would empty {r['sample']}", r["sample"])
    for r in quality.library_sizes(flagged, "library_id", min_cells).orderBy("library_id").collect() if doublets else ():
        mine = set(r["samples"].split(";"))
        if mine & set(kept) and not mine <= set(kept):
            needs.append(f"Partial skip within capture library {r['library_id']}")
        if r["low_cell"] and not mine <= set(kept):
            doubt("CAPTURE_LIBRARY", "predicted_after_qc_cells", r["predicted_after_qc_cells"], f"{r['library_id']} ({r['predicted_after_qc_cells']} cells after QC)", r["library_id"], f"samples={r['samples']}", "LOW_CELL_SAMPLE")
    return finish("NEEDS_USER_DECISION", "; ".join(dict.fromkeys(needs))) if needs else finish("PASS")
