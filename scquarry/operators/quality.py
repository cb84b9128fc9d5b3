"""Quality rules of cells: flags, reasons, summaries and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules in the order in which reasons name them: threshold, metric, whether the metric must stay above it.
RULES = (
    ("nfeature_min", "nfeature", True),
    ("nfeature_max", "nfeature", False),
    ("ncount_min", "ncount", True),
    ("ncount_max", "ncount", False),
    ("pmt_max", "pmt", False),
    ("phb_max", "phb", False),
    ("prp_max", "prp", False),
)


def rule_columns(thresholds: dict[str, float]) -> dict[str, Column]:
    """Per rule whether a cell fails it. Bounds are strict: a value equal to its threshold fails. Null and NaN metrics fail none."""

    def fails(name: str, metric: str, above: bool) -> Column:
        m, t = F.col(metric).cast("double"), F.lit(float(thresholds[name]))
        return F.coalesce(~F.isnan(m) & ((m <= t) if above else (m >= t)), F.lit(False))

    return {n: fails(n, m, a) for n, m, a in RULES if n in thresholds}


def flag_cells(metrics: DataFrame, thresholds: dict[str, float], removed_samples: Sequence[str] = ()) -> DataFrame:
    """metrics with a flag per rule, n_failed, failed_rules, removed_sample, retained and removal_reason."""
    rules = rule_columns(thresholds)
    out = metrics.withColumns(rules)
    names = F.concat_ws(";", *[F.when(F.col(n), n) for n in rules])
    out = out.withColumns({"n_failed": sum((F.col(n).cast("int") for n in rules), F.lit(0)), "failed_rules": names, "removed_sample": F.col("sample").isin(*removed_samples) if removed_samples else F.lit(False)})
    out = out.withColumn("retained", (F.col("n_failed") == 0) & ~F.col("removed_sample"))
    return out.withColumn("removal_reason", F.when(F.col("retained"), "retained").when(F.col("n_failed") > 0, F.col("failed_rules")).otherwise("user_confirmed_sample_removal"))


def filter_reasons(flagged: DataFrame) -> DataFrame:
    """Per sample: hits of every rule (they overlap), cells that fail it alone, and the cells removed, each counted once."""
    rules = [n for n, _, _ in RULES if n in flagged.columns]
    count = lambda c: F.count(F.when(c, 1))
    out = flagged.groupBy("sample").agg(
        F.count(F.lit(1)).alias("input_cells"),
        *[x for n in rules for x in (count(F.col(n)).alias(f"{n}_hits"), count(F.col(n) & (F.col("n_failed") == 1)).alias(f"{n}_only"))],
        count(F.col("n_failed") > 1).alias("multiple_conditions"),
        count(F.col("n_failed") > 0).alias("qc_removed_cells"),
        count(F.col("removed_sample")).alias("user_removed_sample_cells"),
        count(~F.col("retained")).alias("total_removed_cells"),
    )
    return out.withColumn("removed_fraction", F.col("total_removed_cells") / F.col("input_cells"))


def rule_fractions(flagged: DataFrame) -> DataFrame:
    """rule, fraction_outside: the share of the cells of samples that stay which fail the rule."""
    rules = [n for n, _, _ in RULES if n in flagged.columns]
    one = flagged.filter("NOT removed_sample").agg(*[F.avg(F.col(n).cast("double")).alias(n) for n in rules])
    return one.unpivot([], rules, "rule", "fraction_outside")


def predicted_removal(flagged: DataFrame, limit: float = 0.15) -> DataFrame:
    """Per sample and over ALL: input, cells left, cells removed, their fraction and whether it is over the limit."""
    s = flagged.filter("NOT removed_sample").rollup("sample").agg(F.grouping("sample").alias("_all"), F.count(F.lit(1)).alias("input_cells"), F.count(F.when(F.col("retained"), 1)).alias("predicted_after_qc_cells"))
    removed = F.col("input_cells") - F.col("predicted_after_qc_cells")
    return s.select(
        F.when(F.col("_all") == 1, "ALL").otherwise(F.col("sample")).alias("sample"),
        "input_cells",
        "predicted_after_qc_cells",
        removed.alias("predicted_removed_cells"),
        (removed / F.col("input_cells")).alias("predicted_removed_fraction"),
        (removed / F.col("input_cells") > limit).alias("over_limit"),
    )


def sample_summary(flagged: DataFrame, prevalence: DataFrame) -> DataFrame:
    """Per sample cells and genes before and after: the genes are those of the whole matrix."""
    genes = prevalence.agg(F.count(F.lit(1)).alias("input_genes"), F.count(F.when(F.col("retained"), 1)).alias("retained_genes")).first()
    s = flagged.groupBy("sample").agg(F.count(F.lit(1)).alias("input_cells"), F.count(F.when(F.col("retained"), 1)).alias("retained_cells"))
    s = s.withColumns({c: F.lit(genes[c]) for c in ("input_genes", "retained_genes")})
    return s.select(
        "sample",
        "input_cells",
        "retained_cells",
        (F.col("input_cells") - F.col("retained_cells")).alias("removed_cells"),
        (F.col("retained_cells") / F.col("input_cells")).alias("cell_retention"),
        "input_genes",
        "retained_genes",
        (F.col("retained_genes") / F.nullif(F.col("input_genes"), F.lit(0))).alias("gene_retention"),
    )


def filter_cells_and_genes(counts: DataFrame, flagged: DataFrame, more_than: int) -> DataFrame:
    """counts of the retained cells, then of the genes that more than so many of these have."""
    kept = counts.join(flagged.filter("retained").select("cell_id"), "cell_id", "left_semi")
    genes = kept.filter("value > 0").groupBy("gene_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > more_than)
    return kept.join(genes, "gene_id", "left_semi")


def library_sizes(flagged: DataFrame, library: str, min_cells: int) -> DataFrame:
    """Per capture library its samples, cells, cells left after quality control, and whether these are too few."""
    s = flagged.filter("NOT removed_sample").groupBy(F.col(library).alias("library_id")).agg(
        F.array_join(F.array_sort(F.collect_set("sample")), ";").alias("samples"), F.count(F.lit(1)).alias("input_cells"), F.count(F.when(F.col("retained"), 1)).alias("predicted_after_qc_cells")
    )
    return s.withColumn("low_cell", F.col("predicted_after_qc_cells") < min_cells)


def capture_libraries(cells: DataFrame, blank_allowed: bool = False) -> tuple[DataFrame, str]:
    """cells with library_id from the first complete source, and that source: library_id, capture_id or the sample.

    A column counts as a whole: an incomplete library_id is an error, an incomplete capture_id is passed over. Samples stand for
    libraries only where nothing hints at pooling and each has at most one sequencing run.
    """
    blank = lambda c: c.isNull() | (F.trim(c.cast("string")) == "")
    columns = [c for c in ("library_id", "capture_id") if c in cells.columns]
    clues = [c for c in ("source_type", "technology", "capture_layout", "pool_id") if c in cells.columns]
    seen = cells.agg(
        *[F.count(F.when(blank(F.col(c)), 1)).alias(f"blank_{c}") for c in columns],
        *[F.coalesce(F.bool_or(F.lower(F.col(c).cast("string")).rlike("pool|multiplex|demultiplex|multiple.capture")), F.lit(False)).alias(f"clue_{c}") for c in clues],
        F.lit(0).alias("_"),
    ).first()
    if "library_id" in columns:
        if seen["blank_library_id"] and not blank_allowed:
            raise ValueError("ambiguous capture libraries: library_id is incomplete")
        return cells, "library_id"
    if "capture_id" in columns and not seen["blank_capture_id"]:
        return cells.withColumn("library_id", F.col("capture_id").cast("string")), "capture_id"
    runs = 0
    if "sequencing_run" in cells.columns:
        runs = cells.groupBy("sample").agg(F.countDistinct(F.when(~blank(F.col("sequencing_run")), F.col("sequencing_run"))).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("m")).first()["m"]
    if any(seen[f"clue_{c}"] for c in clues) or runs > 1:
        raise ValueError("ambiguous capture libraries: cells are pooled or of several runs")
    return cells.withColumn("library_id", F.col("sample").cast("string")), "sample"
