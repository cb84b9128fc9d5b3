"""The two workflows as compositions of the operators: quality control and formal analysis of one dataset."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scquarry.functions import stats
from scquarry.kernels import ambient, communities, components, doublets, integration, layout
from scquarry.operators import checks, graph, matrix, quality, review
from scquarry.session import materialize


@dataclass
class Settings:
    """The defaults of the workflows."""

    thresholds: dict = field(default_factory=lambda: {"nfeature_min": 200, "nfeature_max": 4000, "ncount_min": 500, "ncount_max": 30000, "pmt_max": 25, "phb_max": 1, "prp_max": 100})
    gene_cells: int = 3
    doublet_min_cells: int = 100
    doublet_rate: float = 0.04
    variable_genes: int = 2000
    max_pcs: int = 50
    neighbours: int = 20
    resolutions: tuple = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0, 1.2)
    risk_correlation: float = 0.5
    seed: int = 42


def quality_control(
    counts: DataFrame,
    cells: DataFrame,
    genes: DataFrame,
    families: dict[str, str],
    settings: Settings | None = None,
    removed_samples: tuple[str, ...] = (),
    kept_samples: tuple[str, ...] = (),
    score_doublets: Callable = doublets.doublet_scores,
    correct: Callable = ambient.correct_counts,
    observe: Callable[[str, DataFrame], None] = lambda name, df: None,
) -> dict[str, DataFrame]:
    """Metrics, filters, doublets and contamination: the tables of all three steps by name.

    counts: cell_id, gene_id, value; cells: cell_id, sample, library_id, cluster (any grouping of cells for the homotypic share);
    genes: gene_id and the flags of families. Libraries below doublet_min_cells are not evaluated: their cells stay only if their
    sample is among kept_samples. score_doublets and correct stand for other kernels with the same arguments and columns; observe
    is told of each step's table by name.
    """
    s = settings or Settings()
    flags = genes.select("gene_id", *families.values())
    metrics = matrix.cell_totals(counts.join(flags, "gene_id"), cells, families)
    flagged = materialize(quality.flag_cells(metrics, s.thresholds, removed_samples), "flagged")
    observe("flagged", flagged)
    if lost := checks.emptied_samples(flagged):
        raise ValueError("the rules leave no cells of samples: " + ", ".join(map(str, lost)))
    retained = flagged.filter("retained")
    prevalence = materialize(matrix.gene_prevalence(counts, genes, s.gene_cells, retained), "prevalence")
    kept = materialize(quality.filter_cells_and_genes(counts, flagged, s.gene_cells), "kept")
    scores = materialize(score_doublets(kept, retained.select("cell_id", "library_id"), min_cells=s.doublet_min_cells, seed=s.seed), "scores")
    expected = review.expected_doublets(review.homotypic_proportion(retained, "library_id", "cluster"), s.doublet_rate)
    called = review.call_doublets(scores, expected, "library_id").select("cell_id", "pann", "df", "df_adj")
    called = retained.join(called, "cell_id", "left").withColumns({c: F.coalesce(c, F.lit("NotEvaluated")) for c in ("df", "df_adj")})
    called = materialize(called, "called")
    observe("called", called)
    singlets = review.accepted_singlets(called, kept_samples)
    single = materialize(kept.join(singlets.select("cell_id"), "cell_id", "left_semi"), "singlets")
    corrected = materialize(correct(single, singlets.select("cell_id", "library_id", "cluster")), "corrected")
    observe("corrected", corrected)
    after = corrected.groupBy("cell_id").agg(F.sum("value").alias("corrected"), F.first("contamination").alias("contamination"))
    review_cells = singlets.join(after, "cell_id").withColumnRenamed("ncount", "original")
    return {
        "cells": flagged,
        "reasons": quality.filter_reasons(flagged),
        "samples": quality.sample_summary(flagged, prevalence),
        "genes": prevalence,
        "doublets": review.doublet_summary(called, "library_id"),
        "contamination": review.contamination_review(review_cells),
        "final_cells": singlets,
        "counts": single,
        "corrected": corrected.select("cell_id", "gene_id", "value"),
    }


def formal_analysis(counts: DataFrame, cells: DataFrame, batch: str | None, settings: Settings | None = None, regress: str = "pmt") -> dict[str, DataFrame]:
    """Components, their selection and association with metrics, design, integration, neighbours, clusters and their stability.

    cells: cell_id, sample, grp, ncount, the covariate and any metrics. Integration runs where the design allows it.
    """
    s = settings or Settings()
    spark = counts.sparkSession
    scores, stdev, _ = components.formal_pca(counts, cells, regress, s.variable_genes, s.max_pcs)
    scores = materialize(scores, "pca")
    spectrum = spark.createDataFrame([(1, i + 1, float(v)) for i, v in enumerate(stdev)], "k int, pc int, stdev double")
    selection = stats.pc_selection(spectrum, ["k"], max_pc=s.max_pcs).drop("k")
    used = selection.first()["pc_used"]
    metrics = [c for c in ("pmt", "ncount", "nfeature", "s_score", "g2m_score") if c in cells.columns]
    long = cells.select("cell_id", *[F.col(c).cast("double").alias(c) for c in metrics]).unpivot("cell_id", metrics, "variable", "x")
    each = scores.select("cell_id", F.posexplode("vec").alias("pc", "y")).withColumn("pc", F.col("pc") + 1)
    associations = stats.spearman(each.join(long, "cell_id"), ["variable", "pc"], "x", "y")
    associations = associations.withColumn("risk", F.coalesce((F.col("pc") <= used) & (F.abs("rho") >= s.risk_correlation), F.lit(False)))
    vectors = scores.select("cell_id", F.slice("vec", 1, used).alias("vec"))
    fields = [f for f in ("sample", "batch", "library_id", "sequencing_run") if f in cells.columns]
    design = graph.batch_design(cells, fields, "grp", batch, [batch] if batch and batch != "sample" else [])
    eligible = design.filter("selected AND decision = 'ELIGIBLE'").count() > 0
    chosen = materialize(integration.integrate(vectors, cells, batch, seed=s.seed), "integrated") if eligible else vectors
    nn = materialize(graph.neighbour_graph(chosen, s.neighbours), "nn")
    nn_before = materialize(graph.neighbour_graph(vectors, s.neighbours), "nn") if eligible else nn
    snn = materialize(graph.shared_neighbours(nn), "snn")
    clusters = materialize(communities.communities(snn, chosen.select("cell_id"), list(s.resolutions), s.seed), "clusters")
    sizes = review.cluster_sizes(clusters)
    return {
        "scores": scores,
        "spectrum": spectrum.drop("k"),
        "selection": selection,
        "associations": associations,
        "design": design,
        "representation": chosen,
        "layout": layout.umap_layout(chosen, seed=s.seed),
        "layout_before": layout.umap_layout(vectors, seed=s.seed),
        "nn": nn,
        "snn": snn,
        "mixing_before": graph.same_label_fraction(nn_before, cells, [f for f in ("sample", "grp", "batch") if f in cells.columns]),
        "mixing": graph.same_label_fraction(nn, cells, [f for f in ("sample", "grp", "batch") if f in cells.columns]),
        "clusters": clusters,
        "cluster_sizes": sizes,
        "cluster_metrics": review.cluster_metrics(sizes),
        "stability": stats.adjusted_rand(review.transitions(clusters), ["resolution_from", "resolution_to"], "cluster_from", "cluster_to"),
        "cluster_associations": stats.eta_squared(clusters.join(long, "cell_id"), ["resolution", "variable"], "cluster", "x"),
    }


def regression_review(counts: DataFrame, cells: DataFrame, baseline: dict[str, DataFrame], target: str, resolution: float, settings: Settings | None = None) -> DataFrame:
    """One row that compares the baseline with an analysis that also regresses target: status, ari, overlap, before, after, recommendation.

    Nothing is recomputed without a risk: an association of target with a used component, or with clusters.
    """
    s = settings or Settings()
    spark = counts.sparkSession
    risk = baseline["associations"].filter((F.col("variable") == target) & F.col("risk")).count() > 0
    eta = baseline["cluster_associations"].filter((F.col("variable") == target) & (F.abs(F.col("resolution") - resolution) < 1e-10)).first()
    before = eta["eta_squared"] if eta else None
    schema = "target string, status string, ari double, overlap double, before double, after double"
    if target not in cells.columns:
        return review.recommendation(spark.createDataFrame([(target, "SKIPPED_MISSING_METADATA", None, None, before, None)], schema)).withColumn("recommendation", F.lit("BASELINE_PREFERRED"))
    if not risk and (before or 0) < 0.5:
        return review.recommendation(spark.createDataFrame([(target, "SKIPPED_NO_CLEAR_RISK", None, None, before, None)], schema)).withColumn("recommendation", F.lit("BASELINE_PREFERRED"))
    used = baseline["selection"].first()["pc_used"]
    n = cells.count()
    genes = materialize(components.variable_genes(counts, n, s.variable_genes), "hvg")
    width = genes.count()
    covariates = tuple(dict.fromkeys(["pmt", target]))
    rows = materialize(components.cell_rows(matrix.log_normalize(counts, cells), genes, cells.select("cell_id", *covariates)), "cells")
    other, _, _ = components.principal_components(rows, width, max(2, stats.pc_cap(s.max_pcs, n, width, width + 1)), covariates)
    other = materialize(other, "other")
    vectors = other.select("cell_id", F.slice("vec", 1, used).alias("vec"))
    snn = graph.shared_neighbours(graph.neighbour_graph(vectors, s.neighbours))
    after = materialize(communities.communities(snn, vectors.select("cell_id"), [resolution], s.seed), "after")
    both = baseline["clusters"].filter(F.abs(F.col("resolution") - resolution) < 1e-10).select("cell_id", F.col("cluster").alias("a")).join(after.select("cell_id", F.col("cluster").alias("b")), "cell_id").withColumn("k", F.lit(1))
    ari = stats.adjusted_rand(both, ["k"], "a", "b").first()["ari"]
    overlap = components.subspace_overlap(baseline["scores"], other, used)
    e = stats.eta_squared(after.join(cells.select("cell_id", F.col(target).cast("double").alias("x")), "cell_id"), ["resolution"], "cluster", "x").first()
    return review.recommendation(spark.createDataFrame([(target, "COMPLETE", float(ari), float(overlap), before, e["eta_squared"] if e else None)], schema))
