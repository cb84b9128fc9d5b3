"""Doublet, cell-cycle, contamination, cluster and regression reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scquarry.functions.stats import finite, percentiles
from scquarry.functions.text import each_of
from scquarry.operators.graph import label_grid


def homotypic_proportion(cells: DataFrame, library: str, cluster: str) -> DataFrame:
    """Per library the chance that two of its cells are of one cluster: sum of squared cluster shares."""
    c = cells.groupBy(library, cluster).agg(F.count(F.lit(1)).alias("_c"))
    s = c.groupBy(library).agg(F.sum("_c").alias("n_cells"), F.sum(F.col("_c") * F.col("_c")).alias("_q"))
    return s.select(library, "n_cells", (F.col("_q") / (F.col("n_cells") * F.col("n_cells"))).alias("homotypic"))


def expected_doublets(homotypic: DataFrame, rate: float = 0.04) -> DataFrame:
    """n_exp and n_exp_adj per library: rounded half to even, the second without homotypic doublets, and whether both make sense."""
    e = homotypic.withColumn("n_exp", F.bround(F.col("n_cells") * rate, 0).cast("bigint"))
    e = e.withColumn("n_exp_adj", F.bround(F.col("n_exp") * (1 - F.col("homotypic")), 0).cast("bigint"))
    return e.withColumn("valid", (F.col("n_exp") >= 1) & (F.col("n_exp") < F.col("n_cells")) & (F.col("n_exp_adj") >= 1))


def call_doublets(scores: DataFrame, expected: DataFrame, library: str) -> DataFrame:
    """scores with df and df_adj: Doublet for the n_exp (n_exp_adj) highest pann of a library, ties to the smaller id."""
    place = F.row_number().over(W.partitionBy(library).orderBy(F.desc("pann"), "cell_id"))
    r = scores.withColumn("_p", place).join(expected.select(library, "n_exp", "n_exp_adj"), library)
    call = lambda n: F.when(F.col("_p") <= F.col(n), "Doublet").otherwise("Singlet")
    return r.withColumns({"df": call("n_exp"), "df_adj": call("n_exp_adj")}).drop("_p", "n_exp", "n_exp_adj")


def doublet_summary(called: DataFrame, library: str) -> DataFrame:
    count = lambda c: F.count(F.when(c, 1))
    n = F.count(F.lit(1))
    return called.groupBy("sample").agg(
        F.array_join(F.array_sort(F.collect_set(F.col(library).cast("string"))), ";").alias("library_ids"),
        n.alias("input_cells"),
        count(F.col("df") == "Doublet").alias("df_doublets"),
        count(F.col("df_adj") == "Doublet").alias("df_adj_doublets"),
        (count(F.col("df") == "Doublet") / n).alias("df_fraction"),
        (count(F.col("df_adj") == "Doublet") / n).alias("df_adj_fraction"),
        count(F.col("df") != F.col("df_adj")).alias("disagreements"),
        count(F.col("df_adj") == "NotEvaluated").alias("unevaluated_cells"),
    )


def accepted_singlets(called: DataFrame, kept_samples: Sequence[str] = ()) -> DataFrame:
    """Cells that df_adj calls singlets, and unevaluated ones of samples that were approved; df never filters."""
    keep = F.col("df_adj") == "Singlet"
    if kept_samples:
        keep |= (F.col("df_adj") == "NotEvaluated") & F.col("sample").isin(*kept_samples)
    return called.filter(keep)


def best_pk(sweep: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per keys the pk of the greatest finite metric, the least pk of several: only 0 < pk < 1 counts."""
    ok = sweep.filter(finite(F.col("metric")) & (F.col("pk") > 0) & (F.col("pk") < 1))
    return ok.groupBy(*keys).agg(F.max_by("pk", F.struct("metric", -F.col("pk"))).alias("pk"))


def phase_summary(cells: DataFrame) -> DataFrame:
    """Cells and their share per sample and phase, combinations without cells included."""
    g = label_grid(cells.filter("sample IS NOT NULL AND phase IS NOT NULL"), F.col("sample"), F.col("phase"))
    return g.select(F.col("a").alias("sample"), F.col("b").alias("phase"), "cells", (F.col("cells") / F.sum("cells").over(W.partitionBy("a"))).alias("fraction"))


def contamination_review(cells: DataFrame, high: float = 0.5) -> DataFrame:
    """Per sample: mean and percentiles of contamination, the cells with much of it, and the counts that were removed.

    cells: cell_id, sample, contamination, original, corrected, nfeature.
    """
    base = cells.groupBy("sample").agg(
        F.count(F.lit(1)).alias("cells"),
        F.avg("contamination").alias("mean_contamination"),
        F.count(F.when(F.col("contamination") >= high, 1)).alias("high_cells"),
        F.sum("original").alias("original_umi"),
        F.sum("corrected").alias("corrected_umi"),
        F.sum(F.col("original") - F.col("corrected")).alias("removed_umi"),
    )
    q = percentiles(cells, ["sample"], "contamination", {"median_contamination": 0.5, "p90_contamination": 0.9, "p95_contamination": 0.95, "p99_contamination": 0.99})
    much = cells.filter(F.col("contamination") >= high)
    umi = percentiles(much, ["sample"], "original", {"high_median_umi": 0.5})
    feature = percentiles(much, ["sample"], "nfeature", {"high_median_nfeature": 0.5})
    out = base.join(q, "sample", "left").join(umi, "sample", "left").join(feature, "sample", "left")
    return out.withColumn("retained_umi_fraction", F.when(F.col("original_umi") > 0, F.col("corrected_umi") / F.col("original_umi")))


def contamination_warnings(review: DataFrame, markers: DataFrame, cells: DataFrame, mean: float = 0.5, median: float = 0.5, p95: float = 0.8, retention: float = 0.2) -> DataFrame:
    """sample, category, detail of what the reviews make doubtful; nothing is removed for it."""
    a = review.filter((F.col("mean_contamination") >= mean) | (F.col("median_contamination") >= median) | (F.col("p95_contamination") >= p95))
    b = cells.filter("corrected <= 0").groupBy("sample").agg(F.count(F.lit(1)).alias("n"))
    c = markers.filter(F.col("retained_fraction") < retention)
    return (
        a.select("sample", F.lit("EXTREME_CONTAMINATION").alias("category"), F.lit("").alias("detail"))
        .union(b.select("sample", F.lit("ZERO_CORRECTED_UMI"), F.lit("")))
        .union(c.select("sample", F.lit("MARKER_LOSS"), F.col("marker").cast("string")))
    )


def _markers(markers: DataFrame, genes: DataFrame, most: int = 10_000) -> tuple[list, list]:
    """The names of a short list of markers and those of them that are genes."""
    names = sorted(r["marker"] for r in markers.filter("marker IS NOT NULL").select("marker").distinct().limit(most + 1).collect())
    if len(names) > most:
        raise ValueError("too many markers")
    return names, sorted(r["gene_id"] for r in genes.filter(F.col("gene_id").isin(names)).select("gene_id").distinct().collect())


def marker_retention(original: DataFrame, corrected: DataFrame, cells: DataFrame, markers: DataFrame, genes: DataFrame) -> DataFrame:
    """Per sample and marker: means and detection before and after correction over all cells of the sample, and what was kept.

    original, corrected: counts; markers: marker (few rows). Zeros count: numbers of cells come from cells. A marker that no
    gene has is MARKER_ABSENT with nulls.
    """
    size = cells.groupBy("sample").agg(F.count(F.lit(1)).alias("n"))
    names, known = _markers(markers, genes)
    grid = size.select("sample", "n", each_of(names, markers.schema["marker"].dataType.simpleString()).alias("marker")).withColumn("present", F.col("marker").isin(known))
    side = lambda x, v: x.filter(F.col("gene_id").isin(known)).select("cell_id", F.col("gene_id").alias("marker"), F.col("value").alias(v))
    both = side(original, "a").join(side(corrected, "b"), ["cell_id", "marker"], "full_outer").join(cells.select("cell_id", "sample"), "cell_id")
    s = both.groupBy("sample", "marker").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count(F.when(F.col("a") > 0, 1)).alias("da"), F.count(F.when(F.col("b") > 0, 1)).alias("db"))
    j = grid.join(s, ["sample", "marker"], "left")
    over = lambda c: F.when(F.col("present"), F.coalesce(F.col(c), F.lit(0)) / F.col("n"))
    return j.select(
        "sample",
        "marker",
        F.when(F.col("present"), "MEASURED").otherwise("MARKER_ABSENT").alias("status"),
        over("a").alias("mean_original"),
        over("b").alias("mean_corrected"),
        over("da").alias("detected_original"),
        over("db").alias("detected_corrected"),
        F.when(F.col("present") & (F.col("a") > 0), F.coalesce("b", F.lit(0.0)) / F.col("a")).alias("retained_fraction"),
    )


def marker_structure(data: DataFrame, assignments: DataFrame, markers: DataFrame, genes: DataFrame, value: str = "data") -> DataFrame:
    """Per cluster and marker the mean and the share of cells with it; a marker that no gene has gives one MARKER_ABSENT row."""
    size = assignments.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    names, known = _markers(markers, genes)
    kind = markers.schema["marker"].dataType.simpleString()
    x = data.filter(F.col("gene_id").isin(known)).join(assignments.select("cell_id", "cluster"), "cell_id")
    s = x.groupBy("cluster", F.col("gene_id").alias("marker")).agg(F.sum(value).alias("s"), F.count(F.when(F.col(value) > 0, 1)).alias("d"))
    grid = size.select("cluster", "n", each_of(known, kind).alias("marker")).join(s, ["cluster", "marker"], "left")
    out = grid.select("cluster", "marker", (F.coalesce("s", F.lit(0.0)) / F.col("n")).alias("mean_expression"), (F.coalesce("d", F.lit(0)) / F.col("n")).alias("fraction_detected"), F.lit("MEASURED").alias("status"))
    absent = markers.sparkSession.createDataFrame([(m,) for m in names if m not in known], f"marker {kind}")
    absent = absent.select(F.lit(None).cast(assignments.schema["cluster"].dataType).alias("cluster"), "marker", F.lit(None).cast("double").alias("mean_expression"), F.lit(None).cast("double").alias("fraction_detected"), F.lit("MARKER_ABSENT").alias("status"))
    return out.union(absent)


def cluster_sizes(assignments: DataFrame) -> DataFrame:
    c = assignments.groupBy("resolution", "cluster").agg(F.count(F.lit(1)).alias("cells"))
    return c.withColumn("fraction", F.col("cells") / F.sum("cells").over(W.partitionBy("resolution")))


def cluster_metrics(sizes: DataFrame) -> DataFrame:
    return sizes.groupBy("resolution").agg(F.count(F.lit(1)).alias("n_clusters"), F.min("cells").alias("min_cluster_cells"), F.max("fraction").alias("max_cluster_fraction"))


def cluster_composition(assignments: DataFrame, cells: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Cells per resolution, cluster and combination of fields that occurs."""
    return assignments.join(cells.select("cell_id", *fields), "cell_id").groupBy("resolution", "cluster", *fields).agg(F.count(F.lit(1)).alias("cells"))


def composition_grid(assignments: DataFrame, cells: DataFrame, fields: Sequence[str]) -> DataFrame:
    """cluster, field, value, cells for every combination of a cluster and a value of a field, zeros included."""
    j = assignments.join(cells.select("cell_id", *fields), "cell_id")
    out = None
    for f in fields:
        g = label_grid(j, F.col("cluster"), F.col(f).cast("string")).select(F.col("a").alias("cluster"), F.lit(f).alias("field"), F.col("b").alias("value"), "cells")
        out = g if out is None else out.union(g)
    return out


def transitions(assignments: DataFrame) -> DataFrame:
    """Cells per pair of clusters of adjacent resolutions: resolution_from, resolution_to, cluster_from, cluster_to, cells."""
    levels = assignments.select("resolution").distinct()
    after = levels.withColumn("resolution_to", F.lead("resolution").over(W.partitionBy(F.lit(0)).orderBy("resolution"))).filter("resolution_to IS NOT NULL")  # a few rows
    a = assignments.join(F.broadcast(after), "resolution").select("cell_id", F.col("resolution").alias("resolution_from"), "resolution_to", F.col("cluster").alias("cluster_from"))
    b = assignments.select("cell_id", F.col("resolution").alias("resolution_to"), F.col("cluster").alias("cluster_to"))
    return a.join(b, ["cell_id", "resolution_to"])


def metric_profiles(cells: DataFrame, cluster: str, metrics: Sequence[str]) -> DataFrame:
    """Per cluster and metric: cells, median, mean, p10, p90 and how far the mean is off that of all, in standard deviations."""
    long = cells.select(F.col(cluster).alias("cluster"), F.explode(F.array(*[F.struct(F.lit(m).alias("variable"), F.col(m).cast("double").alias("x")) for m in metrics])).alias("m")).select("cluster", "m.variable", "m.x").filter(finite(F.col("x")))
    total = long.groupBy("variable").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"))
    g = long.groupBy("cluster", "variable").agg(F.count(F.lit(1)).alias("cells"), F.avg("x").alias("mean"))
    q = percentiles(long, ["cluster", "variable"], "x", {"median": 0.5, "p10": 0.1, "p90": 0.9})
    out = g.join(q, ["cluster", "variable"]).join(F.broadcast(total), "variable")
    return out.select("cluster", "variable", "cells", "median", "mean", "p10", "p90", F.when(F.col("s") > 0, (F.col("mean") - F.col("m")) / F.col("s")).alias("standardized_mean_shift"))


def recommendation(df: DataFrame, similar_ari: float = 0.9, similar_subspace: float = 0.9, tolerance: float = 0.05) -> DataFrame:
    """df (ari, overlap, before, after) with what a comparison suggests."""
    same = (F.col("ari") >= similar_ari) & (F.col("overlap") >= similar_subspace)
    no_gain = finite(F.col("before")) & finite(F.col("after")) & (F.col("after") >= F.col("before") - tolerance)
    return df.withColumn("recommendation", F.when(same, "SIMILAR_RESULTS").when(no_gain, "BASELINE_PREFERRED").otherwise("USER_REVIEW_REQUIRED"))


def final_diagnostics(data: DataFrame, assignments: DataFrame, cells: DataFrame, genes: DataFrame, markers: DataFrame, resolution: float, fields: Sequence[str] = ("sample", "grp", "phase"), metrics: Sequence[str] = ("ncount", "nfeature", "pmt", "s_score", "g2m_score")) -> dict[str, DataFrame]:
    """Tables on the clusters of the chosen resolution: markers (marker, status), structure (cluster, marker, mean, share of cells with it),
    sizes, composition (cluster, field, value, cells) and distributions (cluster, metric profiles). Fields and metrics that cells lack
    are left out."""
    chosen = assignments.filter(F.abs(F.col("resolution") - float(resolution)) < 1e-10).select("cell_id", "resolution", "cluster")
    names, known = _markers(markers, genes)
    status = markers.sparkSession.createDataFrame([(m, "MEASURED" if m in known else "MARKER_ABSENT") for m in names], f"marker {markers.schema['marker'].dataType.simpleString()}, status string")
    have = [c for c in metrics if c in cells.columns]
    return {
        "markers": status,
        "structure": marker_structure(data, chosen, markers, genes),
        "sizes": cluster_sizes(chosen).select("cluster", "cells", "fraction"),
        "composition": composition_grid(chosen, cells, [f for f in fields if f in cells.columns]),
        "distributions": metric_profiles(cells.join(chosen.select("cell_id", "cluster"), "cell_id"), "cluster", have),
    }
