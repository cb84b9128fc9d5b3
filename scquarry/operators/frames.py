"""The data behind figures: limits, panels, violins, overlays. Nothing is drawn here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Panels of one page, margin around an embedding, and the order of metrics in violins.
PANELS, MARGIN = 9, 0.03
METRICS = ("nfeature", "ncount", "pmt", "prp", "phb")
#: Figure sizes in inches by kind, resolution in dots per inch, point sizes by number of cells.
SIZES = {"umap": (8, 6), "violin": (12, 6), "diagnostics": (12, 9), "clustering_grid": (15, 12)}
DPI = 300
POINT_SIZES = ((1_000, 1.0), (10_000, 0.5), (50_000, 0.2), (None, 0.05))


def point_size(n_cells: int) -> float:
    return next(s for n, s in POINT_SIZES if n is None or n_cells <= n)


def limits(points: DataFrame, x: str = "x", y: str = "y", margin: float = MARGIN) -> DataFrame:
    """One row of the ranges of an embedding, widened by the margin on either side."""
    pad = lambda c: margin * (F.max(c) - F.min(c))
    return points.agg(*[e for c in (x, y) for e in ((F.min(c) - pad(c)).alias(f"{c}_lower"), (F.max(c) + pad(c)).alias(f"{c}_upper"))])


def violins(cells: DataFrame, metrics: Sequence[str] = METRICS, stage: str = "before") -> DataFrame:
    """sample, metric, place (the metric's in its fixed order), value, stage; metrics that are missing are left out."""
    have = [m for m in metrics if m in cells.columns]
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(i).alias("place"), F.col(m).cast("double").alias("value")) for i, m in enumerate(have)])).alias("m")
    return cells.select("sample", each).select("sample", "m.*", F.lit(stage).alias("stage"))


def panel(points: DataFrame, cells: DataFrame, field: str, last: str | None = None) -> DataFrame:
    """x, y and a field of the cells, with the order of drawing: cells whose field is last come on top."""
    out = points.select("cell_id", "x", "y").join(cells.select("cell_id", F.col(field).cast("string").alias("value")), "cell_id")
    return out.withColumn("drawn", (F.col("value") == last).cast("int") if last is not None else F.lit(0))


def subset_panel(points: DataFrame, kept: DataFrame) -> DataFrame:
    """The points of the kept cells exactly as they were: an embedding is never fitted anew for a part of its cells."""
    return points.join(kept.select("cell_id"), "cell_id", "left_semi")


def pages(names: Sequence[str], per_page: int = PANELS) -> list[list[str]]:
    return [list(names[i : i + per_page]) for i in range(0, len(names), per_page)]


def elbow(spectrum: DataFrame, pc_used: int) -> DataFrame:
    """pc, stdev, its share and cumulative share, explained variance and whether the component is used; one spectrum."""
    w, run = W.partitionBy(F.lit(0)), W.partitionBy(F.lit(0)).orderBy("pc").rowsBetween(W.unboundedPreceding, 0)
    s = spectrum.withColumn("sd_share", F.col("stdev") * 100 / F.sum("stdev").over(w)).withColumn("variance_explained", F.pow("stdev", F.lit(2)) * 100 / F.sum(F.pow("stdev", F.lit(2))).over(w))
    return s.withColumns({"cumulative_sd_share": F.sum("sd_share").over(run), "cumulative_variance": F.sum("variance_explained").over(run), "selected": F.col("pc") <= pc_used})


def correction_scatter(cells: DataFrame) -> DataFrame:
    """Counts before and after correction and whether contamination is high."""
    return cells.select("cell_id", "sample", "original", "corrected", F.when(F.col("contamination") >= 0.5, "High estimate").otherwise("Other").alias("stratum"))


def tree(transitions: DataFrame) -> DataFrame:
    """Edges of the cluster tree: cells of every pair of clusters of adjacent resolutions, and their share of either."""
    c = transitions.groupBy("resolution_from", "resolution_to", "cluster_from", "cluster_to").agg(F.count(F.lit(1)).alias("cells"))
    out = F.col("cells") / F.sum("cells").over(W.partitionBy("resolution_from", "resolution_to", "cluster_from"))
    into = F.col("cells") / F.sum("cells").over(W.partitionBy("resolution_from", "resolution_to", "cluster_to"))
    return c.withColumns({"share_out": out, "share_in": into})


def cycle_panels(points: DataFrame, cells: DataFrame) -> DataFrame:
    """x, y of the cells with their phase and both cycle scores, one row per cell and panel: panel, label, value."""
    j = points.select("cell_id", "x", "y").join(cells.select("cell_id", "phase", "s_score", "g2m_score"), "cell_id")
    panels = [F.struct(F.lit("phase").alias("panel"), F.col("phase").alias("label"), F.lit(None).cast("double").alias("value"))]
    panels += [F.struct(F.lit(c).alias("panel"), F.lit(None).cast("string").alias("label"), F.col(c).cast("double").alias("value")) for c in ("s_score", "g2m_score")]
    return j.select("cell_id", "x", "y", F.explode(F.array(*panels)).alias("p")).select("cell_id", "x", "y", "p.*")


def before_and_after(before: DataFrame, after: DataFrame, cells: DataFrame, fields: Sequence[str]) -> DataFrame:
    """x, y of two layouts of the same cells with the labels of fields: stage, cell_id, x, y, field, value; missing fields are left out."""
    have = [f for f in fields if f in cells.columns]
    long = cells.select("cell_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in have])).alias("l")).select("cell_id", "l.*")
    both = before.select(F.lit("before").alias("stage"), "cell_id", "x", "y").union(after.select(F.lit("after").alias("stage"), "cell_id", "x", "y"))
    return both.join(long, "cell_id").select("stage", "cell_id", "x", "y", "field", "value")


def dot_plot(structure: DataFrame) -> DataFrame:
    """Dots of measured markers: cluster, marker, size (percent of cells with it), colour (mean, standardized over clusters, within 2.5)."""
    w = W.partitionBy("marker")
    z = (F.col("mean_expression") - F.avg("mean_expression").over(w)) / F.nullif(F.stddev_samp("mean_expression").over(w), F.lit(0.0))
    return structure.filter("status = 'MEASURED'").select("cluster", "marker", (F.col("fraction_detected") * 100).alias("size"), F.greatest(F.lit(-2.5), F.least(F.lit(2.5), F.coalesce(z, F.lit(0.0)))).alias("colour"))
