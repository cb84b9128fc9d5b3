"""Queries on the iterative kernels: checked by their invariants in the tests, without SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry import model
from scquarry.kernels import ambient, communities, components, doublets, integration, layout, scores
from scquarry.operators import graph, matrix, review
from scquarry.plans.common import rounded
from scquarry.plans.graphs import K, neighbours
from scquarry.plans.qc import metrics
from scquarry.plans.statistics import vector_cells, vectors
from scquarry.session import materialize, sent_if_small, table
from scquarry.streaming.totals import running_totals

RESOLUTIONS = [0.2, 0.5, 1.0]


def formal_pca(s: SparkSession, d: str) -> tuple:
    """Scores, standard deviations and loadings; the matrix is made once, by genes, for the metrics and for the components."""
    counts = materialize(model.counts(s, d, "gene_id"), "counts")
    return components.formal_pca(counts, materialize(metrics(s, d, counts), "metrics"))


def pca_spectrum(s: SparkSession, d: str) -> DataFrame:
    _, stdev, _ = formal_pca(s, d)
    return s.createDataFrame([(i + 1, float(v)) for i, v in enumerate(stdev)], "pc int, stdev double")


def pca_embedding(s: SparkSession, d: str) -> DataFrame:
    return formal_pca(s, d)[0]


def libraries(s: SparkSession, d: str) -> DataFrame:
    return model.cells(s, d).select("cell_id", F.col("batch").alias("library_id"), F.col("grp").alias("cluster"))


def module_scores(s: SparkSession, d: str) -> DataFrame:
    """Two families of parts stand in for the genes of the phases."""
    genes = model.genes(s, d)
    sets = genes.filter("fam_hb").select(F.lit("S").alias("set_name"), "gene_id").union(genes.filter("gene_id % 40 = 11").select(F.lit("G2M"), "gene_id"))
    counts = materialize(model.counts(s, d, "cell_id"), "counts")  # made once, by cells, for the metrics and the scores
    data = matrix.log_normalize(counts, sent_if_small(materialize(metrics(s, d, counts), "metrics").select("cell_id", "ncount")))
    n = [r["count"] for r in sets.groupBy("set_name").count().collect()]
    return scores.cycle_phase(scores.module_scores(data, model.cells(s, d), genes, sets, scores.control_size(n, genes.count())))


def clusters(s: SparkSession, d: str) -> DataFrame:
    edges = materialize(graph.shared_neighbours(neighbours(s, d)), "snn")
    return communities.communities(edges, vectors(s, d).select("cell_id"), RESOLUTIONS)


def overlap(s: SparkSession, d: str) -> DataFrame:
    """The vectors against themselves with one half of the dimensions mixed: a share of the space of the first 16 is kept."""
    v = vectors(s, d)
    mixed = v.select("cell_id", F.concat(F.slice("vec", 1, 8), F.slice("vec", 33, 8)).alias("vec"))
    return s.createDataFrame([(16, components.subspace_overlap(v, mixed, 16))], "components int, overlap double")


def indexed_neighbours(s: SparkSession, d: str) -> DataFrame:
    """Neighbours by the inverted file as the pipeline sets it, of every vector whose id is divisible by 50, against all."""
    v = vectors(s, d)
    return graph.nearest_indexed(v, K, queries=v.filter("cell_id % 50 = 0"))


QUERIES = {
    "hvg_vst": lambda s, d: components.variable_genes(model.counts(s, d, "gene_id"), model.cells(s, d).count()),
    "pca_spectrum": pca_spectrum,
    "pca_embedding": pca_embedding,
    "doublet_pann": lambda s, d: doublets.doublet_scores(model.counts(s, d, "cell_id"), libraries(s, d)),
    "doublet_calls": lambda s, d: review.call_doublets(
        materialize(doublets.doublet_scores(model.counts(s, d, "cell_id"), libraries(s, d)), "pann"), review.expected_doublets(review.homotypic_proportion(libraries(s, d), "library_id", "cluster")), "library_id"
    ),
    "module_scores": module_scores,
    "ambient_em": lambda s, d: ambient.correct_counts(model.counts(s, d), libraries(s, d)),
    "harmony_embedding": lambda s, d: integration.integrate(vectors(s, d), vector_cells(s, d), "sample"),
    "louvain_clusters": clusters,
    "subspace_overlap": overlap,
    "umap_layout": lambda s, d: layout.umap_layout(vectors(s, d)),
    "pca_layout": lambda s, d: components.layout(pca_embedding(s, d)),
    "knn_indexed": indexed_neighbours,
    "event_totals": lambda s, d: rounded(running_totals(table(s, d, "events").select(F.col("user_id").alias("cell_id"), "value")), 4),
}
SQL = {"event_totals": "SELECT user_id AS cell_id, round(sum(value), 4) AS ncount, count(*) FILTER (value > 0) AS nfeature FROM events GROUP BY 1"}
