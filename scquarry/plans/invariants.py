"""Queries on what must hold of the iterative kernels' results, whatever way they take: these can be said in SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry import model
from scquarry.kernels import ambient, communities, components, doublets, integration, layout
from scquarry.kernels.sums import matrix_of, partial_sums
from scquarry.operators import graph, matrix, review
from scquarry.plans import kernels
from scquarry.plans.graphs import neighbours
from scquarry.plans.statistics import vector_cells, vectors
from scquarry.session import materialize

MIN_CELLS = 30


def hvg_check(s: SparkSession, d: str) -> DataFrame:
    """Genes chosen, their places, and how many have other moments than the matrix, or a greater variance than the one before."""
    from pyspark.sql import Window as W

    counts, n = materialize(model.counts(s, d, "gene_id"), "counts"), model.cells(s, d).count()
    got = materialize(components.variable_genes(counts, n), "hvg")
    exact = matrix.gene_moments(counts, "value", F.lit(n)).select("gene_id", F.col("mean").alias("m"), F.col("variance").alias("v"))
    other = got.join(exact, "gene_id", "left").filter(~F.coalesce((F.abs(F.col("mean") - F.col("m")) < 1e-9) & (F.abs(F.col("variance") - F.col("v")) < 1e-9), F.lit(False))).count()
    rising = got.withColumn("before", F.lag("standardized_variance").over(W.orderBy("place"))).filter("standardized_variance > before").count()
    return got.agg(F.count(F.lit(1)).alias("genes"), F.countDistinct("place").alias("places"), F.max("place").cast("bigint").alias("last_place")).withColumns({"other_moments": F.lit(other), "out_of_order": F.lit(rising)})


def pca_check(s: SparkSession, d: str) -> DataFrame:
    """Components of all variable genes: cells, components, and whether scores are centred, uncorrelated and spread as stated, loadings orthonormal."""
    scores, stdev, loadings = kernels.formal_pca(s, d)

    def moments(b):
        x = matrix_of(b.column(b.schema.names.index("vec")), b.num_rows)
        return [0, 1, 2], [(x.T @ x).ravel(), x.sum(axis=0), [b.num_rows]]

    got = partial_sums(scores, moments)
    n, k = int(got[2][0]), len(stdev)
    mean = got[1] / n
    cov = (got[0].reshape(k, k) - n * np.outer(mean, mean)) / (n - 1)
    size = stdev.max()
    rows = [(n, k, bool(np.abs(mean).max() < 1e-6 * size), bool(np.abs(cov - np.diag(stdev**2)).max() < 1e-6 * size**2), bool(np.abs(loadings.T @ loadings - np.eye(k)).max() < 1e-8), bool((np.diff(stdev) <= 1e-9).all()))]
    return s.createDataFrame(rows, "cells bigint, components int, centred boolean, uncorrelated boolean, orthonormal boolean, falling boolean")


def doublet_check(s: SparkSession, d: str) -> DataFrame:
    """Per library with enough cells: cells scored, scores that are no shares, and the doublets called with and without homotypic ones."""
    lib = kernels.libraries(s, d)
    scores = materialize(doublets.doublet_scores(model.counts(s, d, "cell_id"), lib, min_cells=MIN_CELLS), "pann")
    expected = review.expected_doublets(review.homotypic_proportion(lib, "library_id", "cluster"))
    called = review.call_doublets(scores, expected, "library_id")
    count = lambda c: F.count(F.when(c, 1))
    return called.groupBy("library_id").agg(
        F.count(F.lit(1)).alias("cells"), count(~F.coalesce(F.col("pann").between(0, 1), F.lit(False))).alias("no_share"), F.countDistinct("pk").alias("neighbourhoods"), count(F.col("df") == "Doublet").alias("df"), count(F.col("df_adj") == "Doublet").alias("df_adj")
    )


def ambient_check(s: SparkSession, d: str) -> DataFrame:
    """Per library: entries and counts before, entries after, values outside 0 and the count, contaminations outside 0 and 1, cells whose
    corrected counts and contamination don't add up to what they had."""
    lib = kernels.libraries(s, d)
    got = materialize(ambient.correct_counts(model.counts(s, d), lib), "corrected")
    j = model.counts(s, d).withColumnRenamed("value", "original").join(lib.select("cell_id", "library_id"), "cell_id").join(got, ["cell_id", "gene_id"], "left")
    each = j.groupBy("library_id", "cell_id").agg(F.sum("original").alias("before"), F.sum("value").alias("after"), F.max("contamination").alias("c"))
    lost = each.groupBy("library_id").agg(F.count(F.when(~F.coalesce(F.abs(F.col("after") - (1 - F.col("c")) * F.col("before")) <= 1e-6 * F.col("before"), F.lit(False)), 1)).alias("other_mass"))
    count = lambda c: F.count(F.when(~F.coalesce(c, F.lit(False)), 1))
    a = j.groupBy("library_id").agg(
        F.count(F.lit(1)).alias("entries"), F.sum("original").alias("original"), F.count("value").alias("corrected_entries"), count((F.col("value") >= 0) & (F.col("value") <= F.col("original") + 1e-9)).alias("out_of_range"), count(F.col("contamination").between(0, 1)).alias("no_share")
    )
    return a.join(lost, "library_id")


def phase_check(s: SparkSession, d: str) -> DataFrame:
    """Cells with scores, scores that are no numbers, and phases other than the scores make them."""
    p = kernels.module_scores(s, d)
    a, b = F.col("s_score"), F.col("g2m_score")
    want = F.when((a < 0) & (b < 0), "G1").when(a == b, "Undecided").when(a > b, "S").otherwise("G2M")
    return p.agg(F.count(F.lit(1)).alias("cells"), F.count(F.when(a.isNull() | b.isNull() | F.isnan(a) | F.isnan(b), 1)).alias("no_scores"), F.count(F.when(F.col("phase") != want, 1)).alias("other_phase"))


def integration_check(s: SparkSession, d: str) -> DataFrame:
    """Cells, those with a vector of another length or no finite one, and whether samples are nearer to one another than before."""
    v, cells = vectors(s, d), vector_cells(s, d)
    got = materialize(integration.integrate(v, cells, "sample"), "integrated")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def spread(df: DataFrame) -> float:
        """Sum over dimensions of the variance of the samples' means."""
        long = df.join(cells.select("cell_id", "sample"), "cell_id").filter("sample IS NOT NULL").select("sample", F.posexplode("vec").alias("i", "x"))
        return long.groupBy("sample", "i").agg(F.avg("x").alias("m")).groupBy("i").agg(F.var_pop("m").alias("v")).agg(F.sum("v").alias("t")).first()["t"]

    nearer = spread(got) <= spread(v) + 1e-12
    return got.agg(F.count(F.lit(1)).alias("cells"), F.countDistinct("cell_id").alias("ids"), F.count(F.when(F.size("vec") != 64, 1)).alias("other_length"), F.count(F.when(bad, 1)).alias("not_finite"), F.lit(nearer).alias("nearer"))


def community_check(s: SparkSession, d: str) -> DataFrame:
    """Per resolution: cells, each in one cluster, and whether the clusters hold no fewer edges than chance (one cluster: as many)."""
    edges = materialize(graph.shared_neighbours(neighbours(s, d)), "snn")
    got = materialize(communities.communities(edges, vectors(s, d).select("cell_id"), kernels.RESOLUTIONS), "clusters")
    m = communities.modularity(edges, got).select("resolution", (F.col("modularity") > -1e-9).alias("above_chance"))
    return got.groupBy("resolution").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("cell_id").alias("cells"), F.count(F.when(F.col("cluster").isNull(), 1)).alias("without")).join(m, "resolution")


def layout_check(s: SparkSession, d: str) -> DataFrame:
    """Cells with a place, those without a finite one, and whether neighbours in the plane are nearer in the vectors than other cells."""
    v = vectors(s, d)
    got = materialize(layout.umap_layout(v), "layout")
    plane = graph.nearest(got.filter("cell_id % 50 = 0").select("cell_id", F.array("x", "y").alias("vec")), got.select("cell_id", F.array("x", "y").alias("vec")), 15)
    dist = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x))
    at = lambda c: v.select(F.col("cell_id").alias(c), F.col("vec").cast("array<double>").alias(f"v_{c}"))
    near = plane.select("src", "dst").join(at("src"), "src").join(at("dst"), "dst").agg(F.avg(dist("v_src", "v_dst")).alias("d")).first()["d"]
    ids = got.select("cell_id", F.row_number().over(_order("cell_id")).alias("n"))
    pairs = ids.select(F.col("cell_id").alias("src"), "n").join(ids.select(F.col("cell_id").alias("dst"), (F.col("n") - 1).alias("n")), "n")
    other = pairs.join(at("src"), "src").join(at("dst"), "dst").agg(F.avg(dist("v_src", "v_dst")).alias("d")).first()["d"]
    finite = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    return got.agg(F.count(F.lit(1)).alias("cells"), F.countDistinct("cell_id").alias("ids"), F.count(F.when(~finite, 1)).alias("not_finite"), F.lit(near < other).alias("nearer"))


def recall_check(s: SparkSession, d: str) -> DataFrame:
    """Queries of the inverted file, and whether it finds the stated share of their true neighbours."""
    v = vectors(s, d)
    asked = v.filter("cell_id % 50 = 0")
    true = graph.nearest(asked, v, kernels.K).select("src", "dst")
    hit = true.join(graph.nearest_indexed(v, kernels.K, queries=asked).select("src", "dst"), ["src", "dst"], "left_semi").count()
    return s.createDataFrame([(asked.count(), hit >= graph.RECALL * true.count())], "queries bigint, reached boolean")


def overlap_check(s: SparkSession, d: str) -> DataFrame:
    """The overlap of a space with itself in another basis, and whether those with other spaces are shares."""
    v = vectors(s, d)
    turned = v.select("cell_id", F.transform(F.reverse(F.slice("vec", 1, 16)), lambda x: x * 3.0).alias("vec"))
    other = v.select("cell_id", F.slice("vec", 20, 16).alias("vec"))
    x = components.subspace_overlap(v, other, 16)
    return s.createDataFrame([(round(components.subspace_overlap(v, turned, 16), 6), 0 <= x < 1)], "same double, other boolean")


def _order(column: str):
    from pyspark.sql import Window as W

    return W.partitionBy(F.lit(0)).orderBy(F.xxhash64(column))


QUERIES = {
    "hvg_check": hvg_check,
    "pca_check": pca_check,
    "doublet_check": doublet_check,
    "ambient_check": ambient_check,
    "phase_check": phase_check,
    "integration_check": integration_check,
    "community_check": community_check,
    "layout_check": layout_check,
    "recall_check": recall_check,
    "overlap_check": overlap_check,
}

_C, _S = model.SQL_COUNTS, model.SQL_CELLS
_N = "(SELECT count(*) FROM embeddings)"

SQL = {
    "hvg_check": f"""WITH {_C}, n AS (SELECT count(*) AS n FROM customer), m AS (SELECT gene_id, sum(value) / n AS mean, sum(value * value) AS q, n FROM counts, n GROUP BY gene_id, n),
g AS (SELECT least(2000, count(*)) AS k FROM m WHERE q - n * mean * mean > 0 AND mean > 0) SELECT k AS genes, k AS places, k AS last_place, 0 AS other_moments, 0 AS out_of_order FROM g""",
    "pca_check": f"WITH {model.SQL_METRICS} SELECT count(*) AS cells, 50 AS components, true AS centred, true AS uncorrelated, true AS orthonormal, true AS falling FROM metrics WHERE pmt IS NOT NULL",
    "doublet_check": f"""WITH {_C}, {_S}, b AS (SELECT batch, count(*) AS n FROM cells GROUP BY 1 HAVING count(*) >= {MIN_CELLS}),
h AS (SELECT batch, sum(c * c) / (sum(c) * sum(c)) AS p FROM (SELECT batch, grp, count(*)::DOUBLE AS c FROM cells GROUP BY 1, 2) GROUP BY 1),
x AS (SELECT batch, count(DISTINCT cell_id) AS cells FROM cells WHERE cell_id IN (SELECT cell_id FROM counts WHERE value > 0) GROUP BY 1), e AS (SELECT b.batch, x.cells, round_even(b.n * 0.04, 0) AS e, p FROM b JOIN x USING (batch) JOIN h USING (batch))
SELECT batch AS library_id, cells, 0 AS no_share, 1 AS neighbourhoods, e::BIGINT AS df, round_even(e * (1 - p), 0)::BIGINT AS df_adj FROM e""",
    "ambient_check": f"""WITH {_C}, {_S} SELECT batch AS library_id, count(*) AS entries, sum(value) AS original, count(*) AS corrected_entries, 0 AS out_of_range, 0 AS no_share, 0 AS other_mass
FROM counts JOIN cells USING (cell_id) GROUP BY 1""",
    "phase_check": "SELECT count(*) AS cells, 0 AS no_scores, 0 AS other_phase FROM customer",
    "integration_check": f"SELECT {_N} AS cells, {_N} AS ids, 0 AS other_length, 0 AS not_finite, true AS nearer",
    "community_check": f"SELECT unnest({kernels.RESOLUTIONS})::DOUBLE AS resolution, {_N} AS rows, {_N} AS cells, 0 AS without, true AS above_chance",
    "layout_check": f"SELECT {_N} AS cells, {_N} AS ids, 0 AS not_finite, true AS nearer",
    "recall_check": "SELECT count(*) AS queries, true AS reached FROM embeddings WHERE vec_id % 50 = 0",
    "overlap_check": "SELECT 1.0::DOUBLE AS same, true AS other",
}
