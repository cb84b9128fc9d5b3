"""Queries on neighbours, shared neighbours, batch design, clusters and markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry import model
from scquarry.functions import stats
from scquarry.operators import graph, matrix, review
from scquarry.plans.common import rounded
from scquarry.plans.qc import metrics
from scquarry.plans.statistics import _ASSIGN, _META, _VEC, assignments, vector_cells, vectors
from scquarry.session import table

K = 20
MARKERS = (1, 5, 99, -1)


def neighbours(s: SparkSession, d: str) -> DataFrame:
    """The graph of all vectors: the table holds 2,000 at most, so all are asked for."""
    v = vectors(s, d)
    return graph.nearest(v, v, K)


def marker_neighbour_spearman(s: SparkSession, d: str) -> DataFrame:
    """How the first eight dimensions of a cell go with the mean of its neighbours'."""
    nn = neighbours(s, d)
    x = vectors(s, d).select("cell_id", F.posexplode(F.slice("vec", 1, 8)).alias("dim", "x"))
    smooth = nn.join(x.select(F.col("cell_id").alias("dst"), "dim", F.col("x").alias("y")), "dst").groupBy("src", "dim").agg(F.avg("y").alias("y"))
    return rounded(stats.spearman(x.join(smooth.withColumnRenamed("src", "cell_id"), ["cell_id", "dim"]), ["dim"], "x", "y"), 5)


def markers(s: SparkSession) -> DataFrame:
    return s.createDataFrame([(m,) for m in MARKERS], "marker bigint")


def customer_clusters(s: SparkSession, d: str) -> DataFrame:
    return model.cells(s, d).select("cell_id", F.col("batch").alias("cluster"))


def _design(s: SparkSession, d: str) -> DataFrame:
    cells = model.cells(s, d).withColumn("library_id", F.when(F.col("cell_id") % 50 != 0, F.col("batch")))
    return graph.batch_design(cells, ["sample", "batch", "library_id", "sequencing_run"], "grp", "batch", ["batch"])


QUERIES = {
    "knn_exact": lambda s, d: rounded(graph.nearest(vectors(s, d).filter("cell_id % 50 = 0"), vectors(s, d), K), 5),
    "neighbor_same_label": lambda s, d: rounded(graph.same_label_fraction(neighbours(s, d), vector_cells(s, d), ["sample", "grp", "phase"])),
    "marker_neighbor_spearman": marker_neighbour_spearman,
    "snn_jaccard": lambda s, d: rounded(graph.shared_neighbours(neighbours(s, d))),
    "batch_design": _design,
    "batch_confounding": lambda s, d: s.createDataFrame(
        [(f, graph.components(model.cells(s, d), f, "grp"), graph.components(model.cells(s, d), f, "grp") > 1) for f in ("sample", "batch")], "field string, components int, confounded boolean"
    ),
    "batch_group_contingency": lambda s, d: graph.label_grid(model.cells(s, d), F.col("batch"), F.col("grp")),
    "cluster_sizes": lambda s, d: rounded(review.cluster_sizes(assignments(s, d))),
    "cluster_metrics": lambda s, d: rounded(review.cluster_metrics(review.cluster_sizes(assignments(s, d)))),
    "cluster_composition": lambda s, d: review.cluster_composition(assignments(s, d), vector_cells(s, d), ["sample", "grp"]),
    "composition_grid": lambda s, d: review.composition_grid(assignments(s, d).filter("resolution = 0.8"), vector_cells(s, d), ["sample", "grp", "phase"]),
    "cluster_transitions": lambda s, d: review.transitions(assignments(s, d)).groupBy("resolution_from", "resolution_to", "cluster_from", "cluster_to").agg(F.count(F.lit(1)).alias("cells")),
    "marker_structure": lambda s, d: rounded(review.marker_structure(matrix.log_normalize(model.counts(s, d), metrics(s, d)), customer_clusters(s, d), markers(s), model.genes(s, d))),
    "resolution_choice": lambda s, d: assignments(s, d).filter(F.abs(F.col("resolution") - 0.5) < 1e-10).select("cell_id", "cluster"),
    "cluster_table_sizes": lambda s, d: rounded(
        review.cluster_sizes(
            table(s, d, "cluster_assignments")
            .unpivot(["record_no"], ["cluster_res_0_2", "cluster_res_0_5", "cluster_res_0_8"], "resolution", "cluster")
            .filter("cluster IS NOT NULL")
        )
    ),
}

_NN = f"""{_VEC}, pairs AS (SELECT a.cell_id AS src, b.cell_id AS dst, list_distance(a.vec, b.vec) AS dist FROM v a JOIN v b ON a.cell_id <> b.cell_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(dist, 9), dst) AS rnk FROM pairs), nn AS (SELECT * FROM ranked WHERE rnk <= {K})"""

SQL = {
    "knn_exact": f"WITH {_NN} SELECT src, dst, rnk::INT AS rnk, round(dist, 5) AS dist FROM nn WHERE src % 50 = 0",
    "neighbor_same_label": f"""WITH {_NN}, {_META}, l AS (SELECT cell_id, 'sample' AS field, sample AS x FROM m UNION ALL SELECT cell_id, 'grp', grp FROM m UNION ALL SELECT cell_id, 'phase', phase FROM m),
e AS (SELECT a.field, src, avg(coalesce((a.x = b.x)::INT, 0)) AS s FROM nn JOIN l a ON a.cell_id = src JOIN l b ON b.cell_id = dst AND a.field = b.field WHERE a.x IS NOT NULL GROUP BY 1, 2)
SELECT field, round(avg(s), 6) AS value, count(*) AS cells FROM e GROUP BY 1""",
    "marker_neighbor_spearman": f"""WITH {_NN}, x AS (SELECT cell_id, unnest(range(8))::INT AS dim, unnest(vec[1:8]) AS x FROM v),
j AS (SELECT a.dim, a.cell_id, any_value(a.x) AS x, avg(b.x) AS y FROM nn JOIN x a ON a.cell_id = src JOIN x b ON b.cell_id = dst AND a.dim = b.dim GROUP BY 1, 2),
r AS (SELECT dim, rank() OVER (PARTITION BY dim ORDER BY x) AS rx, rank() OVER (PARTITION BY dim ORDER BY y) AS ry FROM j) SELECT dim, count(*) AS n, round(corr(rx, ry), 5) AS rho FROM r GROUP BY 1""",
    "snn_jaccard": f"""WITH {_NN}, o AS (SELECT src, dst FROM nn UNION ALL SELECT cell_id, cell_id FROM v), k AS (SELECT src, count(*) AS k FROM o GROUP BY 1),
c AS (SELECT a.src AS x, b.src AS y, count(*) AS c FROM o a JOIN o b ON a.dst = b.dst AND a.src < b.src GROUP BY 1, 2)
SELECT x AS src, y AS dst, round(c / (p.k + q.k - c), 6) AS weight FROM c JOIN k p ON p.src = x JOIN k q ON q.src = y WHERE c / (p.k + q.k - c) >= 1 / 15""",
    "batch_design": f"""WITH {model.SQL_CELLS} SELECT 'sample' AS field, true AS available, count(DISTINCT sample) AS n_levels, 0::BIGINT AS n_missing, 'BIOLOGICAL_SAMPLE' AS role, true AS confounded_with_group, false AS selected, 'ELIGIBLE' AS decision FROM cells
UNION ALL SELECT 'batch', true, count(DISTINCT batch), 0, 'CONFIRMED_TECHNICAL', false, true, 'ELIGIBLE' FROM cells
UNION ALL SELECT 'library_id', true, count(DISTINCT batch) FILTER (cell_id % 50 <> 0), count(*) FILTER (cell_id % 50 = 0), 'UNCONFIRMED_TECHNICAL_MEANING', NULL, false, 'ELIGIBLE' FROM cells
UNION ALL SELECT 'sequencing_run', false, 0, count(*), 'UNCONFIRMED_TECHNICAL_MEANING', NULL, false, 'ELIGIBLE' FROM cells""",
    "batch_confounding": f"""WITH RECURSIVE {model.SQL_CELLS}, e AS (SELECT DISTINCT 'sample' AS field, 'a' || sample AS x, 'b' || grp AS y FROM cells UNION SELECT DISTINCT 'batch', 'a' || batch, 'b' || grp FROM cells),
e2 AS (SELECT field, x, y FROM e UNION ALL SELECT field, y, x FROM e), r AS (SELECT field, x AS root, x AS node FROM e2 UNION SELECT r.field, root, y FROM r JOIN e2 ON e2.field = r.field AND e2.x = r.node),
c AS (SELECT field, node, min(root) AS root FROM r GROUP BY 1, 2) SELECT field, count(DISTINCT root)::INT AS components, count(DISTINCT root) > 1 AS confounded FROM c GROUP BY 1""",
    "batch_group_contingency": f"""WITH {model.SQL_CELLS} SELECT a, b, count(batch) AS cells FROM (SELECT DISTINCT batch AS a FROM cells) CROSS JOIN (SELECT DISTINCT grp AS b FROM cells) LEFT JOIN cells ON batch = a AND grp = b GROUP BY 1, 2""",
    "cluster_sizes": f"WITH {_ASSIGN} SELECT resolution, cluster, count(*) AS cells, round(count(*) / sum(count(*)) OVER (PARTITION BY resolution), 6) AS fraction FROM a GROUP BY 1, 2",
    "cluster_metrics": f"""WITH {_ASSIGN}, s AS (SELECT resolution, cluster, count(*) AS c FROM a GROUP BY 1, 2)
SELECT resolution, count(*) AS n_clusters, min(c) AS min_cluster_cells, round(max(c) / sum(c), 6) AS max_cluster_fraction FROM s GROUP BY 1""",
    "cluster_composition": f"WITH {_ASSIGN}, {_META} SELECT resolution, cluster, sample, grp, count(*) AS cells FROM a JOIN m USING (cell_id) GROUP BY ALL",
    "composition_grid": f"""WITH {_META}, l AS (SELECT label::VARCHAR AS cluster, 'sample' AS field, sample AS value FROM m UNION ALL SELECT label::VARCHAR, 'grp', grp FROM m UNION ALL SELECT label::VARCHAR, 'phase', phase FROM m),
g AS (SELECT DISTINCT c.cluster, f.field, f.value FROM l c, l f WHERE f.value IS NOT NULL) SELECT g.cluster, g.field, g.value, count(l.value) AS cells FROM g LEFT JOIN l ON g.cluster = l.cluster AND g.field = l.field AND g.value = l.value GROUP BY ALL""",
    "cluster_transitions": f"""WITH {_ASSIGN} SELECT x.resolution AS resolution_from, y.resolution AS resolution_to, x.cluster AS cluster_from, y.cluster AS cluster_to, count(*) AS cells
FROM a x JOIN a y ON x.cell_id = y.cell_id AND ((x.resolution = 0.2 AND y.resolution = 0.5) OR (x.resolution = 0.5 AND y.resolution = 0.8)) GROUP BY ALL""",
    "marker_structure": f"""WITH {model.SQL_METRICS}, norm AS (SELECT cell_id, gene_id, ln(1 + 10000 * value / ncount) AS data FROM counts JOIN metrics USING (cell_id)),
s AS (SELECT batch AS cluster, count(*) AS n FROM cells GROUP BY 1), k AS (SELECT unnest([1, 5, 99, -1])::BIGINT AS marker),
t AS (SELECT batch AS cluster, gene_id AS marker, sum(data) AS sm, count(*) AS dt FROM norm JOIN cells USING (cell_id) GROUP BY 1, 2)
SELECT s.cluster, k.marker, round(coalesce(sm, 0) / n, 6) AS mean_expression, round(coalesce(dt, 0) / n, 6) AS fraction_detected, 'MEASURED' AS status
FROM s CROSS JOIN (SELECT marker FROM k WHERE marker IN (SELECT gene_id FROM genes)) k LEFT JOIN t ON t.cluster = s.cluster AND t.marker = k.marker
UNION ALL SELECT NULL, marker, NULL, NULL, 'MARKER_ABSENT' FROM k WHERE marker NOT IN (SELECT gene_id FROM genes)""",
    "resolution_choice": "SELECT vec_id AS cell_id, (label // 2)::VARCHAR AS cluster FROM embeddings",
    "cluster_table_sizes": """WITH a AS (SELECT 'cluster_res_0_2' AS resolution, cluster_res_0_2 AS cluster FROM cluster_assignments UNION ALL SELECT 'cluster_res_0_5', cluster_res_0_5 FROM cluster_assignments
UNION ALL SELECT 'cluster_res_0_8', cluster_res_0_8 FROM cluster_assignments) SELECT resolution, cluster, count(*) AS cells, round(count(*) / sum(count(*)) OVER (PARTITION BY resolution), 6) AS fraction FROM a WHERE cluster IS NOT NULL GROUP BY 1, 2""",
}
