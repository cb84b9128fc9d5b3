"""Queries on the data behind figures and on checks of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry import model
from scquarry.operators import checks, frames, review
from scquarry.plans.ambient import _CALLS, _CONT, called, contaminated
from scquarry.plans.common import rounded
from scquarry.plans.qc import flagged, metrics
from scquarry.plans.statistics import _ASSIGN, _META, _VEC, assignments, spectrum, vector_cells, vectors
from scquarry.session import table


def points(s: SparkSession, d: str) -> DataFrame:
    """The first two dimensions of the vectors as a plane."""
    return vectors(s, d).select("cell_id", F.col("vec")[0].alias("x"), F.col("vec")[1].alias("y"))


def violins(s: SparkSession, d: str) -> DataFrame:
    m = flagged(s, d)
    both = frames.violins(m).union(frames.violins(m.filter("retained"), stage="after"))
    return rounded(both.groupBy("sample", "metric", "place", "stage").agg(F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")))


def faulty_vectors(s: SparkSession, d: str) -> DataFrame:
    v = vectors(s, d)
    cut = F.when(F.col("cell_id") % 40 == 3, F.slice("vec", 1, 63)).when(F.col("cell_id") % 40 == 4, F.transform("vec", lambda x: x / F.lit(0.1) * F.lit(float("inf")))).otherwise(F.col("vec"))
    return v.filter("cell_id % 40 <> 1").select("cell_id", cut.alias("vec")).union(v.filter("cell_id % 40 = 2").select("cell_id", "vec")).union(v.filter("cell_id % 40 = 5").select(F.col("cell_id") + 10**6, "vec"))


def faulty_assignments(s: SparkSession, d: str) -> DataFrame:
    a = assignments(s, d)
    return a.filter("NOT (resolution = 0.2 AND cell_id % 30 = 1)").withColumn("cluster", F.when(F.col("cell_id") % 30 == 2, " ").otherwise(F.col("cluster"))).union(a.filter("resolution = 0.8 AND cell_id % 30 = 3"))


def pooled(s: SparkSession, d: str) -> DataFrame:
    """Cells of the doublet table against samples' libraries as their patients' codes."""
    cells = table(s, d, "seurat_qc_2").filter("sample IS NOT NULL").select(F.col("cell_id").alias("Cell"), "sample", F.col("library_id").alias("patient"))
    known = table(s, d, "keep_targets").filter("sample <> '*'").select("sample", F.concat("sample", F.lit("_L1")).alias("patient"))
    return checks.pooled_metadata_problems(cells, known).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "violin_ranges": violins,
    "panel_limits": lambda s, d: rounded(frames.limits(points(s, d))),
    "doublet_panel": lambda s, d: rounded(frames.panel(points(s, d), called(s, d), "df_adj", "Doublet")),
    "singlet_panel": lambda s, d: rounded(frames.subset_panel(points(s, d), review.accepted_singlets(called(s, d)))),
    "elbow_frame": lambda s, d: rounded(frames.elbow(spectrum(s, d).filter("label = 0").select("pc", "stdev"), 20)),
    "correction_scatter": lambda s, d: rounded(frames.correction_scatter(contaminated(s, d))),
    "cluster_tree": lambda s, d: rounded(frames.tree(review.transitions(assignments(s, d)))),
    "embedding_violations": lambda s, d: checks.embedding_violations(faulty_vectors(s, d), vector_cells(s, d), 64),
    "clustering_violations": lambda s, d: checks.clustering_violations(faulty_assignments(s, d), vector_cells(s, d), [0.2, 0.5, 0.9]),
    "pooled_metadata": pooled,
    "input_values_kept": lambda s, d: _kept(s, d),
}


def _kept(s: SparkSession, d: str) -> DataFrame:
    from scquarry.operators.matrix import keep_input_values

    claimed = model.cells(s, d).select("cell_id", (F.col("cell_id") % 500).cast("double").alias("ncount"))
    return keep_input_values(claimed, metrics(s, d).select("cell_id", "ncount"), ["ncount"])


_P = f"{_VEC}, pt AS (SELECT cell_id, vec[1] AS x, vec[2] AS y FROM v)"
_V = "SELECT sample, '{m}' AS metric, {i} AS place, '{s}' AS stage, count({m}) AS n, round(min({m}), 6) AS low, round(max({m}), 6) AS high FROM kept {w} GROUP BY sample"

SQL = {
    "violin_ranges": f"WITH {model.SQL_FLAGS} " + " UNION ALL ".join(_V.format(m=m, i=i, s=st, w=w) for i, m in enumerate(frames.METRICS) for st, w in (("before", ""), ("after", "WHERE hits = 0"))),
    "panel_limits": f"""WITH {_P} SELECT round(min(x) - 0.03 * (max(x) - min(x)), 6) AS x_lower, round(max(x) + 0.03 * (max(x) - min(x)), 6) AS x_upper,
round(min(y) - 0.03 * (max(y) - min(y)), 6) AS y_lower, round(max(y) + 0.03 * (max(y) - min(y)), 6) AS y_upper FROM pt""",
    "doublet_panel": f"WITH {_CALLS}, {_P} SELECT cell_id, round(x, 6) AS x, round(y, 6) AS y, df_adj AS value, (df_adj = 'Doublet')::INT AS drawn FROM pt JOIN called USING (cell_id)",
    "singlet_panel": f"WITH {_CALLS}, {_P} SELECT cell_id, round(x, 6) AS x, round(y, 6) AS y FROM pt WHERE cell_id IN (SELECT cell_id FROM called WHERE df_adj = 'Singlet')",
    "elbow_frame": f"""WITH {_VEC}, u AS (SELECT unnest(range(64)) AS dim, unnest(vec) AS x FROM v WHERE label = 0), sd AS (SELECT dim, stddev_samp(x) AS stdev FROM u GROUP BY 1),
o AS (SELECT stdev, row_number() OVER (ORDER BY stdev DESC, dim)::INT AS pc FROM sd), e AS (SELECT pc, stdev, stdev * 100 / sum(stdev) OVER () AS a, stdev * stdev * 100 / sum(stdev * stdev) OVER () AS b FROM o)
SELECT pc, round(stdev, 6) AS stdev, round(a, 6) AS sd_share, round(b, 6) AS variance_explained, round(sum(a) OVER (ORDER BY pc), 6) AS cumulative_sd_share, round(sum(b) OVER (ORDER BY pc), 6) AS cumulative_variance, pc <= 20 AS selected FROM e""",
    "correction_scatter": f"WITH {_CONT} SELECT cell_id, sample, round(original, 6) AS original, round(corrected, 6) AS corrected, CASE WHEN contamination >= 0.5 THEN 'High estimate' ELSE 'Other' END AS stratum FROM cont",
    "cluster_tree": f"""WITH {_ASSIGN}, t AS (SELECT x.resolution AS resolution_from, y.resolution AS resolution_to, x.cluster AS cluster_from, y.cluster AS cluster_to, count(*) AS cells
FROM a x JOIN a y ON x.cell_id = y.cell_id AND ((x.resolution = 0.2 AND y.resolution = 0.5) OR (x.resolution = 0.5 AND y.resolution = 0.8)) GROUP BY ALL)
SELECT *, round(cells / sum(cells) OVER (PARTITION BY resolution_from, cluster_from), 6) AS share_out, round(cells / sum(cells) OVER (PARTITION BY resolution_to, cluster_to), 6) AS share_in FROM t""",
    "embedding_violations": f"""WITH {_META} SELECT 'LENGTH' AS rule, count(*) FILTER (cell_id % 40 = 3) AS n FROM m UNION ALL SELECT 'NOT_FINITE', count(*) FILTER (cell_id % 40 = 4) FROM m UNION ALL SELECT 'REPEATED', count(*) FILTER (cell_id % 40 = 2) FROM m
UNION ALL SELECT 'CELL_WITHOUT_VECTOR', count(*) FILTER (cell_id % 40 = 1) FROM m UNION ALL SELECT 'UNKNOWN_CELL', count(*) FILTER (cell_id % 40 = 5) FROM m""",
    "clustering_violations": f"""WITH {_META} SELECT 'MISSING' AS rule, count(*) + count(*) FILTER (cell_id % 30 = 1) AS n FROM m UNION ALL SELECT 'REPEATED', count(*) FILTER (cell_id % 30 = 3) FROM m
UNION ALL SELECT 'BLANK', 3 * count(*) FILTER (cell_id % 30 = 2) FROM m UNION ALL SELECT 'UNKNOWN_RESOLUTION', 1""",
    "pooled_metadata": """WITH c AS (SELECT cell_id, sample, library_id FROM seurat_qc_2 WHERE sample IS NOT NULL), k AS (SELECT sample, sample || '_L1' AS patient FROM keep_targets WHERE sample <> '*'),
p AS (SELECT 'REPEATED_CELL' AS problem FROM c GROUP BY cell_id HAVING count(*) > 1 UNION ALL SELECT 'PREFIX' FROM c WHERE NOT coalesce(starts_with(cell_id, sample || '_'), false)
UNION ALL SELECT DISTINCT 'UNKNOWN_SAMPLE' || sample FROM c WHERE sample NOT IN (SELECT sample FROM k) UNION ALL SELECT 'PATIENT_DIFFERS' FROM c JOIN k ON c.sample = k.sample WHERE library_id IS DISTINCT FROM patient)
SELECT CASE WHEN starts_with(problem, 'UNKNOWN_SAMPLE') THEN 'UNKNOWN_SAMPLE' ELSE problem END AS problem, count(*) AS n FROM p GROUP BY 1""",
    "input_values_kept": f"WITH {model.SQL_METRICS} SELECT cell_id, ncount, (cell_id % 500)::DOUBLE AS ncount_input_metadata, ncount AS ncount_before_qc FROM metrics",
}
