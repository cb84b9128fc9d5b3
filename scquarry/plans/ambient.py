"""Queries on doublets, cell cycle and ambient contamination: the deterministic bookkeeping around the kernels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry import model
from scquarry.operators import quality, review
from scquarry.plans.common import rounded
from scquarry.plans.graphs import markers
from scquarry.plans.qc import flagged, metrics
from scquarry.session import table


def scored(s: SparkSession, d: str) -> DataFrame:
    """Cells of the stand-in with a made-up doublet score; segments are capture libraries, regions clusters."""
    c = model.cells(s, d)
    return c.select("cell_id", "sample", F.col("batch").alias("library_id"), F.col("grp").alias("cluster"), ((F.col("cell_id") * 7919) % 10007 / 10007.0).alias("pann"))


def expected(s: SparkSession, d: str) -> DataFrame:
    return review.expected_doublets(review.homotypic_proportion(scored(s, d), "library_id", "cluster"))


def called(s: SparkSession, d: str) -> DataFrame:
    c = review.call_doublets(scored(s, d), expected(s, d), "library_id")
    skipped = F.col("cell_id") % 31 == 0
    return c.withColumns({"df": F.when(skipped, "NotEvaluated").otherwise(F.col("df")), "df_adj": F.when(skipped, "NotEvaluated").otherwise(F.col("df_adj"))})


def contaminated(s: SparkSession, d: str) -> DataFrame:
    """Cells with a made-up contamination and what it leaves of their counts."""
    m = metrics(s, d).filter("ncount > 0")
    c = (F.col("cell_id") * 6007) % 997 / 997.0
    c = F.when(F.col("sample") == "NATION_7", 0.5 + c / 2).otherwise(c * c)
    return m.select("cell_id", "sample", c.alias("contamination"), F.col("ncount").alias("original"), (F.col("ncount") * (1 - c)).alias("corrected"), "nfeature")


def corrected_counts(s: SparkSession, d: str) -> DataFrame:
    return model.counts(s, d).join(contaminated(s, d).select("cell_id", "contamination"), "cell_id").select("cell_id", "gene_id", (F.col("value") * (1 - F.col("contamination"))).alias("value"))


def retention(s: SparkSession, d: str) -> DataFrame:
    return review.marker_retention(model.counts(s, d), corrected_counts(s, d), contaminated(s, d), markers(s), model.genes(s, d))


def phase_counts(s: SparkSession, d: str) -> DataFrame:
    """Phases by sample of the doublet table, its bad labels as they are."""
    return review.phase_summary(table(s, d, "seurat_qc_2").select("sample", "phase"))


QUERIES = {
    "homotypic_proportion": lambda s, d: rounded(review.homotypic_proportion(scored(s, d), "library_id", "cluster")),
    "expected_doublets": lambda s, d: rounded(expected(s, d)),
    "doublet_calls_topn": lambda s, d: review.call_doublets(scored(s, d), expected(s, d), "library_id").select("cell_id", "df", "df_adj"),
    "doublet_summary": lambda s, d: rounded(review.doublet_summary(called(s, d), "library_id")),
    "singlet_filter": lambda s, d: review.accepted_singlets(called(s, d), ("NATION_1", "NATION_2")).select("cell_id"),
    "pk_selection": lambda s, d: review.best_pk(table(s, d, "part").select("p_brand", (F.col("p_size") / 100.0 - 0.05).alias("pk"), F.when(F.col("p_partkey") % 9 != 0, F.col("p_partkey") % 13).cast("double").alias("metric")), ["p_brand"]),
    "phase_grid": lambda s, d: rounded(phase_counts(s, d)),
    "contamination_summary": lambda s, d: rounded(review.contamination_review(contaminated(s, d)), 5),
    "marker_retention": lambda s, d: rounded(retention(s, d)),
    "ambient_warnings": lambda s, d: review.contamination_warnings(review.contamination_review(contaminated(s, d)), retention(s, d), contaminated(s, d), retention=0.55),
    "filter_reason_bars": lambda s, d: quality.filter_reasons(flagged(s, d)).select("sample", *[f"{r}_hits" for r in model.THRESHOLDS]).unpivot("sample", [f"{r}_hits" for r in model.THRESHOLDS], "rule", "cells"),
    "singlet_limits": lambda s, d: rounded(
        review.accepted_singlets(called(s, d)).agg(*[x for c in ("pann",) for x in ((F.min(c) - 0.03 * (F.max(c) - F.min(c))).alias("lower"), (F.max(c) + 0.03 * (F.max(c) - F.min(c))).alias("upper"))])
    ),
}

_SCORED = f"{model.SQL_CELLS}, sc AS (SELECT cell_id, sample, batch AS library_id, grp AS cluster, (cell_id * 7919) % 10007 / 10007.0 AS pann FROM cells)"
_EXPECTED = f"""{_SCORED}, hc AS (SELECT library_id, cluster, count(*) AS c FROM sc GROUP BY 1, 2), h AS (SELECT library_id, sum(c)::BIGINT AS n_cells, sum(c * c) / (sum(c) * sum(c)) AS homotypic FROM hc GROUP BY 1),
e1 AS (SELECT *, round_even(n_cells * 0.04::DOUBLE, 0)::BIGINT AS n_exp FROM h), e AS (SELECT *, round_even(n_exp * (1 - homotypic), 0)::BIGINT AS n_exp_adj FROM e1)"""
_CALLS = f"""{_EXPECTED}, p AS (SELECT *, row_number() OVER (PARTITION BY library_id ORDER BY pann DESC, cell_id) AS p FROM sc),
calls AS (SELECT cell_id, sample, p.library_id, pann, CASE WHEN p <= n_exp THEN 'Doublet' ELSE 'Singlet' END AS df, CASE WHEN p <= n_exp_adj THEN 'Doublet' ELSE 'Singlet' END AS df_adj FROM p JOIN e ON p.library_id = e.library_id),
called AS (SELECT cell_id, sample, library_id, pann, CASE WHEN cell_id % 31 = 0 THEN 'NotEvaluated' ELSE df END AS df, CASE WHEN cell_id % 31 = 0 THEN 'NotEvaluated' ELSE df_adj END AS df_adj FROM calls)"""
_CONT = f"""{model.SQL_METRICS}, c0 AS (SELECT *, ((cell_id * 6007) % 997)::DOUBLE / 997 AS r FROM metrics WHERE ncount > 0), c1 AS (SELECT *, CASE WHEN sample = 'NATION_7' THEN 0.5 + r / 2 ELSE r * r END AS contamination FROM c0),
cont AS (SELECT cell_id, sample, contamination, ncount AS original, ncount * (1 - contamination) AS corrected, nfeature FROM c1)"""
_REVIEW = """r AS (SELECT sample, count(*) AS cells, avg(contamination) AS mean_contamination, count(*) FILTER (contamination >= 0.5) AS high_cells, sum(original) AS original_umi, sum(corrected) AS corrected_umi,
sum(original - corrected) AS removed_umi, quantile_cont(contamination, 0.5) AS median_contamination, quantile_cont(contamination, 0.9) AS p90_contamination, quantile_cont(contamination, 0.95) AS p95_contamination,
quantile_cont(contamination, 0.99) AS p99_contamination, quantile_cont(original, 0.5) FILTER (contamination >= 0.5) AS high_median_umi, quantile_cont(nfeature, 0.5) FILTER (contamination >= 0.5) AS high_median_nfeature,
sum(corrected) / sum(original) AS retained_umi_fraction FROM cont GROUP BY 1)"""
_RETENTION = f"""{_CONT}, k AS (SELECT unnest([1, 5, 99, -1])::BIGINT AS marker), n AS (SELECT sample, count(*) AS n FROM cont GROUP BY 1),
t AS (SELECT sample, gene_id AS marker, sum(value) AS a, sum(value * (1 - contamination)) AS b, count(*) FILTER (value > 0) AS da, count(*) FILTER (value * (1 - contamination) > 0) AS db FROM counts JOIN cont USING (cell_id) GROUP BY 1, 2),
rt AS (SELECT n.sample, k.marker, k.marker IN (SELECT gene_id FROM genes) AS pr, n, a, b, da, db FROM n CROSS JOIN k LEFT JOIN t ON t.sample = n.sample AND t.marker = k.marker)"""

SQL = {
    "homotypic_proportion": f"WITH {_EXPECTED} SELECT library_id, n_cells, round(homotypic, 6) AS homotypic FROM h",
    "expected_doublets": f"WITH {_EXPECTED} SELECT library_id, n_cells, round(homotypic, 6) AS homotypic, n_exp, n_exp_adj, n_exp >= 1 AND n_exp < n_cells AND n_exp_adj >= 1 AS valid FROM e",
    "doublet_calls_topn": f"WITH {_CALLS} SELECT cell_id, df, df_adj FROM calls",
    "doublet_summary": f"""WITH {_CALLS} SELECT sample, string_agg(DISTINCT library_id, ';' ORDER BY library_id) AS library_ids, count(*) AS input_cells, count(*) FILTER (df = 'Doublet') AS df_doublets,
count(*) FILTER (df_adj = 'Doublet') AS df_adj_doublets, round(count(*) FILTER (df = 'Doublet') / count(*), 6) AS df_fraction, round(count(*) FILTER (df_adj = 'Doublet') / count(*), 6) AS df_adj_fraction,
count(*) FILTER (df <> df_adj) AS disagreements, count(*) FILTER (df_adj = 'NotEvaluated') AS unevaluated_cells FROM called GROUP BY 1""",
    "singlet_filter": f"WITH {_CALLS} SELECT cell_id FROM called WHERE df_adj = 'Singlet' OR (df_adj = 'NotEvaluated' AND sample IN ('NATION_1', 'NATION_2'))",
    "pk_selection": """WITH x AS (SELECT p_brand, p_size / 100::DOUBLE - 0.05::DOUBLE AS pk, CASE WHEN p_partkey % 9 <> 0 THEN p_partkey % 13 END AS metric FROM part),
o AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY metric DESC, pk) AS r FROM x WHERE metric IS NOT NULL AND pk > 0 AND pk < 1) SELECT p_brand, pk FROM o WHERE r = 1""",
    "phase_grid": """WITH g AS (SELECT s.sample, p.phase FROM (SELECT DISTINCT sample FROM seurat_qc_2 WHERE phase IS NOT NULL) s, (SELECT DISTINCT phase FROM seurat_qc_2 WHERE sample IS NOT NULL) p WHERE s.sample IS NOT NULL AND p.phase IS NOT NULL),
c AS (SELECT g.sample, g.phase, count(q.record_no) AS cells FROM g LEFT JOIN seurat_qc_2 q ON q.sample = g.sample AND q.phase = g.phase GROUP BY 1, 2) SELECT *, round(cells / sum(cells) OVER (PARTITION BY sample), 6) AS fraction FROM c""",
    "contamination_summary": f"WITH {_CONT}, {_REVIEW} SELECT sample, cells, high_cells, " + ", ".join(f"round({c}, 5) AS {c}" for c in ("mean_contamination", "original_umi", "corrected_umi", "removed_umi", "median_contamination", "p90_contamination", "p95_contamination", "p99_contamination", "high_median_umi", "high_median_nfeature", "retained_umi_fraction")) + " FROM r",
    "marker_retention": f"""WITH {_RETENTION} SELECT sample, marker, CASE WHEN pr THEN 'MEASURED' ELSE 'MARKER_ABSENT' END AS status, round(CASE WHEN pr THEN coalesce(a, 0) / n END, 6) AS mean_original, round(CASE WHEN pr THEN coalesce(b, 0) / n END, 6) AS mean_corrected,
round(CASE WHEN pr THEN coalesce(da, 0) / n END, 6) AS detected_original, round(CASE WHEN pr THEN coalesce(db, 0) / n END, 6) AS detected_corrected, round(CASE WHEN pr AND a > 0 THEN b / a END, 6) AS retained_fraction FROM rt""",
    "ambient_warnings": f"""WITH {_RETENTION}, {_REVIEW} SELECT sample, 'EXTREME_CONTAMINATION' AS category, '' AS detail FROM r WHERE mean_contamination >= 0.5 OR median_contamination >= 0.5 OR p95_contamination >= 0.8
UNION ALL SELECT DISTINCT sample, 'ZERO_CORRECTED_UMI', '' FROM cont WHERE corrected <= 0 UNION ALL SELECT sample, 'MARKER_LOSS', marker::VARCHAR FROM rt WHERE pr AND a > 0 AND b / a < 0.55""",
    "filter_reason_bars": f"WITH {model.SQL_FLAGS} " + " UNION ALL ".join(f"SELECT sample, '{n}_hits' AS rule, count(*) FILTER ({r}) AS cells FROM kept GROUP BY 1" for n, r in zip(model.THRESHOLDS, ("r1", "r2", "r3", "r4", "r5", "r6", "r7"))),
    "singlet_limits": f"WITH {_CALLS} SELECT round(min(pann) - 0.03 * (max(pann) - min(pann)), 6) AS lower, round(max(pann) + 0.03 * (max(pann) - min(pann)), 6) AS upper FROM called WHERE df_adj = 'Singlet'",
}
