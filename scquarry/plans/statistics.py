"""Queries on statistics: moments, regression, component selection, association, agreement, rank sums, percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry import model
from scquarry.functions import stats
from scquarry.operators import evidence, matrix, review
from scquarry.plans.common import rounded
from scquarry.plans.qc import metrics
from scquarry.session import sent_if_small, table

#: Clusterings of the vectors that stand in for resolutions: names and SQL of the label.
RESOLUTIONS = {0.2: "label div 5", 0.5: "label div 2", 0.8: "label"}


def vectors(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "embeddings").select(F.col("vec_id").alias("cell_id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


def vector_cells(s: SparkSession, d: str) -> DataFrame:
    """Metadata of the embedded cells, made of their id and label."""
    v = table(s, d, "embeddings").select(F.col("vec_id").alias("cell_id"), "label")
    return v.select(
        "cell_id",
        F.concat(F.lit("S"), F.col("cell_id") % 7).alias("sample"),
        F.when(F.col("cell_id") % 11 != 0, F.concat(F.lit("G"), F.col("label") % 3)).alias("grp"),
        F.element_at(F.array(F.lit("G1"), F.lit("S"), F.lit("G2M")), (F.col("cell_id") % 3 + 1).cast("int")).alias("phase"),
        ((F.col("cell_id") * 7919) % 1009 / 100.0).alias("pmt"),
        ((F.col("cell_id") * 31 + F.col("label") * 100) % 977).cast("double").alias("ncount"),
        F.when(F.col("cell_id") % 17 != 0, F.col("label") * 3.0 + F.col("cell_id") % 5).alias("s_score"),
    )


def assignments(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "embeddings")
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("resolution"), F.expr(f"string({e})").alias("cluster")) for r, e in RESOLUTIONS.items()])).alias("a")
    return v.select(F.col("vec_id").alias("cell_id"), each).select("cell_id", "a.*")


def spectrum(s: SparkSession, d: str) -> DataFrame:
    """Standard deviations of the vectors' dimensions per label, largest first: one spectrum a label."""
    from pyspark.sql import Window as W

    x = vectors(s, d).select("label", F.posexplode("vec").alias("dim", "x")).groupBy("label", "dim").agg(F.stddev_samp("x").alias("stdev"))
    return x.select("label", "stdev", F.row_number().over(W.partitionBy("label").orderBy(F.desc("stdev"), "dim")).alias("pc"))


def normalized(s: SparkSession, d: str) -> DataFrame:
    return matrix.log_normalize(model.counts(s, d), metrics(s, d))


def pc_metadata_spearman(s: SparkSession, d: str) -> DataFrame:
    """Rank correlation of every vector dimension with every metric of the cells; risk among the first 20 from 0.1 on."""
    long = vector_cells(s, d).unpivot("cell_id", ["pmt", "ncount", "s_score"], "variable", "x")
    pcs = vectors(s, d).select("cell_id", F.posexplode("vec").alias("pc", "y")).withColumn("pc", F.col("pc") + 1)
    r = stats.spearman(pcs.join(long, "cell_id"), ["variable", "pc"], "x", "y")
    return rounded(r.withColumn("selected_pc", F.col("pc") <= 20).withColumn("risk", F.coalesce((F.col("pc") <= 20) & (F.abs("rho") >= 0.1), F.lit(False))))


def scaled_values(s: SparkSession, d: str) -> DataFrame:
    """Residuals of normalized values after regression on pmt, over the cells with the gene, in standard deviations, clipped at 10."""
    cells = metrics(s, d).filter("pmt IS NOT NULL")
    n = cells.count()
    data = normalized(s, d)
    moments = matrix.gene_moments(data, "data", F.lit(n))
    c = matrix.regression_coefficients(data, "data", cells, "pmt")
    x = data.join(cells.select("cell_id", "pmt"), "cell_id").join(c, "gene_id").join(moments.select("gene_id", "variance"), "gene_id")
    residual = (F.col("data") - F.col("intercept") - F.col("slope") * F.col("pmt")) / F.sqrt("variance")
    return rounded(x.select("cell_id", "gene_id", F.least(F.lit(10.0), residual).alias("scaled")), 5)


def rank_sums(s: SparkSession, d: str) -> DataFrame:
    """Per gene the rank sum of the cells of one group against all others."""
    cells = model.cells(s, d).select("cell_id", (F.col("grp") == "ASIA").alias("inside"))
    n = cells.agg(F.count(F.when(F.col("inside"), 1)).alias("n_in"), F.count(F.when(~F.col("inside"), 1)).alias("n_out"))
    return rounded(stats.rank_sum(model.counts(s, d, "gene_id").join(sent_if_small(cells), "cell_id"), ["gene_id"], "value", "inside", n), 5)


def ari_stability(s: SparkSession, d: str) -> DataFrame:
    t = review.transitions(assignments(s, d))
    return rounded(stats.adjusted_rand(t, ["resolution_from", "resolution_to"], "cluster_from", "cluster_to"))


def recommendations(s: SparkSession, d: str) -> DataFrame:
    """Every part as a comparison with made-up measures."""
    p = table(s, d, "part")
    x = p.select("p_partkey", (F.col("p_partkey") % 101 / 100.0).alias("ari"), (F.col("p_partkey") % 51 / 50.0).alias("overlap"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_size") / 50.0).alias("before"), (F.col("p_partkey") % 37 / 36.0).alias("after"))
    return review.recommendation(x).select("p_partkey", "recommendation")


QUERIES = {
    "gene_moments": lambda s, d: rounded(matrix.gene_moments(normalized(s, d), "data", F.lit(model.cells(s, d).count()))),
    "regression_coefficients": lambda s, d: rounded(matrix.regression_coefficients(normalized(s, d), "data", metrics(s, d).filter("pmt IS NOT NULL"), "pmt")),
    "scaled_values": scaled_values,
    "pc_selection": lambda s, d: stats.pc_selection(spectrum(s, d), ["label"]),
    "pc_selection_table": lambda s, d: evidence.to_metrics(stats.pc_selection(spectrum(s, d), ["label"]), ["label"], ["max_pc", "pc_used", "selection_method"]),
    "pc_metadata_spearman": pc_metadata_spearman,
    "eta_squared": lambda s, d: rounded(stats.eta_squared(assignments(s, d).join(vector_cells(s, d).unpivot("cell_id", ["pmt", "ncount", "s_score"], "variable", "x"), "cell_id"), ["resolution", "variable"], "cluster", "x")),
    "cluster_profiles": lambda s, d: rounded(review.metric_profiles(assignments(s, d).filter("resolution = 0.8").join(vector_cells(s, d), "cell_id"), "cluster", ["pmt", "ncount", "s_score"])),
    "ari_stability": ari_stability,
    "wilcoxon_rank_sum": rank_sums,
    "regression_recommendation": recommendations,
    "metric_percentiles": lambda s, d: rounded(stats.percentiles(table(s, d, "cell_qc_all"), ["group_name"], "pmt", {"p10": 0.1, "median": 0.5, "p90": 0.9, "p99": 0.99})),
}

_VEC = "v AS (SELECT vec_id AS cell_id, embedding::DOUBLE[] AS vec, label FROM embeddings)"
_META = """m AS (SELECT vec_id AS cell_id, label, 'S' || (vec_id % 7) AS sample, CASE WHEN vec_id % 11 <> 0 THEN 'G' || (label % 3) END AS grp,
['G1', 'S', 'G2M'][vec_id % 3 + 1] AS phase, (vec_id * 7919) % 1009 / 100.0 AS pmt, ((vec_id * 31 + label * 100) % 977)::DOUBLE AS ncount,
CASE WHEN vec_id % 17 <> 0 THEN label * 3.0 + vec_id % 5 END AS s_score FROM embeddings)"""
_LONG = "l AS (SELECT cell_id, 'pmt' AS variable, pmt AS x FROM m UNION ALL SELECT cell_id, 'ncount', ncount FROM m UNION ALL SELECT cell_id, 's_score', s_score FROM m)"
_ASSIGN = """a AS (SELECT vec_id AS cell_id, 0.2::DOUBLE AS resolution, (label // 5)::VARCHAR AS cluster FROM embeddings UNION ALL SELECT vec_id, 0.5, (label // 2)::VARCHAR FROM embeddings
UNION ALL SELECT vec_id, 0.8, label::VARCHAR FROM embeddings)"""
_NORM = f"{model.SQL_METRICS}, norm AS (SELECT cell_id, gene_id, pmt, ln(1 + 10000 * value / ncount) AS data FROM counts JOIN metrics USING (cell_id))"
_RANK = "rank() OVER (PARTITION BY {p} ORDER BY {x}) + (count(*) OVER (PARTITION BY {p}, {x}) - 1) / 2.0"
_REG = f"""{_NORM}, t AS (SELECT count(*) AS n, sum(pmt) AS sx, sum(pmt * pmt) AS sxx FROM metrics WHERE pmt IS NOT NULL),
g AS (SELECT gene_id, sum(data) AS sy, sum(data * pmt) AS sxy, sum(data * data) AS syy FROM norm GROUP BY 1),
co AS (SELECT gene_id, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope, sy, syy, n, sx FROM g, t), coef AS (SELECT gene_id, (sy - slope * sx) / n AS intercept, slope, (syy - sy * sy / n) / (n - 1) AS variance FROM co)"""

SQL = {
    "gene_moments": f"""WITH {_NORM} SELECT gene_id, count(*) AS n, round(sum(data) / (SELECT count(*) FROM cells), 6) AS mean,
round((sum(data * data) - sum(data) * sum(data) / (SELECT count(*) FROM cells)) / ((SELECT count(*) FROM cells) - 1), 6) AS variance FROM norm GROUP BY 1""",
    "regression_coefficients": f"WITH {_REG} SELECT gene_id, round(intercept, 6) + 0 AS intercept, round(slope, 6) + 0 AS slope FROM coef",
    "scaled_values": f"WITH {_REG} SELECT cell_id, gene_id, round(least(10, (data - intercept - slope * pmt) / sqrt(variance)), 5) + 0 AS scaled FROM norm JOIN coef USING (gene_id)",
    "pc_selection": f"""WITH {_VEC}, x AS (SELECT label, unnest(range(64)) AS dim, unnest(vec) AS x FROM v), sd AS (SELECT label, dim, stddev_samp(x) AS stdev FROM x GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY stdev DESC, dim) AS pc FROM sd), o2 AS (SELECT *, stdev * 100 / sum(stdev) OVER (PARTITION BY label) AS share FROM o WHERE pc <= 50),
o3 AS (SELECT *, sum(share) OVER (PARTITION BY label ORDER BY pc) AS cum, share - lead(share) OVER (PARTITION BY label ORDER BY pc) AS dr FROM o2),
p AS (SELECT label, max(pc)::INT AS max_pc, (min(pc) FILTER (cum > 90 AND share < 5))::INT AS sd_pick, (max(pc) FILTER (dr > 0.1) + 1)::INT AS drop_pick FROM o3 GROUP BY 1),
u AS (SELECT *, greatest(2, least(coalesce(least(sd_pick, drop_pick), 20), max_pc))::INT AS pc_used FROM p)
SELECT *, CASE WHEN sd_pick IS NOT NULL AND drop_pick IS NOT NULL THEN 'reference_sd_min_cumulative_last_drop' WHEN sd_pick IS NOT NULL THEN 'reference_sd_cumulative_only'
WHEN drop_pick IS NOT NULL THEN 'reference_sd_last_drop_only' ELSE 'fallback_min_20_max_pc' END AS selection_method, max_pc >= 10 AND pc_used <= 3 AS low_dim_warning FROM u""",
    "pc_metadata_spearman": f"""WITH {_VEC}, {_META}, {_LONG}, p AS (SELECT cell_id, unnest(range(1, 65))::INT AS pc, unnest(vec) AS y FROM v), j AS (SELECT * FROM p JOIN l USING (cell_id) WHERE x IS NOT NULL),
r AS (SELECT *, {_RANK.format(p="variable, pc", x="x")} AS rx, {_RANK.format(p="variable, pc", x="y")} AS ry FROM j), c AS (SELECT variable, pc, count(*) AS n, corr(rx, ry) AS rho FROM r GROUP BY 1, 2)
SELECT variable, pc, n, round(rho, 6) AS rho, pc <= 20 AS selected_pc, pc <= 20 AND abs(rho) >= 0.1 AS risk FROM c""",
    "eta_squared": f"""WITH {_META}, {_LONG}, {_ASSIGN}, j AS (SELECT * FROM a JOIN l USING (cell_id) WHERE x IS NOT NULL),
g AS (SELECT *, avg(x) OVER (PARTITION BY resolution, variable) AS m, avg(x) OVER (PARTITION BY resolution, variable, cluster) AS mg FROM j)
SELECT resolution, variable, count(*) AS n, round(sum((mg - m) * (mg - m)) / sum((x - m) * (x - m)), 6) AS eta_squared FROM g GROUP BY 1, 2""",
    "cluster_profiles": f"""WITH {_META}, {_LONG}, j AS (SELECT label::VARCHAR AS cluster, variable, x FROM l JOIN m USING (cell_id) WHERE x IS NOT NULL), t AS (SELECT variable, avg(x) AS m, stddev_samp(x) AS s FROM j GROUP BY 1)
SELECT cluster, j.variable, count(*) AS cells, round(quantile_cont(x, 0.5), 6) AS median, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.1), 6) AS p10, round(quantile_cont(x, 0.9), 6) AS p90,
round((avg(x) - any_value(t.m)) / any_value(t.s), 6) AS standardized_mean_shift FROM j JOIN t ON j.variable = t.variable GROUP BY 1, 2""",
    "ari_stability": f"""WITH {_ASSIGN}, n AS (SELECT 0.2::DOUBLE AS f, 0.5::DOUBLE AS t UNION ALL SELECT 0.5, 0.8), j AS (SELECT f, t, x.cluster AS c, y.cluster AS e FROM n JOIN a x ON x.resolution = f JOIN a y ON y.resolution = t AND x.cell_id = y.cell_id),
c AS (SELECT f, t, sum(k * (k - 1) / 2) AS o, sum(k) AS n FROM (SELECT f, t, c, e, count(*) AS k FROM j GROUP BY ALL) GROUP BY 1, 2), r AS (SELECT f, t, sum(k * (k - 1) / 2) AS r FROM (SELECT f, t, c, count(*) AS k FROM j GROUP BY ALL) GROUP BY 1, 2),
l AS (SELECT f, t, sum(k * (k - 1) / 2) AS l FROM (SELECT f, t, e, count(*) AS k FROM j GROUP BY ALL) GROUP BY 1, 2)
SELECT f AS resolution_from, t AS resolution_to, n::BIGINT AS n, round((o - r * l / (n * (n - 1) / 2)) / ((r + l) / 2 - r * l / (n * (n - 1) / 2)), 6) AS ari FROM c JOIN r USING (f, t) JOIN l USING (f, t)""",
    "wilcoxon_rank_sum": f"""WITH {model.SQL_COUNTS}, {model.SQL_CELLS}, t AS (SELECT count(*) FILTER (grp = 'ASIA') AS n_in, count(*) FILTER (grp <> 'ASIA') AS n_out FROM cells),
x AS (SELECT gene_id, value, grp = 'ASIA' AS i, rank() OVER (PARTITION BY gene_id ORDER BY value) + (count(*) OVER (PARTITION BY gene_id, value) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY gene_id, value) AS e
FROM counts JOIN cells USING (cell_id)), s AS (SELECT gene_id, count(*) AS nz, count(*) FILTER (i) AS nzi, coalesce(sum(r) FILTER (i), 0) AS s, sum(e * e - 1.0) AS tie FROM x GROUP BY 1),
u AS (SELECT gene_id, n_in, n_out, (n_in + n_out)::DOUBLE AS n, (n_in + n_out - nz)::DOUBLE AS z0, s + nzi * (n_in + n_out - nz) + (n_in - nzi) * (n_in + n_out - nz + 1) / 2.0 - n_in * (n_in + 1) / 2.0 AS u, tie FROM s, t)
SELECT gene_id, n_in, n_out, round(u, 5) AS u, round((u - n_in * n_out / 2.0) / sqrt(n_in * n_out / 12.0 * (n + 1 - (tie + z0 * z0 * z0 - z0) / (n * (n - 1)))), 5) AS z FROM u""",
    "regression_recommendation": """SELECT p_partkey, CASE WHEN p_partkey % 101 / 100.0 >= 0.9 AND p_partkey % 51 / 50.0 >= 0.9 THEN 'SIMILAR_RESULTS'
WHEN p_partkey % 7 <> 0 AND (p_partkey % 37)::DOUBLE / 36.0::DOUBLE >= p_size::DOUBLE / 50.0::DOUBLE - 0.05::DOUBLE THEN 'BASELINE_PREFERRED' ELSE 'USER_REVIEW_REQUIRED' END AS recommendation FROM part""",
    "metric_percentiles": """SELECT group_name, round(quantile_cont(pmt, 0.1), 6) AS p10, round(quantile_cont(pmt, 0.5), 6) AS median, round(quantile_cont(pmt, 0.9), 6) AS p90, round(quantile_cont(pmt, 0.99), 6) AS p99
FROM cell_qc_all WHERE pmt IS NOT NULL AND isfinite(pmt) GROUP BY 1""",
}

SQL["pc_selection_table"] = f"""WITH s AS ({SQL["pc_selection"]}) SELECT label, 'max_pc' AS metric, max_pc::VARCHAR AS value FROM s UNION ALL SELECT label, 'pc_used', pc_used::VARCHAR FROM s
UNION ALL SELECT label, 'selection_method', selection_method FROM s"""
