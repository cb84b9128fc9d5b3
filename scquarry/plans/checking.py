"""Queries on the precheck, checkpoints, cell maps, diagnostics of the chosen clusters and the frames of their figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry import model
from scquarry.functions import stats
from scquarry.operators import checks, frames, matrix, precheck, review
from scquarry.plans import figures, qc, statistics
from scquarry.plans.common import rounded
from scquarry.session import table

MIN_CELLS = 280
#: Checkpoints with faults: which cells have them.
_FAULTY = {"metric": 50, "call": 40, "marker": 30}


def named_genes(s: SparkSession, d: str) -> DataFrame:
    """Parts with names by which patterns tell their families."""
    kind = F.col("p_partkey") % 10
    name = F.when(kind == 1, "MT-").when(kind == 2, "HBB").when(kind == 3, "RPL").when(kind == 4, "HBP").otherwise("G")
    return table(s, d, "part").select(F.col("p_partkey").alias("gene_id"), F.concat(name, F.col("p_partkey").cast("string")).alias("gene_name"))


def precheck_report(s: SparkSession, d: str) -> DataFrame:
    cells = model.cells(s, d).withColumnRenamed("batch", "capture_id")
    _, report = precheck.precheck(model.counts(s, d), cells, named_genes(s, d), model.THRESHOLDS, min_cells=MIN_CELLS)
    rows = report.filter("section IN ('CELL_QC', 'CAPTURE_LIBRARY', 'RUN')")
    return rows.select("section", "sample", "metric", F.round(F.expr("try_cast(value AS DOUBLE)"), 3).alias("value"), "status")


def checkpoint(s: SparkSession, d: str) -> DataFrame:
    """The doublet step's cells with faults: other totals, rejected calls, cells without a score and without the marker of it."""
    i = F.col("cell_id")
    m = qc.metrics(s, d).withColumn("ncount", F.when(i % _FAULTY["metric"] == 7, F.col("ncount") + 1).otherwise(F.col("ncount")))
    call = F.when(i % _FAULTY["call"] == 3, "Doublet").when(i % _FAULTY["marker"] == 1, "NotEvaluated").otherwise("Singlet")
    zeros = {c: F.lit(0.0) for c in ("s_score", "g2m_score", "cc_difference", "pann")}
    m = m.withColumns({**zeros, "phase": F.lit("G1"), "df": call, "df_adj": call, "doublet_status": F.when(i % (2 * _FAULTY["marker"]) == 1, "SKIPPED_LOW_CELL")})
    parent = model.counts(s, d)
    child = parent.filter("gene_id % 7 <> 0").withColumn("value", F.when((i % 90 == 5) & (F.col("gene_id") % 6 == 1), F.col("value") + 1).otherwise(F.col("value")))
    sums = matrix.cell_totals(child, model.cells(s, d)).select("cell_id", F.col("ncount").alias("_n"), F.col("nfeature").alias("_f"))
    m = m.join(sums, "cell_id").withColumn("ncount", F.when(i % _FAULTY["metric"] == 7, F.col("_n") + 1).otherwise(F.col("_n"))).withColumn("nfeature", F.col("_f")).drop("_n", "_f")
    return checks.checkpoint_violations(child, m, "qc2", parent, provenance={"stage": "qc2", "configuration": {"a": 1, "ambient": 2}}, configuration={"a": 1, "ambient": 3}, tables=("cells", "pca", "snn_graph"))


def mapped_samples(s: SparkSession, d: str) -> DataFrame:
    """A confirmed part of a map's samples: cells by sample, and the entries of the matrix that are left."""
    mapping = matrix.named_map(table(s, d, "customer").select(F.col("c_custkey").alias("barcode"), F.col("c_mktsegment").alias("author_sample"), "c_acctbal"), "barcode", "author_sample")
    counts = model.counts(s, d).withColumn("cell_id", F.col("cell_id").cast("string"))
    some, _, totals = matrix.select_mapped(counts, mapping.select("cell_id"), mapping, ["BUILDING", "MACHINERY"], confirmed=True)
    left = some.join(mapping, "cell_id").groupBy("sample").agg(F.count(F.lit(1)).alias("entries"))
    return totals.join(left, "sample", "left").select("sample", "cells", "selected", F.coalesce("entries", F.lit(0)).alias("entries"))


def final_tables(s: SparkSession, d: str) -> DataFrame:
    """Markers, sizes and composition of the clusters at one resolution: kind, cluster, name, value."""
    cells = statistics.vector_cells(s, d)
    data = cells.select("cell_id", F.concat(F.lit("g"), F.col("cell_id") % 3).alias("gene_id"), F.lit(1.0).alias("data"))
    markers = s.createDataFrame([("g0",), ("g2",), ("zz",), (None,)], "marker string")
    t = review.final_diagnostics(data, statistics.assignments(s, d), cells, data.select("gene_id").distinct(), markers, 0.5)
    none = F.lit(None).cast("string")
    out = t["markers"].select(F.lit("marker").alias("kind"), none.alias("cluster"), F.concat_ws("=", "marker", "status").alias("name"), F.lit(None).cast("double").alias("value"))
    out = out.union(t["sizes"].select(F.lit("size"), "cluster", none, F.round("fraction", 6)))
    out = out.union(t["composition"].select(F.lit("composition"), "cluster", F.concat_ws("=", "field", "value"), F.col("cells").cast("double")))
    out = out.union(t["structure"].filter("status = 'MEASURED'").select(F.lit("structure"), "cluster", "marker", F.round("mean_expression", 6)))
    return out.union(t["distributions"].select(F.lit("distribution"), "cluster", "variable", F.round("median", 6)))


def dot_plot(s: SparkSession, d: str) -> DataFrame:
    a = statistics.assignments(s, d).filter("resolution = 0.5")
    cells = statistics.vector_cells(s, d)
    data = cells.select("cell_id", F.concat(F.lit("g"), F.col("cell_id") % 3).alias("gene_id"), F.col("pmt").alias("data"))
    markers = s.createDataFrame([("g0",), ("g1",), ("zz",)], "marker string")
    return rounded(frames.dot_plot(review.marker_structure(data, a, markers, data.select("gene_id").distinct())), 5)


def _cycle_cells(s: SparkSession, d: str) -> DataFrame:
    return statistics.vector_cells(s, d).withColumn("g2m_score", F.col("pmt") - 5)


def before_after(s: SparkSession, d: str) -> DataFrame:
    """Ranges by stage, field and label of a layout and the same one turned."""
    p = figures.points(s, d)
    f = frames.before_and_after(p, p.select("cell_id", F.col("y").alias("x"), (-F.col("x")).alias("y")), statistics.vector_cells(s, d), ("sample", "grp", "absent"))
    return rounded(f.groupBy("stage", "field", "value").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("y").alias("high")))


def dimensions(s: SparkSession, d: str) -> DataFrame:
    """What a report says of an object's size against the object."""
    n, g = model.cells(s, d).count(), model.genes(s, d).count()
    rows = [(1, "RUN", "final_cells", "7"), (2, "RUN", "final_cells", str(n)), (3, "RUN", "final_genes", str(g + 1)), (4, "CELL_QC", "final_genes", str(g))]
    return checks.report_dimensions(s.createDataFrame(rows, "n bigint, section string, metric string, value string"), n, g)


QUERIES = {
    "family_flags": lambda s, d: precheck.family_flags(named_genes(s, d), "human"),
    "precheck_report": precheck_report,
    "checkpoint_violations": checkpoint,
    "mapped_samples": mapped_samples,
    "final_tables": final_tables,
    "dot_plot": dot_plot,
    "cycle_panels": lambda s, d: rounded(frames.cycle_panels(figures.points(s, d), _cycle_cells(s, d))),
    "before_after": before_after,
    "report_dimensions": dimensions,
    "first_drop_selection": lambda s, d: stats.pc_selection(statistics.spectrum(s, d), ["label"], first_drop=True),
    "contract_columns": lambda s, d: checks.contract_columns(statistics.vector_cells(s, d).withColumn("seurat_clusters", F.lit("1"))),
}

_R = qc._RULES
_METRICS = f"""{model.SQL_COUNTS}, {model.SQL_CELLS}, totals AS (SELECT cell_id, sum(value) AS ncount, count(*) AS nfeature, sum(CASE WHEN gene_id % 10 = 1 THEN value ELSE 0 END) AS mt,
  sum(CASE WHEN gene_id % 10 = 2 THEN value ELSE 0 END) AS hb, sum(CASE WHEN gene_id % 10 = 3 THEN value ELSE 0 END) AS rp FROM counts GROUP BY 1),
metrics AS (SELECT cells.*, coalesce(ncount, 0)::DOUBLE AS ncount, coalesce(nfeature, 0)::BIGINT AS nfeature, 100 * mt / ncount AS pmt, 100 * hb / ncount AS phb, 100 * rp / ncount AS prp FROM cells LEFT JOIN totals USING (cell_id))"""
_FLAGS = model.SQL_FLAGS.replace(model.SQL_METRICS, _METRICS)

SQL = {
    "family_flags": "SELECT gene_id, gene_name, regexp_matches(gene_name, '^MT-') AS pmt, regexp_matches(gene_name, '^RP[SL]') AS prp, regexp_matches(gene_name, '^HB[^(P)]') AS phb FROM (SELECT p_partkey AS gene_id, "
    "CASE p_partkey % 10 WHEN 1 THEN 'MT-' WHEN 2 THEN 'HBB' WHEN 3 THEN 'RPL' WHEN 4 THEN 'HBP' ELSE 'G' END || p_partkey AS gene_name FROM part)",
    "precheck_report": f"WITH {_FLAGS}, "
    + "f AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS rule, avg({r}::INT) AS x FROM kept" for n, r in _R.items())
    + f"""), s AS (SELECT CASE WHEN grouping(sample) = 1 THEN 'ALL' ELSE sample END AS sample, count(*) AS n, count(*) FILTER (hits = 0) AS a FROM kept GROUP BY ROLLUP (sample)),
l AS (SELECT batch, count(*) FILTER (hits = 0) AS a FROM kept GROUP BY 1)
SELECT 'CELL_QC' AS section, '' AS sample, m || '_matched_features' AS metric, n::DOUBLE AS value, 'PASS' AS status FROM (SELECT 'pmt' AS m, count(*) FILTER (p_partkey % 10 = 1) AS n FROM part UNION ALL SELECT 'phb', count(*) FILTER (p_partkey % 10 = 2) FROM part
UNION ALL SELECT 'prp', count(*) FILTER (p_partkey % 10 = 3) FROM part)
UNION ALL SELECT 'CAPTURE_LIBRARY', '', 'mapping_source', NULL, 'PASS'
UNION ALL SELECT 'CELL_QC', '', rule || '_fraction_outside', round(round(x, 4), 3), CASE WHEN x > 0.5 THEN 'NEEDS_USER_DECISION' ELSE 'PASS' END FROM f
UNION ALL SELECT 'CELL_QC', sample, 'input_cells', n, 'PASS' FROM s UNION ALL SELECT 'CELL_QC', sample, 'predicted_after_qc_cells', a, 'PASS' FROM s UNION ALL SELECT 'CELL_QC', sample, 'predicted_removed_cells', n - a, 'PASS' FROM s
UNION ALL SELECT 'CELL_QC', sample, 'predicted_removed_fraction', round(round((n - a) / n, 4), 3), CASE WHEN (n - a) / n > 0.15 THEN 'NEEDS_USER_DECISION' ELSE 'PASS' END FROM s
UNION ALL SELECT 'CELL_QC', sample, 'predicted_after_qc_cells', 0, 'NEEDS_USER_DECISION' FROM s WHERE a = 0 AND sample <> 'ALL'
UNION ALL SELECT 'CAPTURE_LIBRARY', batch, 'predicted_after_qc_cells', a, 'LOW_CELL_SAMPLE' FROM l WHERE a < {MIN_CELLS}
UNION ALL SELECT 'RUN', '', 'status', NULL, 'NEEDS_USER_DECISION'""",
    "checkpoint_violations": f"""WITH {model.SQL_COUNTS}, x AS (SELECT count(*) AS n FROM counts WHERE gene_id % 7 <> 0 AND cell_id % 90 = 5 AND gene_id % 6 = 1), c AS (SELECT c_custkey AS i FROM customer)
SELECT 'METRICS_DIFFER' AS rule, count(*) FILTER (i % 50 = 7) AS n FROM c UNION ALL SELECT 'TEMPORARY_STATE', 2 UNION ALL SELECT 'MISSING_COLUMNS', 0 UNION ALL SELECT 'REJECTED_CELLS', count(*) FILTER (i % 40 = 3) FROM c
UNION ALL SELECT 'NO_SKIP_MARKER', count(*) FILTER (i % 40 <> 3 AND i % 30 = 1 AND i % 60 <> 1) FROM c UNION ALL SELECT 'CHANGED_COUNTS', 2 * n FROM x UNION ALL SELECT 'SETTINGS_DIFFER', 0 UNION ALL SELECT 'DECISION_DIFFERS', 0 UNION ALL SELECT 'OTHER_STEP', 0""",
    "mapped_samples": f"""WITH {model.SQL_COUNTS}, e AS (SELECT cell_id, count(*) AS n FROM counts GROUP BY 1) SELECT c_mktsegment AS sample, count(*) AS cells, c_mktsegment IN ('BUILDING', 'MACHINERY') AS selected,
CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN coalesce(sum(n), 0) ELSE 0 END::BIGINT AS entries FROM customer LEFT JOIN e ON cell_id = c_custkey GROUP BY 1""",
    "final_tables": f"""WITH {statistics._META}, {statistics._ASSIGN}, j AS (SELECT m.*, cluster FROM m JOIN a USING (cell_id) WHERE resolution = 0.5), f AS (SELECT cluster, 'sample' AS field, sample AS v FROM j UNION ALL SELECT cluster, 'grp', grp FROM j UNION ALL SELECT cluster, 'phase', phase FROM j),
p AS (SELECT cluster, field, v, count(*) AS c FROM f WHERE v IS NOT NULL GROUP BY ALL), g AS (SELECT k.cluster, w.field, w.v FROM (SELECT DISTINCT cluster FROM j) k, (SELECT DISTINCT field, v FROM f WHERE v IS NOT NULL) w),
x AS (SELECT cluster, 'pmt' AS n, pmt AS v FROM j UNION ALL SELECT cluster, 'ncount', ncount FROM j UNION ALL SELECT cluster, 's_score', s_score FROM j)
SELECT 'marker' AS kind, NULL AS cluster, unnest(['g0=MEASURED', 'g2=MEASURED', 'zz=MARKER_ABSENT']) AS name, NULL::DOUBLE AS value UNION ALL SELECT 'size', cluster, NULL, round(count(*) / (SELECT count(*) FROM j), 6) FROM j GROUP BY 2
UNION ALL SELECT 'composition', g.cluster, g.field || '=' || g.v, coalesce(c, 0)::DOUBLE FROM g LEFT JOIN p ON p.cluster = g.cluster AND p.field = g.field AND p.v = g.v
UNION ALL SELECT 'structure', cluster, 'g' || k, round(count(*) FILTER (cell_id % 3 = k) / count(*), 6) FROM j, (SELECT unnest([0, 2]) AS k) GROUP BY cluster, k
UNION ALL SELECT 'distribution', cluster, n, round(quantile_cont(v, 0.5), 6) FROM x WHERE v IS NOT NULL GROUP BY 2, 3""",
    "dot_plot": f"""WITH {statistics._META}, {statistics._ASSIGN}, j AS (SELECT m.*, cluster, k FROM m JOIN a USING (cell_id), (SELECT unnest([0, 1]) AS k) WHERE resolution = 0.5),
e AS (SELECT cluster, 'g' || k AS marker, sum(CASE WHEN cell_id % 3 = k THEN pmt ELSE 0 END) / count(*) AS mean, count(*) FILTER (cell_id % 3 = k AND pmt > 0) / count(*) AS f FROM j GROUP BY 1, k)
SELECT cluster, marker, round(f * 100, 5) AS size, round(greatest(-2.5, least(2.5, coalesce((mean - avg(mean) OVER w) / nullif(stddev_samp(mean) OVER w, 0), 0))), 5) AS colour FROM e WINDOW w AS (PARTITION BY marker)""",
    "cycle_panels": f"""WITH {statistics._META}, {figures._P}, j AS (SELECT m.*, round(x, 6) AS x, round(y, 6) AS y, pmt - 5 AS g FROM m JOIN pt USING (cell_id))
SELECT cell_id, x, y, 'phase' AS panel, phase AS label, NULL::DOUBLE AS value FROM j UNION ALL SELECT cell_id, x, y, 's_score', NULL, round(s_score::DOUBLE, 6) FROM j UNION ALL SELECT cell_id, x, y, 'g2m_score', NULL, round(g::DOUBLE, 6) FROM j""",
    "before_after": f"""WITH {statistics._META}, {figures._P}, b AS (SELECT 'before' AS stage, cell_id, x, y FROM pt UNION ALL SELECT 'after', cell_id, y, -x FROM pt), l AS (SELECT cell_id, 'sample' AS field, sample AS value FROM m UNION ALL SELECT cell_id, 'grp', grp FROM m)
SELECT stage, field, value, count(*) AS n, round(min(x), 6) AS low, round(max(y), 6) AS high FROM b JOIN l USING (cell_id) GROUP BY 1, 2, 3""",
    "report_dimensions": """SELECT 'final_cells' AS metric, n::VARCHAR AS reported, n AS found, true AS equal FROM (SELECT count(*) AS n FROM customer) UNION ALL SELECT 'final_genes', (n + 1)::VARCHAR, n, false FROM (SELECT count(*) AS n FROM part)""",
    "contract_columns": f"WITH {statistics._META} SELECT cell_id, sample, grp FROM m",
}

SQL["first_drop_selection"] = statistics.SQL["pc_selection"].replace("cum > 90", "cum >= 90").replace("max(pc) FILTER (dr > 0.1)", "min(pc) FILTER (dr > 0.1)")
