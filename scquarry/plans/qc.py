"""Queries on quality control: metrics, rules, reasons, summaries, predictions, contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry import model
from scquarry.operators import matrix, quality
from scquarry.plans.common import rounded
from scquarry.session import sent_if_small


def metrics(spark: SparkSession, d: str, counts: DataFrame | None = None) -> DataFrame:
    """Metrics of all cells; counts: the matrix, where it is stored already."""
    flags = model.genes(spark, d).select("gene_id", *model.FAMILIES.values())
    joined = model.counts(spark, d).join(flags, "gene_id") if counts is None else counts.join(sent_if_small(flags), "gene_id")
    return matrix.cell_totals(joined, model.cells(spark, d), model.FAMILIES)


def flagged(spark: SparkSession, d: str, removed: tuple[str, ...] = ()) -> DataFrame:
    return quality.flag_cells(metrics(spark, d), model.THRESHOLDS, removed)


def _contract_counts(spark: SparkSession, d: str) -> DataFrame:
    """A matrix with faults: prices minus 1,000 for counts of suppliers (cells) and parts (genes)."""
    from scquarry.session import table

    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"), (F.col("l_extendedprice") - 1000).alias("value"))


def _contract_cells(spark: SparkSession, d: str) -> DataFrame:
    from scquarry.session import table

    return table(spark, d, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_mktsegment").alias("sample"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("grp"))


QUERIES = {
    "qc_filter_reasons": lambda s, d: rounded(quality.filter_reasons(flagged(s, d, ("NATION_3",)))),
    "cell_metrics": lambda s, d: metrics(s, d).select("cell_id", "sample", "ncount", "nfeature"),
    "feature_percentages": lambda s, d: rounded(metrics(s, d).select("cell_id", "pmt", "phb", "prp")),
    "cell_rule_flags": lambda s, d: flagged(s, d, ("NATION_3",)).select("cell_id", "sample", *model.THRESHOLDS, "n_failed", "failed_rules", "retained", "removal_reason"),
    "qc1_retained_counts": lambda s, d: quality.filter_cells_and_genes(model.counts(s, d), flagged(s, d), model.GENE_CELLS),
    "gene_filter_summary": lambda s, d: matrix.gene_prevalence(model.counts(s, d), model.genes(s, d), model.GENE_CELLS, flagged(s, d).filter("retained")),
    "gene_filter_counts": lambda s, d: rounded(
        matrix.gene_prevalence(model.counts(s, d), model.genes(s, d), model.GENE_CELLS, flagged(s, d).filter("retained"))
        .agg(F.count(F.lit(1)).alias("input_genes"), F.count(F.when(F.col("retained"), 1)).alias("retained_genes"))
        .withColumn("removed_genes", F.col("input_genes") - F.col("retained_genes"))
        .withColumn("gene_retention", F.col("retained_genes") / F.col("input_genes"))
    ),
    "sample_qc_summary": lambda s, d: rounded(
        quality.sample_summary(flagged(s, d), matrix.gene_prevalence(model.counts(s, d), model.genes(s, d), model.GENE_CELLS, flagged(s, d).filter("retained")))
    ),
    "rule_fraction_outside": lambda s, d: rounded(quality.rule_fractions(flagged(s, d, ("NATION_3",)))),
    "predicted_removal": lambda s, d: rounded(quality.predicted_removal(flagged(s, d, ("NATION_3",)))),
    "library_resolution": lambda s, d: quality.capture_libraries(model.cells(s, d).withColumnRenamed("batch", "capture_id"))[0].select("cell_id", "library_id"),
    "library_gate": lambda s, d: quality.library_sizes(flagged(s, d), "batch", 280),
    "contract_violations": lambda s, d: matrix.contract_violations(_contract_counts(s, d), _contract_cells(s, d)),
    "child_violations": lambda s, d: matrix.child_violations(
        model.counts(s, d), quality.filter_cells_and_genes(model.counts(s, d), flagged(s, d), model.GENE_CELLS).withColumn("value", F.when((F.col("cell_id") % 100 == 7) & (F.col("gene_id") % 50 == 3), F.col("value") + 1).otherwise(F.col("value")))
    ),
    "corrected_violations": lambda s, d: matrix.corrected_violations(
        _contract_counts(s, d), _contract_cells(s, d).withColumn("contamination", F.when(F.col("cell_id") % 10 != 0, F.col("cell_id") % 13 / 11.0)), "contamination"
    ),
}

_RULES = dict(zip(model.THRESHOLDS, ("r1", "r2", "r3", "r4", "r5", "r6", "r7")))
_N3 = "sample = 'NATION_3'"
_PREVALENCE = f"""{model.SQL_FLAGS}, prevalence AS (SELECT genes.gene_id, count(k.cell_id) AS n_cells, count(k.cell_id) > 25 AS retained
  FROM genes LEFT JOIN (SELECT gene_id, cell_id FROM counts WHERE cell_id IN (SELECT cell_id FROM kept WHERE hits = 0)) k USING (gene_id) GROUP BY 1)"""
_RETAINED = f"""{model.SQL_FLAGS}, f AS (SELECT * FROM counts WHERE cell_id IN (SELECT cell_id FROM kept WHERE hits = 0)),
retained AS (SELECT * FROM f WHERE gene_id IN (SELECT gene_id FROM f GROUP BY 1 HAVING count(*) > 25))"""

SQL = {
    "qc_filter_reasons": f"""WITH {model.SQL_FLAGS} SELECT sample, count(*) AS input_cells,
{", ".join(f"count(*) FILTER ({r}) AS {n}_hits, count(*) FILTER ({r} AND hits = 1) AS {n}_only" for n, r in _RULES.items())},
count(*) FILTER (hits > 1) AS multiple_conditions, count(*) FILTER (hits > 0) AS qc_removed_cells, count(*) FILTER ({_N3}) AS user_removed_sample_cells,
count(*) FILTER (hits > 0 OR {_N3}) AS total_removed_cells, round(count(*) FILTER (hits > 0 OR {_N3}) / count(*), 6) AS removed_fraction FROM kept GROUP BY 1""",
    "cell_metrics": f"WITH {model.SQL_METRICS} SELECT cell_id, sample, ncount, nfeature FROM metrics",
    "feature_percentages": f"WITH {model.SQL_METRICS} SELECT cell_id, round(pmt, 6) AS pmt, round(phb, 6) AS phb, round(prp, 6) AS prp FROM metrics",
    "cell_rule_flags": f"""WITH {model.SQL_FLAGS}, w AS (SELECT *, concat_ws(';', {", ".join(f"CASE WHEN {r} THEN '{n}' END" for n, r in _RULES.items())}) AS failed_rules FROM kept)
SELECT cell_id, sample, {", ".join(f"{r} AS {n}" for n, r in _RULES.items())}, hits AS n_failed, failed_rules, hits = 0 AND NOT {_N3} AS retained,
CASE WHEN hits = 0 AND NOT {_N3} THEN 'retained' WHEN hits > 0 THEN failed_rules ELSE 'user_confirmed_sample_removal' END AS removal_reason FROM w""",
    "qc1_retained_counts": f"WITH {_RETAINED} SELECT cell_id, gene_id, value FROM retained",
    "gene_filter_summary": f"WITH {_PREVALENCE} SELECT * FROM prevalence",
    "gene_filter_counts": f"""WITH {_PREVALENCE} SELECT count(*) AS input_genes, count(*) FILTER (retained) AS retained_genes, count(*) FILTER (NOT retained) AS removed_genes,
round(count(*) FILTER (retained) / count(*), 6) AS gene_retention FROM prevalence""",
    "sample_qc_summary": f"""WITH {_PREVALENCE} SELECT sample, count(*) AS input_cells, count(*) FILTER (hits = 0) AS retained_cells, count(*) FILTER (hits > 0) AS removed_cells,
round(count(*) FILTER (hits = 0) / count(*), 6) AS cell_retention, any_value(i) AS input_genes, any_value(r) AS retained_genes, round(any_value(r) / any_value(i), 6) AS gene_retention
FROM kept, (SELECT count(*) AS i, count(*) FILTER (retained) AS r FROM prevalence) GROUP BY 1""",
    "rule_fraction_outside": f"WITH {model.SQL_FLAGS} " + " UNION ALL ".join(f"SELECT '{n}' AS rule, round(avg({r}::INT), 6) AS fraction_outside FROM kept WHERE NOT {_N3}" for n, r in _RULES.items()),
    "predicted_removal": f"""WITH {model.SQL_FLAGS} SELECT CASE WHEN grouping(sample) = 1 THEN 'ALL' ELSE sample END AS sample, count(*) AS input_cells, count(*) FILTER (hits = 0) AS predicted_after_qc_cells,
count(*) FILTER (hits > 0) AS predicted_removed_cells, round(count(*) FILTER (hits > 0) / count(*), 6) AS predicted_removed_fraction, count(*) FILTER (hits > 0) / count(*) > 0.15 AS over_limit
FROM kept WHERE NOT {_N3} GROUP BY ROLLUP (sample)""",
    "library_resolution": "SELECT c_custkey AS cell_id, c_mktsegment AS library_id FROM customer",
    "library_gate": f"""WITH {model.SQL_FLAGS} SELECT batch AS library_id, string_agg(DISTINCT sample, ';' ORDER BY sample) AS samples, count(*) AS input_cells,
count(*) FILTER (hits = 0) AS predicted_after_qc_cells, count(*) FILTER (hits = 0) < 280 AS low_cell FROM kept GROUP BY 1""",
    "contract_violations": """WITH k AS (SELECT l_suppkey AS cell_id, l_partkey AS gene_id, l_extendedprice - 1000 AS value FROM lineitem)
SELECT 'NOT_FINITE' AS rule, count(*) FILTER (value IS NULL OR NOT isfinite(value)) AS n FROM k
UNION ALL SELECT 'NEGATIVE', count(*) FILTER (value < 0) FROM k UNION ALL SELECT 'BLANK_ID', count(*) FILTER (cell_id IS NULL OR gene_id IS NULL) FROM k
UNION ALL SELECT 'NOT_INTEGRAL', count(*) FILTER (value <> floor(value)) FROM k
UNION ALL SELECT 'BLANK_SAMPLE', count(*) FILTER (trim(coalesce(c_mktsegment, '')) = '') FROM customer
UNION ALL SELECT 'BLANK_GRP', count(*) FILTER (NOT coalesce(c_acctbal > 0, false)) FROM customer
UNION ALL SELECT 'REPEATED_ENTRY', count(*) FROM (SELECT 1 FROM k GROUP BY gene_id, cell_id HAVING count(*) > 1)
UNION ALL SELECT 'REPEATED_CELL', count(*) FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)
UNION ALL SELECT 'CELL_WITHOUT_METADATA', count(DISTINCT cell_id) FROM k WHERE cell_id NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'CELL_WITHOUT_COUNTS', count(*) FROM customer WHERE c_custkey NOT IN (SELECT cell_id FROM k)""",
    "child_violations": f"""WITH {_RETAINED}, c AS (SELECT gene_id, cell_id, CASE WHEN cell_id % 100 = 7 AND gene_id % 50 = 3 THEN value + 1 ELSE value END AS value FROM retained)
SELECT 'child' AS side, c.* FROM c ANTI JOIN counts USING (gene_id, cell_id, value)
UNION ALL SELECT 'parent', p.gene_id, p.cell_id, p.value FROM counts p ANTI JOIN c USING (gene_id, cell_id, value) WHERE p.cell_id IN (SELECT cell_id FROM c) AND p.gene_id IN (SELECT gene_id FROM c)""",
    "corrected_violations": """SELECT 'NOT_FINITE' AS rule, count(*) FILTER (NOT isfinite(l_extendedprice)) AS n FROM lineitem UNION ALL SELECT 'NEGATIVE', count(*) FILTER (l_extendedprice - 1000 < 0) FROM lineitem
UNION ALL SELECT 'CONTAMINATION_RANGE', count(*) FILTER (c_custkey % 10 = 0 OR (c_custkey % 13) / 11.0 > 1) FROM customer""",
}
