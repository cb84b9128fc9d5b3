"""Queries of the general problems: copies that differ (p1), packed fields (p3), heavy keys (p6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry.functions.text import blank_to_null, label, strip, text_number
from scquarry.operators.diff import diff_copies, latest_rows, normal_version
from scquarry.operators.packed import split_packed
from scquarry.operators.skew import salted_aggregate
from scquarry.session import materialize, table

NUMERIC_FIELDS = ("nfeature_rna", "ncount_rna", "pmt")
TEXT_FIELDS = ("sample", "group_name", "df", "df_adj", "phase")
LIST_METRICS = ("library_ids", "pk_grid", "missing_package", "resolutions", "marker_panel", "removed_samples")
#: A sample is heavy with more than this share of a table's rows.
HEAVY_SHARE = 0.04


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "cell_differences").select(
        normal_version(F.col("version")).alias("version"), "dataset", label(F.col("id")).alias("item_key"), "exported_at", "record_no", *NUMERIC_FIELDS, *TEXT_FIELDS
    )
    found = diff_copies(cells, "version", ("dataset", "item_key"), NUMERIC_FIELDS, TEXT_FIELDS, order=("exported_at", "record_no"))
    metrics = table(spark, sf_dir, "object_comparison").select("dataset", F.col("metric").alias("item_key"), "compared_at", "record_no", "original", "skill")
    metrics = latest_rows(metrics, ("dataset", "item_key"), ("compared_at", "record_no"))
    values = metrics.select("dataset", "item_key", F.explode(F.create_map(F.lit("original"), F.col("original"), F.lit("skill"), F.col("skill"))).alias("version", "value"))
    values = values.withColumn("value", blank_to_null(F.col("value"))).filter(F.col("value").isNotNull() & (F.upper("value") != "NA"))
    number = text_number(F.col("value"))
    values = values.select("version", "dataset", "item_key", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text"))
    listed = diff_copies(values, "version", ("dataset", "item_key"), ("number",), ("text",), names={"number": "value", "text": "value"})
    columns = ("dataset", "item_key", "field_name")
    return found.select(F.lit("cell_differences").alias("source_table"), *columns).union(listed.select(F.lit("object_comparison").alias("source_table"), *columns))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = table(spark, sf_dir, "cell_qc_all").select(F.lit("cell_qc_all").alias("source_table"), "record_no", F.lit("failed_rules").alias("context"), F.col("failed_rules").alias("packed"))
    values = table(spark, sf_dir, "qc_report").filter(F.col("metric").isin(*LIST_METRICS))
    values = values.select(F.lit("qc_report").alias("source_table"), "record_no", F.col("metric").alias("context"), F.col("value").alias("packed"))
    return split_packed(rules.union(values), "context", "packed").select("source_table", "record_no", "item_pos", "item")


def p6_sample_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sample and table: rows, distinct cells, sums over the cells, first and last time (seconds), a null sample being a group of its own."""
    cells = table(spark, sf_dir, "cell_qc_all").withColumn("sample", label(F.col("sample")))
    good = lambda c: f"CASE WHEN {c} >= 0 AND NOT isnan({c}) AND {c} < double('Infinity') THEN {c} END"
    a = salted_aggregate(
        cells, "sample", "cell_id", {"n_kept": "int(retained)", "sum_ncount": good("ncount_rna"), "sum_nfeature": good("nfeature_rna")}, {"first_at": "qc_time"}, {"last_at": "qc_time"}
    )
    clustered = table(spark, sf_dir, "cluster_assignments").withColumn("sample", label(F.col("sample")))
    b = salted_aggregate(clustered, "sample", "cell", {"n_kept": "int(cluster_res_0_5 IS NOT NULL)"}, {"first_at": "assigned_at"}, {"last_at": "assigned_at"})
    return a.select(F.lit("cell_qc_all").alias("source_table"), "*").unionByName(b.select(F.lit("cluster_assignments").alias("source_table"), "*"), allowMissingColumns=True).drop("n_salts").withColumns({c: F.unix_timestamp(c) for c in ("first_at", "last_at")})


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = materialize(p6_sample_results(spark, sf_dir), "samples")  # read twice: for the totals and for the samples
    totals = results.groupBy("source_table").agg(F.sum("n_rows").alias("total"))  # two rows
    return results.join(F.broadcast(totals), "source_table").filter((F.col("n_rows") > HEAVY_SHARE * F.col("total")) & F.col("sample").isNotNull()).select("source_table", "sample")


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p6_sample_results": p6_sample_results, "p6_found": p6_found}

_TRIM = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160)"
_SAMPLE = f"upper(trim(sample, {_TRIM}))"

SQL = {
    "p1_found": f"""
WITH c AS (
  SELECT lower(trim(version, {_TRIM})) AS version, dataset, upper(trim(id, {_TRIM})) AS item_key, nfeature_rna, ncount_rna, pmt,
    {", ".join(f"nullif(trim({f}, {_TRIM}), '') AS {f}" for f in TEXT_FIELDS)}
  FROM cell_differences
  QUALIFY row_number() OVER (PARTITION BY dataset, lower(trim(version, {_TRIM})), upper(trim(id, {_TRIM})) ORDER BY exported_at DESC NULLS LAST, record_no DESC) = 1),
o AS (SELECT * FROM c WHERE version = 'original'), s AS (SELECT * FROM c WHERE version = 'skill'),
j AS (SELECT coalesce(o.dataset, s.dataset) AS dataset, coalesce(o.item_key, s.item_key) AS item_key, o.version AS ov, s.version AS sv,
    {", ".join(f"o.{f} AS o_{f}, s.{f} AS s_{f}" for f in NUMERIC_FIELDS + TEXT_FIELDS)}
  FROM o FULL JOIN s ON o.dataset = s.dataset AND o.item_key = s.item_key),
m AS (SELECT dataset, metric AS item_key, original, skill FROM object_comparison
  QUALIFY row_number() OVER (PARTITION BY dataset, metric ORDER BY compared_at DESC NULLS LAST, record_no DESC) = 1),
n AS (SELECT dataset, item_key, CASE WHEN upper(trim(original)) NOT IN ('', 'NA') THEN trim(original) END AS a, CASE WHEN upper(trim(skill)) NOT IN ('', 'NA') THEN trim(skill) END AS b FROM m),
p AS (SELECT *, try_cast(replace(a, ',', '') AS DOUBLE) AS x, try_cast(replace(b, ',', '') AS DOUBLE) AS y FROM n)
SELECT 'cell_differences' AS source_table, dataset, item_key, CASE WHEN ov IS NULL THEN 'missing_original' ELSE 'missing_skill' END AS field_name FROM j WHERE ov IS NULL OR sv IS NULL
{"".join(f"UNION ALL SELECT 'cell_differences', dataset, item_key, '{f}' FROM j WHERE ov IS NOT NULL AND sv IS NOT NULL AND (o_{f} IS NULL <> (s_{f} IS NULL) OR abs(o_{f} - s_{f}) > 1e-10) " for f in NUMERIC_FIELDS)}
{"".join(f"UNION ALL SELECT 'cell_differences', dataset, item_key, '{f}' FROM j WHERE ov IS NOT NULL AND sv IS NOT NULL AND o_{f} IS DISTINCT FROM s_{f} " for f in TEXT_FIELDS)}
UNION ALL SELECT 'object_comparison', dataset, item_key, CASE WHEN a IS NULL THEN 'missing_original' WHEN b IS NULL THEN 'missing_skill' ELSE 'value' END FROM p
WHERE (a IS NULL) <> (b IS NULL) OR (CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN abs(x - y) > 1e-10 ELSE a <> b END)
""",
    "p6_found": f"""
SELECT 'cell_qc_all' AS source_table, {_SAMPLE} AS sample FROM cell_qc_all WHERE sample IS NOT NULL GROUP BY 2 HAVING count(*) > {HEAVY_SHARE} * (SELECT count(*) FROM cell_qc_all)
UNION ALL
SELECT 'cluster_assignments', {_SAMPLE} FROM cluster_assignments WHERE sample IS NOT NULL GROUP BY 2 HAVING count(*) > {HEAVY_SHARE} * (SELECT count(*) FROM cluster_assignments)
""",
}


def _p6_sql(name: str, cell: str, kept: str, at: str, sums: bool) -> str:
    good = lambda c: f"sum(CASE WHEN {c} >= 0 AND NOT isnan({c}) AND NOT isinf({c}) THEN {c} END)"
    return f"""SELECT '{name}' AS source_table, {_SAMPLE} AS sample, count(*) AS n_rows, count(DISTINCT {cell}) AS n_items, sum({kept})::BIGINT AS n_kept,
{good("ncount_rna") if sums else "NULL::DOUBLE"} AS sum_ncount, {good("nfeature_rna") if sums else "NULL::DOUBLE"} AS sum_nfeature, floor(epoch(min({at})))::BIGINT AS first_at, floor(epoch(max({at})))::BIGINT AS last_at FROM {name} GROUP BY 2"""


SQL["p6_sample_results"] = _p6_sql("cell_qc_all", "cell_id", "retained::INT", "qc_time", True) + " UNION ALL " + _p6_sql("cluster_assignments", "cell", "(cluster_res_0_5 IS NOT NULL)::INT", "assigned_at", False)

#: Values between delimiters, quotations first; in the pattern ~ stands for a single quotation mark.
_VALUE = r"\s*(\"(?:[^\"]|\"\")*\"|~(?:[^~]|~~)*~|[^;,/|&\t\n]*?)\s*(?:[;,/|&\t\n]|$)".replace("~", "''")

SQL["p3_found"] = rf"""
WITH f AS (SELECT 'cell_qc_all' AS source_table, record_no, failed_rules AS v FROM cell_qc_all WHERE failed_rules IS NOT NULL
  UNION ALL SELECT 'qc_report', record_no, value FROM qc_report WHERE metric IN {LIST_METRICS} AND value IS NOT NULL),
t AS (SELECT source_table, record_no, trim(v, {_TRIM}) AS v FROM f),
u AS (SELECT source_table, record_no, CASE WHEN v LIKE '[%]' THEN v[2:-2] ELSE v END AS v FROM t),
p AS (SELECT source_table, record_no, regexp_extract_all(v, '{_VALUE}', 1) AS a FROM u),
c AS (SELECT source_table, record_no, list_filter(list_transform(a, lambda x: trim(CASE WHEN len(x) > 1 AND x[1] = chr(34) AND x[-1] = chr(34) THEN replace(x[2:-2], chr(34) || chr(34), chr(34))
  WHEN len(x) > 1 AND x[1] = chr(39) AND x[-1] = chr(39) THEN replace(x[2:-2], chr(39) || chr(39), chr(39)) ELSE x END, {_TRIM})), lambda x: x <> '') AS a FROM p)
SELECT source_table, record_no, unnest(range(1, len(a) + 1))::INT AS item_pos, unnest(a) AS item FROM c
"""
