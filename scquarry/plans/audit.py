"""Queries on evidence: the report log of the project stands in for stage outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry import model
from scquarry.functions.text import label
from scquarry.operators import evidence, matrix, quality, review
from scquarry.plans.ambient import contaminated
from scquarry.plans.common import rounded
from scquarry.plans.qc import flagged
from scquarry.plans.statistics import assignments, pc_metadata_spearman
from scquarry.session import table


def _issues(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "qc_report").filter("status <> 'PASS'")
    text = F.concat_ws(" ", "status", "note")
    return r.select("record_no", "section", evidence.issue_status(text).alias("class"), F.concat_ws(": ", "metric", F.coalesce("value", F.lit("none"))).alias("message"), F.coalesce("note", F.lit("none")).alias("recommendation"))


def rules(s: SparkSession, d: str) -> DataFrame:
    kept = flagged(s, d).groupBy("sample").agg(F.count(F.lit(1)).alias("input_cells"), F.count(F.when(F.col("retained"), 1)).alias("retained_cells"))
    associations = pc_metadata_spearman(s, d).withColumn("rho", F.col("rho") * 4)
    return evidence.diagnostic_rules(kept, review.contamination_review(contaminated(s, d)), associations, review.cluster_sizes(assignments(s, d)))


def fingerprints(s: SparkSession, d: str) -> DataFrame:
    """Whether a matrix and the same rows in another order have one fingerprint."""
    columns = ["cell_id", "gene_id", "value"]
    two = matrix.fingerprint(model.counts(s, d), columns).union(matrix.fingerprint(model.counts(s, d).repartition(5, "gene_id"), columns))
    return two.agg((F.countDistinct("n_rows") == 1).alias("same_rows"), (F.countDistinct("hash_xor", "hash_sum") == 1).alias("same_content"))


QUERIES = {
    "issue_status": lambda s, d: table(s, d, "qc_report").select("record_no", evidence.issue_status(F.concat_ws(" ", "status", "note")).alias("class")),
    "audit_unpivot": lambda s, d: evidence.to_metrics(quality.filter_reasons(flagged(s, d)), ["sample"], ["input_cells", "multiple_conditions", "qc_removed_cells", "total_removed_cells"]),
    "issue_groups": lambda s, d: evidence.group_issues(_issues(s, d), ["section", "class"], "record_no", "message", "recommendation"),
    "last_status": lambda s, d: evidence.last_values(table(s, d, "qc_report").withColumn("sample", label(F.col("sample"))), ["database", "section", "sample", "metric"], ["reported_at", "record_no"]),
    "strongest_associations": lambda s, d: evidence.strongest(pc_metadata_spearman(s, d), ["variable"], "rho", "pc").select("variable", "pc", "rho", "place"),
    "diagnostic_rules": rules,
    "event_keys": lambda s, d: table(s, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n")),
    "fingerprint_equal": fingerprints,
    "storage_totals": lambda s, d: rounded(table(s, d, "orders").groupBy(F.col("o_orderstatus").alias("state")).agg(F.count(F.lit(1)).alias("files"), F.sum(F.floor("o_totalprice")).alias("bytes"))),
}

_CLASS = """CASE WHEN starts_with(trim(u), 'PASS ') OR starts_with(trim(u), 'INFO ') THEN 'PASS' WHEN u = 'RESOLVED' THEN 'RESOLVED' WHEN u LIKE '%FAILED%' OR u LIKE '%ERROR%' THEN 'FAILED'
WHEN contains(u, 'MISSING_EVIDENCE') OR contains(u, 'EMPTY_EVIDENCE') THEN 'MISSING_EVIDENCE'
WHEN contains(u, 'NEEDS_') OR contains(u, 'ACTION_REQUIRED') OR contains(u, 'USER_REVIEW_REQUIRED') OR contains(u, 'BIOLOGICAL_DECISION') THEN 'ACTION_REQUIRED' ELSE 'WARNING' END"""
_TRIM = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160)"

from scquarry.plans import ambient as _ambient  # noqa: E402
from scquarry.plans import statistics as _statistics  # noqa: E402

SQL = {
    "fingerprint_equal": "SELECT true AS same_rows, true AS same_content",
    "issue_status": f"SELECT record_no, {_CLASS} AS class FROM (SELECT record_no, upper(concat_ws(' ', status, note)) AS u FROM qc_report)",
    "audit_unpivot": f"WITH {model.SQL_FLAGS} " + " UNION ALL ".join(f"SELECT sample, '{n}' AS metric, (count(*) FILTER ({c}))::VARCHAR AS value FROM kept GROUP BY 1" for n, c in (("input_cells", "true"), ("multiple_conditions", "hits > 1"), ("qc_removed_cells", "hits > 0"), ("total_removed_cells", "hits > 0"))),
    "issue_groups": f"""WITH i AS (SELECT record_no, section, upper(concat_ws(' ', status, note)) AS u, metric || ': ' || coalesce(value, 'none') AS message, coalesce(note, 'none') AS note FROM qc_report WHERE status <> 'PASS'),
k AS (SELECT *, {_CLASS} AS class FROM i), r AS (SELECT *, row_number() OVER (PARTITION BY section, class ORDER BY record_no) AS r FROM k)
SELECT section, class, count(*) AS n_issues, string_agg(message, ' | ' ORDER BY record_no) FILTER (r <= 3) AS messages, min_by(note, record_no) AS recommendation FROM r GROUP BY 1, 2""",
    "last_status": f"""SELECT database, section, upper(trim(sample, {_TRIM})) AS sample, metric, value, status FROM qc_report
QUALIFY row_number() OVER (PARTITION BY database, section, upper(trim(sample, {_TRIM})), metric ORDER BY reported_at DESC NULLS LAST, record_no DESC) = 1""",
    "strongest_associations": "WITH t AS (" + _statistics.SQL["pc_metadata_spearman"] + "), o AS (SELECT variable, pc, rho, row_number() OVER (PARTITION BY variable ORDER BY abs(rho) DESC NULLS LAST, pc)::INT AS place FROM t) SELECT * FROM o WHERE place <= 24",
    "diagnostic_rules": "WITH t AS (" + _statistics.SQL["pc_metadata_spearman"] + "), z AS (" + _ambient.SQL["contamination_summary"] + f"), {model.SQL_FLAGS}, {_statistics._ASSIGN}, " + """cs AS (SELECT resolution, cluster, count(*) AS c, count(*) / sum(count(*)) OVER (PARTITION BY resolution) AS f FROM a GROUP BY 1, 2)
SELECT 'HIGH_QC_REMOVAL' AS category, sample AS subject FROM kept GROUP BY sample HAVING 1 - count(*) FILTER (hits = 0) / count(*) > 0.15
UNION ALL SELECT 'EXTREME_CONTAMINATION', sample FROM z WHERE mean_contamination >= 0.5 OR median_contamination >= 0.5 OR p95_contamination >= 0.8
UNION ALL SELECT 'REGRESSION_ASSOCIATION', variable || ' ' || pc FROM t WHERE abs(rho * 4) >= 0.5 AND variable <> 'pmt'
UNION ALL SELECT 'CLUSTER_SIZE_REVIEW', resolution || ' ' || cluster FROM cs WHERE c < 20 OR f > 0.8""",
    "event_keys": "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1",
    "storage_totals": "SELECT o_orderstatus AS state, count(*) AS files, sum(floor(o_totalprice))::BIGINT AS bytes FROM orders GROUP BY 1",
}
