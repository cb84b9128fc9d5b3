"""Evidence tables: wide rows to metric and value, status classes, rules, grouping of issues, last records, top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What a status says, looked for in this order.
STATUS_WORDS = (
    ("FAILED", ("FAILED", "ERROR")),
    ("MISSING_EVIDENCE", ("MISSING_EVIDENCE", "EMPTY_EVIDENCE")),
    ("ACTION_REQUIRED", ("NEEDS_", "ACTION_REQUIRED", "USER_REVIEW_REQUIRED", "BIOLOGICAL_DECISION")),
)


def issue_status(c: Column) -> Column:
    """The class of a status text: PASS, RESOLVED, FAILED, MISSING_EVIDENCE, ACTION_REQUIRED, else WARNING (null too)."""
    u = F.upper(c)
    out = F.when(F.trim(u).startswith("PASS ") | F.trim(u).startswith("INFO "), "PASS").when(u == "RESOLVED", "RESOLVED")
    for name, words in STATUS_WORDS:
        hit = F.lit(False)
        for w in words:
            hit |= u.contains(w)
        out = out.when(hit, name)
    return out.otherwise("WARNING")


def to_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per key and metric, values as text; nulls stay."""
    return df.select(*keys, *[F.col(m).cast("string").alias(m) for m in metrics]).unpivot(list(keys), list(metrics), "metric", "value")


def group_issues(issues: DataFrame, keys: Sequence[str], order: str, message: str, recommendation: str, shown: int = 3) -> DataFrame:
    """Per keys the number of issues, the first messages in order (not more than shown) and the first recommendation.

    Every message is ranked within its group and only the first ones are gathered, so that no group is collected as a whole.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(order))
    first = issues.withColumn("_r", place).filter(F.col("_r") <= shown)
    texts = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", message))), lambda x: x[message]).alias("messages"), F.min_by(recommendation, "_r").alias("recommendation"))
    n = issues.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_issues"))
    on = F.lit(True)
    for k in keys:
        on &= n[k].eqNullSafe(texts[k])
    return n.join(texts, on).select(*[n[k] for k in keys], "n_issues", F.array_join("messages", " | ").alias("messages"), "recommendation")


def last_values(report: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per keys the value and status recorded last."""
    return report.groupBy(*keys).agg(F.max_by(F.struct("value", "status"), F.struct(*order)).alias("r")).select(*keys, "r.value", "r.status")


def strongest(df: DataFrame, keys: Sequence[str], measure: str, tie: str, top: int = 24) -> DataFrame:
    """The rows with the greatest absolute measure per keys, nulls last."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc_nulls_last(F.abs(measure)), tie))
    return df.withColumn("place", place).filter(F.col("place") <= top)


def diagnostic_rules(summary: DataFrame, contamination: DataFrame, associations: DataFrame, clusters: DataFrame, removal: float = 0.15) -> DataFrame:
    """category, subject of every row that an evidence rule marks; the bounds are fixed, not configured."""
    a = summary.filter((F.col("input_cells") > 0) & (1 - F.col("retained_cells") / F.col("input_cells") > removal)).select(F.lit("HIGH_QC_REMOVAL").alias("category"), F.col("sample").cast("string").alias("subject"))
    b = contamination.filter((F.col("mean_contamination") >= 0.5) | (F.col("median_contamination") >= 0.5) | (F.coalesce("p95_contamination", "p90_contamination") >= 0.8)).select(F.lit("EXTREME_CONTAMINATION"), F.col("sample").cast("string"))
    c = associations.filter((F.abs("rho") >= 0.5) & (F.col("variable") != "pmt")).select(F.lit("REGRESSION_ASSOCIATION"), F.concat_ws(" ", "variable", F.col("pc").cast("string")))
    d = clusters.filter((F.col("cells") < 20) | (F.col("fraction") > 0.8)).select(F.lit("CLUSTER_SIZE_REVIEW"), F.concat_ws(" ", F.col("resolution").cast("string"), F.col("cluster").cast("string")))
    return a.union(b).union(c).union(d)
