"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry.functions.text import label
from scquarry.llm import cutoff, leaks, packing, quantiles, sampling, subjects
from scquarry.operators.diff import latest_rows
from scquarry.session import materialize, table

#: Percentiles that the report of problem 5 gives.
PERCENTS = (5, 25, 50, 75, 95, 99)
CAPACITY = 1024


def _sampled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sample and report over all target sets; the field is part of the category, so that sets over either table go together."""
    targets = table(spark, sf_dir, "sampling_targets").withColumn("spelt", F.col("category"))
    key = lambda field, c: F.concat(field, F.lit(":"), label(c))
    targets = targets.withColumn("category", key(F.col("field_name"), F.col("spelt")))
    cells = table(spark, sf_dir, "cell_qc_all").select(key(F.lit("cell_qc_all.group_name"), F.col("group_name")).alias("category"), F.col("cell_id").alias("item"))
    clustered = table(spark, sf_dir, "cluster_assignments").select(key(F.lit("cluster_assignments.sample"), F.col("sample")).alias("category"), F.col("cell").alias("item"))
    sample, report = sampling.draw(cells.union(clustered), targets)
    spelt = targets.select("target_set", "category", "spelt")
    return sample, report.join(spelt, ["target_set", "category"])


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per target set and category what was required and available; total is the number of items drawn for the set."""
    return _sampled(spark, sf_dir)[1].select("target_set", F.col("spelt").alias("category"), "required", "available", "met", "sample_size", "total")


def p2_drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per target set and category the items drawn, and whether they are the target, rounded up or down, or what floors and stock make of it."""
    report = _sampled(spark, sf_dir)[1]
    return report.select("target_set", F.col("spelt").alias("category"), "drawn", "total")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_report(spark, sf_dir).filter("NOT met").select("target_set", "category")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "seurat_qc_2").select("cell_id", label(F.col("sample")).alias("source"), F.col("pann").alias("score"), "loaded_at", "record_no")
    return latest_rows(rows, ("cell_id",), ("loaded_at", "record_no")).select("cell_id", "source", "score").filter("source IS NOT NULL AND score BETWEEN 0 AND 1")


def _cutoffs(spark: SparkSession, sf_dir: str, scored: DataFrame) -> DataFrame:
    aims = table(spark, sf_dir, "keep_targets").select(label(F.col("sample")).alias("source"), "keep_percent")
    usual = aims.filter("source = '*'").first()
    named = scored.select("source").distinct().join(aims, "source", "left")
    usual = F.lit(usual["keep_percent"] if usual else None).cast("int")
    return cutoff.cutoffs(scored, named.select("source", F.coalesce("keep_percent", usual).alias("keep_percent")).filter("keep_percent IS NOT NULL"))


def p4_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cutoffs(spark, sf_dir, materialize(_scored(spark, sf_dir), "scored")).withColumnRenamed("source", "sample")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = materialize(_scored(spark, sf_dir), "scored")
    return scored.join(_cutoffs(spark, sf_dir, scored).select("source", "cutoff"), "source").filter("score > cutoff").select(F.col("source").alias("sample"), "cell_id")


def p5_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of both counts per sample and over all (sample null), combined from summaries of single days and samples."""
    cells = table(spark, sf_dir, "cell_qc_all")
    both = F.explode(F.create_map(F.lit("ncount_rna"), F.col("ncount_rna"), F.lit("nfeature_rna"), F.col("nfeature_rna"))).alias("metric", "value")
    rows = cells.select(label(F.col("sample")).alias("sample"), F.to_date("qc_time").alias("day"), both).filter("value >= 0")  # negative counts are no measurements
    days = materialize(quantiles.summarize(rows, ["metric", "sample", "day"], "value"), "days")
    samples = materialize(quantiles.combine(days, ["metric", "sample"]), "samples")
    overall = quantiles.combine(samples, ["metric"])
    per_sample = quantiles.percentiles(samples.filter("sample IS NOT NULL"), ["metric", "sample"], PERCENTS).withColumn("scope", F.lit("sample"))
    total = quantiles.percentiles(overall, ["metric"], PERCENTS).withColumn("sample", F.lit(None).cast("string")).withColumn("scope", F.lit("all"))
    return per_sample.unionByName(total).select("scope", "metric", "sample", "percent", "n", "value", "rank_error")


def p5_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The percentiles held against exact ranks: n, and whether the value's places come within rank_error of the wanted one and that within 0.5 % of n."""
    got = materialize(p5_percentiles(spark, sf_dir), "percentiles")
    cells = table(spark, sf_dir, "cell_qc_all")
    both = F.explode(F.create_map(F.lit("ncount_rna"), F.col("ncount_rna"), F.lit("nfeature_rna"), F.col("nfeature_rna"))).alias("metric", "x")
    rows = cells.select(label(F.col("sample")).alias("sample"), both).filter("x >= 0 AND NOT isnan(x)").groupBy("metric", "sample", "x").agg(F.count(F.lit(1)).alias("c"))
    # equal values are counted first; what is compared are the values of a sample with its few percentiles
    asked = got.select("scope", "metric", F.col("sample").alias("s"), "percent", "n", "value", "rank_error")
    own = rows.join(asked.filter("scope = 'sample'").withColumnRenamed("metric", "m"), (F.col("metric") == F.col("m")) & (F.col("sample") == F.col("s")))
    every = rows.groupBy("metric", "x").agg(F.sum("c").alias("c")).join(asked.filter("scope = 'all'"), "metric")
    columns = ("scope", "metric", "s", "percent", "n", "value", "rank_error", "x", "c")
    g = own.select(*columns).union(every.select(*columns)).groupBy("scope", "metric", F.col("s").alias("sample"), "percent").agg(
        F.first("n").alias("n"), F.first("rank_error").alias("e"), F.sum(F.when(F.col("x") < F.col("value"), F.col("c")).otherwise(0)).alias("below"), F.sum(F.when(F.col("x") <= F.col("value"), F.col("c")).otherwise(0)).alias("up_to"), F.sum("c").alias("rows")
    )
    aim = F.greatest(F.lit(1), F.ceil(F.col("percent") * F.col("n") / 100))
    off = F.greatest(F.lit(0), F.col("below") + 1 - aim, aim - F.col("up_to"))
    within = (off <= F.col("e")) & (F.col("e") <= 0.005 * F.col("n") + 1) & (F.col("rows") == F.col("n"))
    return g.select("scope", "metric", "sample", "percent", "n", within.alias("within"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=CAPACITY)


def p7_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its tokens, its parts, and whether any of its containers holds more than the capacity."""
    packed = p7_containers(spark, sf_dir)
    return packed.groupBy("doc_id").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("parts"), (F.max("used") > CAPACITY).alias("overfull"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, those that as many tokens need at least, and whether no more than one in fifty is there beyond them (and one per task)."""
    packed = p7_containers(spark, sf_dir)
    used = packed.groupBy("container_id").agg(F.max("used").alias("used"), F.sum("tokens").alias("tokens"))
    one = used.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens"), F.count(F.when(F.col("used") != F.col("tokens"), 1)).alias("miscounted"), F.countDistinct(F.split("container_id", "-")[0]).alias("tasks"))
    need = F.ceil(F.col("tokens") / F.lit(float(CAPACITY)))
    return one.select(F.col("tokens"), need.alias("needed"), "miscounted", (F.col("n") <= need * 1.02 + F.col("tasks") + 1).alias("tight"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that packing split: the rows of packed parts beyond a document's first."""
    return p7_containers(spark, sf_dir).filter("part = 2").select("doc_id")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the passages that they hold, edited or not; equal passages are represented by their least item."""
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of every passage, by the item that p8_leaks names."""
    return leaks.members_of(table(spark, sf_dir, "eval_items"))


def p8_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of words that a document shares with a passage, where it has RUN words or more."""
    return p8_leaks(spark, sf_dir).filter(F.col("run_words") >= leaks.RUN).select("doc_id", "item_id", "n_items", "run_words")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = p8_leaks(spark, sf_dir).filter(F.col("run_words") >= leaks.RUN).select("doc_id", "item_id")
    return found.join(p8_members(spark, sf_dir), "item_id").select("doc_id", F.col("member").alias("item_id"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = [r["subject"] for r in table(spark, sf_dir, "subject_areas").select("subject").orderBy("subject").collect()]  # eight rows
    return subjects.assign_subjects(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_labels"), areas)


def p9_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of documents without text, of unknown subjects, repeated ones, documents with more than three; whether a third has a subject."""
    found = materialize(p9_found(spark, sf_dir), "found")
    docs, areas = table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id"), table(spark, sf_dir, "subject_areas").select("subject")
    count = lambda df, name: df.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("n"))
    out = count(found.join(docs, "doc_id", "left_anti"), "UNKNOWN_DOCUMENT").union(count(found.join(areas, "subject", "left_anti"), "UNKNOWN_SUBJECT"))
    out = out.union(count(found.groupBy("doc_id", "subject").count().filter("count > 1"), "REPEATED")).union(count(found.groupBy("doc_id").count().filter("count > 3"), "MORE_THAN_THREE"))
    few = found.select("doc_id").distinct().count() * 3 < docs.count()
    return out.union(spark.createDataFrame([("FEW_DOCUMENTS", int(few))], "rule string, n bigint"))


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their share by subject; a document with several subjects counts for each."""
    found = p9_found(spark, sf_dir)
    total = table(spark, sf_dir, "documents").count()
    return found.groupBy("subject").agg(F.count(F.lit(1)).alias("n_docs")).withColumn("share", F.col("n_docs") / F.lit(max(total, 1)))


QUERIES = {
    "p2_report": p2_report,
    "p2_drawn": p2_drawn,
    "p2_found": p2_found,
    "p4_cutoffs": p4_cutoffs,
    "p4_found": p4_found,
    "p5_percentiles": p5_percentiles,
    "p5_bounds": p5_bounds,
    "p7_containers": p7_containers,
    "p7_totals": p7_totals,
    "p7_fill": p7_fill,
    "p7_found": p7_found,
    "p8_leaks": p8_leaks,
    "p8_members": p8_members,
    "p8_runs": p8_runs,
    "p8_found": p8_found,
    "p9_found": p9_found,
    "p9_composition": p9_composition,
    "p9_check": p9_check,
}

_TRIM = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160)"

_P2 = f"""
WITH a AS (
  SELECT 'cell_qc_all.group_name' AS f, upper(trim(group_name, {_TRIM})) AS c, count(DISTINCT cell_id) AS n FROM cell_qc_all WHERE group_name IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'cluster_assignments.sample', upper(trim(sample, {_TRIM})), count(DISTINCT cell) FROM cluster_assignments WHERE sample IS NOT NULL GROUP BY 2),
r AS (SELECT target_set, category, greatest(min_rows, ceil(target_permille * sample_size / 1000.0))::BIGINT AS required, coalesce(n, 0) AS available
  FROM sampling_targets LEFT JOIN a ON f = field_name AND c = upper(trim(category, {_TRIM})))
"""

_P4 = f"""
WITH l AS (SELECT cell_id, upper(trim(sample, {_TRIM})) AS sample, pann FROM seurat_qc_2
  QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY loaded_at DESC NULLS LAST, record_no DESC) = 1),
s AS (SELECT * FROM l WHERE sample IS NOT NULL AND pann BETWEEN 0 AND 1),
k AS (SELECT sample, pann, count(*) OVER (PARTITION BY sample) AS n, count(*) OVER (PARTITION BY sample ORDER BY pann RANGE UNBOUNDED PRECEDING) AS m FROM s),
t AS (SELECT k.*, coalesce(t.keep_percent, (SELECT keep_percent FROM keep_targets WHERE sample = '*')) AS keep_percent
  FROM k LEFT JOIN keep_targets t ON upper(trim(t.sample, {_TRIM})) = k.sample),
c AS (SELECT sample, keep_percent, n, min(pann) AS cutoff, min(m) AS n_kept FROM t WHERE m * 100 >= keep_percent * n GROUP BY ALL)
"""

SQL = {
    "p2_found": _P2 + "SELECT target_set, category FROM r WHERE available < required",
    "p2_report": _P2
    + """SELECT r.target_set, r.category, required, available, available >= required AS met, sample_size, total FROM r JOIN sampling_targets t ON t.target_set = r.target_set AND t.category = r.category
JOIN (SELECT target_set, least(max(sample_size), sum(least(available, CASE WHEN permille > 0 THEN available ELSE 0 END)))::BIGINT AS total FROM (SELECT r.*, target_permille AS permille, sample_size FROM r JOIN sampling_targets USING (target_set, category)) GROUP BY 1) s ON s.target_set = r.target_set""",
    "p4_cutoffs": _P4 + "SELECT * FROM c",
    "p4_found": _P4 + "SELECT s.sample, s.cell_id FROM s JOIN c USING (sample) WHERE s.pann > c.cutoff",
}

_WORDS = r"regexp_extract_all(strip_accents(lower(regexp_replace({}, '</?[A-Za-z!][^<>]*>', ' ', 'g'))), '[\p{{L}}\p{{N}}]+')"
_SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_RUNS = "SELECT DISTINCT {0}, array_to_string(w[i:i + 11], ' ') AS r FROM (SELECT {0}, w, unnest(range(1, len(w) - 10)) AS i FROM {1})"

SQL["p7_found"] = rf"SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_SPACE}]+')) > {CAPACITY}"
SQL["p8_found"] = f"""WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL), e AS (SELECT item_id, {_WORDS.format("passage")} AS w FROM eval_items),
x AS ({_RUNS.format("doc_id", "d")}), y AS ({_RUNS.format("item_id", "e")}) SELECT DISTINCT doc_id, item_id FROM x JOIN y USING (r)"""
SQL["p8_members"] = f"WITH e AS (SELECT DISTINCT item_id, {_WORDS.format('passage')} AS w FROM eval_items WHERE passage IS NOT NULL) SELECT min(item_id) OVER (PARTITION BY w) AS item_id, item_id AS member FROM e WHERE len(w) >= 12"

_PERCENTS = ", ".join(f"({p}::DOUBLE)" for p in PERCENTS)
SQL["p5_bounds"] = f"""WITH v AS (SELECT upper(trim(sample, {_TRIM})) AS sample, 'ncount_rna' AS metric, ncount_rna AS x FROM cell_qc_all UNION ALL SELECT upper(trim(sample, {_TRIM})), 'nfeature_rna', nfeature_rna FROM cell_qc_all),
g AS (SELECT * FROM v WHERE x >= 0 AND NOT isnan(x)), n AS (SELECT 'sample' AS scope, metric, sample, count(*) AS n FROM g WHERE sample IS NOT NULL GROUP BY ALL UNION ALL SELECT 'all', metric, NULL, count(*) FROM g GROUP BY metric)
SELECT scope, metric, sample, percent, n, true AS within FROM n, (VALUES {_PERCENTS}) AS p(percent)"""

_TOKENS = rf"len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_SPACE}]+'))"
SQL["p7_totals"] = f"SELECT doc_id, n AS tokens, ceil(n / {CAPACITY}.0)::BIGINT AS parts, false AS overfull FROM (SELECT doc_id, {_TOKENS} AS n FROM documents WHERE text IS NOT NULL) WHERE n > 0"
SQL["p7_fill"] = f"SELECT sum(n)::BIGINT AS tokens, ceil(sum(n) / {CAPACITY}.0)::BIGINT AS needed, 0 AS miscounted, true AS tight FROM (SELECT {_TOKENS} AS n FROM documents WHERE text IS NOT NULL)"

SQL["p8_runs"] = f"""WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL), e0 AS (SELECT DISTINCT item_id, {_WORDS.format("passage")} AS w FROM eval_items WHERE passage IS NOT NULL),
e AS (SELECT min(item_id) AS item_id, count(*) AS n_items, w FROM e0 GROUP BY w), x AS (SELECT doc_id, p, array_to_string(w[p:p + 11], ' ') AS r FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS p FROM d)),
y AS (SELECT item_id, n_items, p, array_to_string(w[p:p + 11], ' ') AS r FROM (SELECT item_id, n_items, w, unnest(range(1, len(w) - 10)) AS p FROM e)),
j AS (SELECT doc_id, item_id, n_items, x.p - y.p AS line, x.p - row_number() OVER (PARTITION BY doc_id, item_id, x.p - y.p ORDER BY x.p) AS gap FROM x JOIN y USING (r)),
k AS (SELECT doc_id, item_id, n_items, count(*) + 11 AS n FROM j GROUP BY doc_id, item_id, n_items, line, gap) SELECT doc_id, item_id, n_items, max(n)::INT AS run_words FROM k GROUP BY ALL"""

SQL["p9_check"] = "SELECT unnest(['UNKNOWN_DOCUMENT', 'UNKNOWN_SUBJECT', 'REPEATED', 'MORE_THAN_THREE', 'FEW_DOCUMENTS']) AS rule, 0 AS n"
