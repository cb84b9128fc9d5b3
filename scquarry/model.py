"""The engine's data model, and the tables of the test data that stand in for it.

counts      cell_id, gene_id, value      one row per non-zero count of a cell and a gene
genes       gene_id, gene_name, ...      one row per gene
cells       cell_id, sample, grp, ...    one row per cell, those without counts too
vectors     cell_id, vec                 one row per embedded cell
edges       src, dst, ...                neighbour graphs
assignments cell_id, resolution, cluster one row per cell and clustering
report      section, sample, metric, value, status, note (all text)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scquarry.session import table

COUNTS = T.StructType([T.StructField("cell_id", T.StringType(), False), T.StructField("gene_id", T.StringType(), False), T.StructField("value", T.DoubleType(), False)])
GENES = T.StructType([T.StructField("gene_id", T.StringType(), False), T.StructField("gene_name", T.StringType()), T.StructField("gene_ord", T.LongType(), False)])
REPORT = T.StructType([T.StructField(c, T.StringType()) for c in ("section", "sample", "metric", "value", "status", "note")])


def counts(spark: SparkSession, d: str, by: str | None = None) -> DataFrame:
    """Customers stand in for cells, parts for genes, ordered quantities for counts.

    by: cell_id or gene_id, whose rows are to lie together, so that later sums by it are small before they are shuffled.
    """
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if by:
        joined = joined.repartition({"cell_id": "o_custkey", "gene_id": "l_partkey"}[by])
    return joined.groupBy(F.col("o_custkey").alias("cell_id"), F.col("l_partkey").alias("gene_id")).agg(F.sum("l_quantity").alias("value"))


def cells(spark: SparkSession, d: str) -> DataFrame:
    """Nations stand in for samples, regions for groups, market segments for technical batches."""
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("sample"), "n_regionkey")
    region = table(spark, d, "region").select("r_regionkey", F.col("r_name").alias("grp"))
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("cell_id"), "c_nationkey", F.col("c_mktsegment").alias("batch"), F.col("c_acctbal").alias("balance"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("cell_id", "sample", "grp", "batch", "balance")


def genes(spark: SparkSession, d: str) -> DataFrame:
    """Parts with flags that stand in for gene families found by patterns of their names."""
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("gene_id"),
        F.col("p_name").alias("gene_name"),
        (F.col("p_type") == "PROMO").alias("fam_mt"),
        (F.col("p_brand") == "Brand#1").alias("fam_hb"),
        F.col("p_name").rlike("^red ").alias("fam_rp"),
    )


FAMILIES = {"pmt": "fam_mt", "phb": "fam_hb", "prp": "fam_rp"}
THRESHOLDS = {"nfeature_min": 20, "nfeature_max": 70, "ncount_min": 500, "ncount_max": 2000, "pmt_max": 35, "phb_max": 12, "prp_max": 40}
GENE_CELLS = 25

_FROM = "lineitem JOIN orders ON l_orderkey = o_orderkey"
SQL_COUNTS = f"counts AS (SELECT o_custkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS value FROM {_FROM} GROUP BY 1, 2)"
SQL_CELLS = """cells AS (SELECT c_custkey AS cell_id, n_name AS sample, r_name AS grp, c_mktsegment AS batch, c_acctbal AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
SQL_GENES = "genes AS (SELECT p_partkey AS gene_id, p_name AS gene_name, p_type = 'PROMO' AS fam_mt, p_brand = 'Brand#1' AS fam_hb, regexp_matches(p_name, '^red ') AS fam_rp FROM part)"
SQL_METRICS = f"""{SQL_COUNTS}, {SQL_CELLS}, {SQL_GENES},
totals AS (SELECT cell_id, sum(value) AS ncount, count(*) AS nfeature, sum(CASE WHEN fam_mt THEN value ELSE 0 END) AS mt,
  sum(CASE WHEN fam_hb THEN value ELSE 0 END) AS hb, sum(CASE WHEN fam_rp THEN value ELSE 0 END) AS rp FROM counts JOIN genes USING (gene_id) GROUP BY 1),
metrics AS (SELECT cells.*, coalesce(ncount, 0)::DOUBLE AS ncount, coalesce(nfeature, 0)::BIGINT AS nfeature,
  100 * mt / ncount AS pmt, 100 * hb / ncount AS phb, 100 * rp / ncount AS prp FROM cells LEFT JOIN totals USING (cell_id))"""
SQL_FLAGS = f"""{SQL_METRICS},
flags AS (SELECT *, nfeature <= 20 AS r1, nfeature >= 70 AS r2, ncount <= 500 AS r3, ncount >= 2000 AS r4, coalesce(pmt >= 35, false) AS r5,
  coalesce(phb >= 12, false) AS r6, coalesce(prp >= 40, false) AS r7 FROM metrics),
kept AS (SELECT *, r1::INT + r2::INT + r3::INT + r4::INT + r5::INT + r6::INT + r7::INT AS hits FROM flags)"""
