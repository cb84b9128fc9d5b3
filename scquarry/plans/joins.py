"""Queries on joins, comparisons, set operations and normalization of matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scquarry import model
from scquarry.operators import matrix
from scquarry.operators.diff import latest_rows
from scquarry.plans.common import rounded
from scquarry.plans.qc import metrics
from scquarry.session import table


def _mapping(s: SparkSession, d: str) -> DataFrame:
    """A cell map with faults: customers' segments, some left out, some twice, some unknown."""
    c = table(s, d, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_mktsegment").alias("sample"))
    good = c.filter("cell_id % 97 <> 5")
    twice = c.filter("cell_id % 101 = 3").withColumn("sample", F.lit("SECOND"))
    unknown = c.filter("cell_id % 103 = 1").select((F.col("cell_id") + 100_000_000).alias("cell_id"), "sample")
    return good.union(twice).union(unknown)


def _expected(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer").select(F.col("c_mktsegment").alias("sample")).distinct().union(s.createDataFrame([("ABSENT",)], "sample string"))


def _returned(s: SparkSession, d: str, flag: str | None = None) -> DataFrame:
    x = table(s, d, "lineitem")
    x = x if flag is None else x.filter(F.col("l_returnflag") != flag)
    return x.groupBy(F.col("l_suppkey").alias("cell_id"), F.col("l_partkey").alias("gene_id")).agg(F.sum("l_quantity").alias("value"))


def metadata_map(s: SparkSession, d: str) -> DataFrame:
    """Manifest rows (nations with their regions) joined to cells by sample, whatever their order; a cell without one would be lost, so it is counted."""
    cells = table(s, d, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").alias("n_nationkey"))
    manifest = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("sample"), F.col("r_name").alias("grp"))
    return cells.join(manifest, "n_nationkey", "left").select("cell_id", "sample", "grp")


def sample_runs(s: SparkSession, d: str) -> DataFrame:
    """Distinct sequencing runs per sample, blanks left out (users' event types stand in)."""
    e = table(s, d, "events").select((F.col("user_id") % 25).alias("sample"), F.when(F.col("event_type") != "click", F.col("event_type")).alias("run"))
    return e.groupBy("sample").agg(F.countDistinct("run").alias("n_runs"), F.count(F.when(F.col("run").isNull(), 1)).alias("n_blank"))


def barcode_suffixes(s: SparkSession, d: str) -> DataFrame:
    """Cells per barcode suffix and the number of suffixes against that of samples."""
    c = table(s, d, "cluster_assignments").select(F.regexp_extract("cell", r"-(\d+)$", 1).alias("suffix"), "cell", "sample")
    return c.groupBy("suffix").agg(F.countDistinct("cell").alias("cells"), F.countDistinct("sample").alias("samples"))


def inventory(s: SparkSession, d: str) -> DataFrame:
    """What was there before and after: kind and name of both sides, full outer."""
    before = table(s, d, "part").groupBy(F.col("p_type").alias("kind"), F.col("p_brand").alias("name")).agg(F.count(F.lit(1)).alias("before"))
    after = table(s, d, "part").filter("p_size > 40").groupBy(F.col("p_type").alias("kind"), F.col("p_brand").alias("name")).agg(F.count(F.lit(1)).alias("after"))
    return before.join(after, ["kind", "name"], "full_outer").select("kind", "name", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))


def id_sets(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "cell_qc_all").filter("retained").select(F.col("cell_id").alias("id"))
    b = table(s, d, "cluster_assignments").select(F.col("cell").alias("id"))
    part = lambda n, x: x.agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("n"))
    return part("both", a.intersect(b)).union(part("qc_only", a.exceptAll(b).distinct())).union(part("clusters_only", b.subtract(a))).union(part("either", a.union(b).distinct()))


def latest_cells(s: SparkSession, d: str) -> DataFrame:
    """Repeated cells once, the row of the latest load (then of the greatest record number); NaN is no count."""
    x = table(s, d, "cell_qc_all").select("cell_id", "record_no", "loaded_at", "sample", F.nanvl("ncount_rna", F.lit(None)).alias("ncount_rna"), "retained")
    return latest_rows(x, ("cell_id",), ("loaded_at", "record_no")).select("cell_id", "record_no", "sample", "ncount_rna", "retained")


QUERIES = {
    "min_cells_features": lambda s, d: matrix.min_cells_features(model.counts(s, d), 30, 40),
    "min_cells_then_features": lambda s, d: matrix.min_cells_features(model.counts(s, d), 30, 40, sequential=True),
    "pooled_map_check": lambda s, d: matrix.pool_with_map(table(s, d, "customer").select(F.col("c_custkey").alias("cell_id")), _mapping(s, d), _expected(s, d)),
    "subset_columns": lambda s, d: model.counts(s, d).join(model.cells(s, d).filter(F.col("sample").isin("NATION_1", "NATION_2")).select("cell_id"), "cell_id", "left_semi"),
    "metadata_map": metadata_map,
    "feature_reconcile": lambda s, d: matrix.reconcile_features(
        table(s, d, "lineitem").filter("l_quantity > 48").select(F.col("l_partkey").alias("gene_id")), table(s, d, "lineitem").filter("l_discount > 0.09").select(F.col("l_partkey").alias("gene_id"))
    ),
    "sparse_diff": lambda s, d: matrix.sparse_difference(_returned(s, d), _returned(s, d, "R")),
    "id_set_ops": id_sets,
    "retained_flag": lambda s, d: table(s, d, "cell_qc_all")
    .select("record_no", "cell_id")
    .join(table(s, d, "cluster_assignments").select(F.col("cell").alias("cell_id"), F.lit(True).alias("c")).distinct(), "cell_id", "left")
    .select("record_no", F.col("c").isNotNull().alias("clustered")),
    "sample_runs": sample_runs,
    "barcode_suffixes": barcode_suffixes,
    "inventory_merge": inventory,
    "latest_cells": latest_cells,
    "object_inventory": lambda s, d: model.cells(s, d).agg(
        F.count(F.lit(1)).alias("cells"), F.array_join(F.array_sort(F.collect_set("sample")), ";").alias("samples"), F.array_join(F.array_sort(F.collect_set("grp")), ";").alias("groups")
    ),
    "first_gene_matches": lambda s, d: matrix.first_matches(
        s.createDataFrame([("RED widget",), ("blue bolt",), ("Small Ring",), ("no such part",)], "name string"),
        table(s, d, "part").select(F.col("p_partkey").alias("gene_id"), F.initcap("p_name").alias("gene_name"), (-F.col("p_partkey")).alias("gene_ord")),
    ),
    "sample_sizes": lambda s, d: matrix.sample_sizes(model.counts(s, d), model.cells(s, d)),
    "group_cells": lambda s, d: model.cells(s, d).groupBy("grp").agg(F.count(F.lit(1)).alias("cells"), F.countDistinct("sample").alias("samples")),
    "log_normalize": lambda s, d: rounded(matrix.log_normalize(model.counts(s, d), metrics(s, d)).select("cell_id", "gene_id", "data")),
}

_C = model.SQL_COUNTS
_GET = lambda x: f"SELECT l_suppkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS value FROM lineitem {x} GROUP BY 1, 2"

SQL = {
    "min_cells_features": f"""WITH {_C} SELECT * FROM counts WHERE gene_id IN (SELECT gene_id FROM counts GROUP BY 1 HAVING count(*) >= 30)
AND cell_id IN (SELECT cell_id FROM counts GROUP BY 1 HAVING count(*) >= 40)""",
    "min_cells_then_features": f"""WITH {_C}, g AS (SELECT * FROM counts WHERE gene_id IN (SELECT gene_id FROM counts GROUP BY 1 HAVING count(*) >= 30))
SELECT * FROM g WHERE cell_id IN (SELECT cell_id FROM g GROUP BY 1 HAVING count(*) >= 40)""",
    "pooled_map_check": """WITH m AS (SELECT c_custkey AS cell_id, c_mktsegment AS sample FROM customer WHERE c_custkey % 97 <> 5
UNION ALL SELECT c_custkey, 'SECOND' FROM customer WHERE c_custkey % 101 = 3 UNION ALL SELECT c_custkey + 100000000, c_mktsegment FROM customer WHERE c_custkey % 103 = 1)
SELECT 'CELL_NOT_MAPPED' AS problem, c_custkey::VARCHAR AS key FROM customer WHERE c_custkey NOT IN (SELECT cell_id FROM m)
UNION ALL SELECT DISTINCT 'MAPPED_CELL_MISSING', cell_id::VARCHAR FROM m WHERE cell_id NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'CELL_MAPPED_TWICE', cell_id::VARCHAR FROM m GROUP BY cell_id HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'UNKNOWN_SAMPLE', sample FROM m WHERE sample NOT IN (SELECT c_mktsegment FROM customer)
UNION ALL SELECT 'SAMPLE_WITHOUT_CELLS', 'ABSENT'""",
    "subset_columns": f"WITH {_C}, {model.SQL_CELLS} SELECT * FROM counts WHERE cell_id IN (SELECT cell_id FROM cells WHERE sample IN ('NATION_1', 'NATION_2'))",
    "metadata_map": "SELECT c_custkey AS cell_id, n_name AS sample, r_name AS grp FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
    "feature_reconcile": """WITH a AS (SELECT DISTINCT l_partkey AS gene_id FROM lineitem WHERE l_quantity > 48), b AS (SELECT DISTINCT l_partkey AS gene_id FROM lineitem WHERE l_discount > 0.09)
SELECT gene_id, 'a' AS only_in FROM a WHERE gene_id NOT IN (SELECT gene_id FROM b) UNION ALL SELECT gene_id, 'b' FROM b WHERE gene_id NOT IN (SELECT gene_id FROM a)""",
    "sparse_diff": f"""WITH a0 AS ({_GET("")}), b0 AS ({_GET("WHERE l_returnflag <> 'R'")}),
a AS (SELECT * FROM a0 WHERE gene_id IN (SELECT gene_id FROM b0) AND cell_id IN (SELECT cell_id FROM b0)), b AS (SELECT * FROM b0 WHERE gene_id IN (SELECT gene_id FROM a0) AND cell_id IN (SELECT cell_id FROM a0)),
j AS (SELECT abs(coalesce(a.value, 0) - coalesce(b.value, 0)) AS delta FROM a FULL JOIN b ON a.gene_id = b.gene_id AND a.cell_id = b.cell_id)
SELECT count(*) AS n_common, count(*) FILTER (delta > 0) AS n_mismatch, max(delta) AS max_abs_delta FROM j""",
    "id_set_ops": """WITH a AS (SELECT DISTINCT cell_id AS id FROM cell_qc_all WHERE retained), b AS (SELECT DISTINCT cell AS id FROM cluster_assignments),
r AS (SELECT cell_id AS id, count(*) AS c FROM cell_qc_all WHERE retained GROUP BY 1), q AS (SELECT cell AS id, count(*) AS c FROM cluster_assignments GROUP BY 1)
SELECT 'both' AS part, count(*) AS n FROM (SELECT id FROM a INTERSECT SELECT id FROM b) UNION ALL SELECT 'qc_only', count(*) FROM r LEFT JOIN q USING (id) WHERE r.c > coalesce(q.c, 0)
UNION ALL SELECT 'clusters_only', count(*) FROM (SELECT id FROM b EXCEPT SELECT id FROM a) UNION ALL SELECT 'either', count(*) FROM (SELECT id FROM a UNION SELECT id FROM b)""",
    "retained_flag": "SELECT record_no, cell_id IN (SELECT cell FROM cluster_assignments WHERE cell IS NOT NULL) AS clustered FROM cell_qc_all",
    "sample_runs": """SELECT user_id % 25 AS sample, count(DISTINCT CASE WHEN event_type <> 'click' THEN event_type END) AS n_runs, count(*) FILTER (event_type = 'click' OR event_type IS NULL) AS n_blank FROM events GROUP BY 1""",
    "barcode_suffixes": r"SELECT regexp_extract(cell, '-(\d+)$', 1) AS suffix, count(DISTINCT cell) AS cells, count(DISTINCT sample) AS samples FROM cluster_assignments GROUP BY 1",
    "inventory_merge": """SELECT coalesce(a.kind, b.kind) AS kind, coalesce(a.name, b.name) AS name, coalesce(before, 0) AS before, coalesce(after, 0) AS after FROM (SELECT p_type AS kind, p_brand AS name, count(*) AS before FROM part GROUP BY 1, 2) a
FULL JOIN (SELECT p_type AS kind, p_brand AS name, count(*) AS after FROM part WHERE p_size > 40 GROUP BY 1, 2) b ON a.kind = b.kind AND a.name = b.name""",
    "latest_cells": "SELECT cell_id, record_no, sample, CASE WHEN NOT isnan(ncount_rna) THEN ncount_rna END AS ncount_rna, retained FROM cell_qc_all QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY loaded_at DESC NULLS LAST, record_no DESC) = 1",
    "object_inventory": f"WITH {model.SQL_CELLS} SELECT count(*) AS cells, string_agg(DISTINCT sample, ';' ORDER BY sample) AS samples, string_agg(DISTINCT grp, ';' ORDER BY grp) AS groups FROM cells",
    "first_gene_matches": """SELECT upper(p_name) AS name, max(p_partkey) AS gene_id FROM part WHERE upper(p_name) IN ('RED WIDGET', 'BLUE BOLT', 'SMALL RING', 'NO SUCH PART') GROUP BY 1""",
    "sample_sizes": f"""WITH {_C}, {model.SQL_CELLS} SELECT sample, count(DISTINCT cells.cell_id) AS cells, count(DISTINCT counts.cell_id) AS cells_with_counts, count(DISTINCT gene_id) AS genes_detected
FROM cells LEFT JOIN counts USING (cell_id) GROUP BY 1""",
    "group_cells": f"WITH {model.SQL_CELLS} SELECT grp, count(*) AS cells, count(DISTINCT sample) AS samples FROM cells GROUP BY 1",
    "log_normalize": f"WITH {model.SQL_METRICS} SELECT cell_id, gene_id, round(ln(1 + 10000 * value / ncount), 6) AS data FROM counts JOIN metrics USING (cell_id)",
}
