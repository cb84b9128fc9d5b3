"""What failed on tables of 1 GB, on tables as small as show it."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scquarry.kernels import scores
from scquarry.plans import catalog

HOLDS = {
    "hvg_check": {"genes": 2000, "places": 2000, "last_place": 2000, "other_moments": 0, "out_of_order": 0},
    "pca_check": {"cells": 80, "components": 50, "centred": True, "uncorrelated": True, "orthonormal": True, "falling": True},
}


@pytest.mark.parametrize("gene", ["id", "string(id)", "concat('a gene whose name has more than 32 bytes: ', id)"])
def test_controls_are_drawn_without_pairs_of_genes(spark, gene):
    bins = spark.range(3000).select(F.expr(gene).alias("gene_id"), (F.col("id") % 3 + 1).cast("int").alias("bin"))
    some = spark.range(0, 3000, 5).select(F.expr(gene).alias("gene_id"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("set_name"), (F.col("id") % 3 + 1).cast("int").alias("bin"))
    for control in (4, 300):
        place = F.row_number().over(W.partitionBy("set_name", "own").orderBy(F.xxhash64("gene_id", "own", F.lit(42)), "gene_id"))
        pairs = some.select("set_name", F.col("gene_id").alias("own"), "bin").join(bins, "bin").withColumn("p", place)
        want = {tuple(r) for r in pairs.filter(F.col("p") <= control).select("set_name", "gene_id").distinct().collect()}
        got = [tuple(r) for r in scores.control_genes(bins, some, control, 42).select("set_name", "gene_id").collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert "Window" not in scores.control_genes(bins, some, 300, 42)._jdf.queryExecution().optimizedPlan().toString()


def test_phase_check_makes_the_matrix_once(spark, monkeypatch):
    from scquarry import model
    from scquarry.plans import invariants

    made, counts = [], model.counts
    monkeypatch.setattr(model, "counts", lambda *a, **k: made.append(a) or counts(*a, **k))
    n, no_scores, other = invariants.phase_check(spark, "/root/testdata/sf0.001").first()
    assert len(made) == 1 and n == model.cells(spark, "/root/testdata/sf0.001").count() and no_scores == other == 0


@pytest.fixture(scope="module")
def many_genes(spark, tmp_path_factory):
    """Tables of 201,000 parts (genes), 80 customers (cells) and three lines a part."""
    d, n = str(tmp_path_factory.mktemp("many_genes")), 201_000
    for t in ("nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").filter("c_custkey < 80").write.parquet(f"{d}/customer.parquet")
    i = F.col("id")
    spark.range(n).select(i.alias("p_partkey"), F.concat(F.when(i % 9 == 0, "red ").otherwise("blue "), i).alias("p_name"), F.concat(F.lit("Brand#"), i % 20).alias("p_brand"), F.when(i % 5 == 0, "PROMO").otherwise("ECONOMY").alias("p_type")).write.parquet(f"{d}/part.parquet")
    spark.range(80).select(i.alias("o_orderkey"), i.alias("o_custkey")).write.parquet(f"{d}/orders.parquet")
    spark.range(3 * n).select(F.pmod(F.xxhash64("id"), F.lit(80)).alias("l_orderkey"), (i % n).alias("l_partkey"), (F.pmod(F.xxhash64(i + 1), F.lit(50)) + 1.0).alias("l_quantity")).write.parquet(f"{d}/lineitem.parquet")
    return d


@pytest.mark.parametrize("query, rows", [("hvg_check", 1), ("pca_embedding", 80), ("hvg_vst", 2000), ("pca_layout", 80), ("pca_check", 1), ("pca_spectrum", 50)])
def test_any_number_of_genes(spark, many_genes, query, rows):
    got = catalog.QUERIES[query](spark, many_genes)
    assert len(got.collect()) == rows
    if query.endswith("_check"):
        assert got.first().asDict().items() >= HOLDS[query].items()


def test_rank_sum_of_many_cells(spark):
    from scquarry.functions import stats

    df = spark.createDataFrame([("g", 1.0, True), ("g", 2.0, False), ("g", 2.0, True)], "gene_id string, value double, inside boolean")
    n = spark.createDataFrame([(3_000_000, 9_000_000)], "n_in bigint, n_out bigint")
    r = stats.rank_sum(df, ["gene_id"], "value", "inside", n).first()
    n_in, n_out, n, zeros = 3e6, 9e6, 12e6, 12e6 - 3
    u = (zeros + 1) + (zeros + 2.5) + (n_in - 2) * (zeros + 1) / 2 - n_in * (n_in + 1) / 2
    sd = (n_in * n_out / 12 * (n + 1 - (6 + zeros**3 - zeros) / (n * (n - 1)))) ** 0.5
    assert r["u"] == u and r["z"] == pytest.approx((u - n_in * n_out / 2) / sd, rel=1e-6)


def test_small_groups_are_ranked_without_quantiles(spark, monkeypatch):
    from scquarry.functions import stats

    df = spark.range(4000).select((F.col("id") % 3 * F.col("id") % 40).alias("k"), F.pmod(F.xxhash64("id"), F.lit(90)).cast("double").alias("x"))
    got = lambda most: sorted(map(tuple, stats.value_ranks(df, ["k"], "x", 8, {"top": F.max("x")}, most).collect()))
    cut, some = got(0), got(70)
    monkeypatch.setattr(F, "percentile_approx", None)  # its states and joins outgrow the values of many small groups
    assert cut == some == sorted(map(tuple, stats.value_ranks(df, ["k"], "x", 8, {"top": F.max("x")}).collect()))


@pytest.fixture(scope="module")
def equal_cells(spark, tmp_path_factory):
    """Tables of 3,000 customers (cells) in five segments (libraries), each with one line; a segment's have 20 parts (genes) in all."""
    d, i = str(tmp_path_factory.mktemp("equal_cells")), F.col("id")
    for t in ("nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    spark.range(3000).select(i.alias("c_custkey"), (i % 25).cast("int").alias("c_nationkey"), F.concat(F.lit("L"), i % 5).alias("c_mktsegment"), F.lit(0.0).alias("c_acctbal")).write.parquet(f"{d}/customer.parquet")
    spark.range(3000).select(i.alias("o_orderkey"), i.alias("o_custkey")).write.parquet(f"{d}/orders.parquet")
    spark.range(3000).select(i.alias("l_orderkey"), (F.floor(i / 5) % 20).alias("l_partkey"), F.lit(2.0).alias("l_quantity")).write.parquet(f"{d}/lineitem.parquet")
    return d


@pytest.mark.parametrize("query", ["doublet_calls", "doublet_check", "doublet_pann"])
def test_equal_cells_are_searched_once(spark, equal_cells, monkeypatch, query):
    from scquarry.kernels import doublets

    made, materialize = {}, doublets.materialize
    monkeypatch.setattr(doublets, "materialize", lambda df, name: made.setdefault(name, materialize(df, name)))
    got = catalog.QUERIES[query](spark, equal_cells).toPandas()
    assert made["found"].count() == 5 * 20  # points, not cells
    if query == "doublet_check":
        assert len(got) == 5 and (got[["cells", "no_share", "neighbourhoods", "df"]] == [600, 0, 1, 24]).all().all()
        return
    assert len(got) == 3000 and got["cell_id"].is_unique and got["pann"].between(0, 1).all()
    assert (got.assign(gene=got["cell_id"] // 5 % 20).groupby(["library_id", "gene"])["pann"].nunique() == 1).all()
    if query == "doublet_calls":
        assert (got[got["df"] == "Doublet"].groupby("library_id").size() == 24).all()


def test_shares_count_equally_far_cells_by_part():
    import numpy as np

    from scquarry.kernels import doublets

    def plain(a, z, level):
        """Cells one by one; those equally far as the last of a neighbourhood by their part."""
        d = np.delete(((z - z[a]) ** 2).sum(1), a)
        for j in range(len(doublets.PNS)):
            use = np.delete(level, a) <= j
            n, kinds = use.sum() + 1, np.delete(level, a)[use] >= 0
            for pk in doublets.PKS:
                k = min(n - 1, max(1, round(pk * n)))
                edge = np.sort(d[use])[k - 1]
                near, same = d[use] < edge, d[use] == edge
                yield (kinds[near].sum() + (k - near.sum()) * kinds[same].mean()) / k

    r = np.random.default_rng(5)
    for points in (7, 40, 300):  # whole numbers, so that distances are exact; few points with many cells, then most with one
        z, level = r.integers(-9, 9, (points, 3)).astype(float)[r.integers(0, points, 300)], np.r_[np.full(190, -1), r.integers(0, 3, 110)]
        u, at = np.unique(z, axis=0, return_inverse=True)
        cells = np.stack([np.bincount(at[level == i - 1], minlength=len(u)) for i in range(4)], axis=1)
        got = doublets.neighbour_shares(at[:20], u, cells).reshape(20, -1)
        assert np.allclose(got, [list(plain(a, z, level)) for a in range(20)], atol=1e-12)


def test_doublet_search_is_not_put_into_one_task(spark, equal_cells, monkeypatch):
    from scquarry.kernels import doublets

    made, materialize = {}, doublets.materialize
    monkeypatch.setattr(doublets, "materialize", lambda df, name: made.setdefault(name, materialize(df, name)))
    catalog.QUERIES["doublet_calls"](spark, equal_cells)
    assert len(made["found"].inputFiles()) > 1  # few points, whose distances take long all the same


def test_only_near_points_are_sorted(monkeypatch):
    import numpy as np

    from scquarry.kernels import doublets

    r, sorted_, argsort = np.random.default_rng(3), [], np.argsort
    z, cells = np.vstack([np.zeros((1, 10)), r.normal(size=(1999, 10))]), np.eye(4, dtype=int)[r.choice(4, 2000, p=[0.6, 0.1, 0.1, 0.2])]
    own = np.flatnonzero(cells[1:, 0])[:100] + 1
    for most in ((4000, 500, 500, 500), (1, 0, 0, 0)):  # most cells at one point, then none with more than one
        cells[0] = most
        with monkeypatch.context() as c:
            c.setattr(doublets.np, "argsort", lambda a, **k: sorted_.append(len(a)) or argsort(a, **k))
            got = doublets.neighbour_shares(own, z, cells)
        assert sum(sorted_) < 100 * 2000 / 2
        sorted_.clear()
        with monkeypatch.context() as c:
            c.setattr(doublets, "HEAVY", 2000)  # all points
            assert (got == doublets.neighbour_shares(own, z, cells)).all()
    far = np.argsort(-(z * z).sum(1))[:50]
    cells[far] = 90, 30, 30, 30  # too few cells near by
    with monkeypatch.context() as c:
        c.setattr(doublets, "HEAVY", 1)
        got = doublets.neighbour_shares(own, z, cells)
    assert (got == doublets.neighbour_shares(own, z, cells)).all()


def test_cells_without_counts_of_the_genes_are_zero(spark):
    """A block's cells without counts of the genes aren't made dense; the components are those of all cells."""
    import numpy as np
    import pandas as pd

    from scquarry.kernels import doublets

    p = pd.DataFrame({"i": [np.array([], "int32"), np.array([2, 0], "int32"), np.array([], "int32"), np.array([1], "int32")], "x": [np.array([]), np.array([3.0, 1.0]), np.array([]), np.array([5.0])]})
    own, x = doublets.some_dense(p, 3)
    assert own.tolist() == [1, 3] and x.tolist() == [[1, 0, 3], [0, 5, 0]]
    counts = spark.range(400).select((F.col("id") % 40).alias("cell_id"), F.pmod(F.xxhash64("id"), F.lit(30)).alias("gene_id"), F.lit(2.0).alias("value")).distinct()
    libraries = spark.range(40).select(F.col("id").alias("cell_id"), F.lit("L").alias("library_id"))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(doublets, "GENES", 2)
        z = doublets.embedded(counts, libraries, "library_id", 30, 1, 2000)[0].filter("level < 0").toPandas().set_index("cell_id")["z"]
        genes = {r["gene_id"] for r in counts.groupBy("gene_id").count().collect()}
    with_genes = counts.toPandas()
    assert len(genes) > 2 and len(z) == 40
    zero = {c for c, v in z.items() if not np.frombuffer(v, np.float64).any()}
    used = [g for g in genes if not zero & set(with_genes[with_genes["gene_id"] == g]["cell_id"])]
    assert 0 < len(zero) < 40 and len(used) == 2 and set(with_genes[with_genes["gene_id"].isin(used)]["cell_id"]) == set(z.index) - zero
