import numpy as np
import pytest
from pyspark.sql import functions as F

from scquarry.kernels import ambient, communities, components, doublets, integration, scores
from scquarry.operators import matrix


@pytest.fixture(scope="module")
def counts(spark):
    r = np.random.default_rng(813)
    x = r.poisson(0.6, (160, 120))
    x[:80, :20] += r.poisson(4, (80, 20))
    x[80:, 20:40] += r.poisson(4, (80, 20))
    x[:, 40:80] = r.poisson(2.6, (160, 40))  # as frequent as the planted genes, but even
    data = [(f"c{i:03d}", f"g{j:03d}", float(x[i, j])) for i, j in zip(*x.nonzero())]
    return spark.createDataFrame(data, "cell_id string, gene_id string, value double"), x


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame([(f"c{i:03d}", f"S{i % 3}", "L1" if i % 2 else "L2", str(i // 80), i % 7 / 7.0) for i in range(160)], "cell_id string, sample string, library_id string, cluster string, pmt double")


def test_components(spark, counts, cells):
    df, x = counts
    totals = matrix.cell_totals(df, cells)
    scores_, stdev, loadings = components.formal_pca(df, totals, "pmt", 50, 10)
    z = np.array([r["vec"] for r in scores_.orderBy("cell_id").collect()])
    assert np.allclose(z.mean(axis=0), 0, atol=1e-8)
    assert np.allclose(loadings.T @ loadings, np.eye(10), atol=1e-8)
    assert np.allclose(z.std(axis=0, ddof=1), stdev) and (np.diff(stdev) <= 1e-12).all()
    assert (loadings[np.abs(loadings).argmax(axis=0), np.arange(10)] > 0).all()
    assert abs(np.corrcoef(z[:, 0], np.arange(160) < 80)[0, 1]) > 0.9
    same = components.subspace_overlap(scores_, scores_, 5)
    other = scores_.select("cell_id", F.slice("vec", 6, 5).alias("vec"))
    assert abs(same - 1) < 1e-8 and components.subspace_overlap(scores_, other, 5) < 1e-6


def test_dense_regression_agrees(spark, counts, cells):
    df, x = counts
    data = matrix.log_normalize(df, matrix.cell_totals(df, cells))
    got = {r["gene_id"]: (r["intercept"], r["slope"]) for r in matrix.regression_coefficients(data, "data", cells, "pmt").collect()}
    y = np.log1p(1e4 * x / x.sum(axis=1, keepdims=True))
    want = np.linalg.lstsq(np.column_stack([np.ones(160), np.arange(160) % 7 / 7.0]), y, rcond=None)[0]
    for j in range(120):
        assert np.allclose(got[f"g{j:03d}"], want[:, j], atol=1e-8)


def test_variable_genes_are_the_planted_ones(counts):
    df, _ = counts
    best = [r["gene_id"] for r in components.variable_genes(df, 160, 40).collect()]
    assert len(set(best) & {f"g{j:03d}" for j in range(40)}) >= 34


def test_doublets(spark, counts, cells):
    df, _ = counts
    got = doublets.doublet_scores(df, cells, min_cells=30).toPandas()
    assert len(got) == 160 and got["pann"].between(0, 1).all() and got["cell_id"].is_unique
    # however many tasks search, the scores are the same
    cut = doublets.doublet_scores(df, cells, min_cells=30, query_cells=13).toPandas()
    both = got.merge(cut, on=["library_id", "cell_id"], suffixes=("", "_cut"))
    assert len(cut) == len(both) == 160 and np.allclose(both["pann"], both["pann_cut"]) and (both["pk"] == both["pk_cut"]).all()
    assert len(doublets.doublet_scores(df, cells, min_cells=30, block_cells=20).toPandas()) == 160
    assert doublets.doublet_scores(df, cells, min_cells=100).count() == 0


def test_ambient(spark, counts, cells):
    df, _ = counts
    got = ambient.correct_counts(df, cells)
    j = got.join(df.withColumnRenamed("value", "original"), ["cell_id", "gene_id"])
    assert j.count() == got.count() == df.count()
    assert j.filter("value < 0 OR value > original + 1e-9 OR contamination < 0 OR contamination > 1").count() == 0
    empty = spark.createDataFrame([("L1", f"g{j:03d}", 5.0) for j in range(20)], "library_id string, gene_id string, value double")
    with_background = ambient.correct_counts(df, cells, background=empty)
    assert with_background.count() == df.count()


def test_module_scores(spark, counts, cells):
    df, _ = counts
    genes = spark.createDataFrame([(f"g{j:03d}",) for j in range(120)], "gene_id string")
    sets = spark.createDataFrame([("S", f"g{j:03d}") for j in range(10)] + [("G2M", f"g{j:03d}") for j in range(20, 30)], "set_name string, gene_id string")
    data = matrix.log_normalize(df, matrix.cell_totals(df, cells))
    p = scores.cycle_phase(scores.module_scores(data, cells, genes, sets, scores.control_size([10, 10], 120))).toPandas()
    assert len(p) == 160 and set(p["phase"]) <= {"G1", "S", "G2M", "Undecided"}
    assert (p[p["phase"] == "G1"][["s_score", "g2m_score"]] < 0).all().all()
    first = p["cell_id"] < "c080"
    assert p[first]["s_score"].mean() > p[~first]["s_score"].mean()
    assert scores.control_size([43, 54], 300) == 11


def test_module_scores_of_many_sets(spark, counts, cells):
    df, _ = counts
    genes = spark.createDataFrame([(f"g{j:03d}",) for j in range(120)], "gene_id string")
    sets = spark.createDataFrame([(f"set{i:04d}", f"g{i % 120:03d}") for i in range(1100)], "set_name string, gene_id string")
    some = cells.filter("cell_id < 'c003'")
    got = scores.module_scores(df.filter("cell_id < 'c003'"), some, genes, sets, 2, value="value")
    assert got.count() == 3 * 1100 == got.select("cell_id", "set_name").distinct().count()


def test_communities_go_on_to_further_levels(spark):
    """A chain of 400 nodes is best cut into some 20 groups; two levels leave far more."""
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(399)], "src bigint, dst bigint, weight double")
    nodes = spark.range(400).withColumnRenamed("id", "cell_id")
    got = communities.communities(edges, nodes, [1.0])
    assert got.count() == 400
    assert communities.modularity(edges, got).first()["modularity"] > 0.88


def test_integration(spark):
    r = np.random.default_rng(5)
    kind, batch = np.arange(300) % 3, np.arange(300) // 3 % 2
    x = r.normal(scale=0.3, size=(300, 5))
    x[np.arange(300), kind] += 3
    x[:, 4] += batch * 2
    v = spark.createDataFrame([(int(i), x[i].tolist()) for i in range(300)], "cell_id bigint, vec array<double>")
    b = spark.createDataFrame([(int(i), f"B{batch[i]}" if i else None) for i in range(300)], "cell_id bigint, batch string")
    got = {r["cell_id"]: r["vec"] for r in integration.integrate(v, b, "batch", clusters=5).collect()}
    y = np.array([got[i] for i in range(300)])
    assert np.isfinite(y).all() and np.allclose(y[0], x[0])
    gap = lambda z: np.linalg.norm(z[1:][batch[1:] == 0].mean(0) - z[1:][batch[1:] == 1].mean(0))
    assert gap(y) < 0.4 * gap(x)
    one = integration.integrate(v, b.withColumn("batch", F.lit("x")), "batch")
    assert one.count() == 300


def test_communities(spark):
    r = np.random.default_rng(7)
    edges = [(i, j, 1.0) for g in range(4) for i in range(g * 20, g * 20 + 20) for j in range(i + 1, g * 20 + 20) if r.random() < 0.5] + [(i * 20, i * 20 + 25, 0.2) for i in range(3)]
    e = spark.createDataFrame(edges, "src bigint, dst bigint, weight double")
    a = communities.communities(e, spark.range(81).withColumnRenamed("id", "cell_id"), [0.5, 1.0])
    rows = [(x["resolution"], x["cell_id"], x["cluster"]) for x in a.collect()]
    for res in (0.5, 1.0):
        of = {c: k for q, c, k in rows if q == res}
        assert len(of) == 81 and sum(c == 80 for c, k in of.items() if k == of[80]) == 1
        assert all(len({of[i] for i in range(g * 20, g * 20 + 20)}) == 1 for g in range(4))
    assert all(x["modularity"] > 0.6 for x in communities.modularity(e, a).collect())
