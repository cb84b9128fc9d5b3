import math
import random

import numpy as np
import pytest
from conftest import rows

from scquarry.functions import stats
from scquarry.operators import graph, matrix, quality, review
from scquarry.session import materialize

R = {"nfeature_min": 200, "nfeature_max": 4000, "ncount_min": 500, "ncount_max": 30000, "pmt_max": 25, "phb_max": 1, "prp_max": 100}
CELLS = "cell_id string, sample string, nfeature double, ncount double, pmt double, phb double, prp double"


def test_percentiles_and_ranks_against_numpy(spark):
    r = random.Random(1)
    data = [(g, r.choice([1.0, 2.0, 2.0, r.gauss(0, 5), None, float("nan"), float("inf")])) for g in ("a", "b", None) for _ in range(700)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {x["g"]: x for x in stats.percentiles(df, ["g"], "x", {"p1": 0.01, "p50": 0.5, "p90": 0.9}).collect()}
    for g in ("a", "b", None):
        v = np.array([x for k, x in data if k == g and x is not None and math.isfinite(x)])
        assert np.allclose([got[g]["p1"], got[g]["p50"], got[g]["p90"]], np.quantile(v, [0.01, 0.5, 0.9]))
        ranks = [x["r"] for x in stats.average_ranks(df.filter(df.g.eqNullSafe(g)), ["g"], "x", "r").collect()]
        assert sum(ranks) == len(v) * (len(v) + 1) / 2
    assert stats.percentiles(df.filter("false"), ["g"], "x", {"m": 0.5}).count() == 0


def test_spearman_not_estimable(spark):
    df = spark.createDataFrame([("c", 1.0, 1.0), ("c", 1.0, 2.0), ("c", 1.0, 3.0), ("n", 1.0, 1.0), ("n", 2.0, None)] + [("p", float(i), float(i * i)) for i in range(5)], "g string, x double, y double")
    assert rows(stats.spearman(df, ["g"], "x", "y")) == [("c", 3, None), ("n", 1, None), ("p", 5, pytest.approx(1.0))]


def test_ari_vectors(spark):
    """Equal partitions, opposite ones, constants."""
    def ari(a, b):
        return stats.adjusted_rand(spark.createDataFrame([(1, x, y) for x, y in zip(a, b)], "k int, a string, b string"), ["k"], "a", "b").first()["ari"]

    assert ari("1122", "bbaa") == 1
    assert ari("1122", "1212") == pytest.approx(-0.5)
    assert ari("1111", "2222") == 1
    assert ari("1234", "abcd") == 1


def test_eta_without_variation(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "b", 2.0)], "k int, g string, x double")
    assert rows(stats.eta_squared(df, ["k"], "g", "x")) == [(1, 2, None)]


def pick(stdev, max_pc):
    """The rule on a list, written down once more."""
    s = np.array(stdev[:max_pc], float)
    share = s / s.sum() * 100
    cum = np.cumsum(share)
    first = [i + 1 for i in range(len(s)) if cum[i] > 90 and share[i] < 5][:1]
    last = [i + 2 for i in range(len(s) - 1) if share[i] - share[i + 1] > 0.1][-1:]
    both = first + last
    return max(2, min(min(both) if both else 20, max_pc))


@pytest.mark.parametrize("stdev", [[10, 5, 1, 1, 1, 1], [1.0] * 50, list(range(50, 0, -1)), [100, 1, 1], [8, 7.9999, 7.9998], [5, 4, 3, 2, 1] * 2])
def test_component_selection(spark, stdev):
    df = spark.createDataFrame([(1, i + 1, float(x)) for i, x in enumerate(stdev)], "k int, pc int, stdev double")
    got = stats.pc_selection(df, ["k"]).first()
    assert got["pc_used"] == pick(stdev, min(50, len(stdev)))
    assert got["max_pc"] == min(50, len(stdev))
    if stdev == [1.0] * 50:
        assert got["selection_method"] == "reference_sd_cumulative_only"


def test_rule_bounds_are_strict(spark):
    """A cell at a threshold fails, one beside it passes."""
    data = [("1", "A", 200.0, 600.0, 1.0, 0.1, 1.0), ("2", "A", 4000.0, 600.0, 1.0, 0.1, 1.0), ("3", "A", 201.0, 500.0, 1.0, 0.1, 1.0), ("4", "A", 3999.0, 29999.0, 25.0, 0.1, 1.0), ("5", "A", 201.0, 501.0, 24.9, 0.9, 99.0)]
    f = quality.flag_cells(spark.createDataFrame(data, CELLS), R)
    assert [r["retained"] for r in f.orderBy("cell_id").collect()] == [False, False, False, False, True]


def test_reasons(spark):
    """Four cells of two samples."""
    data = [("1", "A", 200.0, 500.0, 25.0, 0.0, 0.0), ("2", "A", 201.0, 501.0, 1.0, 0.0, 0.0), ("3", "A", 4000.0, 30000.0, 1.0, 0.0, 0.0), ("4", "B", 201.0, 501.0, 1.0, 0.0, 0.0), ("5", None, None, float("nan"), None, None, None)]
    got = {r["sample"]: r for r in quality.filter_reasons(quality.flag_cells(spark.createDataFrame(data, CELLS), R, ["B"])).collect()}
    a = got["A"]
    assert (a["input_cells"], a["qc_removed_cells"], a["multiple_conditions"], a["nfeature_min_hits"], a["nfeature_min_only"]) == (3, 2, 2, 1, 0)
    assert (got["B"]["qc_removed_cells"], got["B"]["total_removed_cells"]) == (0, 1)
    assert got[None]["qc_removed_cells"] == 0


def test_metrics_of_cells_without_counts(spark):
    counts = spark.createDataFrame([("a", "g1", 3.0, True), ("a", "g2", 1.0, False), ("x", "g1", 1.0, True)], "cell_id string, gene_id string, value double, mt boolean")
    cells = spark.createDataFrame([("a", 7.0), ("b", 9.0)], "cell_id string, ncount double")
    m = matrix.cell_totals(counts, cells.select("cell_id"), {"pmt": "mt"})
    assert rows(m) == [("a", 4.0, 2, 75.0), ("b", 0.0, 0, None)]
    kept = {r["cell_id"]: r for r in matrix.keep_input_values(cells, m, ["ncount"]).collect()}
    assert (kept["a"]["ncount"], kept["a"]["ncount_input_metadata"], kept["a"]["ncount_before_qc"]) == (4.0, 7.0, 4.0)


def test_design(spark):
    """Samples nested in groups are confounded yet eligible, crossed batches aren't confounded, equal ones are."""
    data = [(i, f"S{i % 4}", f"G{i % 2}", f"B{i // 2 % 2}", "one") for i in range(40)]
    cells = spark.createDataFrame(data, "cell_id int, sample string, grp string, batch string, flat string")
    d = lambda f, tech=(): graph.batch_design(cells, ["sample", "batch", "flat"], "grp", f, tech).filter(f"field = '{f}'").first()
    assert (d("sample")["confounded_with_group"], d("sample")["decision"]) == (True, "ELIGIBLE")
    assert (d("batch", ["batch"])["confounded_with_group"], d("batch", ["batch"])["decision"]) == (False, "ELIGIBLE")
    assert d("flat", ["flat"])["decision"] == "ONE_BATCH_LEVEL"
    assert d("batch")["decision"] == "TECHNICAL_MEANING_UNCONFIRMED"
    same = cells.withColumn("batch", cells.grp)
    assert graph.batch_design(same, ["batch"], "grp", "batch", ["batch"]).first()["decision"] == "BATCH_GROUP_CONFOUNDED"


def test_neighbours_against_brute_force(spark):
    r = np.random.default_rng(3)
    x = np.round(r.normal(size=(300, 6)), 1)
    x[10] = x[11] = x[12]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(None, [0.0] * 6), (999, None)], "cell_id bigint, vec array<double>").repartition(5)
    got = {}
    for row in graph.nearest(df.filter("cell_id < 50"), df, 7, block=16).collect():
        got.setdefault(row["src"], []).append((row["rnk"], row["dst"]))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for i in range(50):
        want = sorted((j for j in range(300) if j != i), key=lambda j: (round(d[i, j], 9), j))[:7]
        assert np.allclose(sorted(d[i, j] for _, j in got[i]), sorted(d[i, j] for j in want))
    approx = graph.nearest_indexed(df, 10, lists=8, probes=6)
    exact = {(r["src"], r["dst"]) for r in graph.nearest(df, df, 10).collect()}
    assert len(exact & {(r["src"], r["dst"]) for r in approx.collect()}) / len(exact) >= 0.9
    blocks = {(r["src"], r["dst"]) for r in graph.nearest(df, df, 10, block=64, rows_block=50).collect()}
    assert blocks == exact == {(r["src"], r["dst"]) for r in graph.neighbour_graph(df, 10, exact=True).collect()}
    again = {(r["src"], r["dst"]) for r in graph.neighbour_graph(df, 10).collect()}
    assert len(exact & again) / len(exact) >= 0.9
    assert graph.nearest(df.filter("false"), df, 3).count() == 0


def test_index_reaches_its_recall_in_64_dimensions(spark):
    r = np.random.default_rng(5)
    plain = r.normal(size=(2500, 64))
    for x in (plain, 3 * r.normal(size=(25, 64))[r.integers(0, 25, 2500)] + plain):
        df = materialize(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cell_id bigint, vec array<double>"), "vectors")
        exact = {(r["src"], r["dst"]) for r in graph.nearest(df, df, 20).collect()}
        found = {(r["src"], r["dst"]) for r in graph.neighbour_graph(df, 20).collect()}
        assert len(exact & found) / len(exact) >= 0.9


def test_hubs_are_cut(spark):
    """A cell that all have as a neighbour: the same graph, whatever the parts."""
    r = random.Random(2)
    data = {(i, 0) for i in range(1, 120)} | {(i, r.randrange(120)) for i in range(120) for _ in range(5)}
    nn = spark.createDataFrame([x for x in data if x[0] != x[1]], "src bigint, dst bigint")
    near = {i: {i} | {d for s, d in data if s == i and d != i} for i in range(120)}
    want = {(i, j): len(near[i] & near[j]) / len(near[i] | near[j]) for i in range(120) for j in range(i + 1, 120) if near[i] & near[j]}
    want = {k: w for k, w in want.items() if w >= 1 / 15}
    for hub in (graph.HUB, 10):
        got = {(x["src"], x["dst"]): x["weight"] for x in graph.shared_neighbours(nn, hub=hub).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_connected_groups(spark):
    r = random.Random(4)
    chain = [(f"a{i}", f"b{i + j}") for i in range(60) for j in (0, 1)]
    data = chain + [(f"x{i}", f"y{i}") for i in range(5)] + [(f"r{r.randrange(40)}", f"s{r.randrange(40)}") for _ in range(30)] + [(None, "b1"), ("a1", None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in data:
        if a and b:
            root[find("l" + a)] = find("r" + b)
    want = len({find(x) for x in list(root)})
    df = spark.createDataFrame(data, "a string, b string")
    assert graph.components(df, "a", "b") == graph.components(df, "a", "b", driver_pairs=0) == want
    assert graph.components(df.filter("false"), "a", "b") == 0


def test_ranks_of_heavy_ties(spark):
    data = [("g", 0.0 if i % 3 else float(i), float(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    rank = lambda v: np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])
    rx, ry = (rank(np.array([d[i] for d in data])) for i in (1, 2))
    assert stats.spearman(df, ["g"], "x", "y").first()["rho"] == pytest.approx(np.corrcoef(rx, ry)[0, 1])


def test_expected_doublets_round_half_to_even(spark):
    h = spark.createDataFrame([("a", 112, 0.2), ("b", 113, 0.2), ("c", 12, 0.9)], "library_id string, n_cells bigint, homotypic double")
    got = {r["library_id"]: (r["n_exp"], r["n_exp_adj"], r["valid"]) for r in review.expected_doublets(h).collect()}
    assert got["a"][:2] == (round(112 * 0.04), round(round(112 * 0.04) * 0.8)) and got["b"][0] == round(113 * 0.04) and not got["c"][2]


def test_recommendation(spark):
    df = spark.createDataFrame([(0.95, 0.95, 0.1, 0.1), (0.5, 0.95, 0.4, 0.36), (0.5, 0.5, 0.4, 0.1), (0.5, 0.5, None, 0.1)], "ari double, overlap double, before double, after double")
    assert [r["recommendation"] for r in review.recommendation(df).collect()] == ["SIMILAR_RESULTS", "BASELINE_PREFERRED", "USER_REVIEW_REQUIRED", "USER_REVIEW_REQUIRED"]


def test_libraries(spark):
    c = spark.createDataFrame([("1", "A", "L1", "r1"), ("2", "A", "", "r2")], "cell_id string, sample string, capture_id string, sequencing_run string")
    with pytest.raises(ValueError):
        quality.capture_libraries(c)
    assert quality.capture_libraries(c.drop("sequencing_run"))[1] == "sample"
    with pytest.raises(ValueError):
        quality.capture_libraries(c.withColumnRenamed("capture_id", "library_id"))
