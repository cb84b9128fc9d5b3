"""Doublet scores per capture library: artificial doublets among the real cells, and how many of a cell's neighbours they are."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scquarry.session import materialize, sent_if_small

#: Share of artificial cells, components, genes, neighbourhoods tried (shares of all cells), shares of artificial cells tried.
PN, COMPONENTS, GENES = 0.25, 10, 500
PKS = (0.005, 0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3)
PNS = (0.15, 0.25, 0.35)
#: Cells of a library that are made dense together (about), and points whose neighbours are sought together.
BLOCK_CELLS, QUERY_CELLS = 2000, 10_000
#: Distances that a task holds at once; points whose shares (some 400 bytes each) and cells whose totals (110 bytes) may go to every executor.
DISTANCES, SENT_POINTS, SENT_CELLS = 1 << 24, 100_000, 1_000_000
#: Points with the most cells, which bound how far a neighbourhood reaches; tasks that a library is cut into while these have so many points or more.
HEAVY, LEAST_TASKS, TASK_POINTS = 64, 8, 500


def artificial(n: int, pn: float) -> int:
    """The artificial cells that make up pn of all beside n real ones."""
    return max(1, round(n / (1 - pn) - n))


def scaled(c: np.ndarray, total: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Cells' counts normalized and standardized."""
    return (np.log1p(1e4 * c / total[:, None]) - mean) / np.maximum(sd, 1e-9)


def some_dense(p: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's cells (i, x: places and counts of the genes chosen): the places of those with any such counts, and these counts."""
    n = p["i"].map(len).to_numpy(int)
    own = np.flatnonzero(n)
    x = np.zeros((len(own), width))
    for row, (i, v) in enumerate(zip(p["i"].iloc[own], p["x"].iloc[own])):
        x[row, np.asarray(i, int)] = v
    return own, x


def neighbour_shares(own: np.ndarray, z: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """By point asked (places among z), share of artificial cells tried and neighbourhood tried: the share of artificial cells among
    the cells nearest to a real one there.

    z holds distinct points; cells by point the real cells, then the artificial ones that come with each share of PNS. Where a
    neighbourhood ends among cells equally far, these count as many of it as are missing, each kind by its part of them. Only points
    up to a distance within which there are enough cells for the largest neighbourhood are sorted.
    """
    made = np.ascontiguousarray(np.cumsum(cells[:, 1:], axis=1).T)
    every = cells[:, 0] + made
    ks = np.array([[min(n - 1, max(1, round(pk * n))) for pk in PKS] for n in every.sum(axis=1).tolist()])
    half, step = (z * z).sum(1) / 2, max(1, DISTANCES // len(z))
    enough = ks.max(axis=1)[:, None] + 1  # with the cell that asks
    heavy = np.argsort(-every[-1], kind="stable")[:HEAVY]
    third = min(len(z) - 1, round((max(PKS) + 0.02) * len(z)))
    out = np.zeros((len(own), len(PNS), len(PKS)))
    for at in range(0, len(own), step):
        b = own[at : at + step]
        far = half - z[b] @ z.T  # grows with the distance
        far[np.arange(len(b)), b] = -np.inf
        for row, d in enumerate(far):
            by = heavy[np.argsort(d[heavy])]
            within = (every[:, by].cumsum(axis=1) >= enough).all(axis=0)
            near = np.flatnonzero(d <= (d[by[within.argmax()]] if within[-1] else np.partition(d, third)[third]))
            if not within[-1] and (every[:, near].sum(axis=1) < enough[:, 0]).any():
                near = np.arange(len(d))
            order = near[np.argsort(d[near])]
            d, n, m = d[order], np.zeros((len(PNS), len(order) + 1), int), np.zeros((len(PNS), len(order) + 1), int)
            np.cumsum(every[:, order], axis=1, out=n[:, 1:])
            np.cumsum(made[:, order], axis=1, out=m[:, 1:])
            n[:, 1:] -= 1  # the cell that asks
            for j, k in enumerate(ks):
                edge = d[np.searchsorted(n[j, 1:], k)]
                lo, hi = np.searchsorted(d, edge, "left"), np.searchsorted(d, edge, "right")
                out[at + row, j] = (m[j, lo] + (k - n[j, lo]) * (m[j, hi] - m[j, lo]) / (n[j, hi] - n[j, lo])) / k
    return out


def _vectors(column: pd.Series) -> np.ndarray:
    return np.vstack([np.frombuffer(v, np.float64) for v in column])


def embedded(counts: DataFrame, libraries: DataFrame, library: str, min_cells: int, seed: int, block_cells: int) -> tuple[DataFrame, DataFrame]:
    """_lib, cell_id (null for artificial cells), level, z: the real and the artificial cells of libraries of min_cells or more in the
    space of the library's components, which are those of its most variable genes, from sums over all its blocks. Tables of cells are
    sent to the rows of counts as far as they may be, so that these are moved and sorted for the genes' moments only; cells without
    counts of the genes, which are zero wherever they are computed, aren't made dense. _lib is the library's number; the second table has
    _name, the library, of each."""
    kind = counts.schema["cell_id"].dataType.simpleString()
    sizes = libraries.groupBy(library).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") >= min_cells) & F.col(library).isNotNull())
    names = materialize(sizes.select(F.row_number().over(W.orderBy(library)).alias("_lib"), F.col(library).alias("_name"), "_n"), "names")  # one row per library
    block = F.pmod(F.xxhash64("cell_id", F.lit(seed)), F.ceil(F.col("_n") / float(block_cells))).cast("int")
    parts = materialize(libraries.join(names, F.col(library) == F.col("_name")).select("cell_id", "_lib", block.alias("_block")), "parts")
    rows = materialize(counts.filter("value > 0").join(sent_if_small(parts, SENT_CELLS), "cell_id").select("_lib", "_block", "cell_id", "gene_id", F.col("value").cast("double").alias("value")), "libraries")
    totals = materialize(rows.groupBy("_lib", "_block", "cell_id").agg(F.sum("value").alias("total")), "totals")
    data = F.log1p(1e4 * F.col("value") / F.col("total"))
    m = rows.join(sent_if_small(totals.select("cell_id", "_lib", "total"), SENT_CELLS), ["cell_id", "_lib"]).groupBy("_lib", "gene_id").agg(F.sum(data).alias("s"), F.sum(data * data).alias("q"))
    m = m.join(totals.groupBy("_lib").agg(F.count(F.lit(1)).alias("n")), "_lib").select("_lib", "gene_id", (F.col("s") / F.col("n")).alias("mean"), F.greatest(F.lit(0.0), F.col("q") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2)).alias("v"))
    place = F.row_number().over(W.partitionBy("_lib").orderBy(F.desc(F.round("v", 12)), "gene_id"))  # one row per gene
    genes = materialize(m.withColumn("place", place).filter(F.col("place") <= GENES).withColumn("place", F.col("place") - 1), "genes")
    per_library = genes.groupBy("_lib").agg(F.array_sort(F.collect_list(F.struct("place", "mean", F.sqrt("v").alias("sd")))).alias("g")).select("_lib", F.col("g.mean").alias("mean"), F.col("g.sd").alias("sd"))
    own = rows.join(genes.select("_lib", "gene_id", "place"), ["_lib", "gene_id"]).groupBy("_lib", "cell_id").agg(F.collect_list("place").alias("i"), F.collect_list("value").alias("x"))
    empty = F.array().cast("array<int>"), F.array().cast("array<double>")
    cells = totals.join(own, ["_lib", "cell_id"], "left").withColumns({"i": F.coalesce(F.col("i").cast("array<int>"), empty[0]), "x": F.coalesce("x", empty[1])})
    cells = materialize(cells, "cells")
    # one row per block: what its cells are standardized by
    params = materialize(cells.select("_lib", "_block").distinct().join(per_library, "_lib"), "params")
    key = ["_lib", "_block"]

    def of(q: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return np.asarray(q["mean"].iloc[0], float), np.asarray(q["sd"].iloc[0], float)

    def gram(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(p):
            return pd.DataFrame({"_lib": p["_lib"], "_part": [], "gram": []})
        mean, sd = of(q)
        own, x = some_dense(p, len(mean))
        x = scaled(x, p["total"].to_numpy(float)[own], mean, sd)
        none = scaled(np.zeros((1, len(mean))), np.ones(1), mean, sd)
        return pd.DataFrame({"_lib": p["_lib"].iloc[:1], "_part": int(p["_block"].iloc[0]) % 32, "gram": [(x.T @ x + (len(p) - len(own)) * (none.T @ none)).tobytes()]})

    def add(p: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(g, np.float64) for g in p["gram"])
        return pd.DataFrame({"_lib": p["_lib"].iloc[:1], "_part": p["_part"].iloc[0], "gram": [total.tobytes()]})

    def axes(p: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(g, np.float64) for g in p["gram"])
        width = math.isqrt(len(total))
        _, vectors = np.linalg.eigh(total.reshape(width, width))
        return pd.DataFrame({"_lib": p["_lib"].iloc[:1], "axes": [np.ascontiguousarray(vectors[:, ::-1][:, :COMPONENTS]).tobytes()]})

    sums = "_lib int, _part int, gram binary"
    grams = cells.groupBy(*key).cogroup(params.groupBy(*key)).applyInPandas(lambda p, q: gram(p, q), sums).groupBy("_lib", "_part").applyInPandas(add, sums)
    loadings = materialize(grams.groupBy("_lib").applyInPandas(axes, "_lib int, axes binary"), "axes")

    def embed(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(p):
            return pd.DataFrame({"_lib": p["_lib"], "cell_id": p["cell_id"], "level": [], "z": []})
        p, (mean, sd) = p.sort_values("cell_id"), of(q)
        total, (own, x) = p["total"].to_numpy(float), some_dense(p, len(mean))
        v = np.frombuffer(q["axes"].iloc[0], np.float64).reshape(len(mean), -1)
        # an artificial cell is the mean of two real ones of the block, which is a random part of its library
        pairs = np.random.default_rng([seed, int(p["_block"].iloc[0])]).integers(0, len(p), (artificial(len(p), max(PNS)), 2))
        level = np.digitize(np.arange(len(pairs)), [artificial(len(p), pn) for pn in PNS[:-1]])
        row = np.full(len(p), len(own))
        row[own] = np.arange(len(own))
        some = np.flatnonzero((row[pairs] < len(own)).any(axis=1))
        a, b = pairs[some].T
        counted = np.vstack([x, np.zeros((1, len(mean)))])
        made = (counted[row[a]] + counted[row[b]]) / 2, (total[a] + total[b]) / 2
        z = np.zeros((len(p) + len(pairs), v.shape[1]))
        # not centred, which leaves distances as they are: those without counts of the genes are zero
        z[own], z[len(p) + some] = scaled(x, total[own], 0.0 * mean, sd) @ v, scaled(*made, 0.0 * mean, sd) @ v
        z += 0.0  # no zero has a sign
        ids = pd.concat([p["cell_id"].astype(object), pd.Series([None] * len(pairs), dtype=object)], ignore_index=True)
        return pd.DataFrame({"_lib": p["_lib"].iloc[0], "cell_id": ids.astype("Int64") if kind in ("bigint", "int") else ids, "level": np.r_[np.full(len(p), -1), level], "z": [r.tobytes() for r in z]})

    return materialize(cells.groupBy(*key).cogroup(params.join(loadings, "_lib").groupBy(*key)).applyInPandas(embed, f"_lib int, cell_id {kind}, level int, z binary"), "embedded"), names.drop("_n")


def doublet_scores(counts: DataFrame, libraries: DataFrame, library: str = "library_id", min_cells: int = 30, seed: int = 42, block_cells: int = BLOCK_CELLS, query_cells: int = QUERY_CELLS) -> DataFrame:
    """library, cell_id, pann, pk of the cells of libraries with min_cells or more; smaller ones are not evaluated.

    libraries: cell_id and library. Genes, components and the neighbourhood pk are those of a whole library, from sums over its blocks;
    artificial cells are made in each block of about block_cells random cells. Cells with equal components are one point with their
    number and are searched once; points are compared with all points of their library, query_cells at a time at most, so that a
    library with a third of all cells makes many tasks and is scored by the same rules as any other; a task holds the library's points
    (120 bytes each). pk is the one whose shares are bimodal alike for all shares of artificial cells tried. Cells without counts have no
    score.
    """
    z, names = embedded(counts, libraries, library, min_cells, seed, block_cells)
    numbers = [f"_n{i}" for i in range(len(PNS) + 1)]
    points = materialize(z.groupBy("_lib", "z").agg(*[F.count(F.when(F.col("level") == i - 1, 1)).alias(n) for i, n in enumerate(numbers)]), "points")
    n = F.count(F.lit(1))
    blocks = F.greatest(F.ceil(n / float(query_cells)), F.least(F.ceil(n / float(TASK_POINTS)), F.lit(LEAST_TASKS)))
    sizes = points.filter("_n0 > 0").groupBy("_lib").agg(blocks.cast("int").alias("_blocks"))  # one row per library
    base = points.join(sizes, "_lib").withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    base = base.withColumn("_asked", (F.col("_n0") > 0) & (F.pmod(F.xxhash64("z"), F.col("_blocks")) == F.col("_q"))).drop("_blocks")
    tasks = int(z.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number: else small ones would be put together, which take long

    def shares(p: pd.DataFrame) -> pd.DataFrame:
        own = np.flatnonzero(p["_asked"])
        s = neighbour_shares(own, _vectors(p["z"]), p[numbers].to_numpy(int))
        return pd.DataFrame({"_lib": p["_lib"].iloc[own], "z": p["z"].iloc[own], "shares": s.reshape(len(own), -1).tolist()})

    found = materialize(base.repartition(tasks, "_lib", "_q").groupBy("_lib", "_q").applyInPandas(shares, "_lib int, z binary, shares array<double>"), "found")
    got = materialize(z.filter("level < 0").join(sent_if_small(found, SENT_POINTS), ["_lib", "z"]).select("_lib", "cell_id", "shares"), "shares")
    # Sarle's coefficient of every column of shares, from its skewness and kurtosis
    n = F.col("n").cast("double")
    g = F.col("g") * F.sqrt(n * (n - 1)) / (n - 2)
    k = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("k") + 6)
    b = got.select("_lib", F.posexplode("shares").alias("j", "x")).groupBy("_lib", "j").agg(F.count(F.lit(1)).alias("n"), F.skewness("x").alias("g"), F.kurtosis("x").alias("k"), F.stddev_pop("x").alias("sd"))
    b = b.filter("n >= 4 AND sd > 1e-12").select("_lib", F.expr(f"j % {len(PKS)}").alias("pk"), ((g * g + 1) / (k + 3 * (n - 1) * (n - 1) / ((n - 2) * (n - 3)))).alias("b"))
    metric = b.groupBy("_lib", "pk").agg((F.avg("b") / F.nullif(F.var_samp("b"), F.lit(0.0))).alias("metric")).filter("metric IS NOT NULL AND NOT isnan(metric)")
    best = metric.groupBy("_lib").agg(F.max_by("pk", F.struct("metric", -F.col("pk"))).alias("best"))
    found = got.join(names, "_lib").join(best, "_lib", "left").withColumn("best", F.coalesce("best", F.lit(3)))
    pks = F.array(*[F.lit(p) for p in PKS])
    pann = F.element_at("shares", (F.lit(PNS.index(PN) * len(PKS) + 1) + F.col("best")).cast("int"))
    return found.select(F.col("_name").alias(library), "cell_id", pann.alias("pann"), F.element_at(pks, (F.col("best") + 1).cast("int")).alias("pk"))
