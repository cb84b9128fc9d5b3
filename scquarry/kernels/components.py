"""Variable genes, principal components, layouts and overlaps of subspaces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scquarry.kernels.sums import matrix_of, partial_sums
from scquarry.operators.matrix import gene_moments
from scquarry.session import materialize, sent_if_small

#: Variable genes at most, span of the local fit, bound of scaled values.
VARIABLE, SPAN, CLIP = 2000, 0.3, 10.0
#: Parts in which the genes' cross products are added up.
GRAM_BLOCKS = 16


def local_fit(x: np.ndarray, y: np.ndarray, span: float = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Local quadratic regression of y on x with tricube weights: the points of a grid and the values there, linear in between."""
    order = np.argsort(x)
    x, y = x[order], y[order]
    k = max(4, int(np.ceil(span * len(x))))
    grid = np.linspace(x[0], x[-1], 128) if x[-1] > x[0] else x[:1]
    fitted = []
    for g in grid:
        d = np.abs(x - g)
        h = max(np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1], 1e-12)
        w = np.clip(1 - (d / h) ** 3, 0, 1) ** 1.5
        use = w > 0
        basis = np.vander(x[use] - g, 3, increasing=True) * w[use, None]
        fitted.append(np.linalg.lstsq(basis, y[use] * w[use], rcond=None)[0][0])
    return grid, np.array(fitted)


def variable_genes(counts: DataFrame, n_cells: int, top: int = VARIABLE) -> DataFrame:
    """The most variable genes: gene_id, mean, variance, standardized_variance, place (from 1; ties to the smaller id).

    The variance expected at a gene's mean comes from a local fit over all genes; values are then standardized by it, clipped at
    sqrt(n_cells), and their variance, zeros included, ranks the genes. The driver gets two numbers a gene (16 bytes) for the fit,
    whatever their number, and sends the values on the fit's grid; counts are written once and read twice.
    """
    spark = counts.sparkSession
    counts = materialize(counts, "counts")
    m = materialize(gene_moments(counts, "value", F.lit(n_cells)).filter("variance > 0 AND mean > 0").select("gene_id", "mean", "variance"), "moments")
    kind = counts.schema["gene_id"].dataType.simpleString()
    both = m.select("mean", "variance").toArrow()
    if not both.num_rows:
        return spark.createDataFrame([], f"gene_id {kind}, mean double, variance double, standardized_variance double, place int")
    grid, fitted = local_fit(*(np.log10(both.column(c).to_numpy()) for c in ("mean", "variance")))

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sd = np.sqrt(10 ** np.interp(np.log10(b.column(1).to_numpy(zero_copy_only=False)), grid, fitted))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sd)], ["gene_id", "mean", "variance", "sd"])

    fit = materialize(m.mapInArrow(expected, f"gene_id {kind}, mean double, variance double, sd double"), "fit")
    z = F.least(F.lit(float(np.sqrt(n_cells))), (F.col("value") - F.col("mean")) / F.col("sd"))
    s = counts.join(sent_if_small(fit), "gene_id").groupBy("gene_id").agg(F.count(F.lit(1)).alias("n"), F.sum(z * z).alias("q"), F.first("mean").alias("mean"), F.first("variance").alias("variance"), F.first("sd").alias("sd"))
    s = s.withColumn("standardized_variance", (F.col("q") + (n_cells - F.col("n")) * F.pow(F.col("mean") / F.col("sd"), 2)) / (n_cells - 1))
    from pyspark.sql import Window as W

    best = s.orderBy(F.desc("standardized_variance"), "gene_id").limit(top)
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("standardized_variance"), "gene_id"))  # top rows at most
    return best.select("gene_id", "mean", "variance", "standardized_variance", place.alias("place"))


def cell_rows(data: DataFrame, features: DataFrame, cells: DataFrame, value: str = "data") -> DataFrame:
    """One row per cell with its non-zero features: cell_id, i (place of the feature, from 0), x; cells without any have empty lists."""
    f = features.select("gene_id", (F.col("place") - 1).cast("int").alias("_i"))
    g = data.join(F.broadcast(f), "gene_id").groupBy("cell_id").agg(F.array_sort(F.collect_list(F.struct("_i", F.col(value).alias("_x")))).alias("p"))
    out = cells.join(g, "cell_id", "left")
    empty = F.array().cast("array<int>"), F.array().cast("array<double>")
    return out.select(*cells.columns, F.coalesce(F.col("p._i"), empty[0]).alias("i"), F.coalesce(F.col("p._x"), empty[1]).alias("x"))


def _dense(b: pa.RecordBatch, width: int) -> np.ndarray:
    names = b.schema.names
    i, x = b.column(names.index("i")), b.column(names.index("x"))
    sizes = np.diff(np.asarray(i.offsets))
    out = np.zeros((b.num_rows, width))
    out[np.repeat(np.arange(b.num_rows), sizes), i.flatten().to_numpy(zero_copy_only=False)] = x.flatten().to_numpy(zero_copy_only=False)
    return out


def principal_components(rows: DataFrame, width: int, n_components: int, covariates: tuple[str, ...] = ()) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Scores (cell_id, vec), standard deviations and loadings of the features of cell_rows().

    Features are regressed on the covariates (with an intercept), divided by the standard deviation of the residuals and clipped
    at CLIP; the scaled values are never stored: blocks of cells are made dense where they lie, once for the regression, once for
    the spread, once for the cross products of the features (width x width) and once for the scores. Signs are set so that the
    largest loading of a component is positive.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:  # few bytes, but much work: adaptive execution leaves them in fewer tasks than there are cores
        rows = rows.repartition(cores)
    p = len(covariates) + 1

    def design(b: pa.RecordBatch) -> np.ndarray:
        return np.column_stack([np.ones(b.num_rows), *[np.array(b.column(b.schema.names.index(c)).to_pylist(), float) for c in covariates]])

    def normal(b):
        d = design(b)
        return [0, 1, 2], [(d.T @ d).ravel(), (d.T @ _dense(b, width)).ravel(), [b.num_rows]]

    s = partial_sums(rows, normal)
    n = int(s[2][0]) if 2 in s else 0
    if n < 2:
        raise ValueError("too few cells")
    beta = np.linalg.pinv(s[0].reshape(p, p)) @ s[1].reshape(p, width)
    residual = lambda b: _dense(b, width) - design(b) @ beta
    spread = partial_sums(rows, lambda b: ([0], [(residual(b) ** 2).sum(axis=0)]))[0]
    sd = np.sqrt(spread / (n - 1))
    scale = np.where(sd > 1e-12, 1 / np.maximum(sd, 1e-12), 0.0)
    scaled = lambda b: np.minimum(residual(b) * scale, CLIP)

    # rows of the table of cross products travel in blocks: few large sums instead of one per gene
    step = -(-width // GRAM_BLOCKS)

    def cross(b):
        z = scaled(b)
        g = z.T @ z
        return [*range(-(-width // step)), -1], [*(g[i : i + step].ravel() for i in range(0, width, step)), z.sum(axis=0)]

    g = partial_sums(rows, cross)
    mean = g.pop(-1) / n
    c = (np.concatenate([g[i] for i in sorted(g)]).reshape(width, width) - n * np.outer(mean, mean)) / (n - 1)
    values, vectors = np.linalg.eigh(c)
    top = np.argsort(values)[::-1][:n_components]
    loadings = vectors[:, top]
    loadings = loadings * np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])])
    shared = spark.sparkContext.broadcast(loadings)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                out = (scaled(b) - mean) @ shared.value
                yield pa.RecordBatch.from_arrays([b.column(b.schema.names.index("cell_id")), pa.array(out.tolist(), pa.list_(pa.float64()))], ["cell_id", "vec"])

    kind = rows.schema["cell_id"].dataType.simpleString()
    return rows.mapInArrow(scores, f"cell_id {kind}, vec array<double>"), np.sqrt(np.maximum(values[top], 0)), loadings


def formal_pca(counts: DataFrame, totals: DataFrame, regress: str = "pmt", top: int = VARIABLE, max_pcs: int = 50) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Normalization, variable genes, regression and components of a matrix: scores, standard deviations, loadings."""
    from scquarry.functions.stats import pc_cap
    from scquarry.operators.matrix import log_normalize

    cells = totals.filter(F.col(regress).isNotNull()).select("cell_id", regress)
    n = cells.count()
    counts = materialize(counts, "counts")  # read for the moments, the ranking and the values
    genes = variable_genes(counts, n, top)
    genes = materialize(genes, "hvg")
    width = genes.count()
    chosen = counts.join(F.broadcast(genes.select("gene_id")), "gene_id", "left_semi")  # few values are left to be shuffled
    rows = materialize(cell_rows(log_normalize(chosen, totals), genes, cells), "cells")
    return principal_components(rows, width, max(2, pc_cap(max_pcs, n, width, width + 1)), (regress,))


def subspace_overlap(a: DataFrame, b: DataFrame, k: int) -> float:
    """How much the spaces of the first k components of two embeddings (cell_id, vec) of the same cells share, from 0 to 1."""
    both = a.select("cell_id", F.slice("vec", 1, k).alias("a")).join(b.select("cell_id", F.slice("vec", 1, k).alias("b")), "cell_id")

    def cross(batch):
        x, y = (matrix_of(batch.column(batch.schema.names.index(c)), batch.num_rows) for c in ("a", "b"))
        return [0, 1, 2], [(x.T @ x).ravel(), (x.T @ y).ravel(), (y.T @ y).ravel()]

    s = {i: v.reshape(k, k) for i, v in partial_sums(both, cross).items()}
    return float(np.trace(np.linalg.pinv(s[0]) @ s[1] @ np.linalg.pinv(s[2]) @ s[1].T) / k)


def layout(vectors: DataFrame) -> DataFrame:
    """A plane for plots: the first two components, x, y, and the name of the layout; nothing is fitted."""
    return vectors.select("cell_id", F.col("vec")[0].alias("x"), F.col("vec")[1].alias("y"), F.lit("pca2").alias("layout"))
