"""Ambient contamination per library: expectation maximization of native and contaminating expression."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITERATIONS, LIBRARY_CELLS = 50, 20_000


def decontaminate(row: np.ndarray, col: np.ndarray, value: np.ndarray, cluster: np.ndarray, n_genes: int, background: np.ndarray | None = None, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """The native part of every entry of a sparse matrix (row: cell, col: gene) and each cell's contamination.

    A cell's counts are a mixture of its cluster's native profile and a profile of what contaminates the cluster: the other
    clusters' counts, or the background if there is one. Expectations of native counts and the profiles and shares that they
    give take turns; a Beta prior of the shares is fitted by its moments.
    """
    k = int(cluster.max()) + 1
    n_cells = len(cluster)
    total = np.maximum(np.bincount(row, value, n_cells), 1e-12)
    of = cluster[row]
    share = np.full(n_cells, 0.1)
    native = value * 0.9
    cell = lambda x: np.bincount(row, x, n_cells)
    for _ in range(iterations):
        own = np.bincount(of * n_genes + col, native, k * n_genes).reshape(k, n_genes) + 1e-9
        if background is None:
            noise = (own.sum(axis=0, keepdims=True) - own) if k > 1 else np.bincount(col, value, n_genes)[None, :] + 0 * own
        else:
            noise = np.repeat(background[None, :].astype(float), k, axis=0)
        phi = own / own.sum(axis=1, keepdims=True)
        eta = (noise + 1e-9) / (noise + 1e-9).sum(axis=1, keepdims=True)
        a = (1 - share[row]) * phi[of, col]
        p = a / np.maximum(a + share[row] * eta[of, col], 1e-300)
        native = value * p
        dirty = 1 - cell(native) / total
        mean, var = dirty.mean(), max(dirty.var(), 1e-6)
        strength = min(max(mean * (1 - mean) / var - 1, 1.0), 1e4)
        new = (dirty * total + mean * strength) / (total + strength)
        if np.abs(new - share).max() < 1e-4:
            share = new
            break
        share = np.clip(new, 1e-6, 1 - 1e-6)
    return np.minimum(native, value), np.clip(1 - cell(native) / total, 0, 1)


def correct_counts(counts: DataFrame, cells: DataFrame, library: str = "library_id", cluster: str = "cluster", background: DataFrame | None = None, library_cells: int = LIBRARY_CELLS) -> DataFrame:
    """cell_id, gene_id, value (fractional, never rounded, at most the count), contamination: a separate assay; counts stay as they are.

    cells: cell_id, library, cluster; cells without counts have no rows. background: library, gene_id, value of empty droplets.
    Libraries are corrected on their own; larger ones than library_cells in equal parts by a hash of the cell.
    """
    sizes = cells.groupBy(library).agg(F.count(F.lit(1)).alias("_n"))
    parts = cells.join(sizes, library).withColumn("_part", F.pmod(F.xxhash64("cell_id"), F.ceil(F.col("_n") / float(library_cells))).cast("int"))
    rows = counts.filter("value > 0").join(parts.select("cell_id", F.col(library).alias("_lib"), F.col(cluster).cast("string").alias("_cl"), "_part"), "cell_id").select("_lib", "_part", "_cl", "cell_id", "gene_id", "value")
    kind, gene = counts.schema["cell_id"].dataType.simpleString(), counts.schema["gene_id"].dataType.simpleString()
    schema = f"cell_id {kind}, gene_id {gene}, value double, contamination double"

    def correct(p: pd.DataFrame, empty: pd.DataFrame | None = None) -> pd.DataFrame:
        if not len(p):
            return pd.DataFrame({"cell_id": p["cell_id"], "gene_id": p["gene_id"], "value": p["value"].astype(float), "contamination": p["value"].astype(float)})
        p = p.sort_values(["cell_id", "gene_id"])
        ids, row = np.unique(p["cell_id"].to_numpy(), return_inverse=True)
        genes, col = np.unique(p["gene_id"].to_numpy(), return_inverse=True)
        _, group = np.unique(p.groupby("cell_id")["_cl"].first().loc[ids].to_numpy().astype(str), return_inverse=True)
        noise = None
        if empty is not None and len(empty):
            noise = empty.groupby("gene_id")["value"].sum().reindex(genes).fillna(0.0).to_numpy()
            noise = noise if noise.sum() > 0 else None
        native, share = decontaminate(row, col, p["value"].to_numpy(float), group, len(genes), noise)
        return pd.DataFrame({"cell_id": p["cell_id"].to_numpy(), "gene_id": p["gene_id"].to_numpy(), "value": native, "contamination": share[row]})

    if background is None:
        return rows.groupBy("_lib", "_part").applyInPandas(lambda p: correct(p), schema)
    empty = background.select(F.col(library).alias("_lib"), "gene_id", "value").groupBy("_lib", "gene_id").agg(F.sum("value").alias("value"))
    empty = empty.join(parts.select(F.col(library).alias("_lib"), F.col("_part").alias("_of")).distinct(), "_lib")
    return rows.groupBy("_lib", "_part").cogroup(empty.groupBy("_lib", "_of")).applyInPandas(lambda a, b: correct(a, b), schema)
