"""A layout of cells in the plane that keeps neighbours together (UMAP): fitted on landmarks, every cell placed among its nearest ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Landmarks at most (taken by a hash of the id), neighbours of each, epochs, repelled cells per attracted one.
LANDMARKS, NEIGHBOURS, EPOCHS, REPELLED = 4000, 15, 200, 5
#: Curve 1 / (1 + a d ** (2 b)) of nearness in the plane for a least distance of 0.3.
A, B = 0.9922, 1.1122


def memberships(d: np.ndarray) -> np.ndarray:
    """How near each row's neighbours are, from their sorted distances: 1 for the nearest, all together log2 of their number."""
    rho, target = d[:, :1], np.log2(max(2, d.shape[1]))
    low, high = np.full((len(d), 1), 1e-6), np.full((len(d), 1), 1e6)
    for _ in range(64):
        mid = np.sqrt(low * high)
        total = np.exp(-np.maximum(d - rho, 0) / mid).sum(axis=1, keepdims=True)
        low, high = np.where(total < target, mid, low), np.where(total < target, high, mid)
    return np.exp(-np.maximum(d - rho, 0) / np.sqrt(low * high))


def nearest_of(q: np.ndarray, x: np.ndarray, k: int, skip_self: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distances and numbers of the k rows of x nearest to each row of q."""
    k = min(k, len(x) - skip_self)
    dist, near = np.zeros((len(q), k)), np.zeros((len(q), k), int)
    for at in range(0, len(q), 512):
        b = q[at : at + 512]
        d = (b * b).sum(1)[:, None] - 2 * b @ x.T + (x * x).sum(1)[None, :]
        if skip_self:
            d[np.arange(len(b)), np.arange(at, at + len(b))] = np.inf
        i = np.argpartition(d, k - 1, axis=1)[:, :k]
        v = np.take_along_axis(d, i, 1)
        order = v.argsort(axis=1, kind="stable")
        dist[at : at + len(b)], near[at : at + len(b)] = np.sqrt(np.maximum(np.take_along_axis(v, order, 1), 0)), np.take_along_axis(i, order, 1)
    return dist, near


def fit(x: np.ndarray, neighbours: int = NEIGHBOURS, epochs: int = EPOCHS, seed: int = 42) -> np.ndarray:
    """Places in the plane of the rows of x: those that are near one another attract, random ones repel."""
    rng = np.random.default_rng(seed)
    n = len(x)
    centred = x - x.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    y = centred @ axes[:2].T if min(centred.shape) > 1 else np.c_[centred[:, 0], np.zeros(n)]
    y = 10 * y / max(np.abs(y).max(), 1e-12) + rng.normal(scale=1e-4, size=(n, 2))
    if n < 3:
        return y
    dist, near = nearest_of(x, x, neighbours, True)
    src, dst, w = np.repeat(np.arange(n), near.shape[1]), near.ravel(), memberships(dist).ravel()
    # a + b - a b for both directions of a pair
    key = np.r_[src * n + dst, dst * n + src]
    pair, place = np.unique(key, return_inverse=True)
    own, back = np.zeros(len(pair)), np.zeros(len(pair))
    np.maximum.at(own, place[: len(w)], w)
    np.maximum.at(back, place[len(w) :], w)
    p = own + back - own * back
    src, dst = pair // n, pair % n
    for e in range(epochs):
        rate = 1.0 - e / epochs
        drawn = rng.random(len(p)) < p
        i, j = src[drawn], dst[drawn]
        d = y[i] - y[j]
        s = np.maximum((d * d).sum(axis=1, keepdims=True), 1e-9)
        move = np.clip(-2 * A * B * s ** (B - 1) / (1 + A * s**B) * d, -4, 4)
        far = rng.integers(0, n, (len(i), REPELLED))
        d = y[i][:, None, :] - y[far]
        s = (d * d).sum(axis=2, keepdims=True)
        push = np.where((far != i[:, None])[:, :, None], np.clip(2 * B / ((0.001 + s) * (1 + A * np.maximum(s, 1e-9) ** B)) * d, -4, 4), 0).sum(axis=1)
        step = np.zeros_like(y)
        np.add.at(step, i, move + push)
        np.add.at(step, j, -move)
        # a landmark of many pairs moves by their mean
        count = np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
        y += rate * step / np.maximum(1, count)[:, None]
    return y


def umap_layout(vectors: DataFrame, landmarks: int = LANDMARKS, neighbours: int = NEIGHBOURS, epochs: int = EPOCHS, seed: int = 42) -> DataFrame:
    """cell_id, x, y, layout: a plane in which cells that are near in vectors (cell_id, vec) stay near.

    It is fitted on at most so many landmarks; every cell then stands at the mean of its nearest landmarks, weighted by nearness, a
    landmark at its own place, so that the work grows with the cells only. Cells without a vector have no place.
    """
    spark, kind = vectors.sparkSession, vectors.schema["cell_id"].dataType.simpleString()
    rows = vectors.filter("cell_id IS NOT NULL AND vec IS NOT NULL").select("cell_id", F.col("vec").cast("array<double>").alias("vec"))
    some = rows.orderBy(F.xxhash64("cell_id", F.lit(seed)), "cell_id").limit(landmarks).collect()
    schema = f"cell_id {kind}, x double, y double, layout string"
    if not some:
        return spark.createDataFrame([], schema)
    x = np.array([r["vec"] for r in some], float)
    shared = spark.sparkContext.broadcast((x, fit(x, neighbours, epochs, seed)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = shared.value
        for b in batches:
            if b.num_rows:
                q = np.array(b.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(b.num_rows, -1)
                dist, near = nearest_of(q, x, 5, False)
                w = memberships(dist)
                exact = dist[:, 0] < 1e-9
                w[exact] = np.eye(1, w.shape[1])[0]
                at = (w[:, :, None] * y[near]).sum(axis=1) / w.sum(axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array(["umap"] * b.num_rows)], ["cell_id", "x", "y", "layout"])

    return rows.mapInArrow(run, schema)


def diagnostic_layout(counts: DataFrame, totals: DataFrame, max_pcs: int = 20, top: int = 2000) -> DataFrame:
    """A layout for plots only, of no more than max_pcs components of which nothing is regressed; nothing of it is kept."""
    from scquarry.kernels import components
    from scquarry.operators.matrix import log_normalize
    from scquarry.session import materialize

    cells = totals.select("cell_id")
    n = cells.count()
    genes = materialize(components.variable_genes(counts, n, top), "hvg")
    width = genes.count()
    rows = materialize(components.cell_rows(log_normalize(counts, totals), genes, cells), "cells")
    vectors, _, _ = components.principal_components(rows, width, max(2, min(max_pcs, n - 1, width - 1)))
    return umap_layout(vectors)
