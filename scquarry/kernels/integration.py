"""Integration of batches: soft clusters with a penalty on uneven batches, and a regression on batches within clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scquarry.kernels.sums import matrix_of, partial_sums, table_of
from scquarry.session import materialize

ROUNDS, INNER, SIGMA, THETA, RIDGE = 6, 4, 0.1, 2.0, 1.0
#: Labels of the batch field at most; vectors that seed the clusters at most (by a hash of the id).
BATCHES, SEEDS = 2000, 5000


def integrate(vectors: DataFrame, batches: DataFrame, batch: str, clusters: int | None = None, seed: int = 42, rounds: int = ROUNDS) -> DataFrame:
    """cell_id, vec: embeddings (cell_id, vec) in which the cells of a cluster no longer differ by batch.

    Every round assigns cells softly to clusters by cosine, the more to a cluster the fewer cells of their batch it has against
    what is expected, and then takes out of the original vectors what a ridge regression on the batch explains in each cluster.
    Only sums by cluster and batch leave the tasks. Cells without a batch label stay out and are given as they came; one batch
    gives the vectors back.
    """
    spark = vectors.sparkSession
    base = vectors.select("cell_id", F.col("vec").cast("array<double>").alias("vec")).join(batches.select("cell_id", F.col(batch).cast("string").alias("_b")), "cell_id", "left")
    names = [r["_b"] for r in base.filter("_b IS NOT NULL").select("_b").distinct().limit(BATCHES + 1).collect()]
    if len(names) > BATCHES:
        raise ValueError("too many batches")
    if len(names) < 2:
        return vectors.select("cell_id", F.col("vec").cast("array<double>").alias("vec"))
    names = {b: i for i, b in enumerate(sorted(names))}
    nb = len(names)
    table = materialize(base.select("cell_id", "vec", "_b"), "vectors")
    used = table.filter("_b IS NOT NULL")
    first = np.array([r["vec"] for r in used.orderBy(F.xxhash64("cell_id", F.lit(seed)), "cell_id").limit(SEEDS).collect()])
    n, dim = used.count(), first.shape[1]
    k = clusters or max(2, min(100, round(n / 30)))
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    c = unit(first[np.random.default_rng(seed).choice(len(first), min(k, len(first)), replace=False)])
    k = len(c)
    for _ in range(10):
        near = (unit(first) @ c.T).argmax(1)
        c = unit(np.array([unit(first)[near == j].mean(0) if (near == j).any() else c[j] for j in range(k)]))
    beta = np.zeros((k, nb, dim))
    observed, expected = np.ones((k, nb)), np.ones((k, nb))

    def parts(b: pa.RecordBatch, state) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Original vectors, corrected unit vectors, batch numbers and soft assignments of a slice."""
        c, beta, observed, expected = state
        x = matrix_of(b.column(1), b.num_rows)
        g = np.array([names[v] for v in b.column(2).to_pylist()])
        penalty = ((expected + 1) / (observed + 1)) ** THETA

        def soft(u):
            w = np.exp(-2 * (1 - u @ c.T) / SIGMA) * penalty[:, g].T + 1e-300
            return w / w.sum(axis=1, keepdims=True)

        r = soft(unit(x))
        r = soft(unit(x - np.einsum("ik,ikd->id", r, beta[:, g].transpose(1, 0, 2))))
        return x, unit(x - np.einsum("ik,ikd->id", r, beta[:, g].transpose(1, 0, 2))), g, r

    state = (c, beta, observed, expected)
    for _ in range(rounds):
        for _ in range(INNER // 2):
            shared = spark.sparkContext.broadcast(state)

            def moved(b, shared=shared):
                _, u, g, r = parts(b, shared.value)
                o = np.zeros((k, nb))
                np.add.at(o.T, g, r)
                return [*range(k)], [*np.hstack([r.T @ u, o])]

            s = table_of(partial_sums(used, moved), k, dim + nb)
            o = s[:, dim:]
            state = (unit(s[:, :dim]), state[1], o, o.sum(axis=1, keepdims=True) * o.sum(axis=0, keepdims=True) / max(o.sum(), 1e-12))
        shared = spark.sparkContext.broadcast(state)

        def weighted(b, shared=shared):
            x, _, g, r = parts(b, shared.value)
            s = np.zeros((k, nb, dim))
            o = np.zeros((k, nb))
            for j in np.unique(g):
                s[:, j] = r[g == j].T @ x[g == j]
                o[:, j] = r[g == j].sum(axis=0)
            return [*range(k)], [np.r_[s[j].ravel(), o[j]] for j in range(k)]

        s = table_of(partial_sums(used, weighted, 256), k, nb * dim + nb)
        beta = np.zeros((k, nb, dim))
        for j in range(k):
            o, y = s[j, nb * dim :], s[j, : nb * dim].reshape(nb, dim)
            a = np.zeros((nb + 1, nb + 1))
            a[0, 0], a[0, 1:], a[1:, 0] = o.sum(), o, o
            a[1:, 1:] = np.diag(o + RIDGE)
            beta[j] = (np.linalg.pinv(a) @ np.vstack([y.sum(axis=0), y]))[1:]
        state = (state[0], beta, state[2], state[3])
    shared = spark.sparkContext.broadcast(state)

    def correct(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in rows:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                x, _, g, r = parts(b, shared.value)
                out = x - np.einsum("ik,ikd->id", r, shared.value[1][:, g].transpose(1, 0, 2))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out.tolist(), pa.list_(pa.float64()))], ["cell_id", "vec"])

    kind = vectors.schema["cell_id"].dataType.simpleString()
    return used.mapInArrow(correct, f"cell_id {kind}, vec array<double>").union(table.filter("_b IS NULL").select("cell_id", "vec"))
