"""Sums over partitions for kernels whose state is a bounded table of numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def partial_sums(df: DataFrame, each: Callable, rows: int = 512) -> dict[int, np.ndarray]:
    """Vectors by key added up over all rows: each(batch) gives (keys, vectors) for a slice of at most so many rows.

    A task adds up its own slices first; tasks' sums are then added by key in parallel. The caller bounds keys and lengths.
    """

    def make(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["key", "vector"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for big in batches:
            for at in range(0, big.num_rows, rows):
                for k, v in zip(*each(big.slice(at, rows))):
                    v = np.asarray(v, float)
                    total[k] = total[k] + v if (k := int(k)) in total else v
        yield make(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.frombuffer(v.as_buffer(), np.float64)
                total[k] = total[k] + x if k in total else x
        yield make(total)

    schema = "key int, vector binary"
    # a task sends all its vectors: few large tasks send less than many small ones
    few = df.coalesce(max(1, 2 * df.sparkSession.sparkContext.defaultParallelism))
    parts = few.mapInArrow(run, schema).repartition("key").mapInArrow(add, schema)
    return {r["key"]: np.frombuffer(r["vector"], np.float64) for r in parts.toLocalIterator()}


def matrix_of(column: pa.Array, rows: int) -> np.ndarray:
    """The vectors of a list column as a matrix."""
    return np.array(column.flatten().to_numpy(zero_copy_only=False), float).reshape(rows, -1)


def table_of(sums: dict[int, np.ndarray], rows: int, width: int) -> np.ndarray:
    out = np.zeros((rows, width))
    for k, v in sums.items():
        out[k] = v
    return out
