"""Statistics of all column pairs in one scan.

Every task adds up small matrix products of its Arrow batches (a triangle of pairs at once, with null masks) and the
tasks' matrices are merged in a tree: one scan for any number of columns, and a partial result of a few times
columns x columns numbers.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.operators.combine import tree_combine

_PARTIAL = "task int, packed binary"


def _packed(x: np.ndarray) -> pa.RecordBatch:
    context = TaskContext.get()
    return pa.RecordBatch.from_arrays([pa.array([context.partitionId() if context else 0], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["task", "packed"])


def _in_one_scan(df: DataFrame, shape: tuple[int, ...], measure, merge, finish, result: str) -> DataFrame:
    """``measure(batch) -> array`` of every batch, merged by ``merge(a, b)`` within and across tasks, given to ``finish(array) -> batch``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if len(batch):
                total = merge(total, measure(batch))
        yield _packed(total)

    def merged(table: pa.Table) -> pa.Table:
        total = np.zeros(shape)
        for x in table["packed"]:
            total = merge(total, np.frombuffer(x.as_py()).reshape(shape))
        return pa.Table.from_batches([_packed(total)])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("packed"):
                yield finish(np.frombuffer(x.as_py()).reshape(shape))

    return tree_combine(df.mapInArrow(task, _PARTIAL), merged).mapInArrow(finished, result)


def co_null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """For each column pair (a < b): rows where both are NULL, and rows where a is NULL."""
    pairs, d = list(itertools.combinations(range(len(cols)), 2)), len(cols)

    def measure(batch: pa.RecordBatch) -> np.ndarray:
        null = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(np.float64)
        return null.T @ null

    def finish(total: np.ndarray) -> pa.RecordBatch:
        count = total.astype(np.int64)
        return pa.RecordBatch.from_pydict({"col_a": [cols[a] for a, _ in pairs], "col_b": [cols[b] for _, b in pairs],
                                           "both_null": [int(count[a, b]) for a, b in pairs], "a_null": [int(count[a, a]) for a, _ in pairs]})

    masks = df.select(*[F.col(c).isNull().alias(f"m{k}") for k, c in enumerate(cols)])
    return _in_one_scan(masks, (d, d), measure, np.add, finish, "col_a string, col_b string, both_null long, a_null long")


#: Of a pair (a, b): rows where both are finite, mean and sum of squares of a among them, co-moment, rows with a NaN or infinity.
N, MEAN, SQUARES, JOINT, ODD = range(5)


def _moments(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The moments of all pairs over rows ``x`` (n, d); ``known`` marks what is not NULL."""
    fine = known & np.isfinite(x)
    # any value of the column does as origin; the first keeps a constant column's squares at exactly 0
    origin = np.where(fine.any(axis=0), x[fine.argmax(axis=0), np.arange(x.shape[1])], 0.0)
    x = np.where(fine, x - origin, 0.0)
    ok, out = fine.astype(np.float64), np.empty((5, x.shape[1], x.shape[1]))
    out[N] = ok.T @ ok
    total, n = x.T @ ok, np.maximum(out[N], 1)
    out[MEAN] = np.where(out[N] > 0, total / n + origin[:, None], 0.0)
    out[SQUARES] = np.maximum(0.0, (x * x).T @ ok - total * total / n)
    out[JOINT] = x.T @ x - total * total.T / n
    out[ODD] = known.astype(np.float64).T @ known.astype(np.float64) - out[N]
    return out


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together."""
    n = a[N] + b[N]
    apart, share = np.where((a[N] > 0) & (b[N] > 0), b[MEAN] - a[MEAN], 0.0), a[N] * b[N] / np.maximum(n, 1)
    mean = np.where(a[N] > 0, a[MEAN] + apart * b[N] / np.maximum(n, 1), b[MEAN])
    return np.stack([n, mean, a[SQUARES] + b[SQUARES] + apart * apart * share, a[JOINT] + b[JOINT] + apart * apart.T * share, a[ODD] + b[ODD]])


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair (a < b), no sampling.

    Pairwise complete: rows where both are not NULL. NULL for a pair without such rows or with a constant side, NaN
    where such a row holds a NaN or an infinity.
    """
    pairs, d = list(itertools.combinations(range(len(cols)), 2)), len(cols)

    def measure(batch: pa.RecordBatch) -> np.ndarray:
        x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns], axis=1)
        return _moments(x, np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1))

    def corr(m: np.ndarray, a: int, b: int) -> float | None:
        if m[ODD, a, b]:
            return float("nan")
        spread = np.sqrt(m[SQUARES, a, b]) * np.sqrt(m[SQUARES, b, a])
        return float(np.clip(m[JOINT, a, b] / spread, -1, 1)) if spread > 0 else None

    def finish(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([cols[a] for a, _ in pairs], pa.string()), pa.array([cols[b] for _, b in pairs], pa.string()),
                                           pa.array([corr(total, a, b) for a, b in pairs], pa.float64(), from_pandas=False)], names=["col_a", "col_b", "corr"])

    doubles = df.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(cols)])
    return _in_one_scan(doubles, (5, d, d), measure, _merged, finish, "col_a string, col_b string, corr double")
