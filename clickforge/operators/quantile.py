"""Exact quantiles without gathering a column in one task.

``percentile`` keeps every distinct value of a column in one aggregation buffer
and merges them in a single final task: unbounded at scale. Here a rank is closed
in digit by digit, in scans shared by all columns: a double's 64 bits, rearranged to
sort like the value, are read as digits of ``DIGIT`` bits. A scan counts the next
digit of the values that begin with the digits known so far (numpy in every task, at
most 2^DIGIT counts a rank leave it), and the counts tell the rank's next digit.

Ranks with at most ``exact_below`` values left are settled by counting these by value in
one last scan, so three or four scans do for any practical number of rows and six at
most, whatever the distribution, ties or range. Infinities are ordinary values; NaN
counts as missing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a digit.
DIGIT = 14
_SIGN = np.uint64(1 << 63)


def _value(key: int) -> float:
    key = np.uint64(key)
    return float((key ^ _SIGN if key & _SIGN else ~key).view(np.float64))


def _counts(df: DataFrame, cols: list[str], spans: list[tuple[str, int, int, int]]) -> dict[int, list[tuple[int, int]]]:
    """For every span (column, known bits, their value, bits to read): the ascending (next digit, values), in one scan."""
    used = [c for c in cols if any(c == s[0] for s in spans)]

    def keys_of(x: np.ndarray) -> np.ndarray:
        """Doubles as whole numbers of the same order (-0.0 as 0.0)."""
        bits = (x + 0.0).view(np.uint64)
        return np.where(bits & _SIGN, ~bits, bits | _SIGN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        narrow = {i: np.zeros(1 << s[3], np.int64) for i, s in enumerate(spans) if s[3] <= DIGIT}
        wide: dict[tuple[int, int], int] = {}
        for batch in batches:
            for k, c in enumerate(used):
                x = batch.column(k).drop_null().to_numpy(zero_copy_only=False)
                keys = keys_of(x[~np.isnan(x)])
                for i, (col, known, prefix, bits) in enumerate(spans):
                    if col != c:
                        continue
                    mine = keys[keys >> np.uint64(64 - known) == np.uint64(prefix)] if known else keys
                    digits = mine >> np.uint64(64 - known - bits) & np.uint64((1 << bits) - 1)
                    if i in narrow:
                        narrow[i] += np.bincount(digits.astype(np.int64), minlength=1 << bits)
                    else:
                        for d, n in zip(*(a.tolist() for a in np.unique(digits, return_counts=True))):
                            wide[i, d] = wide.get((i, d), 0) + n
        for i, seen in narrow.items():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i), pa.int32()), pa.array(at.astype(np.int64)), pa.array(seen[at])], names=["i", "digit", "n"])
        if wide:
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in wide], pa.int32()), pa.array([d for _, d in wide], pa.int64()),
                                              pa.array(list(wide.values()), pa.int64())], names=["i", "digit", "n"])

    found: dict[int, list[tuple[int, int]]] = {i: [] for i in range(len(spans))}
    rows = df.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(used)]).mapInArrow(run, "i int, digit long, n long")
    for r in rows.groupBy("i", "digit").agg(F.sum("n").alias("n")).collect():
        found[r["i"]].append((r["digit"], r["n"]))
    return {i: sorted(f) for i, f in found.items()}


def exact_quantiles(df: DataFrame, cols: list[str], p: float = 0.5, exact_below: int = 2048,
                    known: dict[str, tuple] | None = None, lower: bool = False) -> dict[str, float | None]:
    """Linear-interpolated quantile ``p`` of every column (same definition as ``percentile``); with ``lower`` the value
    below instead, rank ``ceil(p * n)`` (same definition as ``percentile_disc``).

    Returns ``{col: value}`` (``None`` for a column without values); the driver only holds
    digit counts and the last few values, never a column. ``known`` =
    {col: (count, ...)} from an earlier pass gives the counts (of columns without NaN).
    """
    cols = list(dict.fromkeys(cols))
    first = _counts(df, cols, [(c, 0, 0, DIGIT) for c in cols]) if cols else {}
    count = {c: known[c][0] if known is not None else sum(n for _, n in first[i]) for i, c in enumerate(cols)}
    plan = {c: (max(math.ceil(n * p) - 1, 0) if lower else (n - 1) * p, n) for c, n in count.items() if n}
    # per (column, rank): how many leading bits of its value are known, these bits, values that begin so, values below them
    state = {(c, k): (0, 0, n, 0) for c, (pos, n) in plan.items() for k in {math.floor(pos), math.ceil(pos)}}

    def narrowed(rank: int, s: tuple[int, int, int, int], bits: int, digits: list[tuple[int, int]]) -> tuple[int, int, int, int]:
        at = s[3]
        for digit, n in digits:
            if rank < at + n:
                return s[0] + bits, s[1] << bits | digit, n, at
            at += n
        raise RuntimeError("a rank was lost between scans; is the input deterministic?")

    state = {t: narrowed(t[1], s, DIGIT, first[cols.index(t[0])]) for t, s in state.items()}
    while open_ := {t: s for t, s in state.items() if s[0] < 64}:
        few = all(s[2] <= exact_below for s in open_.values())
        step = {t: 64 - s[0] if few else min(DIGIT, 64 - s[0]) for t, s in open_.items() if few or s[2] > exact_below}
        spans = sorted({(t[0], *open_[t][:2], bits) for t, bits in step.items()})
        counts = _counts(df, cols, spans)
        for t, bits in step.items():
            state[t] = narrowed(t[1], state[t], bits, counts[spans.index((t[0], *open_[t][:2], bits))])
    result: dict[str, float | None] = {c: None for c in cols}
    for c, (pos, _) in plan.items():
        low, high = _value(state[c, math.floor(pos)][1]), _value(state[c, math.ceil(pos)][1])
        result[c] = low if low == high else low + (pos - math.floor(pos)) * (high - low)
    return result


def approx_quantiles(df: DataFrame, cols: list[str], p: float = 0.5,
                     relative_error: float = 0.005) -> dict[str, float | None]:
    """The reference's approximate median (Greenwald-Khanna sketch, bounded memory)."""
    vals = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).approxQuantile(cols, [p], relative_error)
    return {c: (v[0] if v else None) for c, v in zip(cols, vals)}
