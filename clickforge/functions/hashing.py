"""Deterministic hash buckets (same value in Spark and in any SQL engine with md5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bucket(key: Column | str, seed: int | str = 2019, buckets: int = 100) -> Column:
    """First 8 hex digits of ``md5('<seed>:' || key)`` modulo ``buckets``.

    A pure function of the row key, so splits and samples are reproducible under
    any partitioning and survive task retries (unlike ``rand``).
    """
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def md5_bucket_sql(key_sql: str, seed: int | str = 2019, buckets: int = 100) -> str:
    """The DuckDB spelling of :func:`md5_bucket` (used by the SQL oracles)."""
    return (f"CAST(CAST('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 8) AS BIGINT)"
            f" % {buckets} AS INTEGER)")


HASH_SPAN = 1 << 60


def md5_place(key: Column | str, seed: int | str = 2019) -> Column:
    """First 60 bits of ``md5('<seed>:' || key)``: a whole number in [0, 2^60), fine enough for any rate."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def md5_place_sql(key_sql: str, seed: int | str = 2019) -> str:
    """The DuckDB spelling of :func:`md5_place`."""
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 15) AS BIGINT)"


def share_edges(ratios) -> list[int]:
    """Upper places of the first ``len(ratios) - 1`` parts; the ratios must be positive and sum to 1."""
    if any(r <= 0 for r in ratios) or abs(sum(ratios) - 1) > 1e-9:
        raise ValueError(f"ratios must be positive and sum to 1: {ratios}")
    edges, acc = [], 0.0
    for r in ratios[:-1]:
        acc += r
        edges.append(int(acc * HASH_SPAN))
    return edges
