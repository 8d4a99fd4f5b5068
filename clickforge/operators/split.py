"""Splits, samples and class rebalancing.

Defaults are hash-based: a row's fate is a pure function of its key, so results
are reproducible across partitionings and task retries. The reference's random
forms (``randomSplit``, ``sample``) are kept for parity.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.functions.hashing import HASH_SPAN, md5_place, share_edges


def hash_split(df: DataFrame, key: str, seed: int = 2019, ratios=(0.8, 0.1, 0.1),
               names=("train", "tests", "valid"), col: str = "subset") -> DataFrame:
    """Adds ``subset`` from the 60-bit md5 place of the key (P1, P8). No shuffle; any ratios that sum to 1."""
    place = md5_place(key, seed)
    part = F.lit(names[len(ratios) - 1])
    for edge, name in reversed(list(zip(share_edges(ratios), names))):
        part = F.when(place < F.lit(edge), F.lit(name)).otherwise(part)
    return df.withColumn(col, part)


def split_counts(df: DataFrame, label: str = "label", col: str = "subset") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("positives"))


def hash_sample_threshold(rate: float) -> int:
    """Rate -> place below which a row is kept (60 bits, so no rate rounds to nothing)."""
    return math.floor(rate * HASH_SPAN)


def hash_ordered_sample(df: DataFrame, key: str, n: int, seed: int = 2019) -> DataFrame:
    """Fixed-size reproducible subsample: the ``n`` rows with the smallest md5 of the key.

    A distributed top-k (each task keeps n rows), not a global sort.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("__h", h).orderBy("__h", key).limit(n).drop("__h")


def class_counts(df: DataFrame, label: str = "label") -> tuple[int, int]:
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("p")).first()
    return int(r["p"] or 0), int(r["n"] - (r["p"] or 0))


def oversample_exact(df: DataFrame, key: str, label: str = "label", seed: int = 7,
                     rate: float | None = None) -> DataFrame:
    """Deterministic oversampling of positives (P4): rate = (neg - pos) / pos extra copies per positive.

    Each positive gets floor(rate) copies plus one more when its hash place falls
    under the fractional part. Returns the original rows (``copy`` 0) and the copies
    (``copy`` >= 1): one scan, ``explode(sequence)`` per row, no shuffle.
    """
    if rate is None:
        pos, neg = class_counts(df, label)
        rate = (neg - pos) / pos if pos else 0.0
    whole = math.floor(rate)
    extra = hash_sample_threshold(rate - whole)
    copies = F.when(F.col(label) == 1, F.lit(whole) + (md5_place(key, seed) < F.lit(extra)).cast("int")).otherwise(F.lit(0))
    return df.select("*", F.explode(F.sequence(F.lit(0), copies)).alias("copy"))


def undersample_hash(df: DataFrame, key: str, label: str = "label", seed: int = 11,
                     rate: float | None = None) -> DataFrame:
    """Keep every positive and a hash-chosen ``rate = pos / neg`` share of negatives (P5)."""
    if rate is None:
        pos, neg = class_counts(df, label)
        rate = pos / neg if neg else 1.0
    keep = (F.col(label) == 1) | (md5_place(key, seed) < F.lit(hash_sample_threshold(rate)))
    return df.filter(keep)


# ---- random forms kept for parity with the reference -------------------------------------------

def random_split(df: DataFrame, ratios=(0.8, 0.1, 0.1), seed: int = 2019) -> list[DataFrame]:
    """``randomSplit`` (P1): depends on partitioning; use :func:`hash_split` for reproducibility."""
    return df.randomSplit(list(ratios), seed=seed)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 2019) -> DataFrame:
    """Seeded Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def reshuffle(df: DataFrame, seed: int = 2019) -> DataFrame:
    """Rows in a seeded random order, over as many partitions as a shuffle has."""
    return df.withColumn("__order", F.rand(seed)).repartitionByRange("__order").sortWithinPartitions("__order").drop("__order")


def oversample_random(df: DataFrame, label: str = "label", seed: int = 2019) -> DataFrame:
    """Random oversampling of positives to balance, in random order.

    One scan draws each positive's number of further copies (mean (neg - pos) / pos), then one range shuffle.
    """
    pos, neg = class_counts(df, label)
    rate = max(0.0, (neg - pos) / pos) if pos else 0.0
    drawn = F.when(F.col(label) == 1, F.floor(F.rand(seed) + F.lit(rate)).cast("int")).otherwise(F.lit(0))
    grown = df.withColumn("__n", drawn).select(*df.columns, F.explode(F.sequence(F.lit(0), F.col("__n"))).alias("__copy"))
    return reshuffle(grown.drop("__copy"), seed + 1)


def null_free_sample(df: DataFrame, fraction: float, seed: int = 2019) -> DataFrame:
    """Tiny sample then ``dropna``, kept distributed."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed).dropna()
