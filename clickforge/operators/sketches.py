"""Stored, mergeable sketches of distinct counts and quantiles.

One scan gives a table of a few kilobytes per (subset, feature). Answers about any union of subsets come from that
table alone, so a new subset costs one scan of its own rows. Distinct counts are HyperLogLog sketches (standard error
0.8 % at ``HLL_BITS`` 14), quantiles are KLL sketches (rank error 0.25 % at 99 % confidence with ``KLL_SIZE`` 2000;
``RANK_ERROR`` is a bound that practically always holds). Sketches of a task are small and merge before the shuffle, whatever the number of rows of a subset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HLL_BITS = 14
KLL_SIZE = 2000
RANK_ERROR = 0.0065


def fit_sketches(df: DataFrame, numeric: list[str], categorical: list[str], by: str) -> DataFrame:
    """(``by``, feature, kind, n, sketch): ``distinct`` sketches of all features, ``quantile`` sketches of the numeric ones.

    NULLs are left out of both (n counts the others), NaNs of the quantiles; -0.0 and 0.0 count as one value.
    """
    value = {c: F.col(c).cast("double") + F.lit(0.0) for c in numeric}
    finite = {c: F.nanvl(value[c], F.lit(None).cast("double")) for c in numeric}
    text = {c: value[c].cast("string") for c in numeric} | {c: F.col(c).cast("string") for c in categorical}
    aggs = [F.hll_sketch_agg(x, HLL_BITS).alias(f"d_{c}") for c, x in text.items()] + [F.count(x).alias(f"c_{c}") for c, x in text.items()]
    aggs += [F.kll_sketch_agg_double(x, KLL_SIZE).alias(f"q_{c}") for c, x in finite.items()] + [F.count(x).alias(f"f_{c}") for c, x in finite.items()]
    row = lambda c, kind, n, sketch: F.struct(F.lit(c).alias("feature"), F.lit(kind).alias("kind"), F.col(n).alias("n"), F.col(sketch).alias("sketch"))
    rows = [row(c, "distinct", f"c_{c}", f"d_{c}") for c in text] + [row(c, "quantile", f"f_{c}", f"q_{c}") for c in numeric]
    return df.groupBy(by).agg(*aggs).select(by, F.inline(F.array(*rows)))


def distinct_estimates(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., feature, distinct_estimate) over the union of the sketches of each group."""
    found = sketches.where("kind = 'distinct'").groupBy(*(by or []), "feature").agg(F.hll_union_agg("sketch").alias("s"))
    return found.select(*(by or []), "feature", F.hll_sketch_estimate("s").alias("distinct_estimate"))


def quantile_estimates(sketches: DataFrame, shares: list[float], by: list[str] | None = None) -> DataFrame:
    """(by..., feature, share, quantile) over the merged sketches of each group; features without values have no rows."""
    found = sketches.where("kind = 'quantile' and n > 0").groupBy(*(by or []), "feature").agg(F.kll_merge_agg_double("sketch").alias("s"))
    at = F.array(*[F.struct(F.lit(float(p)).alias("share"), F.kll_sketch_get_quantile_double("s", F.lit(float(p))).alias("quantile")) for p in shares])
    return found.select(*(by or []), "feature", F.inline(at))
