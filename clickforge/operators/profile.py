"""Profiling: nulls, describe, medians, category frequencies, histograms, correlation.

Every profile is one (or a few) distributed aggregations over the whole table:
a single multi-expression ``agg`` or an unpivot followed by one partial/final hash
aggregate, instead of one job per column. Results are long, small DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clickforge.functions.scalar import safe_divide
from clickforge.operators.pairs import co_null_counts, correlation_matrix  # noqa: F401  (N7 and A16 belong to the profiles)
from clickforge.operators.quantile import approx_quantiles, exact_quantiles


def _stack(pairs: list[tuple[str, Column]], key: str = "feature", value: str = "value") -> Column:
    """``stack`` of (name, column) pairs as an inline generator over a struct array."""
    return F.inline(F.array(*[F.struct(F.lit(n).alias(key), c.alias(value)) for n, c in pairs]))


def unpivot(df: DataFrame, cols: list[str], ids: list[str] | None = None, key: str = "feature",
            value: str = "value", cast: str | None = "string") -> DataFrame:
    """Wide -> long (one row per id x column). NULL values are kept.

    Planned as an ``Expand`` node (codegen, no per-row array/struct allocation).
    """
    ids = ids or []
    vals = [(F.col(c).cast(cast) if cast else F.col(c)).alias(c) for c in cols]
    return df.select(*[F.col(i) for i in ids], *vals).unpivot(ids, cols, key, value)


# ---- nulls (N3-N9) --------------------------------------------------------------------------------

def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null count, null percentage and fill rate of every column in one pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + \
           [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]
    wide = df.agg(*aggs)
    long = wide.select("__rows", _stack([(c, F.col(c)) for c in cols], "feature", "null_count"))
    return long.select(
        "feature", F.col("null_count").cast("long").alias("null_count"),
        F.col("__rows").alias("rows"),
        (F.col("null_count") * 100.0 / F.col("__rows")).alias("null_pct"),
        ((F.col("__rows") - F.col("null_count")) / F.col("__rows")).alias("fill_rate"),
    )


def high_null_columns(df: DataFrame, cols: list[str], pct: float = 40.0) -> DataFrame:
    """Columns whose null percentage is above ``pct``."""
    return null_profile(df, cols).filter(F.col("null_pct") > pct)


def label_by_null(df: DataFrame, cols: list[str], label: str = "label") -> DataFrame:
    """Label distribution among rows where a column is NULL vs among all rows."""
    aggs = [F.count(F.lit(1)).alias("__all")] + [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]
    per_label = df.groupBy(label).agg(*aggs)
    return per_label.select(F.col(label).alias("label"), F.col("__all").alias("rows_all"),
                            _stack([(c, F.col(c)) for c in cols], "feature", "rows_null")) \
                    .select("feature", "label", F.col("rows_null").cast("long").alias("rows_null"), "rows_all")


def null_label_ztest(df: DataFrame, cols: list[str], label: str = "label", critical: float = 2.81) -> DataFrame:
    """Two-proportion z test "is null-ness related to the label" for every column.

    p1 = positive rate of all rows (n), p2 = positive rate of rows where the column
    is NULL (m); z = (p1 - p2) / sqrt(p1(1-p1)/n + p2(1-p2)/m).
    """
    y = F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("__n"), F.sum(y).alias("__pos")]
    for c in cols:
        aggs += [F.sum(F.col(c).isNull().cast("long")).alias(f"m_{c}"),
                 F.sum(F.when(F.col(c).isNull(), y)).alias(f"p_{c}")]
    wide = df.agg(*aggs)
    long = wide.select("__n", "__pos", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("m"), F.col(f"p_{c}").alias("pos_null"))
        for c in cols])))
    p1 = F.col("__pos") / F.col("__n")
    p2 = safe_divide("pos_null", "m")
    se = F.sqrt(p1 * (1 - p1) / F.col("__n") + p2 * (1 - p2) / F.col("m"))
    z = F.try_divide(p1 - p2, se)
    return long.select("feature", F.col("__n").alias("n"), F.col("m").cast("long").alias("m"),
                       p1.alias("p1"), p2.alias("p2"), z.alias("z"), (F.abs(z) > critical).alias("reject"))


def complete_row_ratio(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows, rows without any NULL (``dropna``), and their ratio."""
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(complete.cast("long")).alias("complete_rows")) \
             .withColumn("complete_ratio", F.col("complete_rows") / F.col("rows"))


# ---- numeric descriptions (A2-A6) -----------------------------------------------------------------

_DESCRIBE = ("count", "mean", "stddev", "min", "max")


def _describe_aggs(c: str) -> list[Column]:
    x = F.col(c).cast("double")
    return [F.count(x).alias(f"count|{c}"), F.avg(x).alias(f"mean|{c}"), F.stddev_samp(x).alias(f"stddev|{c}"),
            F.min(x).alias(f"min|{c}"), F.max(x).alias(f"max|{c}")]


def _long_describe(wide: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    structs = [F.struct(F.lit(c).alias("feature"), *[F.col(f"`{m}|{c}`").alias(m) for m in _DESCRIBE]) for c in cols]
    return wide.select(*keep, F.inline(F.array(*structs)))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample stddev, min, max of many columns in one aggregation (A2)."""
    wide = df.agg(*[a for c in cols for a in _describe_aggs(c)])
    return _long_describe(wide, cols, [])


def describe_by(df: DataFrame, cols: list[str], by: str = "label") -> DataFrame:
    """:func:`describe` per class (A3): one grouped aggregation, not one job per class."""
    wide = df.groupBy(by).agg(*[a for c in cols for a in _describe_aggs(c)])
    return _long_describe(wide, cols, [by])


def numeric_measurements(df: DataFrame, cols: list[str], exact: bool = True,
                         relative_error: float = 0.005) -> DataFrame:
    """Describe + median per feature, the train statistics table (A4, A5).

    ``exact`` uses the bounded-memory refinement in :mod:`quantile`; otherwise the
    sketch-based ``approxQuantile`` the reference used.
    """
    rows = describe(df, cols).collect()          # one pass; one row per feature
    known = {r["feature"]: (r["count"], r["min"], r["max"]) for r in rows}
    medians = exact_quantiles(df, cols, known=known) if exact else approx_quantiles(df, cols, 0.5, relative_error)
    schema = "feature string, count long, mean double, stddev double, min double, max double, median double"
    return df.sparkSession.createDataFrame(
        [(r["feature"], r["count"], r["mean"], r["stddev"], r["min"], r["max"], medians[r["feature"]]) for r in rows],
        schema)


def median_skewness(measurements: DataFrame) -> DataFrame:
    """Pearson's second skewness coefficient 3 (mean - median) / stddev."""
    return measurements.withColumn("skewness", F.try_divide(3 * (F.col("mean") - F.col("median")), F.col("stddev")))


# ---- categories (A7-A12, A17, A18) ----------------------------------------------------------------

def category_frequencies(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, counts) for every categorical column: one unpivot + one aggregate.

    Partial aggregation runs before the shuffle, so a value holding a third of the
    rows (e.g. the NULL sentinel) ships one row per task, not a third of the data.
    """
    return unpivot(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("counts"))


def category_shares(freq: DataFrame) -> DataFrame:
    """Share of the feature's rows per value, in percent (A8). Window is per feature over counts."""
    tot = freq.groupBy("feature").agg(F.sum("counts").alias("__tot"))
    return freq.join(F.broadcast(tot), "feature").withColumn("share_pct", F.col("counts") * 100.0 / F.col("__tot")) \
               .drop("__tot")


def top_k_values(freq: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` values per feature by count desc, value asc (NULL first).

    ``row_number() <= k`` is planned as a per-partition group limit before the
    shuffle, so each task ships at most k rows per feature.
    """
    w = Window.partitionBy("feature").orderBy(F.col("counts").desc(), F.col("value").asc_nulls_first())
    return freq.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def distinct_counts(freq: DataFrame) -> DataFrame:
    """Exact distinct non-NULL values per feature, read from the frequency table (A10)."""
    return freq.groupBy("feature").agg(F.count("value").alias("distinct_values"))


def threshold_cardinality(freq: DataFrame, minimum: int) -> DataFrame:
    """Frequent (> min), frequent-inclusive (>= min) and uncommon counts, width after masking."""
    g = freq.groupBy("feature").agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.sum((F.col("counts") > minimum).cast("long")).alias("frequent"),
        F.sum((F.col("counts") >= minimum).cast("long")).alias("frequent_inclusive"),
        F.sum((F.col("counts") <= minimum).cast("long")).alias("uncommon"),
        F.sum(F.when(F.col("counts") <= minimum, F.col("counts")).otherwise(0)).alias("uncommon_rows"))
    g = g.withColumn("width_after_mask", F.col("frequent") + (F.col("uncommon") > 0).cast("long"))
    # running total of the encoded width in feature order (one row per feature: bounded window)
    w = Window.orderBy("feature").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return g.withColumn("running_width", F.sum("width_after_mask").over(w))


def label_distribution(df: DataFrame, label: str = "label", by: list[str] | None = None) -> DataFrame:
    """Rows and percentage per class, optionally per group."""
    by = by or []
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return counts.withColumn("pct", F.col("rows") * 100.0 / F.sum("rows").over(w))


def balance_rate(df: DataFrame, label: str = "label") -> DataFrame:
    """positive / total on one row (A19, A20 is the same mean)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("positives"),
                  F.avg(F.col(label).cast("double")).alias("balance_rate"))


def ctr_by_category(df: DataFrame, cols: list[str], label: str = "label") -> DataFrame:
    """Impressions, clicks, click-through rate and positive/negative ratio per category value."""
    long = unpivot(df, cols, ids=[label])
    y = F.col(label).cast("long")
    g = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("impressions"), F.sum(y).alias("clicks"))
    return g.select("feature", "value", "impressions", "clicks",
                    (F.col("clicks") / F.col("impressions")).alias("ctr"),
                    safe_divide(F.col("clicks"), F.col("impressions") - F.col("clicks")).alias("pos_neg_ratio"))


# ---- histograms, frequencies, special values, correlation (A13-A16) ------------------------------

def equal_width_histogram(df: DataFrame, cols: list[str], bins: int | dict[str, int] = 10) -> DataFrame:
    """Equal-width bins over [min, max] per column, as many as ``bins`` says for it; last bin closed; NULLs ignored.

    Bin = least(floor((x - min) / (max - min) * n), n - 1); empty bins are listed
    with count 0. A constant column gets one bin holding every row.
    """
    number = {c: bins if isinstance(bins, int) else bins[c] for c in cols}
    x = {c: F.col(c).cast("double") for c in cols}
    rng = df.agg(*[e for c in cols for e in (F.min(x[c]).alias(f"lo_{c}"), F.max(x[c]).alias(f"hi_{c}"))])
    bounds = rng.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(number[c]).alias("bins"),
                                                      F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in cols])))
    long = unpivot(df, cols, cast="double").filter(F.col("value").isNotNull())
    # bounds has one row per column: a bounded broadcast
    n = F.col("bins")
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * n), n - 1))
    counts = long.join(F.broadcast(bounds), "feature").groupBy("feature", b.cast("int").alias("bin")) \
                 .agg(F.count(F.lit(1)).alias("count"))
    grid = bounds.filter(F.col("lo").isNotNull()).select(
        "feature", "bins", "lo", "hi", F.explode(F.sequence(F.lit(0), n - 1)).alias("bin"))
    step = (F.col("hi") - F.col("lo")) / n
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin", (F.col("lo") + step * F.col("bin")).alias("lower"),
        F.when(F.col("bin") == n - 1, F.col("hi")).otherwise(F.col("lo") + step * (F.col("bin") + 1)).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def numeric_frequencies(df: DataFrame, cols: list[str], measurements: DataFrame) -> DataFrame:
    """Frequency table of numeric values plus the standardised axis (x - median) / stddev."""
    long = unpivot(df, cols, cast="double").filter(F.col("value").isNotNull())
    g = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    m = measurements.select("feature", "median", "stddev")
    return g.join(F.broadcast(m), "feature").select(
        "feature", "value", "count", F.try_divide(F.col("value") - F.col("median"), F.col("stddev")).alias("normed"))


def special_value_counts(df: DataFrame, cols: list[str], specials=(-1.0, 0.0)) -> DataFrame:
    """Rows equal to each special value, and rows below zero, per column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count_if(x == v).alias(f"{c}|eq|{v}") for v in specials]
        aggs.append(F.count_if(x < 0).alias(f"{c}|lt|0.0"))
    wide = df.agg(*aggs)
    keys = [a for c in cols for a in [f"{c}|eq|{v}" for v in specials] + [f"{c}|lt|0.0"]]
    long = wide.select(_stack([(k, F.col(f"`{k}`")) for k in keys], "key", "rows"))
    parts = F.split("key", r"\|")
    return long.select(parts[0].alias("feature"), parts[1].alias("op"), parts[2].cast("double").alias("special"),
                       F.col("rows").cast("long").alias("rows"))
