"""Numeric features: train statistics, median imputation, rule-based standardisation, scaling.

Fit steps return a small statistics DataFrame (one row per feature); apply steps
are map-only: the statistics travel as literals (constant folding, whole-stage
codegen), never as a join of the big table.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.functions.scalar import SENTINEL_NULL
from clickforge.operators.profile import numeric_measurements
from clickforge.operators.quantile import exact_quantiles

# The standardisation rules (name -> formula).
#   scale2sd: x / (2 * sd)     scale1sd: x / sd
#   median_z: (x - median) / sd     max: x / max
RULES = ("scale2sd", "scale1sd", "median_z", "max")


def fit_numeric_stats(train: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """The train statistics table (feature, count, mean, stddev, min, max, median)."""
    return numeric_measurements(train, cols, exact=exact)


def stats_dict(stats: DataFrame) -> dict[str, dict[str, float]]:
    """Collect the (one row per feature) statistics table; bounded by the feature count."""
    return {r["feature"]: r.asDict() for r in stats.collect()}


def impute_numeric(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Fill numeric NULLs (and NaN) with the train medians (N1). All-NULL columns stay NULL."""
    fill = {c: float(v) for c, v in medians.items() if v is not None}
    return df.fillna(fill) if fill else df


def rule_expr(c: str, rule: str, s: dict[str, float]) -> Column:
    """One standardisation rule as a column expression; zero divisors give 0.0, not an error."""
    x = F.col(c).cast("double")
    if rule == "scale2sd":
        num, den = x, F.lit(2.0 * s["stddev"] if s["stddev"] is not None else None)
    elif rule == "scale1sd":
        num, den = x, F.lit(s["stddev"])
    elif rule == "median_z":
        num, den = x - F.lit(s["median"]), F.lit(s["stddev"])
    elif rule == "max":
        num, den = x, F.lit(s["max"])
    else:
        raise ValueError(f"unknown rule {rule!r}; expected one of {RULES}")
    den = den.cast("double")
    return F.when(den == 0, F.when(num.isNotNull(), F.lit(0.0))).otherwise(F.try_divide(num, den))


def standardize_columns(df: DataFrame, stats: dict[str, dict], rules: dict[str, str],
                        suffix: str = "_std") -> DataFrame:
    """Median-impute then add ``<col><suffix>`` per rule (N1 + F5 + E1's scalar part)."""
    filled = impute_numeric(df, {c: stats[c]["median"] for c in rules})
    return filled.withColumns({f"{c}{suffix}": rule_expr(c, r, stats[c]) for c, r in rules.items()})


def standardize(df: DataFrame, stats: dict[str, dict], rules: dict[str, str], cats: list[str],
                keep: list[str] | None = None, label: str = "label") -> DataFrame:
    """Impute, standardise, pack into ``std_features``, fill categorical NULLs with the sentinel.

    Output: ``keep + [label, std_features] + cats``.
    """
    keep = keep or []
    std = standardize_columns(df, stats, rules)
    cols = [f"{c}_std" for c in rules]
    packed = VectorAssembler(inputCols=cols, outputCol="std_features", handleInvalid="keep").transform(std)
    return packed.select(*keep, label, "std_features", *cats).fillna(SENTINEL_NULL, subset=cats)


def imputer(cols: list[str], strategy: str = "median", suffix: str = "_imp", relative_error: float = 0.001):
    """Spark ML ``Imputer`` (N10). Note its median is approximate (``relativeError``)."""
    return Imputer(inputCols=cols, outputCols=[f"{c}{suffix}" for c in cols], strategy=strategy,
                   relativeError=relative_error)


def fit_median_imputer(train: DataFrame, cols: list[str], suffix: str = "_imp"):
    """The ML ``Imputer`` model of the exact lower medians (N10): a value that occurs, as ``relativeError`` 0 gives.

    Spark's own exact sketch keeps every distinct value of a column in one task. Here each rank is closed in by
    :mod:`quantile`, and the imputer is fitted on one row that holds the medians. NaN counts as missing, as in Spark.
    """
    medians = exact_quantiles(train, cols, lower=True)
    if unknown := [c for c, v in medians.items() if v is None]:
        raise ValueError(f"no median: {unknown} hold only NULL or NaN")
    return imputer(cols, "median", suffix, 0.0).fit(train.sparkSession.range(1).select(
        *[F.lit(medians[c]).cast(train.schema[c].dataType).alias(c) for c in cols]))


def unit_variance_pipeline(cols: list[str], strategy: str = "mean", with_mean: bool = False,
                           output: str = "scaled_features", relative_error: float = 0.001) -> Pipeline:
    """Imputer -> VectorAssembler -> StandardScaler (E13, E14), fit on train."""
    imp = imputer(cols, strategy, relative_error=relative_error)
    asm = VectorAssembler(inputCols=imp.getOutputCols(), outputCol="__num_vec")
    scl = StandardScaler(inputCol="__num_vec", outputCol=output, withStd=True, withMean=with_mean)
    return Pipeline(stages=[imp, asm, scl])
