import numpy as np
import pytest

from clickforge.operators.quantile import exact_quantiles


@pytest.mark.parametrize("p", [0.5, 0.25, 0.9])
def test_exact_quantile_matches_numpy(spark, p):
    rng = np.random.default_rng(1)
    a = rng.normal(size=3001).round(3)           # ties
    b = np.concatenate([np.full(2000, 7.0), rng.exponential(size=1001)])  # one hot value = 2/3 of rows
    rows = [(float(x), float(y), None) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = exact_quantiles(df, ["a", "b", "c"], p=p, exact_below=50)
    assert got["a"] == pytest.approx(np.quantile(a, p), abs=1e-12)
    assert got["b"] == pytest.approx(np.quantile(b, p), abs=1e-12)
    assert got["c"] is None


def test_single_row_and_constant(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, None)], "a double, b double")
    got = exact_quantiles(df, ["a", "b"])
    assert got == {"a": 5.0, "b": 1.0}


def test_extreme_range(spark):
    vals = [-1.0e308, 1.0e308, 3.0, 4.0, 5.0]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    assert exact_quantiles(df, ["a"], exact_below=1)["a"] == 4.0


def test_infinity_nan_and_heavy_tails_in_a_bounded_number_of_scans(spark, monkeypatch):
    rng = np.random.default_rng(2)
    tail = np.exp(rng.uniform(0, 60, 30001))
    two = np.where(rng.random(30001) < 0.5, 1.0, 2.0)
    two[:3] = [1.25, 1.5, 1.75]
    odd = rng.normal(size=30001)
    odd[:4], odd[4:7] = np.inf, -np.inf
    nan = rng.normal(size=30001)
    nan[:10] = np.nan
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(tail, two, odd, nan)], "a double, b double, c double, d double").cache()
    scans = []
    agg = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *e: scans.append(1) or agg(self, *e))
    got = exact_quantiles(df, ["a", "b", "c", "d"], exact_below=20)
    assert len(scans) <= 1 + 2 * 3
    for c, v in zip("abc", (tail, two, odd)):
        assert got[c] == np.quantile(v, 0.5)
    assert got["d"] == pytest.approx(np.quantile(nan[10:], 0.5), abs=1e-12)
    assert exact_quantiles(df.selectExpr("case when a > 0 then double('NaN') end n"), ["n"]) == {"n": None}


def test_approx_median_within_rank_error(spark):
    from clickforge.operators.quantile import approx_quantiles
    rng = np.random.default_rng(5)
    a = rng.lognormal(size=20000)
    df = spark.createDataFrame([(float(x),) for x in a], "a double")
    m = approx_quantiles(df, ["a"], 0.5, 0.005)["a"]
    rank = (a < m).sum()
    assert abs(rank - 10000) <= 0.005 * 20000 + 1
