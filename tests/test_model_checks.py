"""Model checks that can fail, hash folds, and stored sketches."""
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickforge.operators import model as mdl
from clickforge.operators import sketches as sk
from clickforge.operators import sparse


@pytest.fixture(scope="module")
def clicks(spark, tmp_path_factory):
    """Rows whose label follows three of four features, as ML vectors with a key and a weight."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 4)) * [1, 5, 0.2, 1]
    y = (rng.random(1500) < 1 / (1 + np.exp(-(x @ [1.0, -0.3, 4.0, 0.0] - 0.5)))).astype(int)
    rows = [(f"k{i}", int(b), float(1 + i % 3), *map(float, a)) for i, (a, b) in enumerate(zip(x, y))]
    cols = ["f0", "f1", "f2", "f3"]
    df = spark.createDataFrame(rows, ["key", "label", "weight", *cols])
    path = str(tmp_path_factory.mktemp("clicks") / "x")
    df.select("key", "label", "weight", sparse.vector(sparse.numeric_entries(cols), 4, "features")).write.parquet(path)
    return sparse.read_vectors(spark, path)


@pytest.mark.parametrize("reg, weight", [(0.0, None), (0.1, None), (0.0, "weight"), (0.05, "weight")])
def test_the_gradient_vanishes_at_the_optimum_only(clicks, reg, weight):
    best = mdl.logistic(200, reg, weight=weight).fit(clicks)
    early = mdl.logistic(2, reg, weight=weight).fit(clicks)
    assert mdl.logistic_gradient(best, clicks, reg, weight=weight) < 1e-5
    assert mdl.logistic_gradient(early, clicks, reg, weight=weight) > 1e-3
    assert mdl.logistic_gradient(best, clicks, reg + 0.1, weight=weight) > 1e-3  # another objective


def test_leaf_counts_are_those_of_the_train_rows(clicks):
    model = mdl.decision_tree().fit(clicks)
    assert mdl.leaf_counts_differ(model, clicks) == 0
    assert mdl.leaf_counts_differ(model, clicks.where("key <> 'k7'")) == 1


def test_folds_do_not_depend_on_partitioning(spark, clicks):
    found = []
    for n in (4, 16):
        folded = mdl.with_folds(clicks.repartition(n), "key", 5)
        sizes = [r["count"] for r in folded.groupBy("fold").count().orderBy("fold").collect()]
        auc = [r["mean_auc"] for r in mdl.cross_validate(spark, mdl.logistic(50), {"regParam": [0.0, 0.1]}, folded, folds=5, fold_col="fold").collect()]
        found.append((sizes, auc))
    assert found[0][0] == found[1][0] and sum(found[0][0]) == 1500 and min(found[0][0]) > 200
    assert found[0][1] == pytest.approx(found[1][1], abs=1e-9)


def test_sketches_of_subsets_answer_for_their_union(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.exponential(100, 6000), [np.nan, np.inf, -0.0, 0.0]])
    rows = [("abc"[i % 3], float(v) if i % 11 else None, f"v{int(v) % 3000}" if np.isfinite(v) else None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "part string, x double, c string")
    two = sk.fit_sketches(df.where("part <> 'c'"), ["x"], ["c"], "part")
    two.write.parquet(f"{tmp_path}/s")
    stored = spark.read.parquet(f"{tmp_path}/s").unionByName(sk.fit_sketches(df.where("part = 'c'"), ["x"], ["c"], "part"))  # a new subset: a scan of its rows
    assert stored.count() == 9 and max(len(r.sketch) for r in stored.collect()) < 100_000
    exact = df.agg(F.countDistinct("x").alias("x"), F.countDistinct("c").alias("c")).first()
    for r in sk.distinct_estimates(stored).collect():
        assert abs(r.distinct_estimate - exact[r.feature]) <= 0.03 * exact[r.feature]
    part = df.where("part = 'b'").agg(F.countDistinct("x")).first()[0]
    one = {(r.part, r.feature): r.distinct_estimate for r in sk.distinct_estimates(stored, ["part"]).collect()}
    assert abs(one["b", "x"] - part) <= 0.03 * part
    kept = np.sort([r[1] for r in rows if r[1] is not None and not np.isnan(r[1])])
    for r in sk.quantile_estimates(stored, [0.05, 0.5, 0.99]).collect():
        low, high = np.searchsorted(kept, r.quantile, "left") / len(kept), np.searchsorted(kept, r.quantile, "right") / len(kept)
        assert low - sk.RANK_ERROR <= r.share <= high + sk.RANK_ERROR
    empty = sk.fit_sketches(df.where("part = 'z'"), ["x"], ["c"], "part")
    assert empty.count() == 0 and sk.distinct_estimates(empty).count() == 0
    nulls = sk.fit_sketches(df.withColumn("x", F.lit(None).cast("double")), ["x"], ["c"], "part")
    assert sk.quantile_estimates(nulls, [0.5]).count() == 0


def test_vectors_keep_nan_for_null(spark):
    df = spark.createDataFrame([(1.0, None), (0.0, 2.0)], "a double, b double")
    got = [(list(r.v["indices"]), r.v["values"]) for r in df.select(sparse.vector(sparse.numeric_entries(["a", "b"]), 2, "v")).collect()]
    assert got[0][0] == [0, 1] and np.isnan(got[0][1][1]) and got[1] == ([1], [2.0])
    assert Vectors.sparse(2, *got[1]).size == 2
