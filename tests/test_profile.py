from pyspark.sql import functions as F

from clickforge.operators import profile as prof


def test_null_profile_and_ztest(spark):
    rows = [(1, None, 1.0), (0, None, 2.0), (1, 3.0, None), (0, 4.0, 5.0)]
    df = spark.createDataFrame(rows, "label int, a double, b double")
    np_ = {r["feature"]: r for r in prof.null_profile(df, ["a", "b"]).collect()}
    assert np_["a"]["null_count"] == 2 and np_["a"]["null_pct"] == 50.0
    assert np_["b"]["fill_rate"] == 0.75
    z = {r["feature"]: r for r in prof.null_label_ztest(df, ["a", "b"]).collect()}
    assert z["a"]["m"] == 2 and z["a"]["p2"] == 0.5
    assert prof.complete_row_ratio(df, ["a", "b"]).first()["complete_rows"] == 1


def test_all_null_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None)], "k double, z double")
    h = prof.equal_width_histogram(df, ["k", "z"], bins=4).collect()
    assert {(r["feature"], r["bin"], r["count"]) for r in h if r["count"]} == {("k", 0, 2)}
    assert all(r["feature"] == "k" for r in h)          # all-NULL column has no bins
    m = {r["feature"]: r for r in prof.numeric_measurements(df, ["k", "z"]).collect()}
    assert m["z"]["median"] is None and m["k"]["stddev"] == 0.0


def test_top_k_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "c1 string")
    top = prof.top_k_values(prof.category_frequencies(df, ["c1"]), k=2).orderBy("rank").collect()
    assert [r["value"] for r in top] == ["c", "a"]


def test_correlation_one_pass(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), (2 * F.col("id")).cast("double").alias("y"))
    assert prof.correlation_matrix(df, ["x", "y"]).first()["corr"] == 1.0


def test_histogram_last_bin_closed_and_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (4.0,), (None,)], "x double")
    h = {r["bin"]: (r["lower"], r["upper"], r["count"]) for r in prof.equal_width_histogram(df, ["x"], bins=4).collect()}
    assert h[0] == (0.0, 1.0, 1) and h[1] == (1.0, 2.0, 1) and h[2] == (2.0, 3.0, 1)
    assert h[3] == (3.0, 4.0, 1)          # max lands in the last (closed) bin; NULL ignored


def test_co_null_and_special_values(spark):
    df = spark.createDataFrame([(None, None, -1.0), (None, 1.0, 0.0), (2.0, None, 0.0)], "a double, b double, c double")
    co = {(r["col_a"], r["col_b"]): (r["both_null"], r["a_null"]) for r in prof.co_null_counts(df, ["a", "b", "c"]).collect()}
    assert co[("a", "b")] == (1, 2) and co[("b", "c")] == (0, 2)
    sv = {(r["feature"], r["op"], r["special"]): r["rows"] for r in prof.special_value_counts(df, ["c"]).collect()}
    assert sv[("c", "eq", -1.0)] == 1 and sv[("c", "eq", 0.0)] == 2 and sv[("c", "lt", 0.0)] == 1


def test_threshold_cardinality_running_width(spark):
    freq = spark.createDataFrame([("f1", "a", 50), ("f1", "b", 40), ("f2", "x", 41), ("f2", "y", 41)],
                                 "feature string, value string, counts long")
    r = {x["feature"]: x for x in prof.threshold_cardinality(freq, 40).collect()}
    assert (r["f1"]["frequent"], r["f1"]["frequent_inclusive"], r["f1"]["width_after_mask"]) == (1, 2, 2)
    assert r["f2"]["width_after_mask"] == 2 and r["f2"]["running_width"] == 4


def test_constant_column_standardises_to_zero(spark):
    from clickforge.operators import numeric as num
    df = spark.createDataFrame([(1, 5.0, 1.0), (0, 5.0, None), (1, 5.0, 3.0)], "label int, k double, x double")
    stats = num.stats_dict(num.fit_numeric_stats(df, ["k", "x"]))
    assert stats["k"]["stddev"] == 0.0 and stats["x"]["median"] == 2.0
    out = num.standardize_columns(df, stats, {"k": "median_z", "x": "scale1sd"}).collect()
    assert [r["k_std"] for r in out] == [0.0, 0.0, 0.0]          # sd = 0: no error, 0.0
    assert out[1]["x_std"] == 2.0 / stats["x"]["stddev"]        # NULL imputed with the train median


def test_single_class_auc_is_null(spark):
    from clickforge.operators import evaluate as ev
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "label int, score double")
    r = ev.rank_auc(df, "score", "label").first()
    assert r["negatives"] == 0 and r["auc"] is None
