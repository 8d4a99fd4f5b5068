"""Steps that must stay proportional to their input."""
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickforge.operators import model as mdl
from clickforge.operators import numeric as num
from clickforge.operators import packed_svm as psvm
from clickforge.operators import sparse, svm


def _hinge(x, y, w):
    return np.maximum(0.0, 1 - y * (x @ w)).mean()


def test_exact_median_imputer_gives_the_lower_median(spark):
    rows = [(float(v), float(v) if v % 3 else None, float("nan") if v == 2 else float(-v)) for v in range(1, 5001)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    model = num.fit_median_imputer(df, ["a", "b", "c"])
    got = model.surrogateDF.first()
    want = num.imputer(["a", "b", "c"], "median", relative_error=0.0).fit(df).surrogateDF.first()
    assert got["a"] == 2500.0 and got.asDict() == want.asDict()
    assert model.transform(spark.createDataFrame([(None, 1.0, None)], "a double, b double, c double")).first()["a_imp"] == 2500.0
    with pytest.raises(ValueError, match="no median"):
        num.fit_median_imputer(df.withColumn("b", F.lit(None).cast("double")), ["a", "b"])


def test_dense_sums_are_those_of_the_dense_vector(spark, tmp_path):
    width = 2 * sparse.TILE_PLACES + 5
    rows = [(f"k{i}", [] if i == 3 else sorted({0, i, width - 1 - i, sparse.TILE_PLACES - 1 + i % 2})) for i in range(150)]
    df = spark.createDataFrame(rows, "key string, places array<int>")
    df.select("key", sparse.vector(sparse.one_hot_entries("places"), width, "v")).write.parquet(f"{tmp_path}/v")
    dense = sparse.read_vectors(spark, f"{tmp_path}/v").select("key", vector_to_array("v").alias("d"))
    want = {r.key: (len(r.d), sum(r.d), sum(i * x for i, x in enumerate(r.d))) for r in dense.collect()}
    got = {r.key: (r.width, r.mass, r.places) for r in sparse.dense_sums(spark.read.parquet(f"{tmp_path}/v"), "v", ["key"]).collect()}
    assert got == want and got["k3"] == (width, 0.0, 0.0)


def test_sweep_on_blocks_is_the_sweep_on_rows(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 2))
    rows = [(None if i == 5 else 1 if a + 0.3 * b > 0 else -1, 1.0, float("nan") if i == 9 else float(a), float(b)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "y int, x0 double, x1 double, x2 double")
    w = [0.2, 0.1, -0.1]
    want = svm.step_sums_many(df.withColumn("p", F.lit("train")), [w, [0.0, 1.0, 0.0]], part="p")["train"]
    got = svm.block_sums(svm.point_blocks(df.withColumn("p", F.lit("train")).repartition(3), "p", 2), [w, [0.0, 1.0, 0.0]])["train"]
    for a, b in zip(got, want):
        assert a["n"] == b["n"] == 400
        assert {k: pytest.approx(v, abs=1e-9, nan_ok=True) for k, v in b.items()} == a
    clean = df.where("y is not null and not isnan(x1)")
    hist = svm.svm_sweep(clean, None, w, [0.01, 1.0], steps=3)
    assert hist[0.01][-1]["test_loss"] is None
    points = np.array([[r.x0, r.x1, r.x2] for r in clean.collect()])
    assert hist[1.0][-1]["train_loss"] == pytest.approx(_hinge(points, np.array([r.y for r in clean.collect()]), np.array(hist[1.0][-1]["weights"])))


def test_blocks_grow_with_the_width():
    narrow, wide = (mdl.in_wide_blocks(mdl.logistic(5), w) for w in (600, 500_000))
    assert narrow.getMaxBlockSizeInMB() == 0.0 and 20 < wide.getMaxBlockSizeInMB() < 30
    assert mdl.in_wide_blocks(mdl.linear_svc(5), 10**8).getMaxBlockSizeInMB() == mdl.MOST_MB
    tree = mdl.decision_tree()
    assert mdl.in_wide_blocks(tree, 500_000) is tree


def test_packed_sums_are_added_a_model_at_a_time(spark, monkeypatch):
    rng, width = np.random.default_rng(4), 5000
    rows = [(i % 2, [{"i": int(p), "v": float(v)} for p, v in zip(np.sort(rng.choice(width, 3, replace=False)), rng.normal(size=3))]) for i in range(600)]
    df = spark.createDataFrame(rows, "label int, e array<struct<i:int,v:double>>").repartition(1)
    pts = psvm.packed_points(df, F.col("e"), "label", F.lit("train"))
    want = np.zeros(width + 1)
    for y, e in rows:
        want[0] += 2 * y - 1
        for x in e:
            want[x["i"] + 1] += (2 * y - 1) * x["v"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        parts, total = psvm.step_sums(pts, np.zeros(width + 1))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert parts == {"train": (600.0, 1.0)} and total == pytest.approx(want, abs=1e-9)
    batches, wide = [], []
    monkeypatch.setattr(psvm, "_by_place", lambda e, w: wide.append(w) or np.zeros(w))
    batches = [b for b in pts.select("part", "y", "c", "at", "x").toArrow().to_batches(max_chunksize=7)]
    monkeypatch.setattr(psvm.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 0})()))
    list(psvm._sums(type("B", (), {"value": np.zeros(width + 1)})(), "train", psvm.hinge)(iter(batches)))
    assert len(batches) > 50 and len(wide) == 1  # 1,800 entries: one array as wide as the model


def test_sgd_points_that_do_not_fit_go_to_disk(spark):
    rdd = svm._kept(spark, spark.range(3)._jdf.rdd())
    assert rdd.getStorageLevel().useMemory() and rdd.getStorageLevel().useDisk()
    rdd.unpersist(False)


def test_places_are_sorted_without_a_comparator(spark):
    from clickforge.operators import category as cat
    layout = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "u", 0)], "feature string, value string, gidx int")
    df = spark.createDataFrame([("k1", "y", "u"), ("k2", None, "u"), ("k3", "z", None)], "key string, a string, b string")
    out = cat.encode_places(df, ["a", "b"], layout, "key")
    assert {r.key: r.places for r in out.collect()} == {"k1": [0, 2], "k2": [0], "k3": []}
    assert "array_sort(" not in out._jdf.queryExecution().analyzed().toString()  # it calls a comparator row by row


def test_quantiles_take_few_scans_whatever_the_spread(spark, monkeypatch):
    from clickforge.operators import quantile
    rng = np.random.default_rng(3)
    x = np.where(rng.random(9001) < 0.5, 1.0, -1.0) * np.exp(rng.uniform(-600, 600, 9001))
    x[:5] = [np.inf, -np.inf, -0.0, 0.0, np.nan]
    df = spark.createDataFrame([(float(a), None if i % 2 else float(a)) for i, a in enumerate(x)], "a double, b double").repartition(3)
    scans, counts = [], quantile._counts
    monkeypatch.setattr(quantile, "_counts", lambda *a: scans.append(1) or counts(*a))
    monkeypatch.setattr(F, "percentile_approx", lambda *a: pytest.fail("a sketch of every value"))
    for p in (0.01, 0.5, 0.99):
        got = quantile.exact_quantiles(df, ["a", "b"], p, exact_below=8)
        assert got["a"] == np.quantile(x[~np.isnan(x)], p)
        assert got["b"] == np.quantile(x[::2][~np.isnan(x[::2])], p)
    assert len(scans) <= 3 * 4
    assert quantile.exact_quantiles(df.limit(0), ["a"]) == {"a": None}


def test_the_imports_joins_are_cut_by_rows(spark, sf, monkeypatch):
    from clickforge.plans import fixture_plan as fp
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fp.join_partitions(spark, sf) == session
    monkeypatch.setattr(fp, "ROWS_A_TASK", 100)
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert fp.join_partitions(spark, sf) == -(-rows // 100) > session
    used = []
    monkeypatch.setattr(fp.files.StepStore, "resolve", lambda *a: None)
    monkeypatch.setattr(fp.fx, "with_subset", lambda df: used.append(spark.conf.get("spark.sql.shuffle.partitions")) or spark.range(1))
    monkeypatch.setattr(fp, "join_partitions", lambda *a: 77)
    writers = []
    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda self: writers.append(spark.conf.get("spark.sql.shuffle.partitions")) or _Nothing()))
    fp.import_path(spark, sf)
    assert writers == ["77"] and spark.conf.get("spark.sql.shuffle.partitions") == str(session)


class _Nothing:
    def mode(self, *_):
        return self

    def parquet(self, *_):
        pass


def test_crosses_and_packs_are_made_by_the_batch(spark):
    from clickforge.operators import cross as crs
    from pyspark.ml.linalg import Vectors, VectorUDT  # noqa: F401
    struct = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
    rows = [("a", 1, (0, 3, [0, 2], [2.0, float("nan")]), (0, 5, [1, 4], [1.0, -3.0])), ("b", 0, (1, None, None, [0.0, 5.0, -1.0]), (0, 5, [0, 3], [1.0, 0.0])),
            ("c", 1, (0, 3, [], []), (0, 5, [2], [1.0])), ("d", 0, None, (0, 5, [2], [1.0])), (None, 0, (0, 3, [1], [4.0]), (1, None, None, [0.0, 0.0, 7.0, 0.0, 1.0]))]
    df = spark.createDataFrame(rows, f"key string, label int, x {struct}, c {struct}").repartition(2)
    df = df.select("key", "label", *[F.col(k).alias(k, metadata={"ml_attr": {"num_attrs": w}}) for k, w in (("x", 3), ("c", 5))])
    crossed = crs.sparse_cross(df, "x", "c", "xc")
    got = crs.sparse_pack(crossed, ["x", "c", "xc"], keep=["key"])
    assert sparse.width_of(got, "features") == 3 + 5 + 15 and not any(w in got._jdf.queryExecution().analyzed().toString().lower() for w in ("lambda", "transform("))
    one = sparse.outer(sparse.vector_entries_of("x"), sparse.vector_entries_of("c"), 5)
    entries, width = sparse.side_by_side([(sparse.vector_entries_of("x"), 3), (sparse.vector_entries_of("c"), 5), (sparse.vector_entries_of("xc"), 15)])
    plain = df.select("*", sparse.vector(one, 15, "xc")).select("key", "label", sparse.vector(entries, width, "features"))
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.columns == plain.columns
    hot = spark.createDataFrame([("a", [0, 4]), ("b", [])], "key string, places array<int>")
    assert hot.select(sparse.one_hot_vector("places", 6, "v")).collect() == hot.select(sparse.vector(sparse.one_hot_entries("places"), 6, "v")).collect()
