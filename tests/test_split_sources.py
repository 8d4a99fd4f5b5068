import os
import tempfile

from pyspark.sql import functions as F

from clickforge.operators import split as spl
from clickforge.sources import files
from clickforge.sources import fixture as fx


def test_hash_split_matches_fixture_counts(spark, sf):
    c = {r["subset"]: r["rows"] for r in spl.split_counts(spl.hash_split(fx.impressions(spark, sf), "imp_id")).collect()}
    assert c == {"train": 4791, "tests": 582, "valid": 627}


def test_oversample_ratio(spark, sf):
    tr = fx.subsets(spark, sf)["train"].select("imp_id", "label")
    pos, neg = spl.class_counts(tr)
    over = spl.oversample_exact(tr, "imp_id")
    p2 = over.filter("label = 1").count()
    assert abs(p2 - neg) <= 0.05 * neg
    under = spl.undersample_hash(tr, "imp_id")
    n2 = under.filter("label = 0").count()
    assert abs(n2 - pos) <= 0.1 * pos and under.filter("label = 1").count() == pos


def test_tsv_empty_field_is_null(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    with open(os.path.join(d, "x.tsv"), "w") as f:
        f.write("1\t\tabc\n0\t2.5\t\n")
    schema = files.impression_schema("label", ["n01"], ["c01"])
    rows = files.read_tsv(spark, d, schema).orderBy("label").collect()
    assert rows[1]["n01"] is None and rows[1]["c01"] == "abc" and rows[0]["c01"] is None


def test_step_store_skips_and_resumes(spark):
    root = tempfile.mkdtemp(dir="/tmp")
    store = files.StepStore(spark, root)
    store.write(spark.range(10), "train")
    os.makedirs(store.base("train", "double"))           # an interrupted attempt: no _SUCCESS
    build = lambda df: df.withColumn("y", F.col("id") * 2)
    out, ran = store.run("train", "double", build)
    assert ran and out.count() == 10 and store.resolve("train", "double").endswith("@1")
    _, ran2 = store.run("train", "double", build)
    assert not ran2


def test_model_and_libsvm_round_trip(spark):
    from pyspark.ml.functions import vector_to_array
    from clickforge.operators import category as cat
    df = spark.createDataFrame([("a", 1), ("b", 0), ("a", 1)], "c1 string, label int")
    model = cat.encoding_pipeline(["c1"], output="features").fit(df)
    back = files.save_model(model, tempfile.mkdtemp(dir="/tmp") + "/m")
    a = [r[0] for r in model.transform(df).select(vector_to_array("features")).collect()]
    b = [r[0] for r in back.transform(df).select(vector_to_array("features")).collect()]
    assert a == b
    path = tempfile.mkdtemp(dir="/tmp") + "/svm"
    files.write_libsvm(model.transform(df), path)
    got = files.read_libsvm(spark, path, 2).select("label", vector_to_array("features").alias("f")).collect()
    assert sorted((r["label"], tuple(r["f"])) for r in got) == sorted((float(l), tuple(v)) for l, v in zip([1, 0, 1], a))


def test_vector_entries_sparse_and_dense(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import IntegerType, StructField, StructType
    df = spark.createDataFrame([(1, Vectors.sparse(6, [1, 4], [2.0, -1.0])), (2, Vectors.dense([0.0, 3.0, 0.0, 5.0]))],
                               StructType([StructField("id", IntegerType()), StructField("v", VectorUDT())]))
    path = tempfile.mkdtemp(dir="/tmp") + "/vec"
    df.write.parquet(path)
    got = {tuple(r) for r in files.vector_entries(files.read_vectors_as_structs(spark, path, ["v"]), "v", ["id"]).collect()}
    assert got == {(1, 1, 2.0), (1, 4, -1.0), (2, 1, 3.0), (2, 3, 5.0)}


def test_hash_sample_is_partitioning_independent(spark, sf):
    tr = fx.subsets(spark, sf)["train"].select("imp_id", "label")
    a = [r["imp_id"] for r in spl.hash_ordered_sample(tr.repartition(3), "imp_id", 50).collect()]
    b = [r["imp_id"] for r in spl.hash_ordered_sample(tr.repartition(7), "imp_id", 50).collect()]
    assert sorted(a) == sorted(b) and len(a) == 50


def test_label_recode_round_trip(spark):
    from clickforge.functions.scalar import label_recode
    df = spark.createDataFrame([(0,), (1,)], "label int")
    out = df.select(label_recode("label").alias("y")).select("y", label_recode("y", to_signed=False).alias("b")).collect()
    assert [(r["y"], r["b"]) for r in out] == [(-1, 0), (1, 1)]


def test_import_is_keyed_by_source_and_reused(spark, sf):
    from clickforge.plans.fixture_plan import import_path, import_root
    a = import_path(spark, sf)
    assert import_path(spark, sf) == a                      # complete import is reused
    assert files.is_complete(spark, a)
    assert import_root(spark, sf) != import_root(spark, "/root/testdata/sf0.01")


def test_small_rates_and_ratios_keep_rows(spark):
    df = spark.range(200_000).selectExpr("id as k", "cast(id < 5 as int) as label")
    kept = spl.undersample_hash(df, "k", rate=1e-3)
    n = kept.filter("label = 0").count()
    assert kept.filter("label = 1").count() == 5 and 120 < n < 290
    assert spl.undersample_hash(df, "k").filter("label = 0").count() >= 0  # 5 / 199,995: no error, no rounding to a bucket
    assert spl.hash_sample_threshold(2.5e-5) > 0
    parts = {r["subset"]: r["rows"] for r in spl.split_counts(spl.hash_split(df, "k", 3, (0.995, 0.004, 0.001))).collect()}
    assert sum(parts.values()) == 200_000 and 600 < parts["tests"] < 1000 and 120 < parts["valid"] < 290
    import pytest
    with pytest.raises(ValueError):
        spl.hash_split(df, "k", 3, (0.9, 0.2))


def test_reshuffle_keeps_rows_and_changes_order(spark):
    df = spark.range(5000).selectExpr("id as k")
    got = [r["k"] for r in spl.reshuffle(df, 1).collect()]
    assert sorted(got) == list(range(5000)) and got != sorted(got)
    ups = sum(a < b for a, b in zip(got, got[1:]))
    assert 2200 < ups < 2800


def test_a_half_written_model_is_fitted_again(spark, tmp_path):
    import os

    from clickforge.sources import files
    store = files.StepStore(spark, str(tmp_path))
    os.makedirs(f"{tmp_path}/model.parquet.m/metadata")
    calls = []

    def fit(path):
        calls.append(path)
        os.makedirs(path)

    first = store.fitted("m", fit)
    assert first.endswith("@1") and store.fitted("m", fit) == first and len(calls) == 1


def test_import_folder_is_stable_and_follows_the_code(spark, sf, monkeypatch):
    from clickforge.plans import fixture_plan as plan
    monkeypatch.setattr(plan, "stable_root", lambda s: "/shared")
    one = plan.import_root(spark, sf)
    assert one == plan.import_root(spark, sf) and one.startswith("/shared/clickforge-import/")
    monkeypatch.setattr(plan.files, "code_version", lambda: "other")
    assert plan.import_root(spark, sf) != one


def test_malformed_fields(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from clickforge.sources import files
    path = tmp_path / "x.tsv"
    path.write_text("1\ta\n\tb\nq\tc\n")
    schema = StructType([StructField("n", IntegerType()), StructField("s", StringType())])
    assert {r["field"]: r["malformed"] for r in files.malformed_fields(spark, str(path), schema).collect()} == {"n": 1, "s": 0}
