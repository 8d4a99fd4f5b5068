import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from clickforge.operators import cross as crs
from clickforge.plans.fixture_plan import FIXTURE_RULES
from clickforge.plans.prep import FeaturePrep, PrepConfig
from clickforge.sources import files
from clickforge.sources import fixture as fx

CATS = fx.CATEGORICAL[2:6]
CFG = PrepConfig(key=fx.ID, label=fx.LABEL, numeric=fx.NUMERIC, categorical=CATS,
                 rules=FIXTURE_RULES, minimum=5, top=10, crosses=True, toy_rows=100)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("prep"))


@pytest.fixture(scope="module")
def whole(spark, sf):
    return fx.impressions(spark, sf).select(fx.ID, fx.LABEL, *fx.NUMERIC, *CATS).checkpoint()


@pytest.fixture(scope="module")
def first(spark, root, whole):
    prep = FeaturePrep(spark, root, CFG)
    return prep, prep.run(whole)


def ran(prep):
    return {name for name, s in prep.steps.items() if s.ran}


def test_prep_runs_and_packs(spark, root, first):
    prep, packed = first
    assert ran(prep) == set(prep.steps)
    assert sum(df.count() for df in packed.values()) == 6000
    k = spark.read.parquet(f"{root}/stats.parquet.layout").count()
    assert crs.vector_width(packed["train"], "features") == 9 + 10 + 9 * k
    assert crs.vector_width(spark.read.parquet(f"{root}/train.parquet.normed.masked-000005.encode"), "cat_features") == k
    w = {r["label"]: r["weight"] for r in packed["train"].select("label", "weight").distinct().collect()}
    assert abs(w[0] + w[1] - 1.0) < 1e-12
    assert prep.toy().count() == 100


def test_a_second_session_reuses_every_step(spark, root, whole, first):
    """Another store object over the same folder, as a later session has it; other settings in between change nothing."""
    FeaturePrep(spark, root, replace(CFG, top=None, crosses=False, minimum=50)).run(whole)
    again = FeaturePrep(spark.newSession(), root, CFG)
    packed = again.run(whole)
    assert not ran(again) and {s.path for s in again.steps.values()} <= {s.path for s in first[0].steps.values()}
    assert packed["tests"].count() == first[1]["tests"].count()
    made = again.store.manifest(again.packed["train"].path)
    assert made["rows"] == again.packed["train"].rows == packed["train"].count() and made["code"] == files.code_version()


@pytest.mark.parametrize("change, kept", [
    ({"rules": FIXTURE_RULES | {"n01": "max"}}, {("split", ""), ("stats", "numeric"), ("stats", "categories"), ("stats", "layout"), ("stats", "balance")}),
    ({"inclusive": True}, {("split", ""), ("stats", "numeric"), ("stats", "categories"), ("stats", "balance"), *((s, "normed") for s in ("train", "tests", "valid"))}),
    ({"seed": 7}, set()),
    ({"top": 4}, None),
])
def test_a_changed_parameter_runs_its_step_and_those_after(spark, root, whole, first, change, kept):
    prep = FeaturePrep(spark, root, replace(CFG, **change))
    prep.run(whole)
    reused = {name for name, s in prep.steps.items() if not s.ran}
    if kept is None:  # a new top-N: all but the pick and what follows
        assert {n for n in ran(prep)} == {n for n in prep.steps if "picked" in n[1]}
    else:
        assert reused == kept


def test_another_input_is_not_served_the_old_steps(spark, root, whole, first):
    prep = FeaturePrep(spark, root, CFG)
    prep.split(whole.where("n04 < 4"), files.content_key(whole.where("n04 < 4")))
    assert ran(prep) == {("split", "")}


def test_a_step_left_half_written_runs_again(spark, tmp_path):
    store, calls = files.ManifestStore(spark, str(tmp_path)), []

    def make(path):
        calls.append(path)
        spark.range(7).write.parquet(path)

    def cut_short(path):
        make(path)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):  # the data is complete, the manifest was never written
        store.step("train", "x", ["in"], {"a": 1}, cut_short)
    os.makedirs(f"{tmp_path}/train.parquet.x@1")  # and an attempt that did not get that far
    one = store.step("train", "x", ["in"], {"a": 1}, make)
    assert one.ran and one.rows == 7 and one.path.endswith("@2")
    assert store.step("train", "x", ["in"], {"a": 1}, make).ran is False
    assert store.step("train", "x", ["other"], {"a": 1}, make).path.endswith("@3") and len(calls) == 3


def test_content_key_sees_rows_not_their_order(spark):
    df = spark.range(50).selectExpr("id", "cast(id % 7 as string) as s")
    key = files.content_key(df)
    assert key == files.content_key(df.repartition(9)) != files.content_key(df.where("id < 49"))
    assert key != files.content_key(df.union(df.limit(1)).union(df.limit(1)))


SCHEMA = StructType([StructField("n", IntegerType()), StructField("x", DoubleType()), StructField("s", StringType())])
LINES = ["1\t2.5\ta", "\t\tz", "\t\t", "q\t1\tb", "2\tz\tc", "3\t4.0", "4\t5\te\textra", "-7\t1e3\tend", ""]


def test_import_splits_typed_rows_from_rejected_lines(spark, tmp_path):
    (tmp_path / "in.tsv").write_text("\n".join(LINES) + "\n")
    done = files.import_split(spark, str(tmp_path / "in.tsv"), str(tmp_path / "out"), SCHEMA)
    assert sorted(map(str, done.typed.collect())) == sorted(map(str, spark.createDataFrame([(1, 2.5, "a"), (None, None, "z"), (-7, 1000.0, "end")], SCHEMA).collect()))
    assert {(r.line, r.reason) for r in done.rejected.collect()} == {
        ("q\t1\tb", "n"), ("2\tz\tc", "x"), ("3\t4.0", "fields: 2"), ("4\t5\te\textra", "fields: 4")}
    again = files.import_split(spark, "/nowhere", str(tmp_path / "out"), SCHEMA)  # complete: the source is not read again
    assert again.path == done.path and again.typed.count() == 3 and again.rejected.count() == 4
    clean = tmp_path / "clean.tsv"
    clean.write_text("n\tx\ts\n1\t2\tb\n")
    good = files.import_split(spark, str(clean), str(tmp_path / "good"), SCHEMA, header=True)
    assert good.typed.count() == 1 and good.rejected.count() == 0


def test_an_interrupted_import_resumes(spark, tmp_path):
    (tmp_path / "in.tsv").write_text("\n".join(LINES) + "\n")
    left = tmp_path / "out" / "side=typed"
    left.mkdir(parents=True)
    (left / "part-0.parquet").write_bytes(b"half a file")  # no _SUCCESS
    for _ in range(2):
        assert files.import_tsv(spark, str(tmp_path / "in.tsv"), str(tmp_path / "out"), SCHEMA).agg(F.count("*")).first()[0] == 3
    assert (left / "part-0.parquet").exists() and (tmp_path / "out@1" / "_SUCCESS").exists() and not (tmp_path / "out@2").exists()
