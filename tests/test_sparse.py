"""Sparse vectors as plain columns, the encoding without driver labels, and statistics of all pairs in one scan."""
import math

import numpy as np
import pytest
from pyspark.ml.feature import Interaction, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickforge.operators import category as cat
from clickforge.operators import cross as crs
from clickforge.operators import profile as prof
from clickforge.operators import sparse
from clickforge.sources import fixture as fx

CAT = ["c03", "c04", "c05", "c07", "c10"]


@pytest.fixture(scope="module")
def rows(spark, sf):
    """Masked rows of the fixture (some values rare, some NULL in the valid subset)."""
    imp = fx.with_subset(fx.impressions(spark, sf)).select(fx.ID, "subset", *fx.NUMERIC, *CAT).checkpoint()
    filled = cat.fill_categorical(imp, CAT)
    stats = cat.fit_category_stats(filled.where("subset = 'train'"), CAT)
    masked = cat.mask_uncommon(filled, CAT, cat.fit_frequent_values(stats, 40))
    gone = F.when((F.col("subset") != "valid") | (F.col("n04") > 2), F.col("c03"))
    return masked.withColumn("c03", gone).withColumn("c07", F.when(F.col("n04") == 1, F.lit("never seen")).otherwise(F.col("c07"))).cache()


def _layout(rows):
    return cat.fit_layout(cat.fit_category_stats(rows.where("subset = 'train'"), CAT), CAT)


def test_places_equal_the_ml_encoder_whatever_is_broadcast(spark, rows, tmp_path):
    """Broadcast, long-form and mixed look-ups give the vectors of StringIndexer + OneHotEncoder."""
    train = rows.where("subset = 'train'")
    layout = _layout(rows)
    layout.write.parquet(f"{tmp_path}/layout")
    layout = spark.read.parquet(f"{tmp_path}/layout")
    width = layout.count()
    model = cat.encoding_pipeline(CAT).fit(train)
    want = {r.imp_id: list(r.v.indices) for r in model.transform(rows.fillna("no value at all", CAT)).select(fx.ID, F.col("cat_features").alias("v")).collect()}
    hot = cat.hot_values(cat.fit_category_stats(train, CAT), train.count(), 8)
    for limit in (cat.BROADCAST_BYTES, 2000, 0):
        coded = cat.encode_places(rows, CAT, layout, fx.ID, broadcast_bytes=limit, hot_keys=hot if limit == 0 else None)
        assert coded.columns == [*rows.columns, "places"]
        assert {r.imp_id: list(r.places) for r in coded.select(fx.ID, "places").collect()} == want
    struct = coded.select(fx.ID, sparse.vector(sparse.one_hot_entries("places"), width, "cat_features"))
    struct.write.parquet(f"{tmp_path}/vectors")
    back = sparse.read_vectors(spark, f"{tmp_path}/vectors")
    assert crs.vector_width(back, "cat_features") == width
    got = {r.imp_id: r.v for r in back.select(fx.ID, F.col("cat_features").alias("v")).collect()}
    assert {i: list(v.indices) for i, v in got.items()} == want and {v.size for v in got.values()} == {width}


def test_masked_stats_equal_the_counts_of_masked_rows(spark, sf):
    imp = cat.fill_categorical(fx.impressions(spark, sf), CAT)
    stats = cat.fit_category_stats(imp, CAT)
    for inclusive in (False, True):
        masked = cat.mask_uncommon(imp, CAT, cat.fit_frequent_values(stats, 300, inclusive))
        want = {tuple(r) for r in cat.fit_category_stats(masked, CAT).collect()}
        assert {tuple(r) for r in cat.masked_stats(stats, 300, inclusive).select("feature", "value", "counts").collect()} == want


def test_crosses_and_packs_equal_the_ml_stages(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, -2.0, 0.0, "a", "x"), (0, 0.0, 1.5, 3.0, "b", "y"), (1, 1.0, 0.0, 0.0, "a", "z"), (0, 2.0, 2.0, -1.0, "c", "x")],
                               "label int, n1 double, n2 double, n3 double, c1 string, c2 string").coalesce(1)
    nums, cats = ["n1", "n2", "n3"], ["c1", "c2"]
    ml = cat.encoding_pipeline(cats).fit(df).transform(VectorAssembler(inputCols=nums, outputCol="std_features").transform(df))
    ml = Interaction(inputCols=["std_features", "cat_features"], outputCol="cxn_features").transform(ml)
    ml = crs.pack(ml, ["std_features", "cat_features", "cxn_features"], rate=0.25, keep=nums)
    layout = cat.fit_layout(cat.fit_category_stats(df, cats), cats)
    coded = cat.encode_places(df.withColumn("key", F.monotonically_increasing_id()), cats, layout, "key").select(
        "label", *nums, sparse.vector(sparse.numeric_entries(nums), 3, "std_features"),
        sparse.vector(sparse.one_hot_entries("places"), layout.count(), "cat_features"))
    own = crs.sparse_pack(crs.sparse_cross(coded), ["std_features", "cat_features", "cxn_features"], rate=0.25, keep=nums)
    own.write.parquet(f"{tmp_path}/p")
    back = sparse.read_vectors(spark, f"{tmp_path}/p")
    dense = lambda d: sorted((r.n1, r.n2, r.label, r.weight, tuple(r.v)) for r in d.select("*", vector_to_array("features").alias("v")).collect())
    assert dense(back) == dense(ml)
    picked, n = sparse.picked(sparse.vector_entries_of("cat_features"), [0, 2, 5])
    v = coded.select(sparse.vector(picked, n, "top")).select(F.col("top.indices").alias("i")).collect()
    whole = coded.select(F.col("cat_features.indices").alias("i")).collect()
    assert [list(r.i) for r in v] == [[[0, 2, 5].index(k) for k in w.i if k in (0, 2, 5)] for w in whole]


def test_schema_and_footer_do_not_grow_with_the_width(spark, sf, tmp_path):
    """Crosses as wide as those the reference did not finish: 506,183 places and more."""
    import pyarrow.parquet as pq
    sizes = []
    for width in (50, 80_000):
        imp = fx.impressions(spark, sf).select(fx.ID, *fx.NUMERIC, *CAT).fillna(0.0)
        place = F.array_sort(F.array_distinct(F.transform(F.array(*CAT), lambda c: F.pmod(F.xxhash64(c), F.lit(width)).cast("int"))))
        df = imp.select(fx.ID, sparse.vector(sparse.numeric_entries(fx.NUMERIC), 9, "std_features"),
                        sparse.vector(sparse.one_hot_entries(F.filter(place, lambda p: p.isNotNull())), width, "cat_features"))
        packed = crs.sparse_pack(crs.sparse_cross(df).withColumn("label", F.lit(1)), ["std_features", "cat_features", "cxn_features"], keep=[fx.ID])
        assert sparse.width_of(packed, "features") == 9 + width + 9 * width
        packed.coalesce(1).write.parquet(f"{tmp_path}/{width}")
        file = next((tmp_path / str(width)).glob("*.parquet"))
        sizes.append((len(packed.schema.json()), len(str(pq.read_schema(file).metadata))))
        last = packed.agg(F.max(F.array_max("features.indices")), F.min(F.size("features.indices"))).first()
        assert last[0] < 10 * width + 9 and last[1] > 9
    assert sparse.width_of(packed, "features") > 506_183
    assert abs(sizes[0][0] - sizes[1][0]) < 20 and abs(sizes[0][1] - sizes[1][1]) < 40
    with pytest.raises(ValueError):
        sparse.vector(F.array(), 1 << 31, "v")


def test_pairs_of_39_columns_in_one_scan(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 39)) * 10.0 ** rng.integers(-3, 4, 39) + 10.0 ** rng.integers(0, 6, 39)
    x[:, 1] = 3 * x[:, 0] + rng.normal(size=3000)
    x[:, 2], x[:, 3] = 0.1, np.nan
    gone = rng.random(x.shape) < rng.random(39) * 0.5
    gone[:, 3] = True
    cols = [f"c{k}" for k in range(39)]
    rows = [[None if g else float(v) for v, g in zip(*r)] for r in zip(x, gone)]
    spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5).write.parquet(f"{tmp_path}/x")
    df = spark.read.parquet(f"{tmp_path}/x")
    got = {(r.col_a, r.col_b): r["corr"] for r in prof.correlation_matrix(df, cols).collect()}
    both = {(r.col_a, r.col_b): (r.both_null, r.a_null) for r in prof.co_null_counts(df, cols).collect()}
    assert len(got) == len(both) == 39 * 38 // 2
    for a in range(39):
        for b in range(a + 1, 39):
            assert both[cols[a], cols[b]] == ((gone[:, a] & gone[:, b]).sum(), gone[:, a].sum())
            ok = ~gone[:, a] & ~gone[:, b]
            if 2 in (a, b) or 3 in (a, b):
                assert got[cols[a], cols[b]] is None
            else:
                assert got[cols[a], cols[b]] == pytest.approx(np.corrcoef(x[ok, a], x[ok, b])[0, 1], abs=1e-9)
    for out in (prof.correlation_matrix(df, cols), prof.co_null_counts(df, cols)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1
    wide = df.select(*[F.col(cols[k % 39]).alias(f"w{k}") for k in range(130)])
    assert prof.co_null_counts(wide, wide.columns).count() == 130 * 129 // 2


def test_pairs_with_odd_values(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0, nan), (2.0, 4.5, 1.0), (3.0, 5.5, None), (None, 1.0, nan)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r["corr"] for r in prof.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.5, 5.5])[0, 1]) and math.isnan(got["a", "c"]) and math.isnan(got["b", "c"])
    empty = df.where("a > 9")
    assert [r["corr"] for r in prof.correlation_matrix(empty, ["a", "b", "c"]).collect()] == [None] * 3
    assert [r.both_null for r in prof.co_null_counts(empty, ["a", "b", "c"]).collect()] == [0] * 3
    one = spark.createDataFrame([(0, True, "x"), (1, None, None)], "a int, b boolean, c string")
    assert {(r.col_a, r.both_null, r.a_null) for r in prof.co_null_counts(one, ["b", "c"]).collect()} == {("b", 1, 1)}
