from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql import functions as F

from clickforge.operators import category as cat
from clickforge.operators import cross as crs
from clickforge.operators import select as sel
from clickforge.sources import fixture as fx


def test_relational_chi2_picks_like_chisqselector(spark, sf):
    imp = fx.impressions(spark, sf).fillna("deadbeef", subset=["c01", "c03", "c06", "c11"]).cache()
    cols = ["c01", "c03", "c06", "c11"]
    idx = cat.fit_string_index(cat.fit_category_stats(imp, cols))
    offs = cat.feature_offsets(idx, cols)
    g = idx.join(offs, "feature").select("feature", "value", (F.col("offset") + F.col("idx")).alias("gidx"))
    top = sorted(r["gidx"] for r in sel.chi2_top_n(sel.chi2_scores(imp, cols, g), 5).collect())
    enc = cat.encoding_pipeline(cols).fit(imp).transform(imp)
    picked = sel.chi2_selector(5).fit(enc).selectedFeatures
    assert top == sorted(picked)


def test_interaction_order_hand_case(spark):
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    df = spark.createDataFrame([(3.0, 4.0, "b"), (1.0, 1.0, "a")], "x1 double, x2 double, c1 string")
    num = VectorAssembler(inputCols=["x1", "x2"], outputCol="n").transform(df)
    idx = StringIndexer(inputCol="c1", outputCol="i", stringOrderType="alphabetAsc").fit(num).transform(num)
    enc = OneHotEncoder(inputCols=["i"], outputCols=["c"], dropLast=False).fit(idx).transform(idx)
    out = crs.interaction("n", "c", "x").transform(enc).filter("c1 = 'b'").select(vector_to_array("x").alias("x"))
    assert out.first()["x"] == [0.0, 3.0, 0.0, 4.0]


def test_cross_long_matches_interaction(spark):
    df = spark.createDataFrame([(0, 1.5, -2.0, "a"), (1, 0.5, 3.0, "b"), (2, 2.0, 1.0, "a")],
                               "id int, x1 double, x2 double, c1 string")
    idx = cat.fit_string_index(cat.fit_category_stats(df, ["c1"]))
    g = idx.withColumn("gidx", F.col("idx").cast("long"))
    long = {(r["id"], r["cidx"], r["value"]) for r in crs.cross_long(df, ["x1", "x2"], ["c1"], g, 2, ["id"]).collect()}
    num = VectorAssembler(inputCols=["x1", "x2"], outputCol="n").transform(df)
    enc = cat.encoding_pipeline(["c1"], output="c").fit(num).transform(num)
    ml = set()
    for r in crs.interaction("n", "c", "x").transform(enc).select("id", vector_to_array("x").alias("x")).collect():
        ml |= {(r["id"], j, v) for j, v in enumerate(r["x"]) if v}
    assert {t for t in long if t[2]} == ml


def test_feature_hasher_collisions_add_up(spark):
    df = spark.createDataFrame([("a", "b", "c", "d"), ("a", "a", "a", "a")], "s1 string, s2 string, s3 string, s4 string")
    out = crs.feature_hasher(["s1", "s2", "s3", "s4"], 2, "h").transform(df)
    for r in out.select(vector_to_array("h").alias("h")).collect():
        assert len(r["h"]) == 2 and sum(r["h"]) == 4.0


def test_pack_weights(spark):
    df = spark.createDataFrame([(0, Vectors.dense([1.0]), Vectors.sparse(3, [2], [1.0])),
                                (1, Vectors.dense([2.0]), Vectors.sparse(3, [0], [1.0]))],
                               StructType([StructField("label", IntegerType()), StructField("std_features", VectorUDT()),
                                           StructField("cat_features", VectorUDT())]))
    blocks = ["std_features", "cat_features"]
    out = crs.pack(df, blocks, "label", 0.25).collect()
    assert out[0]["features"].toArray().tolist() == [1.0, 0.0, 0.0, 1.0]
    assert [r["weight"] for r in out] == [0.25, 0.75]
    assert crs.vector_width(crs.pack(df, blocks), "features") == 4
