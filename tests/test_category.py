from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickforge.operators import category as cat


def _data(spark):
    rows = [("t", "a")] * 3 + [("t", "b")] * 2 + [("t", "c")] + [("t", None)] + [("v", "a"), ("v", "z"), ("v", None)]
    return spark.createDataFrame([(i, s, v) for i, (s, v) in enumerate(rows)], "id int, subset string, c1 string")


def test_threshold_edge_and_unseen(spark):
    df = _data(spark)
    freq = cat.fit_category_stats(df.filter("subset = 't'"), ["c1"])
    strict = cat.mask_uncommon(df, ["c1"], cat.fit_frequent_values(freq, 2))
    incl = cat.mask_uncommon(df, ["c1"], cat.fit_frequent_values(freq, 2, inclusive=True))
    s = {r["id"]: r["c1"] for r in strict.collect()}
    i = {r["id"]: r["c1"] for r in incl.collect()}
    assert s[0] == "a" and s[3] == "rarebeef" and i[3] == "b"      # count == min: masked unless inclusive
    assert s[6] is None and s[9] is None                            # NULL stays NULL
    assert s[8] == "rarebeef"                                       # unseen in train


def test_shuffle_path_equals_broadcast_path(spark):
    df = _data(spark)
    fr = cat.fit_frequent_values(cat.fit_category_stats(df.filter("subset = 't'"), ["c1"]), 1)
    a = {tuple(r) for r in cat.mask_uncommon(df, ["c1"], fr).collect()}
    b = {tuple(r) for r in cat.mask_uncommon(df, ["c1"], fr, broadcast_bytes=0, partitions=2).collect()}
    assert a == b


def test_relational_index_equals_string_indexer(spark):
    df = _data(spark).fillna("deadbeef", subset=["c1"])
    train = df.filter("subset = 't'")
    rel = {r["value"]: r["idx"] for r in cat.fit_string_index(cat.fit_category_stats(train, ["c1"])).collect()}
    model = cat.encoding_pipeline(["c1"], output="v").fit(train)
    labels = model.stages[0].labelsArray[0]
    assert {v: i for i, v in enumerate(labels)} == rel
    # unseen value -> all-zero block of the same width
    out = model.transform(df).select("id", vector_to_array("v").alias("v")).collect()
    width = {len(r["v"]) for r in out}
    assert width == {len(rel)}
    assert [sum(r["v"]) for r in out if r["id"] == 8] == [0.0]


def test_one_hot_long_matches_ml(spark):
    df = _data(spark).fillna("deadbeef", subset=["c1"])
    train = df.filter("subset = 't'")
    idx = cat.fit_string_index(cat.fit_category_stats(train, ["c1"]))
    long = {(r["id"], r["gidx"]) for r in cat.one_hot_long(df, ["c1"], idx, ["id"]).collect()}
    model = cat.encoding_pipeline(["c1"], output="v").fit(train)
    ml = set()
    for r in model.transform(df).select("id", vector_to_array("v").alias("v")).collect():
        ml |= {(r["id"], j) for j, x in enumerate(r["v"]) if x}
    assert long == ml


def test_salted_shuffle_join_path(spark):
    """No broadcast at all: the salted sort-merge path must give the broadcast result."""
    rows = [(i, "hot" if i % 3 else f"v{i % 7}") for i in range(300)] + [(1000 + i, None) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, c1 string")
    fr = cat.fit_frequent_values(cat.fit_category_stats(df, ["c1"]), 20)
    expect = {tuple(r) for r in cat.mask_uncommon(df, ["c1"], fr).collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = cat.mask_uncommon(df, ["c1"], fr, broadcast_bytes=0, partitions=2)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        got = {tuple(r) for r in salted.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in plan
    assert got == expect


def test_distributed_index_equals_single_window(spark):
    from pyspark.sql import Window
    rows = [("c1", f"v{i}", (i * 37) % 11 + 1) for i in range(400)] + [("c2", f"w{i}", i % 3 + 1) for i in range(150)]
    freq = spark.createDataFrame(rows, "feature string, value string, counts long")
    w = Window.partitionBy("feature").orderBy(F.col("counts").desc(), F.col("value").asc())
    expect = {tuple(r) for r in freq.withColumn("idx", F.row_number().over(w) - 1).collect()}
    got = {tuple(r) for r in cat.fit_string_index(freq, partitions=7).collect()}
    assert got == expect


def test_salted_one_hot_join_equals_broadcast(spark):
    rows = [(i, "hot" if i % 4 else f"v{i % 9}") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, c1 string")
    stats = cat.fit_category_stats(df, ["c1"])
    idx = cat.fit_string_index(stats, partitions=3)
    expect = {tuple(r) for r in cat.one_hot_long(df, ["c1"], idx, ["id"]).collect()}
    hot = cat.hot_values(stats, 400, 4)
    assert [r["value"] for r in hot.collect()] == ["hot"]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got_df = cat.one_hot_long(df, ["c1"], idx, ["id"], broadcast_bytes=0, hot_keys=hot)
        got = {tuple(r) for r in got_df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == expect
