"""What the library leaves on disk: its writes are packed and drop their shuffles' files."""

import time

from pyspark.sql import functions as F

from clickforge.operators import category as cat
from clickforge.operators import cross as crs
from clickforge.operators import evaluate as ev
from clickforge.operators import sparse, svm
from clickforge.session import LEAN
from clickforge.sources import files


def _shuffles(spark) -> set[str]:
    """Files of shuffles on this machine's disk."""
    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (kept.apply(i).getName() for i in range(kept.size())) if f.startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    """Files that came since ``before`` and stay (they are removed in the background)."""
    for _ in range(50):
        left = _shuffles(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_a_write_keeps_no_shuffle_and_gives_the_settings_back(spark, tmp_path):
    before, settings = _shuffles(spark), {k: spark.conf.get(k, None) for k in LEAN}
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("k"))
    files.write_table(rows.repartition(5, "id").groupBy("k").agg(F.sum("id").alias("s")), f"{tmp_path}/t")
    assert not _left(spark, before)
    assert {k: spark.conf.get(k, None) for k in LEAN} == settings
    assert all(".zstd." in p.name for p in (tmp_path / "t").glob("part-*"))
    assert {r.k: r.s for r in spark.read.parquet(f"{tmp_path}/t").collect()} == {k: sum(range(k, 5000, 7)) for k in range(7)}


def test_a_ranking_keeps_no_shuffle_of_its_scores(spark):
    before = _shuffles(spark)
    rows = spark.createDataFrame([("a", 0.1, 0), ("a", 0.5, 1), ("a", 0.5, 0), (None, 0.9, 1), (None, 0.2, 0)], "g string, s double, label int")
    auc = ev.rank_auc(rows, "s", by=["g"], partitions=3)
    assert not _left(spark, before)
    assert {r.g: r.auc for r in auc.collect()} == {"a": 0.75, None: 1.0}


def _shuffled(df) -> bool:
    return "Exchange hash" in df._jdf.queryExecution().executedPlan().toString()


def test_values_are_found_in_sorted_arrays_whatever_their_bytes(spark):
    texts = ["", "a", "a\0", "a\0\0", "\u00e9", "z" * 40, "b", None]
    table = spark.createDataFrame([(t, i, 10 * i) for i, t in enumerate(texts) if t not in ("b", "a\0\0")], "value string, p int, q long")
    rows = spark.createDataFrame([(t,) for t in texts + ["z" * 41, "z" * 39, "\u00e9\0", "a\x01"]], "c string").repartition(3)
    got = {r.c: r.at for r in rows.select("c", cat.looked_up(table, "c", ["p", "q"]).alias("at")).collect()}
    want = {t: (i, 10 * i) for i, t in enumerate(texts) if t not in ("b", "a\0\0", None)}
    assert {c: tuple(at) for c, at in got.items() if at is not None} == want and len(got) == 12
    none = rows.select(cat.looked_up(table.limit(0), "c", ["p"]).alias("at")).where("at is not null")
    assert none.count() == 0


def test_features_beyond_the_broadcast_budget_need_no_shuffle(spark):
    rows = spark.createDataFrame([(i, f"v{i % 90}", None if i % 5 == 0 else f"w{i % 3}") for i in range(900)], "id int, a string, b string")
    stats = cat.fit_category_stats(rows, ["a", "b"])
    layout = cat.fit_layout(stats, ["a", "b"], 2)
    frequent = cat.fit_frequent_values(stats, 5)
    limit = 90 * 22  # the 90 values as arrays; as a broadcast table they take 51 bytes each
    made = [lambda b: cat.mask_uncommon(rows, ["a", "b"], frequent, broadcast_bytes=b),
            lambda b: cat.encode_places(rows, ["a", "b"], layout, "id", broadcast_bytes=b),
            lambda b: cat.one_hot_long(rows, ["a", "b"], layout, ["id"], broadcast_bytes=b)]
    for make in made:
        small, large = make(limit), make(cat.BROADCAST_BYTES)
        assert small.dtypes == large.dtypes
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    table = spark.createDataFrame(layout.collect(), layout.schema)
    assert not _shuffled(cat.encode_places(rows, ["a", "b"], table, "id", broadcast_bytes=limit))
    assert not _shuffled(cat.one_hot_long(rows, ["a", "b"], table, ["id"], broadcast_bytes=limit))


def test_exports_are_packed_and_read_back_the_same(spark, tmp_path):
    rows = spark.createDataFrame([(i % 2, i, float(i) if i % 3 else None, f"t{i % 4}" if i % 5 else None) for i in range(4000)],
                                 "label int, id int, x double, c string").repartition(2)
    files.write_tsv(rows, f"{tmp_path}/tsv", header=True)
    files.write_tsv(rows, f"{tmp_path}/plain", header=True, compression="none")
    size = {n: sum(p.stat().st_size for p in (tmp_path / n).glob("part-*")) for n in ("tsv", "plain")}
    assert 3 * size["tsv"] < size["plain"]
    assert sorted(map(str, files.read_tsv(spark, f"{tmp_path}/tsv", rows.schema, header=True).collect())) == sorted(map(str, rows.collect()))
    two = rows.select("label", sparse.vector(sparse.numeric_entries(["id", "x"]), 2, "a"), sparse.vector(sparse.numeric_entries(["label"]), 1, "b"))
    packed = crs.sparse_pack(two, ["a", "b"], ml=True)
    files.write_table(crs.sparse_pack(two, ["a", "b"]), f"{tmp_path}/structs")
    want = sparse.read_vectors(spark, f"{tmp_path}/structs")
    assert packed.schema["features"] == want.schema["features"] and crs.vector_width(packed, "features") == 3
    files.write_libsvm(packed, f"{tmp_path}/libsvm")
    assert all(p.name.endswith(".gz") for p in (tmp_path / "libsvm").glob("part-*"))
    back = files.read_libsvm(spark, f"{tmp_path}/libsvm", 3)
    text = lambda df: sorted(str((float(r.label), r.features)) for r in df.collect())
    assert text(back) == text(want)


def test_crossed_places_are_stored_as_differences(spark, tmp_path):
    rows = spark.range(3000).select("id", F.expr("transform(sequence(0, 59), k -> cast(k * 100003 + (id * 7919) % 9973 as int))").alias("places"))
    one = rows.select("id", sparse.one_hot_vector("places", 7_000_000, "v")).coalesce(1)
    files.write_table(one, f"{tmp_path}/plain")
    files.write_table(one, f"{tmp_path}/crossed", crossed=True)
    size = {n: sum(p.stat().st_size for p in (tmp_path / n).glob("part-*")) for n in ("plain", "crossed")}
    assert 2 * size["crossed"] < size["plain"]
    plain, crossed = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("plain", "crossed"))
    assert crossed.schema == plain.schema and crossed.exceptAll(plain).isEmpty() and crossed.count() == 3000


def test_sgd_points_have_partitions_for_the_cores(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 2).alias("label"), sparse.vector(sparse.numeric_entries(["id"]), 1, "a"))
    files.write_libsvm(crs.sparse_pack(rows.repartition(40), ["a"], ml=True), f"{tmp_path}/points", compressed=False)
    sc = spark.sparkContext
    points = sc._jvm.org.apache.spark.mllib.util.MLUtils.loadLibSVMFile(sc._jsc.sc(), f"{tmp_path}/points", 1)
    kept = svm._kept(spark, points)
    assert points.getNumPartitions() >= 40 and kept.getNumPartitions() <= svm.PARTS_A_CORE * sc.defaultParallelism < 40
    assert kept.count() == 200
    kept.unpersist(False)
