import duckdb
import pytest

import __spark_entry__ as entry
from clickforge.operators import model as mdl
from clickforge.plans import catalog
from clickforge.plans.fixture_plan import Prepared


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "ctr" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_lr_learns_and_noise_does_not(spark, sf):
    p = Prepared(spark, sf)
    frames = catalog._packed_frames(p)
    res = {r["subset"]: r["auc"] for r in mdl.evaluate(spark, "lr", mdl.logistic(30), frames).collect()}
    assert res["train"] > 0.9 and res["tests"] > 0.85
    assert set(res) == {"train", "tests", "valid"}


def test_shuffled_label_gives_chance_auc(spark, sf):
    from pyspark.sql import functions as F
    p = Prepared(spark, sf)
    frames = {k: v.withColumn("label", (F.rand(7) < 0.25).cast("int")) for k, v in catalog._packed_frames(p).items()}
    res = {r["subset"]: r["auc"] for r in mdl.evaluate(spark, "lr", mdl.logistic(10), frames).collect()}
    assert abs(res["tests"] - 0.5) < 0.1


def test_tree_models_learn(spark, sf):
    frames = catalog._packed_frames(Prepared(spark, sf))
    for name, est in [("tree", mdl.decision_tree()), ("gbt", mdl.gbt(5)), ("svc", mdl.linear_svc(20))]:
        res = {r["subset"]: r["auc"] for r in mdl.evaluate(spark, name, est, frames).collect()}
        assert res["tests"] > 0.8, (name, res)


@pytest.mark.parametrize("name", ["ctr_by_category", "numeric_measurements", "mask_uncommon", "string_index",
                                  "chi2_top_n", "rank_auc", "svm_one_step", "oversample_exact"])
def test_oracle_agrees_at_sf0001(spark, sf, name):
    con = duckdb.connect()
    for t in ["nation", "customer", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = entry.queries()[name](spark, sf)
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    def norm(cols, rows):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted(tuple(round(r[i], 5) if isinstance(r[i], float) else r[i] for i in order) for r in rows)
    assert sorted(df.columns) == sorted(dcols)
    assert norm(df.columns, df.collect()) == norm(dcols, cur.fetchall())
