"""Limits from the data: judged junk goes, clean documents stay, at every length class."""
from clickforge.llm.queries import QUERIES


def test_junk_recall_and_clean_kept(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null")
    rows = QUERIES["op5_quality_rules"](spark, sf).where("not base_failed").join(labels, "doc_id").select("n_words", "kept", "quality").collect()

    def rejected(quality, low, high=10 ** 9):
        found = [not r.kept for r in rows if r.quality == quality and low <= r.n_words < high]
        return sum(found) / len(found)

    assert rejected(0, 200) >= 0.95 and rejected(0, 100, 200) >= 0.9 and rejected(0, 50, 100) >= 0.4
    assert rejected(1, 50) <= 0.005 and rejected(1, 200) <= 0.002
