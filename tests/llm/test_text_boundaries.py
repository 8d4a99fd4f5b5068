"""Neighbouring rows of a batch never make a leak together, and a batch's rows do not matter."""
import random

from clickforge.llm import decontam


def test_a_passage_split_over_two_rows_is_no_leak(spark, sf):
    rnd = random.Random(11)
    items = [(r.item_id, r.text.strip()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    index = decontam.Index([(i, decontam.fold(t)[0]) for i, t in items])
    texts = []
    for _ in range(60):
        _, t = rnd.choice(items)
        cut = rnd.randrange(36, 61)
        texts += [f"something else entirely {rnd.random()} " + t[:cut].rstrip(), t[cut: cut + rnd.randrange(28, 36)].lstrip() + f" and {rnd.random()} so on"]
    texts += [f"{t[:-3]}" for _, t in items[:10]] + ["", "short", items[3][1] + " " + items[4][1]]
    rnd.shuffle(texts)

    def found(run):
        return {(k, item) for k, item, *_ in index.regions(run)}

    alone = {(k, item) for k, t in enumerate(texts) for _, item in found([t])}
    assert found(texts) == alone and alone
    for size in (2, 7):
        parts = {(s + k, item) for s in range(0, len(texts), size) for k, item in found(texts[s: s + size])}
        assert parts == alone


def test_a_column_named_leaks_stays(spark, sf, odd):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    out = decontam.without_leaks(odd, bench)
    assert out.columns == odd.columns and out.schema["leaks"].dataType == odd.schema["leaks"].dataType
    assert sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))
