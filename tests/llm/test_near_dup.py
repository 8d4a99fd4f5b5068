import random
import re

from clickforge.llm import near_dup
from clickforge.llm.near_dup import near_duplicates


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def result(df):
    rows = df.collect()
    assert all(r.kept == (r.component_id == r.doc_id) for r in rows if r.doc_id is not None)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_whole_table_against_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(near_duplicates(docs)) == brute(rows)


def test_group_of_near_copies_with_links_around_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 2000)  # several blocks
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(150)]
    rows = []
    for i in range(120):
        own = list(words)
        for _ in range(rnd.randrange(8)):
            own[rnd.randrange(len(own))] = f"z{rnd.randrange(10 ** 6)}"
        rows.append((i + 1, " ".join(own)))
    assert result(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_odd_input(odd, nothing):
    rows = near_duplicates(odd).collect()
    assert len(rows) == 12
    by = {r.doc_id: r for r in rows}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[3].component_id == 3
    assert by[6].component_id == 5 and not by[6].kept and by[7].n_shingles == 1
    assert by[None].component_id is None and by[None].kept
    assert near_duplicates(nothing).count() == 0


def test_odd_sketch_estimates_high_similarity():
    import numpy as np
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 2 ** 63, 900).astype(np.uint64)
    a, b = (np.concatenate([shared, rng.integers(0, 2 ** 63, 100).astype(np.uint64)]) for _ in range(2))
    odd = near_dup.odd_sketches(np.stack([near_dup.minhash(a), near_dup.minhash(b)]))
    z = int(np.bitwise_count(odd[0] ^ odd[1]).sum())
    estimate = 1 + near_dup.ODD_BITS / (4 * near_dup.SAMPLES) * np.log(1 - 2 * z / near_dup.ODD_BITS)
    assert abs(estimate - 900 / 1100) < 0.12


def test_rows_of_a_repeated_id_are_told_apart(spark):
    """Rows are grouped and dropped by id and text: no text that is its own is lost."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    near_a, near_b = a + " more", "less " + b
    rows = [(1, a), (5, near_a), (5, b), (9, near_b)]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1, True), (5, 1, False), (5, 5, True), (9, 5, False)]

    def stay(rows):
        df = spark.createDataFrame([(i, t, {"k": i}) for i, t in rows], "doc_id long, text string, node map<string,int>").repartition(3)
        out = near_dup.without_near_duplicates(df)
        assert out.columns == df.columns
        return sorted((r.doc_id or 0, r.text or "") for r in out.collect())

    assert stay(rows) == [(1, a), (5, b)]
    assert stay([(1, a), (5, a), (5, c)]) == [(1, a), (5, c)]
    assert stay([(5, b), (5, c), (9, near_b)]) == [(5, b), (5, c)]
    assert stay([(1, a), (1, a), (1, None), (1, ""), (2, near_a), (2, " ")]) == [(1, ""), (1, ""), (1, a), (2, " ")]
    assert stay([(None, a), (None, a), (3, a), (4, a)]) == [(0, a), (0, a), (3, a)]
    one = stay([(1, a), (1, near_a)])
    assert len(one) == 1 and one[0][0] == 1
