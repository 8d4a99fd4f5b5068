"""Near embeddings against brute force over all pairs."""
import numpy as np
import pytest

from clickforge.llm import vector_dup
from clickforge.llm.queries import QUERIES


def brute(rows, threshold=0.95):
    """Sorted (vec_id, n_links, component_id, kept) of (vec_id, vector) rows."""
    ok = [i is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v in rows]
    unit = [np.array(v, float) / np.abs(v).max() / np.linalg.norm(np.array(v, float) / np.abs(v).max()) if k else None for (_, v), k in zip(rows, ok)]
    mates = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(len(rows))]
    low = [i for i, _ in rows]
    while True:
        new = [min([low[i], *(low[j] for j in mates[i])]) if ok[i] else low[i] for i in range(len(rows))]
        if new == low:
            break
        low = new
    return sorted((-1 if i is None else i, len(m), -1 if c is None else c, c == i) for (i, _), m, c in zip(rows, mates, low))


def found(df, **more):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id, r.kept)
                  for r in vector_dup.near_vectors(df, **more).collect())


def planted(rng, n, d, groups):
    """Vectors with groups of near copies (some exact) around the threshold."""
    x = rng.normal(size=(n, d))
    for _ in range(groups):
        at = rng.choice(n, rng.integers(2, 12), replace=False)
        x[at] = x[at[0]] + rng.normal(size=(len(at), d)) * rng.choice([0, 0.1, 0.2, 0.25]) * rng.uniform(0.5, 1.5)
    return x


@pytest.mark.parametrize("n, d", [(400, 64), (250, 40)])
def test_links_against_brute_force(spark, n, d):
    rng = np.random.default_rng(n)
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(rng.permutation(n), planted(rng, n, d, 40))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    assert found(df) == brute(rows)


def test_tiles_against_all_products():
    """The bounds lose no pair, on scattered rows and where most pairs are links."""
    rng = np.random.default_rng(1)
    for spread in (1.0, 0.1, 0.02):
        x = vector_dup.unit_rows(rng.normal(size=(1, 48)) * (spread < 1) + spread * planted(rng, 1500, 48, 100))
        turned = x @ np.linalg.eigh(x.T @ x)[1][:, ::-1]
        whole, cut = vector_dup.Rows(x, turned), [vector_dup.Rows(x[:700], turned[:700]), vector_dup.Rows(x[700:], turned[700:])]
        want = x @ x.T >= 0.95
        got = np.zeros_like(want)
        for i, j in vector_dup.tile_links(whole, whole, 0.95):
            got[whole.order[i], whole.order[j]] = True
        assert ((got | got.T) == (want & ~np.eye(len(x), dtype=bool))).all() and not (got & got.T).any()
        got = np.zeros((700, 800), bool)
        for i, j in vector_dup.tile_links(cut[0], cut[1], 0.95):
            got[cut[0].order[i], cut[1].order[j]] = True
        assert (got == want[:700, 700:]).all()


def test_forest_keeps_the_components():
    rng = np.random.default_rng(8)
    label, i, j = np.arange(60), rng.integers(0, 60, 70), rng.integers(0, 60, 70)
    done, x, y = vector_dup.joining(label, i, j)
    assert len(x) == 60 - len(set(done)) and all(done[i] == done[j])
    again = np.arange(60)
    for p, q in zip(x, y):
        again[again == again[p]] = again[q]
    assert len(set(again)) == len(set(done)) and all(again[i] == again[j])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]),
            (9, [1.0, 0.0]), (9, [0.0, 1.0]), (9, [0.0, 1.0]), (None, [1.0, 0.0]), (10, [1e-300, 0.0]), (11, [1e300, 1e299]), (12, [1.0, 0.0, 0.0]),
            (13, [-0.0, 3.0]), (14, [0.0, 3.0]), (15, [-1.0, 0.0])]
    df = spark.createDataFrame([r + ("x", 5) for r in rows], "vec_id long, embedding array<double>, node string, copies int")
    assert found(df) == brute(rows)
    assert vector_dup.near_vectors(df.where("vec_id = 3 or vec_id = 5")).count() == 2
    assert vector_dup.near_vectors(df.limit(0)).count() == 0


def test_blocks_do_not_matter(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    few = {tuple(r) for r in vector_dup.near_vectors(df, threshold=0.35).collect()}
    many = {tuple(r) for r in vector_dup.near_vectors(df, threshold=0.35, block_bytes=16384).collect()}
    assert few == many and sum(r[1] for r in few) > 100
    assert QUERIES["op13_embedding_near_duplicates"](spark, sf).count() == df.count()
