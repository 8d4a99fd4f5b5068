"""Near-duplicate documents by MinHash bands and odd sketches.

A document is its set of distinct five-word shingles. 128 MinHash samples give 32 bands of 4 (candidates)
and, folded by parity into a 512-bit odd sketch, an estimate of the similarity: the XOR of two sketches has
about ``256 * (1 - exp(-4 * 128 * (1 - J) / 512))`` set bits. Candidates whose sketches differ in more than
``MAX_ODD_BITS`` bits (five standard deviations beyond the 57 bits expected at J = 0.75) are dropped, the
others are confirmed on the full sets.

Pairs are never expanded inside a group:

* equal sets collapse into one class before banding;
* every band bucket links its members with its smallest member only (a star);
* buckets that still hold several components form clusters, compared in blocks of bounded weight that emit
  only confirmed links joining different components (a spanning forest).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickforge.llm.common import GOLDEN, components, id_and_text, keep, mix64, seeded, text_runs, word_hashes, word_spans

WORDS = 5
SAMPLES, BANDS, ROWS = 128, 32, 4
ODD_BITS, MAX_ODD_BITS = 512, 108
PERCENT = 75
#: Shingles (8 bytes each) of a cluster that one block of the last comparison holds.
BLOCK_SHINGLES = 1 << 18

_SEEDS = seeded(SAMPLES, 21) | np.uint64(1)
_SHIFTS = seeded(SAMPLES, 22)
_PLACE = seeded(WORDS, 23) | np.uint64(1)
_BAND_PLACE = (seeded(SAMPLES, 24) | np.uint64(1)).reshape(BANDS, ROWS)
_ODD_SALT = seeded(SAMPLES, 25)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Per row: the sorted distinct shingle hashes; fewer than five words make one shingle, none an empty set."""
    starts, ends, first = word_spans(raw, offsets)
    words = word_hashes(raw, starts, ends)
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            runs += words[k: k + len(runs)] * _PLACE[k]
        runs = mix64(runs)
        for lo, hi in zip(first[:-1], first[1:]):
            n = int(hi - lo)
            if n >= WORDS:
                yield np.unique(runs[lo: hi - WORDS + 1])
            elif n:
                yield mix64((words[lo:hi] * _PLACE[:n]).sum(keepdims=True) + np.uint64(n) * GOLDEN)
            else:
                yield np.zeros(0, np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """128 samples: the smallest value of the set under each of 128 multiplicative hashes."""
    low = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(shingles), 1024):
            x = shingles[k: k + 1024, None] * _SEEDS
            x += _SHIFTS
            np.minimum(low, x.min(axis=0), out=low)
    return low


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """(n, 128) samples to (n, 8) words of 64 parity bits."""
    n = len(samples)
    with np.errstate(over="ignore"):
        bit = (mix64(samples + _ODD_SALT) >> np.uint64(55)).astype(np.int64)
    odd = np.bincount((np.arange(n)[:, None] * ODD_BITS + bit).ravel(), minlength=n * ODD_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, ODD_BITS), axis=1).view(np.uint64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (samples.reshape(-1, BANDS, ROWS) * _BAND_PLACE).sum(axis=2)
        return mix64(x + np.arange(BANDS, dtype=np.uint64) * GOLDEN)


FEATURES = "doc_id long, n_shingles long, set_1 long, set_2 long, odd array<long>, bands array<long>"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, raw, offsets in text_runs(batches):
        sets = list(shingle_sets(raw, offsets))
        samples, n = np.array([minhash(s) for s in sets]), len(sets)
        odd, bands = odd_sketches(samples).view(np.int64), band_keys(samples).view(np.int64)

        def lists(x):
            return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))

        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *set_keys(sets), lists(odd), lists(bands)],
            names=["doc_id", "n_shingles", "set_1", "set_2", "odd", "bands"])


def set_keys(sets: list[np.ndarray]) -> list[pa.Array]:
    """A 128-bit digest of each set as two columns."""
    keys = np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets], np.int64).reshape(-1, 2)
    return [pa.array(keys[:, 0]), pa.array(keys[:, 1])]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, raw, offsets in text_runs(batches):
        sets = list(shingle_sets(raw, offsets))
        ends = np.cumsum([0, *map(len, sets)], dtype=np.int64).astype(np.int32)
        shingles = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *set_keys(sets), shingles], names=["doc_id", "set_1", "set_2", "shingles"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their set's size and digest."""
    for rows, raw, offsets in text_runs(batches):
        sets = list(shingle_sets(raw, offsets))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([len(s) for s in sets], pa.int64()), *set_keys(sets)],
                                         names=[*rows.schema.names, "n", "own_1", "own_2"])


def odd_distance(a: str, b: str):
    """Set bits of the XOR of two sketches (array<long> columns)."""
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(1, ODD_BITS // 64)),
               F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def _block_links(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
    """Confirmed links between documents of different components, within a block or across two."""
    _, p, q = key
    odd = np.stack(table["odd"].to_numpy()).view(np.uint64)
    sets = table["shingles"].to_list()
    node, block = table["node"].to_numpy(), table["block"].to_numpy()
    size = np.array([len(s) for s in sets])
    _, root = np.unique(table["component"].to_numpy(), return_inverse=True)
    found = []
    for i in range(len(table) - 1):
        near = np.bitwise_count(odd[i + 1:] ^ odd[i]).sum(axis=1) <= MAX_ODD_BITS
        near &= (root[i + 1:] != root[i]) & (100 * np.minimum(size[i + 1:], size[i]) >= PERCENT * np.maximum(size[i + 1:], size[i]))
        if p != q:
            near &= block[i + 1:] != block[i]
        for j in np.flatnonzero(near) + i + 1:
            if root[i] != root[j]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= PERCENT * (size[i] + size[j] - both):
                    root[root == root[j]] = root[i]
                    found.append((node[i], node[j]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _grouped(text: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_1, set_2, component (a number of its own), component_id of every row of (doc_id, text)."""
    feats = keep(text.mapInArrow(_features, FEATURES), "near-features")
    real = feats.where("n_shingles > 0 and doc_id is not null")
    # a class has a number of its own: two classes may share their smallest doc_id where ids repeat.
    # Kept, so that Spark can split the rows of a set that very many documents share when it joins them back
    classes = keep(real.groupBy("set_1", "set_2").agg(F.min("doc_id").alias("first")).withColumn("node", F.monotonically_increasing_id()), "near-sets-seen")
    same = (real.set_1 == classes.set_1) & (real.set_2 == classes.set_2) & (real.doc_id == classes["first"])
    reps = keep(real.join(classes, same).select("node", "odd", "bands").dropDuplicates(["node"]), "near-classes")

    buckets = reps.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last")
    members = keep(buckets.join(shared.drop("last"), "bucket"), "near-buckets")
    sources = members.select("node").distinct()
    wanted = keep(classes.join(sources, "node", "left_semi"), "near-wanted")
    # a sort-merge join at every size, so that small inputs show what large ones cost
    near = text.join(wanted.select("first").distinct().hint("merge"), text.doc_id == F.col("first"), "left_semi").mapInArrow(
        _sets, "doc_id long, set_1 long, set_2 long, shingles array<long>")
    same = (near.set_1 == wanted.set_1) & (near.set_2 == wanted.set_2) & (near.doc_id == wanted["first"])
    sets = keep(near.join(wanted, same).select("node", "shingles").dropDuplicates(["node"]), "near-sets")
    sketch = reps.join(sources, "node", "left_semi").select("node", "odd")

    star = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    star = (star.join(sketch.select(F.col("node").alias("a"), F.col("odd").alias("odd_a")), "a")
            .join(sketch.select(F.col("node").alias("b"), F.col("odd").alias("odd_b")), "b")
            .where(odd_distance("odd_a", "odd_b") <= MAX_ODD_BITS).select("a", "b").distinct())
    both = F.size(F.array_intersect("set_a", "set_b"))
    star = keep(star.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
                .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
                .where(100 * both >= PERCENT * (F.size("set_a") + F.size("set_b") - both)).select("a", "b"), "near-star")
    first = keep(components(star), "near-first")

    # buckets with several components left: cluster their components, compare the members in blocks
    named = members.join(first, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    named = keep(named.join(mixed.drop("high"), "bucket").select("node", "component", "low").distinct(), "near-mixed")
    clusters = components(named.select(F.col("component").alias("a"), F.col("low").alias("b"))) \
        .select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    # the smallest component of a cluster has no entry of its own
    left = (named.select("node", "component").distinct().join(clusters, "component", "left")
            .join(sketch, "node").join(sets, "node"))
    left = keep(left.select(F.coalesce("cluster", "component").alias("cluster"), "component", "node", "odd", "shingles"), "near-left")
    weight = left.groupBy("cluster").agg(F.ceil(F.sum(F.size("shingles") + 64) / BLOCK_SHINGLES).cast("int").alias("blocks"))
    left = left.join(weight, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = left.select("cluster", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
                       "block", "component", "node", "odd", "shingles")
    rest = left.groupBy("cluster", "p", "q").applyInPandas(_block_links, "a long, b long")

    # merge the components that the last links join
    first_a = first.select(F.col("node").alias("a"), F.col("component").alias("x"))
    first_b = first.select(F.col("node").alias("b"), F.col("component").alias("y"))
    rest = keep(rest.join(first_a, "a", "left").join(first_b, "b", "left")
                .select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")), "near-rest")
    merged = components(rest).select(F.col("node").alias("top"), F.col("component").alias("merged"))
    final = keep(first.select("node", F.col("component").alias("top")).unionByName(
        merged.join(first, merged.top == first.node, "left_anti").select(F.col("top").alias("node"), "top"))
        .join(merged, "top", "left").select("node", F.coalesce("merged", "top").alias("component")), "near-components")

    named = classes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = keep(named, "near-named")
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = keep(named.join(lowest, "component").select("set_1", "set_2", "component", "component_id"), "near-lowest")
    row = feats.select("doc_id", "n_shingles", *[F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col(c)).alias(c) for c in ("set_1", "set_2")])
    return row.join(named, ["set_1", "set_2"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, for every row of ``docs``.

    Two documents are linked when 100 * |A and B| >= 75 * |A or B| over their shingle sets; component_id is the
    smallest doc_id reachable, kept marks it. A null or wordless text has an empty set and no links. Each row of
    a doc_id that occurs more than once is grouped by its own text. A null doc_id links nothing (component null,
    kept true). Extra columns are ignored.
    """
    return _grouped(id_and_text(docs, id_col, text_col)).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near duplicates, with its columns: of those with the smallest doc_id, the set of smallest digest.

    Rows without words or without a doc_id all stay. Rows are told apart by id and text, so a repeated id loses no
    text of its own, and a row repeated as a whole stays once.
    """
    rows = keep(_grouped(id_and_text(docs, id_col, text_col)).where("doc_id is not null"), "near-rows")
    own = rows.where("set_1 is not null and doc_id = component_id").groupBy("component", "doc_id", "set_1", "set_2").agg(F.count("*").alias("copies"))
    stays = own.groupBy("component").agg(F.min(F.struct("doc_id", "set_1", "set_2", "copies")).alias("s")).select("s.*")
    stays = keep(stays, "near-stays")
    counts = stays.groupBy("doc_id").agg(F.count("*").alias("staying"), F.sum("copies").alias("copies"))
    ids = rows.groupBy("doc_id").agg(F.count("set_1").alias("sets"), F.count("*").alias("n")).join(counts, "doc_id", "left")
    # an id's rows stay or go together, but where it repeats: only then its rows are looked at again
    whole = F.when((F.col("sets") == 0) | (F.col("staying") == F.col("sets")), "stays") \
        .when(F.col("staying").isNull() & (F.col("sets") == F.col("n")), "goes").otherwise("mixed")
    ids = keep(ids.select("doc_id", whole.alias("whole")).where("whole <> 'stays'"), "near-ids")
    key = docs[id_col].cast("long")
    out = docs.join(ids.select("doc_id").hint("merge"), key == ids.doc_id, "left_anti")
    mixed = ids.where("whole = 'mixed'")
    if mixed.isEmpty():
        return out
    packed = docs.select(key.alias("doc_id"), docs[text_col].cast("string").alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    packed = packed.join(mixed, "doc_id", "left_semi")
    found = packed.mapInArrow(_digested, T.StructType([*packed.schema.fields, T.StructField("n", T.LongType()), T.StructField("own_1", T.LongType()),
                                                       T.StructField("own_2", T.LongType())]))
    one = found.join(stays, (found.doc_id == stays.doc_id) & (found.own_1 == stays.set_1) & (found.own_2 == stays.set_2), "left_semi")
    one = one.where("n > 0").dropDuplicates(["doc_id", "own_1", "own_2"])
    return out.unionByName(found.where("n = 0").unionByName(one).select("row.*"))
