"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Equal vectors collapse into one class. The classes are dealt into blocks of bounded bytes, and every pair of
blocks is one group. Inside a group the unit vectors are turned to the principal axes of the group's rows, so
that the leading dimensions hold most of every product. Two rows are compared over the leading ``LEAD``
dimensions first: their product so far plus the product of the norms of what is left bounds the cosine, and
only pairs whose bound reaches the threshold see more dimensions (twice as many each time) and at last the
whole product, in double precision and in the original axes. The bound of a tile of rows is one small matrix
product, with the suffix norm as one more dimension.

No pair leaves a group: it returns the number of links of each row and a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import components, keep

THRESHOLD = 0.95
#: A block holds at most about this many bytes of vectors; there are at least MIN_BLOCKS, for parallel work.
BLOCK_BYTES, MIN_BLOCKS = 32 << 20, 12
#: Rows of a tile, leading dimensions of the first bound, and the room for rounding in the float32 bounds.
TILE, LEAD, SLACK = 1024, 16, 1e-5
#: From this share of surviving pairs on, a tile is multiplied as a whole.
DENSE = 0.02


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 (scaled by their largest component first, so that no square overflows)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Rows:
    """Unit rows in tiles, with their bounds over more and more leading principal dimensions."""

    def __init__(self, unit: np.ndarray, turned: np.ndarray):
        self.order = np.argsort(turned[:, 0], kind="stable")
        self.unit, turned = unit[self.order], turned[self.order]
        rest = np.sqrt(np.maximum(0, np.cumsum((turned ** 2)[:, ::-1], axis=1)[:, ::-1]))
        self.stages, k = [], LEAD
        while not self.stages or k < unit.shape[1]:
            left = rest[:, k:k + 1] if k < unit.shape[1] else np.zeros((len(unit), 1))
            self.stages.append(np.concatenate([turned[:, :k], left], axis=1).astype(np.float32))
            k *= 2
        self.tiles = [slice(s, min(s + TILE, len(unit))) for s in range(0, len(unit), TILE)]
        self.low = [turned[t].min(axis=0) for t in self.tiles]
        self.high = [turned[t].max(axis=0) for t in self.tiles]


def tile_links(p: Rows, q: Rows, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in p, in q) of linked rows, tile by tile; with ``p is q`` each pair once."""
    apart = 2 - 2 * threshold + SLACK
    for a, s in enumerate(p.tiles):
        for b, t in enumerate(q.tiles):
            gap = np.maximum(0, np.maximum(p.low[a] - q.high[b], q.low[b] - p.high[a]))
            if (p is q and b < a) or (gap ** 2).sum() > apart:  # unit rows that far apart have a smaller cosine
                continue
            near = p.stages[0][s] @ q.stages[0][t].T >= threshold - SLACK
            if p is q and a == b:
                near &= np.arange(near.shape[0])[:, None] < np.arange(near.shape[1])
            if np.count_nonzero(near) > DENSE * near.size:
                i, j = np.nonzero(near & (p.unit[s] @ q.unit[t].T >= threshold))
                i, j = i + s.start, j + t.start
            else:
                i, j = np.nonzero(near)
                i, j = i + s.start, j + t.start
                for x, y in [*zip(p.stages[1:], q.stages[1:])]:
                    left = np.einsum("ij,ij->i", x[i], y[j]) >= threshold - SLACK
                    i, j = i[left], j[left]
                left = np.einsum("ij,ij->i", p.unit[i], q.unit[j]) >= threshold
                i, j = i[left], j[left]
            if len(i):
                yield i, j


def joining(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels after the links (i, j), places of the links that joined two labels)."""
    used, at = [], np.arange(len(i))
    while True:
        a, b = label[i[at]], label[j[at]]
        at, a, b = at[a != b], a[a != b], b[a != b]
        if not len(at):
            return label, i[used], j[used]
        high, first = np.unique(np.maximum(a, b), return_index=True)  # each label hooks to one smaller label
        used += at[first].tolist()
        to = np.arange(len(label))
        to[high] = np.minimum(a, b)[first]
        while (to[to] != to).any():
            to = to[to]
        label = to[label]


LINKS = "a long, b long, links long"


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _block_links(threshold: float):
    def compare(key: tuple, table: pa.Table) -> pa.Table:
        """(node, null, its links) for rows with links, and (a, b, null) for the links that join the rows' groups."""
        p, q = key[1].as_py(), key[2].as_py()
        unit = unit_rows(_matrix(table.column("vector")))
        node, copies, block = (table.column(c).to_numpy() for c in ("node", "copies", "block"))
        axes = np.linalg.eigh(unit.T @ unit)[1][:, ::-1]
        turned = unit @ axes
        at = [np.flatnonzero(block == p), np.flatnonzero(block == q)]
        rows = [Rows(unit[x], turned[x]) for x in at[: 1 if p == q else 2]]
        places = [x[r.order] for x, r in zip(at, rows)]
        links, label, forest = np.zeros(len(node), np.int64), np.arange(len(node)), []
        for i, j in tile_links(rows[0], rows[-1], threshold) if len(at[0]) and len(at[1]) else ():
            i, j = places[0][i], places[-1][j]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            label, x, y = joining(label, i, j)
            forest.append((node[x], node[y]))
        some = np.flatnonzero(links)
        a = np.concatenate([node[some], *(x for x, _ in forest)])
        b = np.concatenate([y for _, y in forest]) if forest else np.zeros(0, np.int64)
        return pa.table({"a": pa.array(a, pa.int64()),
                         "b": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(b, pa.int64())]),
                         "links": pa.concat_arrays([pa.array(links[some]), pa.nulls(len(b), pa.int64())])})
    return compare


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """vec_id, n_links, component_id, kept, for every row of ``vectors``.

    Rows are linked when the cosine of their vectors is at least ``threshold`` (over 0). Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do vectors of different lengths. Every
    row of a repeated vec_id is a vector of its own; component_id is the smallest vec_id reachable. A null vec_id
    links nothing (component null, kept true). Extra columns are ignored; no rows give no rows.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    sound = F.coalesce(sound & F.col("vec_id").isNotNull(), F.lit(False))
    classes = rows.where(sound).groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    classes = keep(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")

    size = classes.agg(F.sum(8 * F.size("vector").cast("long"))).first()[0] or 0
    blocks = max(MIN_BLOCKS, -(-size // block_bytes))
    dealt = classes.select(F.size("vector").alias("width"), "node", "copies", "vector", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(int(blocks) - 1))))
    dealt = dealt.select("width", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "node", "copies", "vector")
    found = keep(dealt.groupBy("width", "p", "q").applyInArrow(_block_links(threshold), LINKS), "vector-links")

    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = components(found.where("b is not null").select("a", "b"))
    named = keep(classes.select("node", "first").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node")), "vector-groups")
    first = named.groupBy("component").agg(F.min("first").alias("component_id"))
    # kept, so that Spark can split the rows of a vector that very many rows share
    known = classes.drop("first").join(named.join(first, "component").select("node", "component_id"), "node").join(links, "node", "left")
    known = keep(known.select(F.col("vector").alias("key"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "vector-known")
    out = rows.withColumn("key", F.when(sound, F.col("vector"))).join(known, "key", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
