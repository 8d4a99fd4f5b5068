"""Sparse vectors as plain columns: assembling, outer products and packing without attribute lists.

A vector is its storage struct ``(type, size, indices, values)``. Its width is one number in the column's metadata
(``num_attrs``), so a schema or a Parquet footer has the same size whatever the width. Everything here is built of
array expressions; a written table is read back as ML vectors by :func:`read_vectors` for the ML stages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def _entry(i: Column, v: Column) -> Column:
    return F.struct(i.cast("int").alias("i"), v.cast("double").alias("v"))


def numeric_entries(cols: list[str]) -> Column:
    """array<(i, v)> of the non-zero values of numeric columns, in order; NULL is kept as NaN."""
    value = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols]
    return F.filter(F.array(*[_entry(F.lit(k), v) for k, v in enumerate(value)]), lambda e: e["v"] != 0)


def one_hot_entries(places: str | Column) -> Column:
    """array<(i, 1.0)> of an ascending array of places."""
    return F.transform(places, lambda i: _entry(i, F.lit(1.0)))


def vector_entries_of(vector: str | Column) -> Column:
    """array<(i, v)> of the non-zero entries of a storage struct (sparse or dense)."""
    v = F.col(vector) if isinstance(vector, str) else vector
    stored = F.when(v["type"] == 0, F.zip_with(v["indices"], v["values"], _entry)) \
        .otherwise(F.transform(v["values"], lambda x, i: _entry(i, x)))
    return F.filter(stored, lambda e: e["v"] != 0)


def outer(left: Column, right: Column, right_width: int) -> Column:
    """Entries of the outer product (E9): place i * right_width + j, value a_i * b_j; only stored entries meet."""
    return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: _entry(a["i"] * right_width + b["i"], a["v"] * b["v"]))))


def side_by_side(blocks: list[tuple[Column, int]]) -> tuple[Column, int]:
    """Entries and width of several blocks packed one behind the other."""
    def moved(entries: Column, by: int) -> Column:
        return F.transform(entries, lambda e: _entry(e["i"] + by, e["v"])) if by else entries

    parts, at = [], 0
    for entries, width in blocks:
        parts.append(moved(entries, at))
        at += width
    return F.concat(*parts), at


def picked(entries: Column, places: list[int]) -> tuple[Column, int]:
    """Entries at the given ascending places, renumbered from 0 (E8 apply); ``places`` is a top-N list."""
    kept = F.array(*[F.lit(int(p)) for p in places])
    return F.transform(F.filter(entries, lambda e: F.array_contains(kept, e["i"])),
                       lambda e: _entry(F.array_position(kept, e["i"]) - 1, e["v"])), len(places)


#: Rows and places of one dense tile (2 MB of doubles).
TILE_ROWS, TILE_PLACES = 64, 4096


def dense_sums(df: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """(keep..., width, mass, places): every vector made dense (E15), with the sum of its values and of value x place.

    ``vector`` is a storage struct. The dense rows are made in tiles, so a task holds one tile whatever the width, and
    the arithmetic runs over all rows x width places. A NULL vector gives NULLs.
    """
    width = width_of(df, vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = np.zeros((TILE_ROWS, TILE_PLACES))
        for batch in batches:
            lists = batch.column("__e")
            at, entries = lists.offsets.to_numpy(), lists.values
            place, value = (entries.field(k).to_numpy(zero_copy_only=False) for k in ("i", "v"))
            mass, places = np.zeros(len(batch)), np.zeros(len(batch))
            for first in range(0, len(batch), TILE_ROWS):
                ends = at[first: first + TILE_ROWS + 1]
                rows, mine = len(ends) - 1, slice(ends[0], ends[-1])
                order = np.argsort(place[mine], kind="stable")
                p, v, r = place[mine][order], value[mine][order], np.repeat(np.arange(rows), np.diff(ends))[order]
                cuts = np.searchsorted(p, np.arange(0, width + TILE_PLACES, TILE_PLACES))
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    start, wide = k * TILE_PLACES, min(TILE_PLACES, width - k * TILE_PLACES)
                    dense = tile[:rows, :wide]
                    dense[r[a:b], p[a:b] - start] = v[a:b]
                    mass[first: first + rows] += dense.sum(axis=1)
                    places[first: first + rows] += np.einsum("ij,j->i", dense, np.arange(start, start + wide, dtype=float))
                    dense[r[a:b], p[a:b] - start] = 0.0
            empty = lists.is_null().to_numpy(zero_copy_only=False)
            sums = [pa.array(np.full(len(batch), width), pa.int32(), mask=empty), pa.array(mass, mask=empty), pa.array(places, mask=empty)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *sums], names=[*keep, "width", "mass", "places"])

    rows = df.select(*keep, vector_entries_of(vector).alias("__e"))
    schema = "".join(f"`{c}` {t}, " for c, t in df.select(*keep).dtypes)
    return rows.mapInArrow(run, f"{schema}width int, mass double, places double")


def vector(entries: Column, width: int, name: str) -> Column:
    """A named storage struct of ``width`` with the width as its only attribute."""
    if not 0 <= width < 1 << 31:
        raise ValueError(f"a vector of {width} places does not fit 32-bit indices; use the long form")
    struct = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(width).alias("size"),
                      F.transform(entries, lambda e: e["i"]).alias("indices"), F.transform(entries, lambda e: e["v"]).alias("values"))
    return struct.alias(name, metadata={"ml_attr": {"num_attrs": width}})


def one_hot_vector(places: str, width: int, name: str) -> Column:
    """:func:`vector` of :func:`one_hot_entries` without building the entries: an ascending array of places, each 1.0."""
    at = F.col(places).cast("array<int>")
    struct = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(width).alias("size"), at.alias("indices"),
                      F.array_repeat(F.lit(1.0), F.size(at)).alias("values"))
    return struct.alias(name, metadata={"ml_attr": {"num_attrs": width}})


def stored(v: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries of every row, places, values) of the non-zero entries of storage structs, all rows behind one another."""
    kind, _, indices, values = v.flatten()
    counts = pc.list_value_length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    value, place = (a.flatten().to_numpy(zero_copy_only=False) for a in (values, indices))
    if len(place) < len(value):  # dense rows hold no places
        at = np.arange(len(value)) - np.repeat(np.cumsum(counts) - counts, counts)
        at[np.repeat(kind.fill_null(1).to_numpy(zero_copy_only=False) == 0, counts)] = place
        place = at
    kept = value != 0
    if not kept.all():
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[kept], minlength=len(counts))
        place, value = place[kept], value[kept]
    return counts, place.astype(np.int64), value


def _by_batch(combine: Callable, vectors: list[str], width: int, name: str, ml: bool = False) -> Column:
    """A storage struct, or with ``ml`` an ML vector, made of storage structs a batch at a time.

    ``combine`` gets (entries of every row, places, values) of each vector's non-zero entries, all rows behind one
    another, and returns the same of the result. A row with a NULL vector has NULL entries.
    """
    if not 0 <= width < 1 << 31:
        raise ValueError(f"a vector of {width} places does not fit 32-bit indices; use the long form")

    def run(*given: pa.Array) -> pa.Array:
        counts, place, value = combine([stored(v) for v in given])
        rows, offsets = len(counts), np.concatenate([[0], np.cumsum(counts)])
        lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(a, t)) for a, t in ((place, pa.int32()), (value, pa.float64()))]
        nulls = np.logical_or.reduce([v.flatten()[3].is_null().to_numpy(zero_copy_only=False) for v in given])
        if nulls.any():
            lists = [pc.if_else(pa.array(nulls), pa.scalar(None, a.type), a) for a in lists]
        return pa.StructArray.from_arrays([pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, width, np.int32)), *lists],
                                          names=["type", "size", "indices", "values"])

    struct = F.arrow_udf(run, VectorUDT() if ml else "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>")
    return struct(*[F.col(v) for v in vectors]).alias(name, metadata={"ml_attr": {"num_attrs": width}})


def crossed(left: str, right: str, left_width: int, right_width: int, name: str) -> Column:
    """:func:`vector` of the :func:`outer` product of two storage structs, a batch at a time."""
    def combine(given):
        (n, i, v), (m, j, w) = given
        row = np.repeat(np.arange(len(n)), n)
        times = m[row]  # how many right entries every left entry meets
        own = np.repeat(np.arange(len(i)), times)
        other = np.arange(len(own)) - np.repeat(np.cumsum(times) - times, times) + np.repeat((np.cumsum(m) - m)[row], times)
        return n * m, i[own] * right_width + j[other], v[own] * w[other]

    return _by_batch(combine, [left, right], left_width * right_width, name)


def packed(blocks: list[tuple[str, int]], name: str, ml: bool = False) -> Column:
    """:func:`vector` (with ``ml`` an ML vector) of :func:`side_by_side` blocks (storage struct, width), a batch at a time."""
    firsts = np.cumsum([0, *[width for _, width in blocks]]).tolist()

    def combine(given):
        total = sum(n for n, _, _ in given)
        free = np.cumsum(total) - total
        place, value = np.zeros(int(total.sum()), np.int64), np.zeros(int(total.sum()))
        for first, (n, i, v) in zip(firsts, given):
            at = np.arange(len(i)) + np.repeat(free - (np.cumsum(n) - n), n)
            place[at], value[at] = i + first, v
            free = free + n
        return total, place, value

    return _by_batch(combine, [c for c, _ in blocks], firsts[-1], name, ml)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """A written table whose storage structs with a width come back as ML vectors (same metadata)."""
    fields = [StructField(f.name, VectorUDT(), True, f.metadata) if isinstance(f.dataType, StructType) and "ml_attr" in f.metadata else f
              for f in spark.read.parquet(path).schema.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def width_of(df: DataFrame, col: str) -> int:
    """The width that :func:`vector` put into the schema."""
    return int(df.schema[col].metadata["ml_attr"]["num_attrs"])
