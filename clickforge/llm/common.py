"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.session import scratch_path

#: Work is cut into runs of rows of about this many text bytes (a longer text is a run of its own).
RUN_BYTES = 1 << 20

MIX_1, MIX_2, GOLDEN = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_POWERS = np.ones(1, dtype=np.uint64)


def load(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; other columns cannot clash."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) over an array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * GOLDEN)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, 4096) - 1, GOLDEN | np.uint64(1)), dtype=np.uint64)])
    return _POWERS


def text_runs(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, utf-8 bytes, row offsets into them) for runs of rows of about RUN_BYTES; a null text has no bytes."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        if col.null_count:
            col = col.fill_null("")
        if not pa.types.is_large_string(col.type):
            col = col.cast(pa.large_string())
        if not len(col):
            continue
        _, off, data = col.buffers()
        off = np.frombuffer(off, np.int64)[col.offset: col.offset + len(col) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        start = 0
        while start < len(col):
            stop = max(start + 1, int(np.searchsorted(off, off[start] + RUN_BYTES, "right")) - 1)
            yield batch.slice(start, stop - start), raw[off[start]: off[stop]], off[start: stop + 1] - off[start]
            start = stop


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUE = seeded(256, 11)


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, per row, its first word (n rows + 1 entries)."""
    word = ~_SPACE[raw]
    n = len(raw)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    starts = np.flatnonzero(word & (first[:n] | ~np.concatenate([[False], word[:-1]]))) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(word & (first[1:] | ~np.concatenate([word[1:], [False]]))) + 1 if n else np.zeros(0, np.int64)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of every word (A-Z lower-cased first)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    first = np.cumsum(length) - length
    inner = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
    at = inner + np.repeat(starts, length)
    with np.errstate(over="ignore"):
        values = _BYTE_VALUE[_LOWER[raw[at]] if lower else raw[at]]
        values *= powers(int(length.max()))[inner]
        return mix64(np.add.reduceat(values, first) + length.astype(np.uint64))


def as_long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == np.uint64 else a, pa.int64())


#: Parts in which a filter travels and merges.
CHUNKS = 64


class Bits:
    """A Bloom filter of two probes over a byte array."""

    def __init__(self, bits: int, data: np.ndarray | None = None):
        self.mask = np.uint64(bits - 1)
        self.data = np.zeros(bits // 8, np.uint8) if data is None else data

    def probes(self, hashes: np.ndarray):
        for p in (hashes & self.mask, (hashes >> np.uint64(31)) & self.mask):
            yield (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for at, bit in self.probes(hashes):
            np.bitwise_or.at(self.data, at, bit)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at, bit in self.probes(hashes):
            found &= (self.data[at] & bit) != 0
        return found


def pack_chunk(chunk: np.ndarray) -> bytes:
    """The bytes that are not zero with their places, or the whole chunk where that is shorter."""
    at = np.flatnonzero(chunk)
    if len(at) * 5 >= len(chunk):
        return chunk.tobytes()
    return at.astype(np.uint32).tobytes() + chunk[at].tobytes()


def merge_chunk(into: np.ndarray, packed: bytes) -> tuple[np.ndarray | slice, np.ndarray]:
    """Places and bytes of a packed chunk."""
    data = np.frombuffer(packed, np.uint8)
    if len(data) == len(into):
        return slice(None), data
    n = len(data) // 5
    return np.frombuffer(packed, np.uint32, n), data[4 * n:]


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected ``edges`` (a, b).

    Large-star / small-star rounds: every round points each node's larger neighbours at the smallest node
    it knows, and halves the depth. Edges live in checkpoints; the driver only sees a count and a checksum.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().checkpoint()
    seen = None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        e = small.select("x.*").where("a <> b").distinct().checkpoint()
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
