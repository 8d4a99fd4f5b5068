"""Lines that repeat across documents, found with two Bloom filters.

Pass 1 marks every line key of a document in a task's own *once* filter, or in its *twice* filter when the key
was already there; the tasks' filters merge by chunks (a bit that two tasks have both seen once counts as
twice). Pass 2 tests every key against the merged twice filter: only suspected repeats are shuffled, grouped
by their 128-bit digest, and confirmed when two documents hold them. Pass 3 rebuilds the texts.

The filter has a fixed size (``filter_bits``), which bounds the broadcast and the workers' memory. A fuller
filter lets more lines through to the confirmation; it never loses a repeat, so results do not depend on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickforge.llm.common import CHUNKS, Bits, id_and_text, keep, merge_chunk, pack_chunk, text_runs

FILTER_BITS = 1 << 27
MIN_CHARS = 10
SPACES = b" \t\n\v\f\r"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The stripped, A-Z lower-cased line, or None when it has fewer than ``min_chars`` code points."""
    key = line.strip(SPACES).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def _run_keys(raw: np.ndarray, offsets: np.ndarray, min_chars: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct keys of each row of a run, their 64-bit hashes and the number of keys per row."""
    data, keys, counts = raw.tobytes(), [], []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        own = {line_key(x, min_chars) for x in data[lo:hi].split(b"\n")}
        own.discard(None)
        keys += own
        counts.append(len(own))
    return keys, np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)), np.array(counts)


def _task_filters(bits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Bits(bits), Bits(bits)
        for _, raw, offsets in text_runs(batches):
            _, hashes, _ = _run_keys(raw, offsets, min_chars)
            hashes, n = np.unique(hashes, return_counts=True)
            twice.add(hashes[(n > 1) | once.has(hashes)])
            once.add(hashes)
        size = bits // 8 // CHUNKS
        for c in range(CHUNKS):
            part = once.data[c * size: (c + 1) * size]
            if part.any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([c], pa.int32()), "once": [pack_chunk(part)],
                                                  "twice": [pack_chunk(twice.data[c * size: (c + 1) * size])]})
    return run


def _merged_filters(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                c = row["chunk"]
                for d in (once, twice):
                    d.setdefault(c, np.zeros(bits // 8 // CHUNKS, np.uint8))
                at, new = merge_chunk(once[c], row["once"])
                twice[c][at] |= once[c][at] & new
                once[c][at] |= new
                at, new = merge_chunk(twice[c], row["twice"])
                twice[c][at] |= new
        for c, data in twice.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([c], pa.int32()), "bits": [data.tobytes()]})
    return run


def _suspects(twice, bits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Bits(bits, np.frombuffer(twice.value, np.uint8))
        for rows, raw, offsets in text_runs(batches):
            keys, hashes, counts = _run_keys(raw, offsets, min_chars)
            hit = np.flatnonzero(seen.has(hashes))
            ids = rows.column("doc_id").take(pa.array(np.repeat(np.arange(len(counts)), counts)[hit]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([xxhash.xxh3_128_digest(keys[i]) for i in hit], pa.binary())], names=["doc_id", "line"])
    return run


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                   filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, line digest) of every line that a smaller doc_id also holds."""
    text = id_and_text(docs, id_col, text_col).where("doc_id is not null and text is not null")
    filters = text.select("text").mapInArrow(_task_filters(filter_bits, min_chars), "chunk int, once binary, twice binary")
    merged = filters.repartition(CHUNKS, "chunk").mapInArrow(_merged_filters(filter_bits), "chunk int, bits binary")
    size = filter_bits // 8 // CHUNKS
    whole = bytearray(filter_bits // 8)
    for row in merged.toLocalIterator():  # filter_bits in all, however large the input
        whole[row.chunk * size: (row.chunk + 1) * size] = row.bits
    twice = docs.sparkSession.sparkContext.broadcast(bytes(whole))
    suspects = keep(text.mapInArrow(_suspects(twice, filter_bits, min_chars), "doc_id long, line binary"), "line-suspects")
    firsts = suspects.groupBy("line").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    firsts = keep(firsts.drop("last"), "line-firsts")  # so that Spark can split a very common line in the join
    return suspects.join(firsts, "line").where("doc_id > first").select("doc_id", "line").distinct()


_REBUILT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])


@F.pandas_udf(_REBUILT)
def _rebuild(text: pd.Series, drop: pd.Series) -> pd.DataFrame:
    rows = []
    for t, lines in zip(text, drop):
        if lines is None:
            rows.append((t, 1 + (t or "").count("\n"), 0))
            continue
        gone, all_lines = {bytes(x) for x in lines}, t.split("\n")
        kept = [x for x in all_lines if (k := line_key(x.encode())) is None or xxhash.xxh3_128_digest(k) not in gone]
        rows.append(("\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with their texts freed of repeated lines, and a column ``lines`` (struct text, n_lines, n_dropped).

    A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` and lower-cased in A-Z. Keys of at least ten code
    points that two documents hold keep their lines only in the smallest doc_id (all of them there, also in each
    row that repeats that doc_id). A null text counts as one empty line and stays null; an empty text is one
    empty line. Rows with a null doc_id are left alone and count nowhere. Other columns pass through.
    """
    gone = repeated_lines(docs, id_col, text_col).groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_list("line").alias("__gone"))
    out = docs.join(gone, docs[id_col].cast("long") == gone["__doc"], "left")
    out = out.withColumn("lines", _rebuild(docs[text_col], F.col("__gone")))
    return out.withColumn(text_col, F.col("lines.text")).drop("__doc", "__gone")
