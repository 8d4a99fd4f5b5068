"""Alignment of two tokenizers by pointer jumping over overlapping tokens.

Both token sequences cover the same bytes. Every token points to the farthest-right token that overlaps it (of the
other sequence, or itself; where two tokens end at the same byte, to the first tokenizer's). Doubling the pointers,
``next = next[next]`` over all tokens of many texts at once, converges in log2 of the longest chain to the last
token of every connected component: the label of a group.

Texts are encoded once and their ids are written. A pass over the ids counts, for every pair of ids, the texts that
hold it linked; a second pass scores every text with these counts. The pair counts are broadcast if they fit a byte
budget, else the texts' distinct pairs join them by a shuffle.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import id_and_text, keep

#: Pair counts up to this many bytes (24 a pair) are broadcast.
COUNT_BYTES = 64 << 20
#: Distinct pairs that a task holds before it hands their counts on; tokens of one run of texts; rows written at once.
HELD, RUN_TOKENS, ROWS = 1 << 20, 1 << 17, 256

#: The split of the byte-level tokenizer (a fixed value of its vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken
        with open(byte_path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, special = byte_of_char(), {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        # merges are ranked by id, and strings of special tokens are plain text here
        self.a = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        n = self.b.get_piece_size()
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Ids of both, packed; none where either's bytes are not the text behind one space."""
        if not text:
            return b"", b""
        whole = " " + text
        a, b, raw = self.a.encode_ordinary(whole), self.b.encode(text, num_threads=1), whole.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return b"", b""
        return np.array(a, width_of(self.a_size)).tobytes(), np.array(b, width_of(self.b_size)).tobytes()


def width_of(sizes: np.ndarray) -> np.dtype:
    """The type that holds the ids of a vocabulary: two bytes where they do."""
    return np.dtype("<u2" if len(sizes) <= 1 << 16 else "<u4")


def _encoded(byte_path: str, piece_path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(byte_path, piece_path)
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                part = batch.slice(start, ROWS)
                found = [pair.encode(x.as_py() or "") for x in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array([f[k] for f in found], pa.binary()) for k in (0, 1))], names=["doc_id", "a", "b"])
    return encode


class Aligned:
    """Tokens of a run of texts: ids, links and group labels. ``text_a`` / ``text_b`` give each token's text."""

    def __init__(self, a: np.ndarray, b: np.ndarray, text_a: np.ndarray, text_b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray):
        self.a, self.b, self.text_a, self.text_b = a, b, text_a, text_b
        # both sequences of a text cover the same bytes, so running offsets over all texts agree at every text's end
        end_a, end_b = np.cumsum(a_size[a]), np.cumsum(b_size[b])
        self.first = np.searchsorted(end_b, end_a - a_size[a], "right")  # B tokens that overlap an A token:
        self.last = np.searchsorted(end_b, end_a, "left")                # from first to last
        n, m = len(a), len(b)
        far = np.empty(n + m, np.int64)
        far[:n] = np.where(end_b[self.last] > end_a, n + self.last, np.arange(n))
        back = np.searchsorted(end_a, end_b, "left")
        far[n:] = np.where(end_a[back] >= end_b, back, n + np.arange(m))
        while True:
            jumped = far[far]
            if (jumped == far).all():
                break
            far = jumped
        self.group_a, self.group_b = far[:n], far[n:]  # labelled by the place of the group's last A token

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the A and the B token of every link."""
        many = self.last - self.first + 1
        at = np.repeat(np.arange(len(self.a)), many)
        return at, np.repeat(self.first, many) + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)


def unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of packed ids, and where each row's begin and the last one's end."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0]: ends[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw.view(kind), (ends - ends[0]) // kind.itemsize


def runs_of(batches: Iterator[pa.RecordBatch], a_size: np.ndarray, b_size: np.ndarray) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Runs of rows of about RUN_TOKENS tokens (a longer text is a run of its own)."""
    for batch in batches:
        if not len(batch):
            continue
        sides = [unpacked(batch.column(c), width_of(size)) for c, size in (("a", a_size), ("b", b_size))]
        start, off = 0, sides[0][1]
        while start < len(batch):
            stop = max(start + 1, int(np.searchsorted(off, off[start] + RUN_TOKENS, "right")) - 1)
            token = [ids[o[start]: o[stop]].astype(np.int64) for ids, o in sides]
            text = [np.repeat(np.arange(stop - start), np.diff(o[start: stop + 1])) for _, o in sides]
            yield batch.slice(start, stop - start), Aligned(*token, *text, a_size, b_size)
            start = stop


def _pair_counts(a_size: np.ndarray, b_size: np.ndarray):
    """(a, b, texts of this task that hold the pair)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def handed():
            return pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(counts)], names=["a", "b", "n"])

        for rows, run in runs_of(batches, a_size, b_size):
            at, to = run.links()
            own, code = np.unique((run.a[at] << 32) | run.b[to], return_inverse=True)
            n = np.bincount(np.unique(code * len(rows) + run.text_a[at]) // len(rows), minlength=len(own))
            keys, back = np.unique(np.concatenate([keys, own]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
            if len(keys) >= HELD:
                yield handed()
                keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield handed()
    return count


class Speller:
    """``a1,a2|b1;a3|b2,b3`` for every text: each id with the mark behind it is looked up, then all are joined."""

    def __init__(self, a_ids: int, b_ids: int):
        self.b_from = 2 * a_ids
        self.words = [f"{i}{m}" for i in range(a_ids) for m in ",|"] + [f"{i}{m}" for i in range(b_ids) for m in ",;"]

    def groups(self, run: Aligned, texts: int) -> list[str]:
        cut_a = np.append(run.group_a[1:] != run.group_a[:-1], True)[: len(run.a)]
        cut_b = np.append(run.group_b[1:] != run.group_b[:-1], True)[: len(run.b)]
        # two ascending runs merge: by group, its A tokens first
        order = np.argsort(np.concatenate([2 * run.group_a, 2 * run.group_b + 1]), kind="stable")
        code = np.concatenate([2 * run.a + cut_a, self.b_from + 2 * run.b + cut_b])[order].tolist()
        words = list(map(self.words.__getitem__, code))
        ends = np.searchsorted(np.concatenate([run.text_a, run.text_b])[order], np.arange(texts + 1)).tolist()
        return ["".join(words[x:y])[:-1] for x, y in zip(ends[:-1], ends[1:])]


NUMBERS = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
DIGEST = ", ".join(f"{c} long" for c in NUMBERS) + ", groups_sha256 string"


def _digests(a_size: np.ndarray, b_size: np.ndarray, counts):
    """Digest columns of every text; ``counts``: broadcast (sorted pair codes, counts, is best), or None: n_best and count_sum are null."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(len(a_size), len(b_size))
        for rows, run in runs_of(batches, a_size, b_size):
            n = len(rows)
            at, to = run.links()
            text = run.text_a[at]
            ends = np.flatnonzero(run.group_a == np.arange(len(run.a)))  # a group's last A token
            cols = [np.bincount(x, minlength=n) for x in (run.text_a, run.text_b, run.text_a[ends], text)]
            if counts is None:
                cols += [pa.nulls(n, pa.int64())] * 2
            else:
                codes, size, best = counts.value
                place = np.searchsorted(codes, (run.a[at] << 32) | run.b[to])
                cols.append(np.bincount(text[best[place]], minlength=n))
                cols.append(np.add.reduceat(np.append(size[place], 0), np.searchsorted(text, np.arange(n))) * (cols[3] > 0))
            sha = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in speller.groups(run, n)]
            cols = [rows.column("doc_id"), rows.column("row"), *(x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in cols)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sha, pa.string())], names=[*NUMBERS, "groups_sha256"])
    return digest


def _linked(a_size: np.ndarray, b_size: np.ndarray):
    """(row, a, b, links): the distinct linked pairs of every text."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, run in runs_of(batches, a_size, b_size):
            at, to = run.links()
            text, code = run.text_a[at], (run.a[at] << 32) | run.b[to]
            order = np.lexsort((code, text))
            text, code = text[order], code[order]
            first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (code[1:] != code[:-1]))[: len(code)])
            many = np.diff(np.append(first, len(code)))
            row = rows.column("row").to_numpy()[text[first]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (row, code[first] >> 32, code[first] & 0xFFFFFFFF, many)], names=["row", "a", "b", "links"])
    return pairs


def pair_counts(tokens: DataFrame, a_size: np.ndarray, b_size: np.ndarray) -> DataFrame:
    """(a, b, n, best): the texts that hold the ids linked, and whether n is the largest of its a."""
    counts = keep(tokens.mapInArrow(_pair_counts(a_size, b_size), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "align-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def encode_documents(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a, b, row: the packed ids of both tokenizers for every row (written); ``row`` numbers the rows."""
    found = id_and_text(docs, id_col, text_col).mapInArrow(_encoded(byte_path, piece_path), "doc_id long, a binary, b binary")
    return keep(found.withColumn("row", F.monotonically_increasing_id()), "align-tokens")


def align_tokenizers(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
                     count_bytes: int = COUNT_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``.

    A text is encoded behind one space by a byte-level (``byte_path``) and a piece tokenizer (``piece_path``). Null and
    empty texts, and those whose tokens do not spell the text, have no tokens: zeros and ''. Every row is a text of its
    own, also where a doc_id repeats or is null; extra columns are ignored; no rows give no rows.
    """
    pair = Pair(byte_path, piece_path)
    a_size, b_size = pair.a_size, pair.b_size
    tokens = encode_documents(docs, byte_path, piece_path, id_col, text_col)
    counts = keep(pair_counts(tokens, a_size, b_size), "align-best")
    if 24 * counts.count() <= count_bytes:
        table = counts.toArrow()  # at most count_bytes
        codes = (table["a"].to_numpy() << 32) | table["b"].to_numpy()
        order = np.argsort(codes)
        known = docs.sparkSession.sparkContext.broadcast((codes[order], table["n"].to_numpy()[order], table["best"].to_numpy(zero_copy_only=False).astype(bool)[order]))
        return tokens.mapInArrow(_digests(a_size, b_size, known), DIGEST).drop("row")
    linked = tokens.mapInArrow(_linked(a_size, b_size), "row long, a long, b long, links long").join(counts, ["a", "b"])
    scores = linked.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                                       F.sum(F.col("links") * F.col("n")).alias("count_sum"))
    plain = tokens.mapInArrow(_digests(a_size, b_size, None), DIGEST).drop("n_best", "count_sum")
    zero = F.lit(0).cast("long")
    return plain.join(scores, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                                                    F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
