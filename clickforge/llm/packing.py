"""Sum-of-squares packing of tokenised documents into fixed windows.

A document of n ids fills ``n // window`` windows by itself; its remainder goes, online, to the fill level
that minimises the sum of squared counts of partially filled windows. An array holds the number of open
windows per level, so one placement looks at the open levels only. Every task packs its own rows: no shuffle,
and memory holds the open windows (at most ``max_open``; when there are more, or at the end, the emptiest are
cut up to fill the fullest, which leaves at most one partly filled window).
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clickforge.llm.common import RUN_BYTES, id_and_text

WINDOW = 2048
MAX_OPEN = 4096
END_ID = 1
#: Entries of one generation of the cache of encoded pieces.
CACHE = 300_000

# The tokenizer's own split, spelled out for lower-cased Latin-1 text, which its normaliser leaves as it is.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                     "|[^\t-\r \x85\xa0a-z0-9\xaa\xb5\xba\xdf-\xf6\xf8-\xff\xb2\xb3\xb9\xbc-\xbe]+")
_WIDE = re.compile("[^\x00-\xff]")


class PieceEncoder:
    """Ids of a text through a cache of its pieces (two generations, so memory is bounded).

    The tokenizer cuts a text into pieces that never cross white space and encodes each by itself. Texts of
    Latin-1 characters are cut here and their unknown pieces encoded together; any other text, and one that
    may spell a special token, goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, wanted: set[str]) -> None:
        if len(self.new) + len(wanted.difference(self.new)) > CACHE:
            self.old, self.new = self.new, {}
        missing = []
        for p in wanted.difference(self.new):
            ids = self.old.get(p)
            if ids is None:
                missing.append(p)
            else:
                self.new[p] = ids
        for k in range(0, len(missing), 1000):
            part = missing[k: k + 1000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            data, at = ids.tobytes(), 0
            if len(cuts) != len(part):  # a piece without an end mark of its own: one by one
                self.new.update((p, self.direct(p)) for p in part)
                continue
            for p, cut in zip(part, cuts):
                self.new[p] = data[at:cut]
                at = cut

    def batch(self, texts: list[str]) -> list[bytes]:
        split = [None if _WIDE.search(t) or "<|" in t else _PIECES.findall(t.lower()) for t in texts]
        found = [self.direct(t) if pieces is None else self._known(pieces) for t, pieces in zip(texts, split)]
        missed = [k for k, ids in enumerate(found) if ids is None]
        if missed:  # only texts with a piece not met before need the set of their pieces
            self._learn(set().union(*(split[k] for k in missed)))
            for k in missed:
                found[k] = self._known(split[k])
        return found

    def _known(self, pieces: list[str]) -> bytes | None:
        try:
            return b"".join(map(self.new.__getitem__, pieces))
        except KeyError:
            return None


class SumOfSquares:
    """Open windows by fill level; closed ones are handed to ``close(pieces)``.

    A piece is (document, start, ids as bytes, ids of the whole document).
    """

    def __init__(self, close, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.close, self.window, self.max_open = close, window, max_open
        self.count = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = defaultdict(list)
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The level (0: a new window) whose filling by ``size`` gives the least sum of squared counts; ties: the fullest."""
        n = self.count
        levels = np.flatnonzero(n[1: self.window - size + 1]) + 1
        if not len(levels):
            return 0
        to = n[levels + size]
        cost = np.where(levels + size == self.window, 1 - 2 * n[levels], 2 * (to - n[levels]) + 2)
        best = len(cost) - 1 - int(np.argmin(cost[::-1]))
        return int(levels[best]) if size == self.window or cost[best] <= 2 * n[size] + 1 else 0

    def place(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        level = self.level_for(size)
        pieces = self.open[level].pop() if level else []
        pieces.append(piece)
        self.count[level] -= bool(level)
        self.n_open += not level
        level += size
        if level == self.window:
            self.n_open -= 1
            self.close(pieces)
        else:
            self.count[level] += 1
            self.open[level].append(pieces)
            if self.n_open > self.max_open:
                self.settle()

    def add(self, doc, ids: bytes) -> None:
        n, step = len(ids) // 4, 4 * self.window
        whole = len(ids) // step * step
        for k in range(0, whole, step):
            self.close([(doc, k // 4, ids[k: k + step], n)])
        if whole < len(ids):
            self.place((doc, whole // 4, ids[whole:], n))

    def settle(self) -> None:
        """Cut up the emptiest windows to fill the fullest; the last one stays partly filled."""
        left = [[level, pieces] for level in sorted(self.open, reverse=True) for pieces in self.open[level]]
        self.open.clear()
        self.count[:] = 0
        self.n_open = 0
        i, j = 0, len(left) - 1
        while i < j:
            gap, (doc, start, ids, n) = self.window - left[i][0], left[j][1].pop()
            take = min(gap, len(ids) // 4)
            left[i][1].append((doc, start, ids[: 4 * take], n))
            if 4 * take < len(ids):
                left[j][1].append((doc, start + take, ids[4 * take:], n))
            left[i][0] += take
            left[j][0] -= take
            if left[i][0] == self.window:
                self.close(left[i][1])
                i += 1
            if not left[j][0]:
                j -= 1
        if i == j and left[i][0]:
            self.close(left[i][1])


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_ENCODERS: dict[str, PieceEncoder] = {}


def _packer(path: str, window: int, max_open: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, PieceEncoder(path))
        rows: list[tuple] = []
        sequence = TaskContext.get().partitionId() << 40

        def close(pieces):
            nonlocal sequence
            at = 0
            for doc, start, ids, n in pieces:
                rows.append((doc, start, len(ids) // 4, ids, n, sequence, at))
                at += len(ids) // 4
            sequence += 1

        def out():
            cols = list(zip(*rows)) or [()] * 7
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if k == 3 else pa.int64()) for k, c in enumerate(cols)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        packer = SumOfSquares(close, window, max_open)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(ids):
                part, size = [], 0
                while at + len(part) < len(ids) and (not part or size < RUN_BYTES):
                    part.append(texts[at + len(part)].as_py() or "")
                    size += len(part[-1])
                for doc, x in zip(ids[at: at + len(part)], encoder.batch(part)):
                    packer.add(doc, x + end)
                at += len(part)
                yield out()
        packer.settle()
        yield out()
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, max_open: int = MAX_OPEN,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    Every document ends with id 1, so a null or empty text is one id; every id lies in exactly one piece. Rows
    that repeat a document are packed each. A null doc_id stays null. Sequence ids are unique, not gapless: the
    task's number, then a counter. The rows of a task are packed in their order, so equal partitions give
    equal results; other columns are ignored.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(_packer(tokenizer_path, window, max_open), PIECES)
