"""Benchmark passages in documents, by the q-gram lemma.

A benchmark item is cut into overlapping windows of two sizes: short ones at small steps, so that every run of
at least MIN_RUN characters holds a whole window at any offset, and long ones, whose budget allows more edits in
one place. An occurrence of a window of m characters with at most e
edits shares at least ``m + 1 - q * (e + 1)`` of its q-grams with the document, on diagonals at most e apart.
So shared q-grams are counted in overlapping bands of 2(e + 1) diagonals, first per item (one posting per
q-gram), then per window in the bands that reach the bound, and a banded alignment over each band that still
does gives the true number of edits and the place.

The documents are read once, without a shuffle. The benchmark is the stated query set: it is indexed in blocks
of at most BLOCK_CHARS characters (so every broadcast is bounded) and each block meets every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickforge.llm.common import GOLDEN, RUN_BYTES

Q = 8
#: Characters of a window and between the starts of two.
WINDOWS = ((72, 8), (128, 64))
#: A run of this many characters of an item is found wherever it starts (a shorter item: the whole of it).
MIN_RUN = WINDOWS[0][0] + WINDOWS[0][1] - 1
#: Edits allowed per character, and the least number of shared q-grams that a window's edit budget must leave.
EDIT_RATE, LEAST_SHARED = 0.1, 8
#: Items of fewer characters (letters, digits, single blanks) are too short to tell a leak from chance.
MIN_CHARS = 24
BLOCK_CHARS = 2_000_000
FILTER_BITS = 22
ALIGN_AT_ONCE = 256
_TIE, _FAR = np.int32(1 << 12), np.int32(1 << 28)
_POWER = [np.uint64(pow(int(GOLDEN) | 1, k, 1 << 64)) for k in (1, 2, 4)]


@lru_cache(1)
def _folded() -> np.ndarray:
    """Per code point of the basic plane: lower case for letters and digits, a blank for the rest, 0 for 0."""
    chars = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(1 << 16)]
    low = [c.lower() if c.isalnum() else " " for c in chars]
    table = np.array([ord(x) if len(x) == 1 else c for c, x in enumerate(low)], np.uint32)
    table[0] = 0
    return table


def fold(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points with runs of blanks collapsed, and the place of each in ``text``."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    code = np.where(code < 1 << 16, _folded()[np.minimum(code, 0xFFFF)], code)
    blank = code == 32
    at = np.flatnonzero(~(blank & np.concatenate([[False], blank[:-1]])))
    return code[at], at


def gram_codes(code: np.ndarray) -> np.ndarray:
    """A 64-bit code of each of the overlapping 8-grams."""
    h = code.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k, p in zip((1, 2, 4), _POWER):
            if len(h) <= k:
                return np.zeros(0, np.uint64)
            h = h[:-k] * p + h[k:]
        return h * GOLDEN


def edit_budget(m: int) -> int:
    return max(0, min(int(EDIT_RATE * m), (m + 1 - LEAST_SHARED) // Q - 1))


def _pairs(hit: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (owner, half band), and which of them reach the owner's bound together with the next half band."""
    key, count = np.unique(hit, return_counts=True)
    after = np.zeros(len(key), np.int64)
    follows = np.flatnonzero(key[1:] == key[:-1] + 1)
    after[follows] = count[follows + 1]
    return key, count + after >= bound[key >> 40]


class Index:
    """Windows of some benchmark items with the postings of their q-grams."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.item, self.pattern, start = [], [], []
        none = 1 << 40
        #: Per size of window: diagonals in half a band and the bound of each item's windows; the windows over each posting.
        self.step, self.bound = np.ones((2, len(WINDOWS), len(items)), np.int64) * [[[1]], [[none]]]
        over = [[np.zeros((2, 0), np.int64)] for _ in WINDOWS]
        for k, (item, code) in enumerate(items):
            place = np.arange(max(0, len(code) - Q + 1))
            for c, (size, step) in enumerate(WINDOWS):
                m = min(len(code), size)
                starts = np.array(sorted({*range(0, len(code) - m + 1, step), len(code) - m}) if c == 0 or m > WINDOWS[0][0] else [], np.int64)
                over[c].append(len(start) + np.stack([np.searchsorted(starts, place + Q - m), np.searchsorted(starts, place, "right")]))
                self.item += [item] * len(starts)
                self.pattern += [code[a: a + m] for a in starts]
                start += starts.tolist()
                if len(starts):
                    self.step[c, k], self.bound[c, k] = edit_budget(m) + 1, m + 1 - Q * (edit_budget(m) + 1)
        self.start = np.array(start, np.int64)
        self.length = np.array([len(p) for p in self.pattern], np.int64)
        self.edits = np.array([edit_budget(m) for m in self.length], np.int64)
        self.least = self.length + 1 - Q * (self.edits + 1)
        grams = [gram_codes(code) for _, code in items]
        code = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.code, first = np.unique(code[order], return_index=True)
        self.ends = np.append(first, len(code)).astype(np.int64)
        self.owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, np.int64)])[order]
        self.over = [np.concatenate(x, axis=1)[:, order] for x in over]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.code >> np.uint64(64 - FILTER_BITS)] = True

    def bands(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first diagonal) of every band whose shared q-grams reach the window's bound."""
        none = np.zeros(0, np.int64)
        grams = gram_codes(code)
        at = np.flatnonzero(self.filter[grams >> np.uint64(64 - FILTER_BITS)])
        if not len(at) or not len(self.code):
            return none, none
        k = np.minimum(np.searchsorted(self.code, grams[at]), len(self.code) - 1)
        found = self.code[k] == grams[at]
        at, k = at[found], k[found]
        n = self.ends[k + 1] - self.ends[k]
        post = np.arange(int(n.sum())) + np.repeat(self.ends[k] - (np.cumsum(n) - n), n)
        owner, diagonal = self.owner[post], np.repeat(at, n) - self.place[post]
        found = [(none, none)]
        for step, bound, (low, high) in zip(self.step, self.bound, self.over):
            half = diagonal // step[owner] + (1 << 20)
            hit = (owner << 40) + half
            key, enough = _pairs(hit, bound)
            key = key[enough]
            if not len(key):
                continue
            wanted = np.unique(np.concatenate([key, key + 1]))
            inside = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, hit), len(wanted) - 1)] == hit)
            low, size = low[post[inside]], (high - low)[post[inside]]
            window = np.arange(int(size.sum())) + np.repeat(low - (np.cumsum(size) - size), size)
            key, enough = _pairs((window << 40) + np.repeat(half[inside], size), self.least)
            window = key[enough] >> 40
            half = (key[enough] & ((1 << 40) - 1)) - (1 << 20)
            found.append((window, half * (self.edits[window] + 1) + self.start[window]))
        return np.concatenate([w for w, _ in found]), np.concatenate([d for _, d in found])

    def align(self, code: np.ndarray, window: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least edits of each band's alignment, with the first and last+1 place in ``code`` (the window whole, the text free at both ends)."""
        edits = self.edits[window]
        low = diagonal - edits
        width = int((4 * edits + 3).max())
        m = self.length[window]
        longest = int(m.max())
        pattern = np.zeros((len(window), longest), np.uint32)
        for r, w in enumerate(window):
            pattern[r, : m[r]] = self.pattern[w]
        t = np.arange(width, dtype=np.int32)
        outside = t >= (4 * edits + 3)[:, None]
        mixed = outside.any()
        place = low[:, None] + np.arange(longest + width)
        chars = np.where((place >= 0) & (place < len(code)), code[np.clip(place, 0, len(code) - 1)], 0)
        best = np.where(outside, _FAR, t)
        final = best.copy()
        slope = _TIE * t
        for j in range(longest):
            step = best + _TIE * (chars[:, j: j + width] != pattern[:, j: j + 1])
            step[:, :-1] = np.minimum(step[:, :-1], best[:, 1:] + _TIE)
            step -= slope
            best = np.minimum.accumulate(step, axis=1) + slope
            if mixed:
                best[outside] = _FAR
            ends = m == j + 1
            final[ends] = best[ends]
        pick = final.argmin(axis=1)
        value = final[np.arange(len(window)), pick]
        return value // _TIE, np.maximum(0, low + value % _TIE), np.minimum(len(code), low + pick + m)

    def regions(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) of every window found; places in code points.

        Between two texts stand more characters that match nothing than any budget has edits, so no occurrence spans them.
        """
        gap = int(self.edits.max(initial=0)) + 1
        whole = ("\0" * gap).join(t.replace("\0", " ") for t in texts)
        code, at = fold(whole)
        window, diagonal = self.bands(code)
        starts = np.cumsum([0, *(len(t) + gap for t in texts[:-1])])
        for k in range(0, len(window), ALIGN_AT_ONCE):
            w = window[k: k + ALIGN_AT_ONCE]
            edits, first, last = self.align(code, w, diagonal[k: k + ALIGN_AT_ONCE])
            for r in np.flatnonzero((edits <= self.edits[w]) & (first < last)):
                a, b = int(at[first[r]]), int(at[last[r] - 1]) + 1
                doc = int(np.searchsorted(starts, (a + b - 1) // 2, "right")) - 1
                a, b = max(a, int(starts[doc])), min(b, int(starts[doc]) + len(texts[doc]))
                yield doc, self.item[w[r]], a - int(starts[doc]), b - int(starts[doc]), int(edits[r])


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int, np.ndarray]]]:
    """Folded items in blocks of at most BLOCK_CHARS characters (an item that is longer is a block)."""
    block, size = [], 0
    items = benchmark.select(benchmark[id_col].cast("long").alias("item"), benchmark[text_col].cast("string").alias("text"))
    for row in items.where("text is not null").toLocalIterator():
        code, _ = fold(row.text.strip().replace("\0", " "))
        if len(code) < MIN_CHARS:
            continue
        if block and size + len(code) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row.item, code))
        size += len(code)
    if block:
        yield block


LEAKS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "start", "end", "edits", "windows")]))
_LEAKS = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "edits", "windows")]))


def _finder(index):
    def find(texts: pa.Array) -> pa.Array:
        found: list[dict] = [{} for _ in range(len(texts))]
        row = 0
        while row < len(texts):
            run, size = [], 0
            while row + len(run) < len(texts) and (not run or size < RUN_BYTES):
                run.append(texts[row + len(run)].as_py() or "")
                size += len(run[-1])
            for k, item, a, b, edits in index.value.regions(run):
                seen = found[row + k].setdefault(item, [a, b, edits, set()])
                seen[:3] = min(seen[0], a), max(seen[1], b), min(seen[2], edits)
                seen[3].add((a, b))
            row += len(run)
        return pa.array([[{"item_id": i, "start": a, "end": b, "edits": e, "windows": len(w)}
                          for i, (a, b, e, w) in sorted(x.items(), key=lambda y: (y[0] is None, y[0] or 0))] for x in found], _LEAKS)
    return F.arrow_udf(find, LEAKS)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``leaks``: per benchmark item found the span (code points, end exclusive) from its
    first to its last region, the fewest edits of a region and the number of regions.

    Case, punctuation and the kind of white space do not matter. A null or empty text has no leaks, an empty
    benchmark gives none; benchmark rows that repeat an item_id count as one item. Other columns pass through
    (a column named ``leaks`` is replaced).
    """
    sc = docs.sparkSession.sparkContext
    parts = [_finder(sc.broadcast(Index(block)))(docs[text_col].cast("string")) for block in benchmark_blocks(benchmark)]
    if not parts:
        return docs.withColumn("leaks", F.array().cast(LEAKS))
    return docs.withColumn("leaks", F.concat(*parts) if len(parts) > 1 else parts[0])


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, with their columns (one named ``leaks`` too)."""
    struct = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].cast("string").alias("text"))
    return find_leaks(struct, benchmark).where(F.size("leaks") == 0).select("row.*")
