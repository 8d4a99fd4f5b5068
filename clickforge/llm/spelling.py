"""Spelling variants of words by a trie-node pair dictionary.

The words are numbered into a trie (a node for each distinct beginning) and, reversed, into a second one (a node
for each distinct end). A word cut before position i is the integer pair (node of the beginning, node of the
end); leaving position i out gives the pair (node of the i characters before it, node of those after it).
Joined on their pairs,

* two words that leave out the same position between the same nodes differ by one replaced character;
* a word that leaves out a position and a word cut there differ by one inserted character. Leaving out any
  character of a run of equal ones gives the same word, so only the last of a run counts here.

Every near pair of words thus meets in exactly one bucket, and a bucket holds at most one word per character of
the alphabet and one cut word, so counts and the best neighbour come from buckets of bounded size and no string
longer than a word is ever built: a word of L characters costs 2 L + 1 integer pairs.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import id_and_text, keep

LEAST_CHARS, LEAST_COUNT, RATIO = 7, 2, 10
#: One run in this many loses a character.
DAMAGED = 31
#: Distinct words that a task holds before it hands their counts on; entries of one Arrow batch.
HELD, BATCH = 200_000, 100_000
#: Characters of a word that the split into ranges looks at.
EDGE = 64

_LOWER = {c: c + 32 for c in range(65, 91)}
_RUNS = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_CHARS)


def damaged(doc_id: int | None, run: str) -> str:
    """The run, without one character if 31 divides the crc32 of ``<doc_id>:<run>`` (a null doc_id: never)."""
    if doc_id is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, int] = {}

    def handed():
        return pa.RecordBatch.from_pydict({"word": pa.array(held, pa.string()), "n": pa.array(held.values(), pa.int64())})

    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for k, text in enumerate(batch.column("text")):
            text = text.as_py() or ""
            text = text.lower() if text.isascii() else text.translate(_LOWER)
            for run, n in Counter(_RUNS.findall(text)).items():
                word = damaged(ids[k], run)
                if len(word) >= LEAST_CHARS:
                    held[word] = held.get(word, 0) + n
            if len(held) >= HELD:
                yield handed()
                held = {}
    yield handed()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all texts, damaged as the contract of the operator says, with their counts."""
    counts = id_and_text(docs, id_col, text_col).mapInArrow(_counts, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Trie:
    """Node numbers of sorted words, one range of words at a time.

    A beginning shared by words of two ranges is also a beginning of a range's first word; such nodes are
    numbered (below 0) by the sorted first words alone, all others (0 and up) by range and running number. So
    ranges are numbered apart and no node has two numbers.
    """

    def __init__(self, firsts: dict[int, str]):
        self.edges = sorted(firsts.values())
        self.firsts, self.part = firsts, None

    def shared(self, beginning: str) -> int:
        return -1 - (bisect_left(self.edges, beginning) * (EDGE + 1) + len(beginning))

    def open(self, part: int) -> None:
        first = self.firsts[part]
        at = bisect_left(self.edges, first)
        self.part, self.near = part, self.edges[at: at + 2]
        self.word, self.path, self.next, self.place = "", [self.shared("")], part << 40, part << 40

    def add(self, part: int, word: str) -> tuple[int, list[int]]:
        """(place of the word in the order of all words, the nodes of its 0 to all first characters)."""
        if part != self.part:
            self.open(part)
        same = len(commonprefix([self.word, word]))
        edge = max(len(commonprefix([x, word])) for x in self.near)
        del self.path[same + 1:]
        for d in range(same + 1, len(word) + 1):
            if d <= edge:
                self.path.append(self.shared(word[:d]))
            else:
                self.path.append(self.next)
                self.next += 1
        self.word = word
        self.place += 1
        return self.place, self.path


def _in_ranges(words: DataFrame, key: str, name: str) -> tuple[DataFrame, dict[int, str]]:
    """The rows sorted by ``key`` within written ranges (column ``part``), and each range's first key (its EDGE characters)."""
    start = F.substring(key, 1, EDGE)
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keep(words.repartitionByRange(n, start).withColumn("part", F.spark_partition_id()), name)
    firsts = {r[0]: r[1] for r in ranged.groupBy("part").agg(F.min(start)).collect()}  # one short text a range
    return ranged.repartition("part").sortWithinPartitions("part", key), firsts


def _forward(firsts: dict[int, str]):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(firsts)
        for batch in batches:
            ids, ends, nodes = [], [0], []
            for part, word in zip(batch.column("part").to_pylist(), batch.column("word").to_pylist()):
                place, path = trie.add(part, word)
                ids.append(place)
                nodes += path
                ends.append(len(nodes))
            heads = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(nodes, pa.int64())).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), batch.column("word"), batch.column("n"), heads], names=["id", "word", "n", "heads"])
    return number


#: kinds of an entry: a cut word, a left-out character that is the last of its run, another left-out character
CUT, LAST, INNER = 0, 1, 2


def _entries(firsts: dict[int, str]):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, size = Trie(firsts), [], 0

        def handed():
            cols = [np.concatenate(x) for x in zip(*held)]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=["head", "tail", "kind", "n", "id"])

        for batch in batches:
            heads = batch.column("heads")
            for k, (part, word, n, i) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("part", "reversed", "n", "id")))):
                tails = np.array(trie.add(part, word)[1], np.int64)
                head = heads[k].values.to_numpy(zero_copy_only=False)
                chars = np.frombuffer(word[::-1].encode("utf-32-le"), np.uint32)
                last = np.append(chars[1:] != chars[:-1], True)
                kind = np.concatenate([np.where(last, LAST, INNER), np.full(len(head), CUT)])
                held.append((np.concatenate([head[:-1], head]), np.concatenate([tails[:-1][::-1], tails[::-1]]), kind,
                             np.full(len(kind), n), np.full(len(kind), i)))
                size += len(kind)
                if size >= BATCH:
                    yield handed()
                    held, size = [], 0
        if held:
            yield handed()
    return number


def near_words(words: DataFrame) -> DataFrame:
    """(id, word, n, n_near, best) for every distinct word: the count of its near words and the largest, as (n, -id).

    Ids follow the code-point order of the words.
    """
    ranged, firsts = _in_ranges(words, "word", "spelling-sorted")
    numbered = keep(ranged.mapInArrow(_forward(firsts), "id long, word string, n long, heads array<long>"), "spelling-heads")
    ranged, firsts = _in_ranges(numbered.select("id", "n", "heads", F.reverse("word").alias("reversed")), "reversed", "spelling-reversed")
    entries = ranged.mapInArrow(_entries(firsts), "head long, tail long, kind long, n long, id long")
    entries = entries.withColumn("met", F.count("*").over(Window.partitionBy("head", "tail"))).where("met > 1")
    buckets = entries.groupBy("head", "tail").agg(F.collect_list(F.struct("n", "id", "kind")).alias("b"))  # one word a character at most

    def meet(x, y):
        return (y["id"] != x["id"]) & (((x["kind"] != CUT) & (y["kind"] != CUT)) | (x["kind"] + y["kind"] == LAST))

    met = buckets.select(F.explode(F.transform("b", lambda x: F.struct(
        x["id"].alias("id"), F.transform(F.filter("b", lambda y: meet(x, y)), lambda y: F.struct(y["n"].alias("n"), (-y["id"]).alias("id"))).alias("near")))).alias("x"))
    near = met.select("x.id", F.size("x.near").alias("k"), F.array_max("x.near").alias("top")).where("k > 0")
    near = near.groupBy("id").agg(F.sum("k").alias("n_near"), F.max("top").alias("best"))
    return numbered.select("id", "word", "n").join(near, "id", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)).cast("long"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of at least 7 characters with at least 2 occurrences.

    Words are runs of ASCII and Latin-1 letters (A-Z lower-cased), damaged by :func:`damaged`. A word's form is its
    near word (one character inserted, deleted or replaced) of largest n, ties by code-point order, if that n is at
    least 10 times its own; root follows the forms to the last. Null and empty texts have no words; repeated rows
    count each time; extra columns are ignored; no words give no rows.
    """
    words = keep(near_words(keep(word_counts(docs, id_col, text_col), "spelling-words")), "spelling-near")
    forms = words.where(F.col("best.n") >= RATIO * F.col("n")).select("id", (-F.col("best.id")).alias("to"))
    # n grows tenfold along a chain, so chains are shorter than the digits of the largest n, and each round doubles the steps
    rounds = len(str(words.agg(F.max("n")).first()[0] or 0)).bit_length()
    roots = keep(forms, "spelling-forms")
    for _ in range(rounds):
        step = roots.select(F.col("id").alias("to"), F.col("to").alias("far"))
        roots = keep(roots.join(step, "to", "left").select("id", F.coalesce("far", "to").alias("to")), "spelling-roots")
    named = words.select(F.col("id").alias("to"), F.col("word").alias("named"), F.col("n").alias("named_n"))
    form = forms.join(named, "to").select("id", F.col("named").alias("form"), F.col("named_n").alias("form_n"))
    root = roots.join(named, "to").select("id", F.col("named").alias("root"))
    out = words.join(form, "id", "left").join(root, "id", "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
