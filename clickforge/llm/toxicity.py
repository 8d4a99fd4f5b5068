"""Toxicity by a factorization machine over hashed terms.

Terms are words, word beginnings of three to six characters, and beginnings that several words share (inflected
forms of one stem), hashed to 2^18 places. The machine adds a
linear weight per term and the inner product of factor vectors per pair of terms, so a pair (an insult with a
group) can count for more than its parts. It is fitted by Adam on a bounded sample of labelled texts
(SAMPLE per class, each text once), over the KEPT_TERMS terms whose share differs most between the classes.
Spark finds those terms; the driver fits a few thousand short index lists. Scoring is one narrow pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickforge.llm.common import GOLDEN, RUN_BYTES, keep, mix64, powers
from clickforge.llm.decontam import fold

TERM_BITS = 18
BEGINNINGS = (3, 4, 5, 6)
#: A beginning is a term of its own for each of these numbers of distinct words that share it.
LEVELS = (1, 2, 3, 5)
#: Labelled texts per class in the fitting sample, and terms in the model.
SAMPLE, KEPT_TERMS, LEAST_TEXTS = 6000, 512, 4
RANK, EPOCHS, BATCH, RATE, DECAY = 8, 40, 256, 0.02, 1e-4
FLAG_AT = 0.7


def term_lists(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) of every distinct term of every text, sorted."""
    code, at = fold("\0".join(t.replace("\0", " ") for t in texts))
    starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    inside = (code != 32) & (code != 0)
    first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    last = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    length = last - first
    first, length = first[length > 1], length[length > 1]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.searchsorted(starts, at[first], "right") - 1
    offset = np.cumsum(length) - length
    inner = np.arange(int(length.sum())) - np.repeat(offset, length)

    def keys(text: np.ndarray, h: np.ndarray) -> np.ndarray:
        return (text.astype(np.int64) << TERM_BITS) | (mix64(h) >> np.uint64(64 - TERM_BITS)).astype(np.int64)

    with np.errstate(over="ignore"):
        values = (code[np.repeat(first, length) + inner].astype(np.uint64) + np.uint64(1)) * powers(int(length.max()))[inner]
        whole = np.add.reduceat(values, offset) + length.astype(np.uint64) * GOLDEN
        _, once = np.unique(mix64(whole) ^ mix64(text.astype(np.uint64)), return_index=True)  # each word of a text once
        text, length, offset = text[once], length[once], offset[once]
        found = [keys(text, whole[once])]
        for k in BEGINNINGS:
            long = length > k
            part = values[offset[long]]
            for j in range(1, k):
                part = part + values[offset[long] + j]
            owner, order = text[long].astype(np.uint64), np.uint64(0xA5A5 + 16 * k)
            pair, n = _counted(owner, part ^ order)
            for level in LEVELS:
                found.append(keys(pair[0][n >= level], pair[1][n >= level] + np.uint64(level) * GOLDEN))
    key = np.unique(np.concatenate(found))
    return key >> TERM_BITS, key & ((1 << TERM_BITS) - 1)


def _counted(owner: np.ndarray, value: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Distinct (owner, value) pairs and how often each occurs."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])])[: len(owner)])
    return (owner[new], value[new]), np.diff(np.append(new, len(owner)))


def _runs(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    row = 0
    while row < len(texts):
        run, size = [], 0
        while row + len(run) < len(texts) and (not run or size < RUN_BYTES):
            run.append(texts[row + len(run)].as_py() or "")
            size += len(run[-1])
        yield row, run
        row += len(run)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _terms(texts: pa.Array) -> pa.Array:
    ends, terms = [0], []
    for _, run in _runs(texts):
        text, term = term_lists(run)
        ends.extend((ends[-1] + np.cumsum(np.bincount(text, minlength=len(run)))).tolist())
        terms.append(term.astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(terms) if terms else np.zeros(0, np.int32)))


@dataclass
class FactorizationMachine:
    """``place`` maps a hashed term to its row of ``weight`` and ``factor`` (-1: not in the model)."""

    place: np.ndarray
    base: float
    weight: np.ndarray
    factor: np.ndarray

    def scores(self, text: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Probability of the label for ``n`` texts, given their (text, row) pairs."""
        margin = np.full(n, self.base)
        if len(row):
            margin += np.bincount(text, self.weight[row], n)
            for f in self.factor.T:
                v = f[row]
                margin += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))

    def score_texts(self, texts: list[str]) -> np.ndarray:
        text, term = term_lists(texts)
        row = self.place[term]
        return self.scores(text[row >= 0], row[row >= 0], len(texts))


def fit_machine(lists: list[list[int]], labels: np.ndarray, terms: list[int], base: float) -> FactorizationMachine:
    """Adam on the logistic loss; ``lists`` hold rows of ``terms``."""
    n, k = len(lists), len(terms)
    rng = np.random.default_rng(7)
    place = np.full(1 << TERM_BITS, -1, np.int64)
    place[terms] = np.arange(k)
    params = [np.array([base]), np.zeros(k), rng.normal(0, 0.01, (k, RANK))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    flat = np.concatenate([np.array(x, np.int64) for x in lists]) if n else np.zeros(0, np.int64)
    ends = np.cumsum([0, *map(len, lists)])
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            rows = order[at: at + BATCH]
            size = ends[rows + 1] - ends[rows]
            text = np.repeat(np.arange(len(rows)), size)
            row = flat[np.arange(int(size.sum())) + np.repeat(ends[rows] - (np.cumsum(size) - size), size)]
            v = params[2][row]
            total = np.zeros((len(rows), RANK))
            np.add.at(total, text, v)
            square = np.bincount(text, (v * v).sum(axis=1), len(rows))
            margin = params[0][0] + np.bincount(text, params[1][row], len(rows)) + 0.5 * ((total ** 2).sum(axis=1) - square)
            error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[rows]) / len(rows)
            gradient = [np.array([error.sum()]), np.bincount(row, error[text], k) + DECAY * params[1], DECAY * params[2]]
            np.add.at(gradient[2], row, error[text][:, None] * (total[text] - v))
            step += 1
            for p, g, m, s in zip(params, gradient, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return FactorizationMachine(place, float(params[0][0]), params[1], params[2])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic") -> FactorizationMachine | None:
    """The machine fitted on a sample of ``labels`` (0/1, nulls skipped), or None unless both classes occur.

    Of each class the SAMPLE ids of least hash are taken; a text counts once however many copies it has.
    """
    marked = labels.where(labels[label_col].isin(0, 1) & labels[id_col].isNotNull()) \
        .groupBy(labels[id_col].cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("y"))
    share = {r.y: r.n for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        return None
    order = F.xxhash64("doc_id")
    picked = None
    for y in (0, 1):
        part = marked.where(F.col("y") == y).orderBy(order, "doc_id").limit(SAMPLE)
        picked = part if picked is None else picked.unionByName(part)
    text = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    sample = keep(text.join(F.broadcast(picked), "doc_id")  # at most 2 * SAMPLE rows of two numbers
                  .withColumn("same", F.md5(F.coalesce("text", F.lit("")))).withColumn("terms", _terms("text"))
                  .groupBy("same").agg(F.max("y").alias("y"), F.min_by("terms", "doc_id").alias("terms")), "toxic-sample")
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    seen = sample.select("y", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).where(F.col("p") + F.col("n") >= LEAST_TEXTS)
    p, n = F.col("p") / sizes[1], F.col("n") / sizes[0]
    spread = F.sqrt((F.col("p") + 1) / sizes[1] ** 2 + (F.col("n") + 1) / sizes[0] ** 2)
    chosen = [r.term for r in seen.orderBy(F.abs(p - n).cast("double") / spread, "term", ascending=[False, True]).limit(KEPT_TERMS).collect()]
    if not chosen:
        return None
    rows = F.transform(F.filter("terms", lambda t: t.isin(chosen)), lambda t: F.array_position(F.array(*map(F.lit, sorted(chosen))), t) - 1)
    lists = sample.select("y", "same", rows.alias("rows")).orderBy("same").collect()  # the bounded sample
    y = np.array([r.y for r in lists], float)
    machine = fit_machine([r["rows"] for r in lists], y, sorted(chosen), float(np.log(sizes[1] / sizes[0])))
    machine.base += float(np.log(share[1] / share[0]) - np.log(sizes[1] / sizes[0]))  # the classes' true shares
    return machine


def score_toxicity(docs: DataFrame, machine: FactorizationMachine | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from FLAG_AT on); other columns pass through.

    A null or empty text has no terms and gets the base rate. Without a machine (no labels, or one class) every
    score is 0. Repeated rows get equal scores; columns named score or predicted are replaced.
    """
    if machine is None:
        return docs.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    model = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([model.value.score_texts(run) for _, run in _runs(texts)] or [np.zeros(0)]), pa.float64())

    return docs.withColumn("score", score(docs[text_col].cast("string"))) \
        .withColumn("predicted", (F.col("score") >= FLAG_AT).cast("int"))
