"""Language of texts and of spans in mixed-language texts.

A word's script (by Unicode ranges) narrows the languages it may belong to; its score for each is the sum of
the log-probabilities of its letter trigrams. Viterbi over the words of a text, with a penalty for switching,
labels spans; the language with the most letters is the text's. The model is fitted on a bounded sample:
about SAMPLE texts of each language, however rare (all its texts where it has no more).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickforge.llm.common import mix64
from clickforge.llm.decontam import fold

SAMPLE, DRAWS = 1500, 10**12
GRAM_BITS = 15
SMOOTH = 0.5
SWITCH = 12.0
#: A script counts for a language when it holds at least this share of the language's words.
SCRIPT_SHARE = 0.01
#: Scores held at once (words times languages).
AT_ONCE = 6_000_000
#: Trigrams times languages looked up at once.
LOOKUPS = 1_000_000

#: First code point of each block of a script. 0: no letter script of its own.
SCRIPT_STARTS = [(0x0000, 0), (0x0041, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6),
                 (0x0700, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0B80, 10), (0x0C00, 9), (0x0E00, 11), (0x0E80, 9),
                 (0x10A0, 12), (0x1100, 13), (0x1200, 9), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 14), (0x3100, 9),
                 (0x3400, 15), (0xA000, 9), (0xAC00, 13), (0xD800, 0), (0xF900, 15), (0xFB00, 0), (0x20000, 15), (0x2FA20, 0)]
_STARTS = np.array([a for a, _ in SCRIPT_STARTS], np.int64)
_SCRIPT = np.array([s for _, s in SCRIPT_STARTS], np.int64)
SCRIPTS = int(_SCRIPT.max()) + 1
_DIGITS = np.zeros(1 << 16, bool)
_DIGITS[[c for c in range(1 << 16) if not 0xD800 <= c < 0xE000 and chr(c).isalnum() and not chr(c).isalpha()]] = True


def words_of(texts: list[str]):
    """Per word with a letter: text, script, letters, first and last+1 code point in its text; and the word and bucket of each trigram."""
    code, at = fold("\0".join(t.replace("\0", " ") for t in texts))
    starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    code = np.where(_DIGITS[np.minimum(code, 0xFFFF)] & (code < 1 << 16), 32, code)
    inside = (code != 32) & (code != 0)
    first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    last = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    if not len(first):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty, empty, empty
    text = np.searchsorted(starts, at[first], "right") - 1
    script = _SCRIPT[np.searchsorted(_STARTS, code[first], "right") - 1]
    padded = np.concatenate([[np.uint64(32)], np.where(inside, code, 32).astype(np.uint64), [np.uint64(32)]])
    with np.errstate(over="ignore"):
        gram = mix64((padded[:-2] << np.uint64(42)) ^ (padded[1:-1] << np.uint64(21)) ^ padded[2:])
    place = np.flatnonzero(inside)
    word = np.searchsorted(first, place, "right") - 1
    return (text, script, last - first, at[first] - starts[text], at[last - 1] + 1 - starts[text],
            word, (gram[place] >> np.uint64(64 - GRAM_BITS)).astype(np.int64))


@dataclass
class LanguageModel:
    """Log-probabilities of trigram buckets and the languages that use each script.

    ``base`` is the log-probability of a bucket that a language has not seen; the entries ``first[b]`` to
    ``first[b + 1]`` of ``owner`` and ``lift`` are the languages that have seen bucket b and what it adds.
    """

    languages: list[str]
    base: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    lift: np.ndarray
    uses: np.ndarray

    def word_scores(self, n: int, script: np.ndarray, word: np.ndarray, gram: np.ndarray) -> np.ndarray:
        k = len(self.languages)
        scores = np.bincount(word, minlength=n)[:, None] * self.base
        most = max(1, LOOKUPS // k)
        for at in range(0, len(gram), most):
            w, g = word[at: at + most], gram[at: at + most]
            low, high = int(w[0]), int(w[-1]) + 1  # words ascend
            size = self.first[g + 1] - self.first[g]
            entry = np.arange(int(size.sum())) + np.repeat(self.first[g] - (np.cumsum(size) - size), size)
            cell = np.repeat((w - low) * k, size) + self.owner[entry]
            scores[low:high] += np.bincount(cell, self.lift[entry], (high - low) * k).reshape(-1, k)
        allowed = self.uses[script]
        return np.where(allowed | ~allowed.any(axis=1, keepdims=True), scores, scores - 1000.0)


def viterbi(scores: np.ndarray, text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of every word (words in order of their text): scores summed, ``switch`` off per change.

    All texts advance together, the longest first; ties stay with the label before, then the smaller one.
    """
    n, k = scores.shape
    if k == 1 or not n:
        return np.zeros(n, np.int64)
    _, begin, size = np.unique(text, return_index=True, return_counts=True)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    active = len(size) - np.searchsorted(size[::-1], np.arange(size[0]), "right")
    back = []
    now = scores[begin]
    for t in range(1, int(size[0])):
        prev = now[: active[t]]
        best = prev.argmax(axis=1)
        jump = prev[np.arange(len(prev)), best] - switch
        moves = jump[:, None] > prev
        back.append(np.where(moves, best[:, None], np.arange(k)).astype(np.int16))
        now[: active[t]] = np.where(moves, jump[:, None], prev) + scores[begin[: active[t]] + t]
    label = np.zeros(n, np.int64)
    last = now.argmax(axis=1)
    for t in range(int(size[0]) - 1, 0, -1):
        rows = np.arange(active[t])
        label[begin[rows] + t] = last[rows]
        last[rows] = back[t - 1][rows, last[rows]]
    label[begin] = last
    return label


def identify(model: LanguageModel, texts: list[str]) -> list[dict]:
    """Per text: language (``und`` without a letter), score (share of letters with that label) and spans."""
    text, script, letters, start, end, word, gram = words_of(texts)
    out = [{"lang_pred": "und", "score": 0.0, "spans": []} for _ in texts]
    if not len(text) or not model.languages:
        return out
    label = viterbi(model.word_scores(len(text), script, word, gram), text)
    k = len(model.languages)
    weight = np.bincount(text * k + label, letters, len(texts) * k).reshape(-1, k)
    best, total = weight.argmax(axis=1), weight.sum(axis=1)
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (label[1:] != label[:-1])]))
    for a, b in zip(new.tolist(), [*(new[1:] - 1).tolist(), len(text) - 1]):
        out[text[a]]["spans"].append({"lang": model.languages[label[a]], "start": int(start[a]), "end": int(end[b])})
    for i in np.flatnonzero(total):
        out[i]["lang_pred"] = model.languages[best[i]]
        out[i]["score"] = float(weight[i, best[i]] / total[i])
    return out


def _runs(texts: pa.Array, most: int) -> Iterator[list[str]]:
    run, size = [], 0
    for t in texts:
        t = t.as_py() or ""
        if run and size + len(t) > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, lang, bucket, n) of the trigrams (kind 0) and scripts (kind 1) seen in (lang, text)."""
    for batch in batches:
        lang, texts = batch.column(0).to_numpy(), batch.column(1)
        at = 0
        for part in _runs(texts, 2_000_000):
            text, script, _, _, _, word, gram = words_of(part)
            own = lang[at: at + len(part)]
            at += len(part)
            for kind, owner, bucket in ((0, own[text[word]], gram), (1, own[text], script)):
                key, n = np.unique((owner << GRAM_BITS) | bucket, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind)), pa.array(key >> GRAM_BITS),
                                                  pa.array(key & ((1 << GRAM_BITS) - 1)), pa.array(n)], names=["kind", "lang", "bucket", "n"])


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """The model of the languages in ``docs`` (null languages and texts skipped; none left: a model without languages)."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang")) \
        .where("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()  # a row per language
    languages = [r.lang for r in sizes]
    uses = np.zeros((len(languages), SCRIPTS))
    seen = [np.zeros(0, np.int64)] * 3
    if languages:
        draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("language")), F.lit(DRAWS))
        limits = docs.sparkSession.createDataFrame(
            [(r.lang, k, int(DRAWS * min(1.0, SAMPLE / r.n))) for k, r in enumerate(sizes)], "lang string, k long, most long")
        found = rows.join(F.broadcast(limits), "lang").where(draw < F.col("most")).select("k", "text") \
            .mapInArrow(_counts, "kind long, lang long, bucket long, n long")
        total = found.groupBy("kind", "lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # languages x buckets seen
        kind, *seen = (total.column(x).to_numpy() for x in ("kind", "lang", "bucket", "n"))
        uses[seen[0][kind == 1], seen[1][kind == 1]] = seen[2][kind == 1]
        seen = [x[kind == 0] for x in seen]
    owner, bucket, n = seen
    order = np.lexsort((owner, bucket))
    owner, bucket, n = owner[order], bucket[order], n[order]
    base = np.log(SMOOTH) - np.log(np.bincount(owner, n, len(languages)) + SMOOTH * (1 << GRAM_BITS))
    share = uses / np.maximum(1, uses.sum(axis=1, keepdims=True))
    return LanguageModel(languages, base, np.searchsorted(bucket, np.arange((1 << GRAM_BITS) + 1)), owner.astype(np.int32),
                         np.log(n + SMOOTH) - np.log(SMOOTH), (share >= SCRIPT_SHARE).T)


FOUND = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                      T.StructField("spans", T.ArrayType(T.StructType([
                          T.StructField("lang", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
_FOUND = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()),
                    ("spans", pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])


def label_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``language``: lang_pred, score (0 to 1), spans (lang, start, end in code points).

    Null, empty and letterless texts are ``und`` with score 0 and no spans, as is everything under a model
    without languages. Only the text is read; repeated rows get equal results, other columns pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    most = max(10_000, 6 * AT_ONCE // max(4, len(model.languages)) // 6)

    @F.arrow_udf(FOUND)
    def label(texts: pa.Array) -> pa.Array:
        return pa.array([x for run in _runs(texts, most) for x in identify(shared.value, run)], _FOUND)

    return docs.withColumn("language", label(docs[text_col].cast("string")))
