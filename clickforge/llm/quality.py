"""Quality rules: repetition rules and the divergence of a text from its language's profile.

All in DataFrame expressions, no Python. One narrow projection counts what the rules need and is written; all that
follows reads these counts. The references are one row per language, summed over all documents in whole millionths,
so they do not depend on the order of rows. Languages of at least one in a hundred documents (at most a hundred
rows) are compared with every document; any rarer language is a row of a table joined by ``lang``, so its documents
are also compared with their own reference.

A document is rejected by the method when its character classes or its common words lie further (Jensen-Shannon
distance, base 2) from the nearest of these references than the limit of its length class. The limits come from
the nearest distances of all documents that pass the base rule: a far-out fence, the upper quartile and ``FENCE``
times the distance between the quartiles, in thousandths, and no less than one and a half upper quartiles (where
nearly all distances are equal). Documents of fewer than 50 words are not judged, since a histogram of
few words says little.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import keep

WORD = r"[^\x20\x09-\x0D]+"
#: Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in is that for it as was with be by on not".split(),
    "fr": "le la les de des du et un une est que qui dans pour par".split(),
    "de": "der die das und ist von zu den mit für ein eine nicht sich auf".split(),
    "es": "el la los las de del y que en un una es por con para".split(),
}
COMMON = sorted({w for words in COMMON_WORDS.values() for w in words})
#: One character per common word: a text's common words become a string whose characters are counted.
CODES = [chr(0x30 + k) for k in range(len(COMMON))]
VARIANTS = [v for w in COMMON for v in (w, w[0].upper() + w[1:])]
CLASSES = ("upper", "lower", "digit", "punctuation", "space", "other")

MIN_WORDS, MAX_REPEAT_PERCENT, SPAN = 10, 20, 5
#: Words from which a length class begins; shorter texts are not judged.
GUARDS = (50, 100, 200)
#: Quartile distances from the upper quartile to the limit, and the step of the distances' histogram in millionths.
FENCE, STEP = 4, 1000
MILLION = 1_000_000
#: From this share of the documents on, a language's reference is compared with documents of every language.
MIN_LANG_SHARE = 0.01


@dataclass
class References:
    """``common``: (language, character-class shares, common-word shares); ``rare``: the same as rows of ``_lang``, ``_rc``, ``_rw``."""

    common: list[tuple[str, list[float], list[float]]]
    rare: DataFrame | None
    #: (length class, ``c`` or ``w``) to the greatest distance in steps, see :func:`distance_limits`
    limits: dict[tuple[int, str], int] = field(default_factory=dict)


def _count(text: Column, not_wanted: str) -> Column:
    """Code points left when runs of ``not_wanted`` are removed."""
    return F.length(F.regexp_replace(text, not_wanted, ""))


def with_words(df: DataFrame, text: Column) -> DataFrame:
    return (df.withColumn("_t", F.coalesce(text, F.lit("")))
            .withColumn("_w", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)))
            .withColumn("n_words", F.size("_w").cast("long"))
            .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long")))


def with_histograms(df: DataFrame) -> DataFrame:
    """Columns ``_chars`` (six classes) and ``_common`` (each common word, then all others), as arrays of counts."""
    spelled = F.array(*map(F.lit, VARIANTS))
    codes = F.lit("".join(c + c for c in CODES))
    coded = F.array_join(F.transform(F.filter("_w", lambda w: w.isin(VARIANTS)),
                                     lambda w: codes.substr(F.array_position(spelled, w).cast("int"), F.lit(1))), "")
    df = (df.withColumn("_c", coded)
          .withColumn("_letters", _count(F.col("_t"), r"\P{L}+")).withColumn("_upper", _count(F.col("_t"), r"\P{Lu}+"))
          .withColumn("_digits", _count(F.col("_t"), r"\P{N}+")).withColumn("_punct", _count(F.col("_t"), r"\P{P}+")))
    used = F.col("word_chars") - F.col("_letters") - F.col("_digits") - F.col("_punct")
    chars = F.array(*[x.cast("long") for x in (
        F.col("_upper"), F.col("_letters") - F.col("_upper"), F.col("_digits"), F.col("_punct"),
        F.length("_t") - F.col("word_chars"), used)])
    common = [(F.length("_c") - F.length(F.replace(F.col("_c"), F.lit(c), F.lit("")))).cast("long") for c in CODES]
    return df.withColumn("_chars", chars).withColumn("_common", F.array(*common, F.col("n_words") - F.length("_c")))


def language_references(counts: DataFrame) -> References:
    """Shares of every language, the mean over its documents of at least 50 words."""
    df = counts.where(f"_lang is not null and n_words >= {GUARDS[0]}")
    char_sums, word_sums = [f"c{k}" for k in range(len(CLASSES))], [f"w{k}" for k in range(len(COMMON) + 1)]
    sums = [F.sum(F.round(MILLION * F.col("_chars")[k] / F.col("_length")).cast("long")).alias(x) for k, x in enumerate(char_sums)]
    sums += [F.sum(F.round(MILLION * F.col("_common")[k] / F.col("n_words")).cast("long")).alias(x) for k, x in enumerate(word_sums)]
    found = keep(df.groupBy("_lang").agg(F.count("*").alias("n"), *sums), "quality-languages")
    total = found.agg(F.sum("n").alias("n")).first().n or 0
    is_common = F.col("n") >= MIN_LANG_SHARE * total
    rows = found.where(is_common).orderBy("_lang").collect()  # at most 1 / MIN_LANG_SHARE rows

    def share(row, names):
        whole = sum(row[x] for x in names)
        return [row[x] / whole for x in names]

    def shares(names):
        whole = sum((F.col(x) for x in names[1:]), F.col(names[0]))
        return F.array(*[F.col(x) / whole for x in names])

    rare = found.where(~is_common).select("_lang", shares(char_sums).alias("_rc"), shares(word_sums).alias("_rw"))
    return References([(r["_lang"], share(r, char_sums), share(r, word_sums)) for r in rows], None if rare.isEmpty() else rare)


def js_distance(shares: str, reference: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, in millionths (a whole number)."""
    def part(p: Column, q: Column) -> Column:
        return (F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0) + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0)) / 2

    parts = F.zip_with(shares, reference, part)
    return F.round(MILLION * F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)))).cast("long")


def with_repeats(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: words in five-word windows that the text holds twice or more.

    Windows are hashed to 64 bits. Only where some hash occurs twice are hash and position packed into one
    number, sorted, and neighbours compared, so a long repetitive text costs a sort, not a square.
    """
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    window = F.transform(F.sequence(F.lit(0), F.size("_h") - SPAN),
                         lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(SPAN)]))
    df = df.withColumn("_g", F.when(F.size("_h") >= SPAN, window).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_low", F.expr("shiftleft(1L, length(bin(size(_g)))) - 1L"))
    df = df.withColumn("_s", F.expr(
        "case when size(array_distinct(_g)) < size(_g) then sort_array(transform(_g, (x, i) -> (x & ~_low) | i)) else array() end"))
    same = "(x & ~_low) = (get(_s, {0}) & ~_low) and get(_g, int(x & _low)) = get(_g, int(get(_s, {0}) & _low))"
    df = df.withColumn("_p", F.expr(
        f"sort_array(transform(filter(_s, (x, i) -> coalesce(i > 0 and {same.format('i - 1')}, false)"
        f" or coalesce({same.format('i + 1')}, false)), x -> x & _low))"))
    return df.withColumn("n_repeat_words", F.expr(
        f"aggregate(transform(_p, (x, i) -> least({SPAN}L, coalesce(get(_p, i + 1) - x, {SPAN}L))), 0L, (a, x) -> a + x)"))


def quality_counts(docs: DataFrame, carry: list[str] | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """What the rules count in every document, written: ``_row`` (the carried columns, by default all but one named
    ``quality``), ``_lang``, the counts of the rules and the two histograms."""
    carry = [c for c in docs.columns if c != "quality"] if carry is None else carry
    row = F.struct(*[docs[c] for c in carry]) if carry else F.struct(F.lit(True).alias("_none"))
    df = docs.select(row.alias("_row"), docs[text_col].cast("string").alias("_text"),
                     docs[lang_col].cast("string").alias("_lang"))
    df = with_repeats(with_histograms(with_words(df, F.col("_text"))))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD))
    df = df.withColumn("_lines", lines).withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    df = df.withColumn("n_symbols", F.size(F.regexp_extract_all("_t", F.lit("[#*$%&|<>]"), F.lit(0))).cast("long"))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                       | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return keep(df.select("_row", "_lang", F.length("_t").alias("_length"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", "_chars", "_common"), "quality-counts")


def with_distances(counts: DataFrame, references: References) -> DataFrame:
    """``_d``: the distances (c, w) in millionths of every document with words from each reference it is compared with."""
    df = counts if references.rare is None else counts.join(references.rare, "_lang", "left")
    df = df.withColumn("_chars", F.transform("_chars", lambda x: F.try_divide(x, F.col("_length"))))
    df = df.withColumn("_common", F.transform("_common", lambda x: F.try_divide(x, F.col("n_words"))))

    def distances(chars: Column, words: Column) -> Column:
        return F.struct(js_distance("_chars", chars).alias("c"), js_distance("_common", words).alias("w"))

    near = [distances(*[F.array(*[F.lit(float(x)) for x in shares]) for shares in both]) for _, *both in references.common]
    compared = F.array(*near) if near else F.lit(None).cast("array<struct<c:bigint,w:bigint>>")
    if references.rare is not None:
        compared = F.when(F.col("_rc").isNotNull(), F.array(*near, distances(F.col("_rc"), F.col("_rw")))).otherwise(compared)
    return df.withColumn("_d", F.when(F.col("n_words") > 0, compared))


def nearest(kind: str) -> Column:
    """The least distance ``c`` or ``w`` of ``_d``."""
    return F.array_min(F.transform("_d", lambda d: d[kind]))


def length_class() -> Column:
    """The guard that a text reaches, null below the first."""
    out = F.lit(None).cast("int")
    for words in GUARDS:
        out = F.when(F.col("n_words") >= words, F.lit(words)).otherwise(out)
    return out


def distance_limits(measured: DataFrame) -> dict[tuple[int, str], int]:
    """{(length class, ``c`` or ``w``): greatest distance in steps}, from the nearest distances of all documents that pass the base rule."""
    steps = F.array(*[F.struct(F.lit(k).alias("kind"), F.floor(nearest(k) / STEP).alias("step")) for k in "cw"])
    rows = measured.where("not base_failed and _d is not null").select(length_class().alias("words"), F.explode(steps).alias("x"))
    found = rows.where("words is not null").groupBy("words", "x.kind", "x.step").agg(F.count("*").alias("n")).collect()  # at most 1,001 steps a class and kind
    limits = {}
    for key in {(r["words"], r["kind"]) for r in found}:
        steps = sorted((r["step"], r["n"]) for r in found if (r["words"], r["kind"]) == key)
        total, seen, quartile = sum(n for _, n in steps), 0, {}
        for step, n in steps:
            seen += n
            for q in (1, 3):
                if 4 * seen >= q * total:
                    quartile.setdefault(q, step)
        limits[key] = max(quartile[3] + FENCE * (quartile[3] - quartile[1]), 3 * quartile[3] // 2)
    return limits


def fit_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> References:
    """References and limits of a corpus, to judge other documents by."""
    return _fitted(quality_counts(docs, [], text_col, lang_col))


def _fitted(counts: DataFrame) -> References:
    references = language_references(counts)
    references.limits = distance_limits(with_distances(counts, references))
    return references


def quality_rules(docs: DataFrame, references: References | None = None, carry: list[str] | None = None, text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """``docs`` with a struct column ``quality``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    char_distance, word_distance (millionths, to the nearest language; null without references or words),
    base_failed, kept. ``carry`` names the columns to return (by default all); without ``references`` the documents
    are judged by their own.

    A null or empty text has no words, so it fails the base rule (fewer than ten words). A document without a
    language is compared with the common languages only; without any of them the method does not judge it. Repeated rows get equal results; every
    other column passes through untouched, but one named ``quality`` is replaced.
    """
    counts = quality_counts(docs, carry, text_col, lang_col)
    references = references or _fitted(counts)
    measured, limits = with_distances(counts, references), references.limits
    far = F.lit(False)
    for words in GUARDS:
        if (words, "c") in limits:
            most_c, most_w = ((limits[words, k] + 1) * STEP for k in "cw")
            beyond = (nearest("c") >= most_c) | (nearest("w") >= most_w)
            far = F.when(F.col("n_words") >= words, F.coalesce(beyond, F.lit(False))).otherwise(far)
    told = F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        nearest("c").alias("char_distance"), nearest("w").alias("word_distance"),
        "base_failed", (~F.col("base_failed") & ~far).alias("kept"))
    # an array of one: a filter on the verdict stays above it and is not expanded into all these expressions
    return measured.select("_row", F.explode(F.array(told)).alias("_quality")).select("_row.*", F.col("_quality").alias("quality"))
