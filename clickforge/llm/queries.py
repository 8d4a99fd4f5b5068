"""Registered queries of the subpackage and their DuckDB twins.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds SQL where SQL can say the same.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from clickforge.llm import licenses as lic
from clickforge.llm import pii
from clickforge.llm import quality as qual
from clickforge.llm.alignment import align_tokenizers
from clickforge.llm.common import load
from clickforge.llm.decontam import find_leaks
from clickforge.llm.language import fit_languages, label_languages
from clickforge.llm.line_dedup import drop_repeated_lines
from clickforge.llm.near_dup import near_duplicates
from clickforge.llm.packing import pack_documents
from clickforge.llm.sharding import shard_documents
from clickforge.llm.spelling import spelling_variants
from clickforge.llm.toxicity import fit_toxicity, score_toxicity
from clickforge.llm.vector_dup import near_vectors

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: SQL for the words of a text, as the operators see them.
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return register


@query("op2_near_duplicates", rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
grams AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS n, any_value(b.n) AS m
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs WHERE 100 * c >= 75 * (n + m - c)),
sym AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(d, t) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.d, e.y FROM reach r JOIN sym e ON r.t = e.x),
comp AS (SELECT d, min(t) AS c FROM reach GROUP BY d)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, c = doc_id AS kept
FROM sets JOIN comp ON doc_id = d""")
def op2(spark, sf_dir):
    return near_duplicates(load(spark, sf_dir, "documents"))


def quality_sql() -> str:
    words = ", ".join(f"({k}, '{v}')" for k, w in enumerate(qual.COMMON) for v in sorted({w, w[0].upper() + w[1:]}))
    other = len(qual.COMMON)
    n1 = qual.GUARDS[0]
    guard = "CASE " + " ".join(f"WHEN n >= {w} THEN {w}" for w in reversed(qual.GUARDS)) + " END"

    def quartile(kind: str, q: int) -> str:
        """Per length class the smallest step that at least q quarters of the documents do not exceed."""
        return f"""
  SELECT guard, min(step) FILTER (4 * seen >= {q} * total) AS q{q} FROM (
    SELECT guard, step, sum(c) OVER (PARTITION BY guard ORDER BY step) AS seen, sum(c) OVER (PARTITION BY guard) AS total
    FROM (SELECT guard, {kind} // {qual.STEP} AS step, count(*) AS c FROM nearest GROUP BY 1, 2)) GROUP BY guard"""

    def limit(kind: str) -> str:
        return f"""
  SELECT guard, greatest(q3 + {qual.FENCE} * (q3 - q1), 3 * q3 // 2) AS {kind} FROM ({quartile(kind, 1)}) JOIN ({quartile(kind, 3)}) USING (guard)"""

    def js(table: str, key: str) -> str:
        """Distance of every document from every language over the shares in ``table``."""
        p, q = "p.share", "q.share"
        return f"""
  SELECT p.doc_id, q.lang, CAST(round(1000000 * sqrt(greatest(0.0, sum(
    (CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END
     + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END) / 2)))) AS BIGINT) AS {key}
  FROM (SELECT * FROM {table} JOIN base USING (doc_id)) p JOIN {table}_ref q ON p.k = q.k AND (q.lang IN (SELECT lang FROM langs) OR q.lang = p.lang)
  GROUP BY 1, 2"""

    def ref(table: str) -> str:
        return f"""
  SELECT lang, k, s / sum(s) OVER (PARTITION BY lang) AS share FROM (
    SELECT lang, k, sum(CAST(round(1000000 * share) AS BIGINT)) AS s FROM {table} JOIN base USING (doc_id)
    WHERE n >= {n1} AND lang IS NOT NULL GROUP BY 1, 2)"""

    return rf"""
WITH base AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS_SQL} AS w, len({WORDS_SQL}) AS n FROM documents),
feats AS (
  SELECT doc_id, t, n, coalesce(len(array_to_string(w, '')), 0) AS wc,
    len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines,
    len(regexp_replace(t, '\P{{L}}+', '', 'g')) AS letters, len(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS upper,
    len(regexp_replace(t, '\P{{N}}+', '', 'g')) AS digits, len(regexp_replace(t, '\P{{P}}+', '', 'g')) AS punct FROM base),
grams AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, n - 3)) AS i FROM base WHERE n >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
reps AS (
  SELECT doc_id, CAST(sum(least(5, coalesce(nxt - i, 5))) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY 1),
chars AS (
  SELECT doc_id, k, c / len(t) AS share FROM (
    SELECT doc_id, t, unnest([0, 1, 2, 3, 4, 5]) AS k,
      unnest([upper, letters - upper, digits, punct, len(t) - wc, wc - letters - digits - punct]) AS c FROM feats WHERE n > 0)),
listed(k, v) AS (VALUES {words}),
hits AS (SELECT doc_id, k, count(*) AS c FROM (SELECT doc_id, unnest(w) AS v FROM base) JOIN listed USING (v) GROUP BY 1, 2),
common AS (
  SELECT doc_id, k, coalesce(c, 0) / n AS share FROM (SELECT doc_id, n, unnest(range({other})) AS k FROM base WHERE n > 0)
  LEFT JOIN hits USING (doc_id, k)
  UNION ALL SELECT doc_id, {other}, (n - coalesce(s, 0)) / n FROM base
  LEFT JOIN (SELECT doc_id, sum(c) AS s FROM hits GROUP BY 1) USING (doc_id) WHERE n > 0),
sized AS (SELECT lang, count(*) AS c FROM base WHERE lang IS NOT NULL AND n >= {n1} GROUP BY 1),
langs AS (SELECT lang FROM sized WHERE c >= {qual.MIN_LANG_SHARE} * (SELECT sum(c) FROM sized)),
chars_ref AS ({ref("chars")}),
common_ref AS ({ref("common")}),
pairs AS MATERIALIZED (SELECT * FROM ({js("chars", "cd")}) JOIN ({js("common", "wd")}) USING (doc_id, lang)),
near AS (SELECT doc_id, min(cd) AS char_distance, min(wd) AS word_distance FROM pairs GROUP BY 1),
ruled AS (
  SELECT *, {guard} AS guard, n < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n AS base_failed
  FROM feats LEFT JOIN reps USING (doc_id) LEFT JOIN near USING (doc_id)),
nearest AS (SELECT guard, char_distance AS c, word_distance AS w FROM ruled WHERE guard IS NOT NULL AND NOT base_failed AND char_distance IS NOT NULL),
limits AS (SELECT * FROM ({limit("c")}) JOIN ({limit("w")}) USING (guard)),
told AS (
  SELECT ruled.*, coalesce(char_distance // {qual.STEP} > c OR word_distance // {qual.STEP} > w, false) AS is_far FROM ruled LEFT JOIN limits USING (guard))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(wc AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  base_failed, NOT base_failed AND NOT coalesce(is_far, false) AS kept, char_distance, word_distance FROM told"""


@query("op5_quality_rules", quality_sql())
def op5(spark, sf_dir):
    out = qual.quality_rules(load(spark, sf_dir, "documents"), carry=["doc_id"]).select("doc_id", "quality.*")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "char_distance", "word_distance")


@query("op8_line_dedup", rf"""
WITH lines AS (
  SELECT doc_id, i, x, translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS k
  FROM (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
firsts AS (SELECT k, min(doc_id) AS f FROM lines WHERE len(k) >= 10 GROUP BY k HAVING min(doc_id) < max(doc_id)),
marked AS (SELECT doc_id, i, x, coalesce(doc_id > f, false) AS gone FROM lines LEFT JOIN firsts USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op8(spark, sf_dir):
    out = drop_repeated_lines(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op9_packing")
def op9(spark, sf_dir):
    out = pack_documents(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op3_personal_data")
def op3(spark, sf_dir):
    out = pii.personal_data(load(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(pii.of_kind("spans", k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return out.select("doc_id", *counts[:4], F.sha2(pii.spelled(pii.of_kind("spans", *pii.BASE_KINDS)), 256).alias("base_sha256"),
                      pii.spelled(F.col("spans")).alias("spans"), *counts[4:],
                      F.array_max(F.transform("spans", lambda s: s["score"])).alias("top_score"))


@query("op4_decontamination")
def op4(spark, sf_dir):
    """One row per document and benchmark item found in it."""
    out = find_leaks(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query("op10_toxicity")
def op10(spark, sf_dir):
    docs, labels = load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    machine = fit_toxicity(docs, labels.where(~held_out).select("doc_id", "toxic"))
    return score_toxicity(docs, machine).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op7_language")
def op7(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = label_languages(docs.select("doc_id", "text"), fit_languages(docs.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score",
                      F.size("language.spans").cast("long").alias("n_spans"))


def licence_sql() -> str:
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    keywords = " OR ".join(f"contains(lower(t), {text(k)})" for k in lic.KEYWORDS)
    *known, (other, other_pattern) = lic.SENTENCES
    places = ", ".join(f"CASE WHEN regexp_matches(s, {text(p)}) THEN {{'at': length(regexp_extract(s, {text('^(.*?)(?:' + p + ')')}, 1)), 'k': {k}, 'name': {text(n)}}} END"
                       for k, (n, p) in enumerate(known))
    steps, last = [], "told"
    for k, (name, pattern) in enumerate(lic.RULES):
        whole = text(f"(^|,){pattern}")
        steps.append(f"r{k} AS MATERIALIZED (SELECT * EXCLUDE (left_over, names), regexp_replace(left_over, {whole}, '\\1', 'g') AS left_over, "
                     f"CASE WHEN regexp_matches(left_over, {whole}) AND NOT list_contains(names, {text(name)}) THEN list_append(names, {text(name)}) ELSE names END AS names FROM {last})")
        last = f"r{k}"
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT doc_id, string_split(lower(regexp_replace(regexp_replace(regexp_replace(t, {text(lic.LEADER)}, '', 'g'),
    {text(lic.SENTENCE_END)}, '' || chr(1), 'g'), '[ 	
]+', ' ', 'g')), chr(1)) AS ss FROM docs WHERE {keywords}),
ids AS (
  SELECT doc_id, flatten(list_transform(list_transform(ss, lambda s: {{'s': s, 'found': list_sort(list_filter([{places}], lambda x: x IS NOT NULL))}}),
    lambda y: CASE WHEN len(y.found) > 0 THEN list_transform(y.found, lambda x: x.name) WHEN regexp_matches(y.s, {text(other_pattern)}) THEN [{text(other)}] ELSE [] END)) AS ids FROM cut),
told AS (
  SELECT doc_id, coalesce(ids, []) AS ids, CASE WHEN len(ids) > 0 THEN array_to_string(ids, ',') || ',' ELSE '' END AS left_over,
    CAST([] AS VARCHAR[]) AS names FROM docs LEFT JOIN ids USING (doc_id)),
{", ".join(steps)}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentences,
  coalesce(array_to_string(names, ','), '') AS licences, CAST(len(left_over) - len(replace(left_over, ',', '')) AS BIGINT) AS unmatched FROM {last}"""


@query("op1_licences", licence_sql())
def op1(spark, sf_dir):
    out = lic.scan_licenses(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("licence.sentences").cast("long").alias("n_sentences"),
                      F.array_join("licence.sentences", ",").alias("sentences"),
                      F.array_join("licence.names", ",").alias("licences"), F.col("licence.unmatched").alias("unmatched"))


@query("op6_sharding")
def op6(spark, sf_dir):
    out = shard_documents(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op11_tokenizer_alignment")
def op11(spark, sf_dir):
    return align_tokenizers(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def spelling_sql() -> str:
    """The words with a crc32 over lists of bytes, near words by their deletions, forms followed by recursion."""
    table, poly = [], 0xEDB88320
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (poly if byte & 1 else 0)
        table.append(byte)
    return rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, r, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS r FROM documents)
  WHERE length(r) >= 7 GROUP BY 1, 2),
spelled AS (SELECT r, n, length(r) AS l, hex(encode(doc_id || ':' || r)) AS x FROM runs),
hashed AS (
  SELECT r, n, l, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, b: xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1]))) AS h FROM spelled),
words AS (
  SELECT w AS word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN r[:h % l] || r[h % l + 2:] ELSE r END AS w, n FROM hashed)
  WHERE length(w) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
gaps AS (SELECT word, n, i, word[:i] || word[i + 2:] AS d FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM gaps a JOIN gaps b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.d = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, min(other) FILTER (m = top) AS other
  FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
forms AS (SELECT word, other, m FROM best JOIN words USING (word) WHERE m >= 10 * n),
follow(word, last) AS (SELECT word, word FROM words UNION ALL SELECT f.word, g.other FROM follow f JOIN forms g ON f.last = g.word),
roots AS (SELECT word, last AS root FROM follow WHERE last NOT IN (SELECT word FROM forms))
SELECT word, n, coalesce(n_near, 0) AS n_near, forms.other AS form, forms.m AS form_n, root
FROM words LEFT JOIN best USING (word) LEFT JOIN forms USING (word) JOIN roots USING (word)"""


@query("op12_spelling_variants", spelling_sql())
def op12(spark, sf_dir):
    return spelling_variants(load(spark, sf_dir, "documents"))


@query("op13_embedding_near_duplicates", """
WITH RECURSIVE sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach(d, t) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.d, l.y FROM reach r JOIN links l ON r.t = l.x),
comp AS (SELECT d, min(t) AS c FROM reach GROUP BY d),
degree AS (SELECT x, count(*) AS k FROM links GROUP BY x)
SELECT vec_id, coalesce(k, 0) AS n_links, c AS component_id, c = vec_id AS kept
FROM embeddings JOIN comp ON vec_id = d LEFT JOIN degree ON vec_id = x""")
def op13(spark, sf_dir):
    return near_vectors(load(spark, sf_dir, "embeddings"))
