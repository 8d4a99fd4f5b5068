"""Documents to packed training sequences: quality, line dedup, near dedup, decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; the first four
return the columns of ``documents`` (``n_chars`` follows the text).

Null and empty texts fail the quality rules; handed to a later stage they stay, and are packed as the end mark alone.
Rows without a doc_id stay in every stage. Rows that repeat an id are told apart by their text. An empty table gives
an empty table; further columns, whatever their names, pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.llm.common import keep, load
from clickforge.llm.decontam import without_leaks
from clickforge.llm.line_dedup import drop_repeated_lines
from clickforge.llm.near_dup import without_near_duplicates
from clickforge.llm.packing import pack_documents
from clickforge.llm.quality import quality_rules

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    rows = docs.select("text", "lang", F.struct(*docs.columns).alias("row"))
    return quality_rules(rows, carry=["row"]).where("quality.kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a smaller doc_id also holds; every document stays."""
    rows = docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return drop_repeated_lines(rows).select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_leaks(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 ids."""
    out = pack_documents(docs, public_tokenizers.path(TOKENIZER))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: SQL can express neither the packing nor the alignment; tests hold the stages against brute force.
ORACLE_SQL = None
