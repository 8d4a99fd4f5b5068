"""Shards of near equal size by longest-processing-time scheduling.

Groups of equal texts stay together. Groups larger than one BUNDLES-th of all bytes are scheduled by
themselves (there are fewer than BUNDLES of them); all smaller groups are gathered into BUNDLES bundles by the
hash of their text. So the heap sees at most 2 * BUNDLES items whatever the input, sorted by size, each going
to the least loaded shard; a bundle of small groups is far smaller than a shard, so the sizes stay near equal.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import keep

SHARDS, BUNDLES = 16, 4096
#: Rows that one task numbers.
ROWS_AT_ONCE = 4096


def schedule(items: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Largest first to the least loaded shard; ties by key, then by shard."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size, key in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heap[0]
        placed[key] = shard
        heapq.heapreplace(heap, (load + size, shard))
    return placed


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs``.

    size: UTF-8 bytes of the text and one more; a null text is like an empty one (size 1, same group). Slots
    count from 0 without gaps in each shard. Repeated rows each get a slot, in the same shard; an empty table
    gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = keep(docs.select(docs[id_col].cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                            F.crc32(text).alias("text_crc32"), F.md5(text).alias("same")), "shard-rows")
    groups = keep(rows.groupBy("same").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
                  .withColumn("bundle", F.concat(F.lit("b"), F.pmod(F.conv(F.substring("same", 1, 8), 16, 10).cast("long"), F.lit(BUNDLES)))), "shard-groups")
    total = groups.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    large = F.col("bytes") * BUNDLES > F.lit(total.bytes or 0)
    big = groups.where(large).select("same", "bytes").collect()  # fewer than BUNDLES
    small = groups.where(~large).groupBy("bundle").agg(F.sum("bytes").alias("bytes")).collect()  # at most BUNDLES
    placed = schedule([(r.bytes, r.same) for r in big] + [(r.bytes, r.bundle) for r in small], shards)
    of_group = spark.createDataFrame([(r.same, placed[r.same]) for r in big], "same string, big_shard int")
    of_bundle = spark.createDataFrame([(r.bundle, placed[r.bundle]) for r in small], "bundle string, small_shard int")
    bundle = F.concat(F.lit("b"), F.pmod(F.conv(F.substring("same", 1, 8), 16, 10).cast("long"), F.lit(BUNDLES)))
    buckets = max(1, -(-(total.n or 0) // (shards * ROWS_AT_ONCE)))
    out = (rows.withColumn("bundle", bundle).join(F.broadcast(of_group), "same", "left").join(F.broadcast(of_bundle), "bundle", "left")
           .withColumn("shard", F.coalesce("big_shard", "small_shard"))
           .withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
           .select("doc_id", "size", "text_crc32", "same", "shard", "bucket"))
    before = out.groupBy("shard", "bucket").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "same")) - 1
    return out.withColumn("own", own).join(before.drop("n"), ["shard", "bucket"]) \
        .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("own")).alias("slot"))
