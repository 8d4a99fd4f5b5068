"""Size-checked broadcast joins, with a salted shuffle join beyond the limit.

A side is broadcast only after its bytes have been measured (a small aggregation over
it) and found within ``broadcast_bytes``. Otherwise the
join shuffles; keys known to be hot (their counts are in the fitted statistics, and a
bounded list of them is passed in) are spread over ``salt_buckets`` reducers on the big
side and replicated on the small side, so no reducer receives a hot key's rows alone.
Without a hot list, AQE's skew-join handling splits oversized partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
ROW_OVERHEAD = 48
SALT_BUCKETS = 64


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a table in memory: texts as they are, 8 for any other value, and an overhead per row."""
    texts = {c for c, kind in df.dtypes if kind == "string"}
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in sorted(texts)), F.lit(ROW_OVERHEAD + 8 * (len(df.columns) - len(texts))))
    return df.agg(F.sum(size.cast("long"))).first()[0] or 0


def join_bounded(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                 broadcast_bytes: int = BROADCAST_BYTES, hot_keys: DataFrame | None = None,
                 salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    if measured_bytes(small) <= broadcast_bytes:
        return big.join(F.broadcast(small), on, how)
    if hot_keys is None:
        return big.join(small, on, how)
    hot = hot_keys.select(*on).distinct().withColumn("__hot", F.lit(True))
    if measured_bytes(hot) > BROADCAST_BYTES:
        raise ValueError("hot-key list must be small enough to broadcast")
    salt_of_row = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(salt_buckets)).cast("int")
    big_s = (big.join(F.broadcast(hot), on, "left")
                .withColumn("__salt", F.when(F.col("__hot"), salt_of_row).otherwise(F.lit(0)))
                .drop("__hot"))
    small_s = (small.join(F.broadcast(hot), on, "left")
                    .withColumn("__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1)))
                                                     .otherwise(F.array(F.lit(0)))))
                    .drop("__hot"))
    return big_s.join(small_s, on + ["__salt"], how).drop("__salt")
