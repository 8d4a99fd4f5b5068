"""Categorical features: sentinel fill, rare-value masking, string indexing, one-hot encoding.

The frequent-value table of a feature has at most ``rows / min`` entries (counts
sum to the row count), so it is the bounded side of every join here. It is
broadcast only within a byte budget that all features of a plan share. A table beyond it
is looked up in sorted arrays (:func:`looked_up`), which hold many more values in as many
bytes; what does not fit there either goes through a shuffle join in which NULLs and
known-hot values (their counts are in the statistics) are kept out of the join key's
hash partition by a deterministic salt.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clickforge.functions.scalar import SENTINEL_NULL, SENTINEL_RARE
from clickforge.session import LEAN, ensure_checkpoint_dir, session_conf
from clickforge.operators.joins import BROADCAST_BYTES, join_bounded, measured_bytes
from clickforge.operators.profile import category_frequencies, unpivot

SALT_BUCKETS = 64
#: What a broadcast value costs beside its text.
VALUE_OVERHEAD = 48


def _sizes(table: DataFrame) -> dict:
    """Per feature of a (feature, value, ...) table: values, their bytes in a broadcast join and in sorted arrays."""
    size, n = F.coalesce(F.octet_length("value"), F.lit(0)), F.count(F.lit(1))
    return {r["feature"]: r for r in table.groupBy("feature").agg(
        n.alias("n"), F.sum(size + VALUE_OVERHEAD).alias("bytes"), (n * (F.max(size) + 1 + 16)).alias("array_bytes")).collect()}


def _within(sizes: dict, cols: list[str], budget: int, key: str) -> list[str]:
    """The features of ``cols`` whose tables fit the budget together, smallest first."""
    fits, left = [], budget
    for c in sorted((c for c in cols if c in sizes), key=lambda c: (sizes[c][key], c)):
        if sizes[c][key] <= left:
            fits.append(c)
            left -= sizes[c][key]
    return fits


def looked_up(table: DataFrame, col: str, places: list[str]) -> Column:
    """struct<places...> of ``col`` in a (value, places...) table of whole numbers, NULL where it is not there.

    The values are broadcast as one sorted array of bytes beside the arrays of their places, so a row is answered by
    a halving search: no shuffle, and 8 bytes a place and no object for a value. The caller sees to it that the table is small.
    """
    spark, found = table.sparkSession, table.where(F.col("value").isNotNull()).select(F.encode("value", "UTF-8").alias("value"), *places).toArrow()
    ended = lambda texts: [b + b"\x01" for b in texts]  # noqa: E731  numpy drops zero bytes at the end
    keys = np.array(ended(found["value"].to_pylist()) or [b"\x01"], dtype="S")
    order = np.argsort(keys[:found.num_rows])
    shared = spark.sparkContext.broadcast((keys[order] if len(order) else keys[:0], [found[p].to_numpy()[order].astype(np.int64) for p in places]))

    def run(value: pa.Array) -> pa.Array:
        keys, numbers = shared.value
        given = value.dictionary_encode()
        texts = ended(given.dictionary.cast(pa.binary()).to_pylist())
        fits = np.array([len(t) <= keys.itemsize for t in texts], bool)
        wanted = np.array(texts, dtype=keys.dtype)  # longer texts are cut here, and are not in the table
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        hit = fits & (keys[at] == wanted) if len(keys) else np.zeros(len(texts), bool)
        where = pc.take(pa.array(at, mask=~hit), given.indices)
        return pa.StructArray.from_arrays([pc.take(pa.array(a), where) for a in numbers], names=places, mask=where.is_null())

    return F.arrow_udf(run, ", ".join(f"{p} long" for p in places))(F.col(col).cast("string"))


def fill_categorical(df: DataFrame, cols: list[str], value: str = SENTINEL_NULL) -> DataFrame:
    """Categorical NULL -> sentinel."""
    return df.fillna(value, subset=cols)


def replace_values(df: DataFrame, values: list[str], replacement: str, cols: list[str]) -> DataFrame:
    """Replace a short explicit value list in some columns."""
    return df.replace(values, replacement, subset=cols)


def fit_frequent_values(freq: DataFrame, minimum: int, inclusive: bool = False) -> DataFrame:
    """(feature, value, counts) of values kept by the mask: counts > min, or >= min (E2 / E3 fit)."""
    keep = F.col("counts") >= minimum if inclusive else F.col("counts") > minimum
    return freq.filter(keep & F.col("value").isNotNull())


def mask_uncommon(df: DataFrame, cols: list[str], frequent: DataFrame, replacement: str = SENTINEL_RARE,
                  broadcast_bytes: int = BROADCAST_BYTES, partitions: int | None = None) -> DataFrame:
    """Replace values absent from the frequent table with ``rarebeef`` (E2, E3 apply; F6, F7).

    NULL stays NULL (``NOT IN`` on NULL is NULL -> otherwise-branch). Values unseen in train are masked. One
    left join per feature against its frequent values. All features share one broadcast budget in bytes, the
    smallest tables first; larger ones are looked up in sorted arrays within the same budget. What does not fit
    there either is joined by a shuffle in which NULLs and hot values (those with more than 1 / (2 * partitions) of
    the feature's rows, so at most 2 * partitions of them) get a salt.
    """
    sizes = _sizes(frequent)
    fits = _within(sizes, cols, broadcast_bytes, "bytes")
    arrays = _within(sizes, [c for c in cols if c not in fits], broadcast_bytes, "array_bytes")
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df
    for c in cols:
        if c not in sizes:
            out = out.withColumn(c, F.when(F.col(c).isNotNull(), F.lit(replacement)))
            continue
        fr = frequent.filter(F.col("feature") == c).select(F.col("value").alias(f"__v_{c}"))
        if c in fits:
            out = out.join(F.broadcast(fr), F.col(c) == F.col(f"__v_{c}"), "left")
            kept = F.col(f"__v_{c}").isNotNull()
        elif c in arrays:
            one = frequent.filter(F.col("feature") == c).select("value", F.lit(1).alias("known"))
            out = out.withColumn(f"__v_{c}", looked_up(one, c, ["known"]))
            kept = F.col(f"__v_{c}").isNotNull()
        else:
            own = frequent.filter(F.col("feature") == c)
            hot = [r["value"] for r in hot_values(own, own.agg(F.sum("counts")).first()[0], parts).collect()]
            is_hot = F.col(c).isNull() | F.col(c).isin(hot)
            salt = F.concat(F.lit("\u0001"), F.pmod(F.xxhash64(*[F.col(x) for x in df.columns]),
                                                   F.lit(SALT_BUCKETS)).cast("string"))
            out = out.withColumn(f"__k_{c}", F.when(is_hot, salt).otherwise(F.col(c)))
            out = out.join(fr, F.col(f"__k_{c}") == F.col(f"__v_{c}"), "left").drop(f"__k_{c}")
            kept = F.col(f"__v_{c}").isNotNull() | F.col(c).isin(hot)
        out = out.withColumn(c, F.when(F.col(c).isNull(), F.lit(None).cast("string"))
                                 .when(kept, F.col(c)).otherwise(F.lit(replacement))).drop(f"__v_{c}")
    return out.select(*df.columns)


def fit_string_index(freq: DataFrame, partitions: int | None = None) -> DataFrame:
    """(feature, value, counts, idx): most frequent value = 0, ties by value ascending (E4, relational).

    Matches ``StringIndexer(stringOrderType='frequencyDesc')`` without ranking a whole
    feature in one task: rows are range-partitioned on (feature, counts desc, value),
    ranked inside each (partition, feature) piece, and shifted by the sizes of the same
    feature's pieces in earlier partitions (a table of at most partitions x features rows).
    """
    spark = freq.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("feature").asc(), F.col("counts").desc(), F.col("value").asc()]
    ranged = (freq.filter(F.col("value").isNotNull())
                  .repartitionByRange(parts, *order)
                  .withColumn("__p", F.spark_partition_id()))
    ensure_checkpoint_dir(spark)
    with session_conf(spark, LEAN):
        ranged = ranged.checkpoint(eager=True)   # pin the partition ids: both branches read the same rows
    w_piece = Window.partitionBy("__p", "feature").orderBy(F.col("counts").desc(), F.col("value").asc())
    local = ranged.withColumn("__r", F.row_number().over(w_piece) - 1)
    sizes = ranged.groupBy("__p", "feature").agg(F.count(F.lit(1)).alias("__n"))
    w_off = Window.partitionBy("feature").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.withColumn("__off", F.coalesce(F.sum("__n").over(w_off), F.lit(0))).drop("__n")
    return (local.join(F.broadcast(offs), ["__p", "feature"])
                 .select("feature", "value", "counts", (F.col("__off") + F.col("__r")).cast("int").alias("idx")))


def feature_offsets(index: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, width, offset): where each feature's one-hot block starts in the assembled vector."""
    widths = index.groupBy("feature").agg(F.count(F.lit(1)).alias("width"))
    order = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    w = Window.orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)  # <= len(cols) rows
    return (widths.withColumn("__pos", order[F.col("feature")])
                  .withColumn("offset", F.coalesce(F.sum("width").over(w), F.lit(0)))
                  .drop("__pos"))


def one_hot_long(df: DataFrame, cols: list[str], index: DataFrame, ids: list[str],
                 broadcast_bytes: int = BROADCAST_BYTES, hot_keys: DataFrame | None = None) -> DataFrame:
    """Sparse one-hot in long form: (ids..., feature, idx, gidx) with gidx = offset + idx.

    Values unseen in the index get no entry (the all-zero block of ``handleInvalid='keep'``
    with ``dropLast=True``). A layout too large to broadcast is looked up row by row before the
    features are laid out in long form (:func:`feature_places`); if parts of it do not fit there either,
    ``hot_keys`` (feature, value) are salted in a shuffle join (see :func:`hot_values`).
    """
    if "gidx" in index.columns:      # a precomputed layout (feature, value, idx, gidx)
        table = index.select("feature", "value", "idx", "gidx")
    else:
        offs = feature_offsets(index, cols)
        table = index.join(F.broadcast(offs), "feature").select(
            "feature", "value", "idx", (F.col("offset") + F.col("idx")).alias("gidx"))
    return long_places(df, cols, table, ["idx", "gidx"], ids, broadcast_bytes, hot_keys)


def feature_places(df: DataFrame, cols: list[str], table: DataFrame, places: list[str],
                   broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, dict[str, Column], list[str]]:
    """``df`` with the places of each feature's value, found without a shuffle: the frame, struct<places...> by feature, the features left.

    ``table`` is (feature, value, places...). Its features share one broadcast budget, smallest first; of the others,
    those that fit it as sorted arrays are looked up there. A value that is not in the table has a NULL struct.
    """
    sizes = _sizes(table)
    fits = _within(sizes, cols, broadcast_bytes, "bytes")
    arrays = _within(sizes, [c for c in cols if c not in fits], broadcast_bytes, "array_bytes")
    out, found = df, {}
    for c in (*fits, *arrays):
        own, name = table.where(F.col("feature") == c), f"__g_{c}"
        if c in fits:
            one = own.select(F.col("value").alias(f"__v_{c}"), F.struct(*[F.col(p).cast("long").alias(p) for p in places]).alias(name))
            out = out.join(F.broadcast(one), F.col(c) == F.col(f"__v_{c}"), "left").drop(f"__v_{c}")
        else:
            out = out.withColumn(name, looked_up(own.select("value", *places), c, places))
        found[c] = F.col(name)
    return out, found, [c for c in cols if c in sizes and c not in found]


def long_places(df: DataFrame, cols: list[str], table: DataFrame, places: list[str], ids: list[str],
                broadcast_bytes: int = BROADCAST_BYTES, hot_keys: DataFrame | None = None) -> DataFrame:
    """(ids..., feature, places...): a row for every feature whose value is in the (feature, value, places...) ``table``."""
    if measured_bytes(table) > broadcast_bytes:
        out, found, rest = feature_places(df, cols, table, places, broadcast_bytes)
        if not rest:
            if not found:
                return unpivot(df, cols, ids=ids).join(table, ["feature", "value"]).select(*ids, "feature", *places)
            entries = F.array(*[F.struct(F.lit(c).alias("feature"), at.alias("at")) for c, at in found.items()])
            long = out.select(*ids, F.inline(F.filter(entries, lambda e: e["at"].isNotNull())))
            kinds = dict(table.dtypes)
            return long.select(*ids, "feature", *[F.col("at")[p].cast(kinds[p]).alias(p) for p in places])
    return join_bounded(unpivot(df, cols, ids=ids), table, ["feature", "value"], broadcast_bytes=broadcast_bytes,
                        hot_keys=hot_keys).select(*ids, "feature", *places)


def masked_stats(stats: DataFrame, minimum: int, inclusive: bool = False, replacement: str = SENTINEL_RARE) -> DataFrame:
    """The category table (A7) of the masked train rows, from that of the filled rows: rare values counted as one."""
    common = F.col("counts") >= minimum if inclusive else F.col("counts") > minimum
    value = F.when(F.col("value").isNull() | common, F.col("value")).otherwise(F.lit(replacement))
    return stats.groupBy("feature", value.alias("value")).agg(F.sum("counts").alias("counts"))


def fit_layout(stats: DataFrame, cols: list[str], partitions: int | None = None) -> DataFrame:
    """(feature, value, idx, gidx): the one-hot layout of a category table (A7), fitted without any label on the driver."""
    index = fit_string_index(stats, partitions)
    return index.join(F.broadcast(feature_offsets(index, cols)), "feature").select(
        "feature", "value", "idx", (F.col("offset") + F.col("idx")).cast("int").alias("gidx"))


def encode_places(df: DataFrame, cols: list[str], layout: DataFrame, key: str, output: str = "places",
                  broadcast_bytes: int = BROADCAST_BYTES, hot_keys: DataFrame | None = None) -> DataFrame:
    """``df`` with the ascending one-hot places of each row's values as an array (E4, E5, E7); only look-up tables within the
    broadcast budget pass the driver.

    ``layout`` is :func:`fit_layout`'s table. What fits the budget is looked up without a shuffle (:func:`feature_places`).
    The values of all other features go through one long-form join (hot values salted, see
    :func:`hot_values`) and come back as one short list per ``key``, which must tell the rows apart. Values unseen in
    the layout and NULLs have no place (the all-zero block).
    """
    out, at, rest = feature_places(df, cols, layout, ["gidx"], broadcast_bytes)
    found = [g["gidx"].cast("int") for g in at.values()]
    places = F.filter(F.array(*found), lambda g: g.isNotNull()) if found else F.array().cast("array<int>")
    if rest:
        long = unpivot(df, rest, ids=[key])
        table = layout.select("feature", "value", "gidx")
        long = join_bounded(long, table, ["feature", "value"], broadcast_bytes=-1, hot_keys=hot_keys)
        lists = long.groupBy(F.col(key).alias("__key")).agg(F.collect_list("gidx").alias("__rest"))  # one place a feature at most
        out = out.join(lists, out[key] == lists["__key"], "left")
        places = F.concat(places, F.coalesce("__rest", F.array().cast("array<int>")))
    return out.select(*df.columns, F.sort_array(places).alias(output))


def encoding_pipeline(cols: list[str], output: str = "cat_features", keep_unseen: bool = True) -> Pipeline:
    """StringIndexer(multi) -> OneHotEncoder(multi) -> VectorAssembler (E4, E5, E6, E7), for small vocabularies.

    The fit holds every label on the driver; :func:`encode_places` gives the same vectors without. ``keep_unseen``: unseen values map to an all-zero block of the same width
    (the reference's default would raise on them).
    """
    idx = [f"{c}_idx" for c in cols]
    vec = [f"{c}_vec" for c in cols]
    indexer = StringIndexer(inputCols=cols, outputCols=idx, stringOrderType="frequencyDesc",
                            handleInvalid="keep" if keep_unseen else "error")
    # the indexer's "unknown" slot is the last category; dropLast removes it -> all-zero block
    encoder = OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=keep_unseen, handleInvalid="error")
    assembler = VectorAssembler(inputCols=vec, outputCol=output)
    return Pipeline(stages=[indexer, encoder, assembler])


def fit_category_stats(train: DataFrame, cols: list[str]) -> DataFrame:
    """Category statistics table of the train subset (A7), kept as a DataFrame."""
    return category_frequencies(train, cols)


def hot_values(stats: DataFrame, rows: int, partitions: int) -> DataFrame:
    """(feature, value) whose train count exceeds rows / (2 * partitions): at most 2 * partitions
    values per feature (counts of a feature sum to ``rows``), the keys worth salting."""
    return stats.filter(F.col("counts") > rows / (2 * partitions)).select("feature", "value")
