"""Assembling, numeric x categorical crosses, packing with class weights, feature hashing.

The ML-vector forms use Spark ML stages (``VectorAssembler``, ``Interaction``,
``FeatureHasher``); the long forms ``(row, index, value)`` are the relational twins
used for checking and for sparse exports. Crosses are computed per row (unpivot +
broadcast of the bounded index table), never by joining two row-level tables.
"""

from __future__ import annotations

from pyspark.ml.feature import FeatureHasher, Interaction, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.operators import sparse
from clickforge.operators.category import long_places


def assemble(inputs: list[str], output: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """Columns/vectors -> one vector."""
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid=handle_invalid)


def interaction(numeric_vec: str = "std_features", cat_vec: str = "cat_features",
                output: str = "cxn_features") -> Interaction:
    """Outer product of the numeric and one-hot vectors: index i*K + j."""
    return Interaction(inputCols=[numeric_vec, cat_vec], outputCol=output)


def numeric_long(df: DataFrame, cols: list[str], ids: list[str]) -> DataFrame:
    """(ids..., i, value) for a list of numeric columns in order."""
    return df.select(*ids, F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("i", "value"))


def cross_long(df: DataFrame, num_cols: list[str], cat_cols: list[str], gindex: DataFrame, width: int,
               ids: list[str], hot_keys: DataFrame | None = None) -> DataFrame:
    """(ids..., cidx, value): cidx = i * K + gidx(j), value = numeric_i (one-hot is 1.0) (E9 long form).

    ``gindex`` (feature, value, gidx) is the bounded encoding table (see :func:`~clickforge.operators.category.long_places`).
    """
    with_x = df.withColumn("__x", F.array(*[F.col(c).cast("double") for c in num_cols]))
    hot = long_places(with_x, cat_cols, gindex.select("feature", "value", "gidx"), ["gidx"], ids + ["__x"], hot_keys=hot_keys)
    return hot.select(*ids, "gidx", F.posexplode("__x").alias("i", "value")) \
              .select(*ids, (F.col("i") * F.lit(width) + F.col("gidx")).alias("cidx"), "value")


def sparse_cross(df: DataFrame, numeric_vec: str = "std_features", cat_vec: str = "cat_features", output: str = "cxn_features") -> DataFrame:
    """``df`` with the outer product of two storage-struct vectors (E9): place i * K + j, as wide as both widths multiplied.

    The same entries as :func:`interaction`, but the schema holds the width only, at any width.
    """
    k = sparse.width_of(df, cat_vec)
    return df.select("*", sparse.crossed(numeric_vec, cat_vec, sparse.width_of(df, numeric_vec), k, output))


def sparse_pack(df: DataFrame, inputs: list[str], label: str = "label", rate: float | None = None, output: str = "features",
                keep: list[str] | None = None, ml: bool = False) -> DataFrame:
    """E10 / E11 on storage structs: the caller's blocks, in order, as one vector (with ``ml`` an ML vector); with ``rate`` also the class weight."""
    vector = sparse.packed([(c, sparse.width_of(df, c)) for c in inputs], output, ml)
    weight = [] if rate is None else [class_weight(label, rate).alias("weight")]
    return df.select(*(keep or []), label, vector, *weight)


def class_weight(label: str, rate: float):
    """label 0 -> positive rate, label 1 -> 1 - positive rate."""
    return F.when(F.col(label) == 0, F.lit(float(rate))).otherwise(F.lit(1.0 - float(rate)))


def pack(df: DataFrame, inputs: list[str], label: str = "label", rate: float | None = None,
         output: str = "features", keep: list[str] | None = None) -> DataFrame:
    """The caller's blocks, in order, as one vector; with ``rate`` also the class weight."""
    packed = assemble(inputs, output).transform(df)
    weight = [] if rate is None else [class_weight(label, rate).alias("weight")]
    return packed.select(*(keep or []), label, output, *weight)


def vector_width(df: DataFrame, col: str) -> int:
    """Width of a vector column: from the ML attribute metadata, else from one row."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    attrs = meta.get("attrs", {})
    if attrs:
        return sum(len(v) for v in attrs.values())
    row = df.select(col).first()
    return 0 if row is None or row[0] is None else int(row[0].size)


def feature_hasher(cols: list[str], num_features: int = 1 << 18, output: str = "hashed") -> FeatureHasher:
    """String columns hashed to a fixed width."""
    return FeatureHasher(inputCols=cols, outputCol=output, numFeatures=num_features)
