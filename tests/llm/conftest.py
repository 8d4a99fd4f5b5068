import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("node", T.StringType()), T.StructField("component", T.LongType()), T.StructField("quality", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("leaks", T.StringType()),
    T.StructField("lines", T.StringType()), T.StructField("line", T.StringType()), T.StructField("shard", T.StringType()),
    T.StructField("language", T.StringType()), T.StructField("licence", T.StringType())])
EXTRA = ("x", None, "q", None, "s", "l", "n", None, "d", None, "c")

PROSE = ("the quick brown fox jumps over the lazy dog and runs to the river\n"
         "a second line of this short story that is here for the test\n") * 1
LONG = " ".join(f"word{i % 977} of number {i}" for i in range(12000))

ODD_ROWS = [(1, None, "en"), (2, "", None), (3, " \t\n\r ", "en"), (4, LONG, "en"), (5, PROSE, "en"), (6, PROSE, None),
            (6, PROSE, None), (7, "one two", "fr"), (8, "x" * 300_000, "de"), (9, "\n" * 50, "en"), (None, PROSE, "en"),
            (10, "日本語 текст ñ é \U0001F600 +1 (629) 555-0812", "xx")]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns with clashing names."""
    return spark.createDataFrame([r + EXTRA for r in ODD_ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
