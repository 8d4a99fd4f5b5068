"""The ``impressions`` table: a CTR-shaped view over the driver's star-schema tables.

One row per line item: a 0/1 ``label``, numeric features ``n01..n09`` (some with
NULLs) and categorical features ``c01..c12`` (some high-cardinality, some with
NULLs). The same text, :data:`IMPRESSIONS_SQL`, runs unchanged in DuckDB (the
oracle); the Spark side is written with the DataFrame API so Catalyst sees plain
equi-joins and prunes every unused column at the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.functions.hashing import md5_place, md5_place_sql, share_edges

LABEL = "label"
NOISE_LABEL = "label_noise"
ID = "imp_id"
NUMERIC = [f"n{i:02d}" for i in range(1, 10)]
CATEGORICAL = [f"c{i:02d}" for i in range(1, 13)]
COLUMNS = [ID, LABEL, NOISE_LABEL] + NUMERIC + CATEGORICAL
SPLIT_SEED = 2019
MASK_MIN = 40

IMPRESSIONS_SQL = """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING), '-',
              CAST(l_suppkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
              CAST(CAST(l_quantity AS INT) AS STRING)) AS imp_id,
       CASE WHEN l_quantity * l_extendedprice * (1 - l_discount) > 2000000 THEN 1 ELSE 0 END AS label,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label_noise,
       l_quantity AS n01,
       NULLIF(l_discount, 0) AS n02,
       NULLIF(l_tax, 0) AS n03,
       CAST(l_linenumber AS DOUBLE) AS n04,
       l_extendedprice AS n05,
       p_retailprice AS n06,
       o_totalprice AS n07,
       c_acctbal AS n08,
       CAST(p_size AS DOUBLE) AS n09,
       l_returnflag AS c01, l_linestatus AS c02, p_brand AS c03, p_type AS c04,
       NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS c05,
       c_mktsegment AS c06, n_name AS c07,
       CAST(l_suppkey AS STRING) AS c08, p_name AS c09,
       CAST(o_custkey AS STRING) AS c10,
       o_orderstatus AS c11,
       CAST(l_partkey AS STRING) AS c12
FROM lineitem
JOIN orders   ON l_orderkey = o_orderkey
JOIN part     ON l_partkey  = p_partkey
JOIN customer ON o_custkey  = c_custkey
JOIN nation   ON c_nationkey = n_nationkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture as a lazy DataFrame (joins planned by Catalyst; small dims broadcast by size)."""
    # A table stored as one unsplittable file would run the whole plan in one task: spread
    # the two large inputs when they arrive in fewer splits than there are cores (both, so
    # the size-based join choice still broadcasts the smaller side and streams the larger).
    cores = spark.sparkContext.defaultParallelism

    def spread(df: DataFrame) -> DataFrame:
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    li = spread(table(spark, sf_dir, "lineitem"))
    o = spread(table(spark, sf_dir, "orders"))
    p = table(spark, sf_dir, "part")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    # customer and nation attach to orders first (an orders-sized join), so at scale the
    # lineitem-sized side is shuffled at most twice (by order key, by part key), not three times
    oc = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    joined = li.join(oc, li.l_orderkey == oc.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    s = lambda x: F.col(x).cast("string")
    return joined.select(
        F.concat(s("l_orderkey"), F.lit("-"), s("l_partkey"), F.lit("-"), s("l_suppkey"), F.lit("-"),
                 s("l_linenumber"), F.lit("-"), F.col("l_quantity").cast("int").cast("string")).alias(ID),
        F.when(F.col("l_quantity") * F.col("l_extendedprice") * (1 - F.col("l_discount")) > 2000000, 1)
         .otherwise(0).alias(LABEL),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias(NOISE_LABEL),
        F.col("l_quantity").alias("n01"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("n02"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("n03"),
        F.col("l_linenumber").cast("double").alias("n04"),
        F.col("l_extendedprice").alias("n05"),
        F.col("p_retailprice").alias("n06"),
        F.col("o_totalprice").alias("n07"),
        F.col("c_acctbal").alias("n08"),
        F.col("p_size").cast("double").alias("n09"),
        F.col("l_returnflag").alias("c01"), F.col("l_linestatus").alias("c02"),
        F.col("p_brand").alias("c03"), F.col("p_type").alias("c04"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("c05"),
        F.col("c_mktsegment").alias("c06"), F.col("n_name").alias("c07"),
        s("l_suppkey").alias("c08"), F.col("p_name").alias("c09"),
        s("o_custkey").alias("c10"), F.col("o_orderstatus").alias("c11"),
        s("l_partkey").alias("c12"),
    )


RATIOS = (0.8, 0.1, 0.1)


def subset_column(key: str = ID, seed: int = SPLIT_SEED, ratios=RATIOS):
    """'train' / 'tests' / 'valid' from the md5 place of the key (P1, reproducible)."""
    place, (first, second) = md5_place(key, seed), share_edges(ratios)
    return (F.when(place < F.lit(first), F.lit("train"))
             .when(place < F.lit(second), F.lit("tests"))
             .otherwise(F.lit("valid")))


def with_subset(df: DataFrame, key: str = ID, seed: int = SPLIT_SEED) -> DataFrame:
    return df.withColumn("subset", subset_column(key, seed))


def subsets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """train / tests / valid frames of the fixture (filters on a pure hash: no shuffle)."""
    imp = with_subset(impressions(spark, sf_dir))
    return {name: imp.filter(F.col("subset") == name).drop("subset") for name in ("train", "tests", "valid")}


# ---- SQL spellings for the DuckDB oracles -------------------------------------------------------

def subset_sql(key: str = ID, seed: int = SPLIT_SEED) -> str:
    place, (first, second) = md5_place_sql(key, seed), share_edges(RATIOS)
    return f"CASE WHEN {place} < {first} THEN 'train' WHEN {place} < {second} THEN 'tests' ELSE 'valid' END"


def oracle_prelude() -> str:
    """``WITH impressions AS (...), imp AS (+subset), train AS (...)`` for oracle SQL."""
    return (f"WITH impressions AS ({IMPRESSIONS_SQL}),\n"
            f"imp AS (SELECT *, {subset_sql()} AS subset FROM impressions),\n"
            f"train AS (SELECT * EXCLUDE (subset) FROM imp WHERE subset = 'train'),\n"
            f"tests AS (SELECT * EXCLUDE (subset) FROM imp WHERE subset = 'tests'),\n"
            f"valid AS (SELECT * EXCLUDE (subset) FROM imp WHERE subset = 'valid')\n")
