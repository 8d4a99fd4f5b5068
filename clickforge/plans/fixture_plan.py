"""The feature-preparation plan over the ``impressions`` fixture, as reusable lazy steps.

Each helper returns DataFrames (lazy) plus the small fitted statistics it needed.
Statistics are fitted on ``train`` only and applied to every subset.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.operators import category as cat
from clickforge.operators import numeric as num
from clickforge.operators import sparse
from clickforge.session import session_conf, stable_root
from clickforge.sources import files
from clickforge.sources import fixture as fx

# The standardisation rule of every fixture column.
FIXTURE_RULES = {
    "n01": "scale2sd", "n02": "median_z", "n03": "scale1sd", "n04": "max", "n05": "median_z",
    "n06": "scale2sd", "n07": "median_z", "n08": "median_z", "n09": "scale1sd",
}


SOURCES = ("lineitem", "orders", "part", "customer", "nation")


_KEYS: dict[tuple[str, str], str] = {}


def _source_key(spark: SparkSession, sf_dir: str) -> str:
    """Content key of the source tables: path, byte length and modification time of each."""
    memo = (spark.sparkContext.applicationId, sf_dir)
    if memo not in _KEYS:
        _KEYS[memo] = _compute_key(spark, sf_dir)
    return _KEYS[memo]


def _compute_key(spark: SparkSession, sf_dir: str) -> str:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = [sf_dir]
    for t in SOURCES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(conf)
        parts += [t, str(fs.getContentSummary(path).getLength()), str(fs.getFileStatus(path).getModificationTime())]
    return hashlib.md5("|".join(parts).encode()).hexdigest()[:16]


#: Line items that one task of the import's joins sorts.
ROWS_A_TASK = 250_000


def join_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Shuffle partitions of the import: the session's, or more where a task's share would grow with the input.

    The rows are counted from the Parquet footers.
    """
    rows = fx.table(spark, sf_dir, "lineitem").count()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK))


def import_path(spark: SparkSession, sf_dir: str) -> str:
    """S1 + P1 + S11: the fixture imported once as Parquet with its ``subset`` column.

    Written under the shared checkpoint folder, keyed by the sources' content and the code,
    and reused while complete (``_SUCCESS``); an interrupted import is left alone and the
    next attempt writes a fresh folder. Later passes read pruned columns instead of
    re-running the joins, and lineage stops here. A task sorts a bounded share of the rows, whatever the
    input (:func:`join_partitions`), and ``subset`` is a plain column: writing a folder for each subset would sort
    the whole rows once more, which costs more than reading the small subsets along.
    """
    store = files.StepStore(spark, import_root(spark, sf_dir))
    done = store.resolve("whole")
    if done is not None:
        return done
    df = fx.with_subset(fx.impressions(spark, sf_dir))
    path = store.fresh("whole")
    with session_conf(spark, {"spark.sql.shuffle.partitions": join_partitions(spark, sf_dir)}):
        files.write_table(df, path)
    return path


def import_root(spark: SparkSession, sf_dir: str) -> str:
    """Where a source's import and fitted steps live: by the sources' content and by this code, so neither a
    changed table nor a changed rule, threshold or operator is ever served an older fit."""
    return f"{stable_root(spark)}/clickforge-import/{_source_key(spark, sf_dir)}-{files.code_version()}"


@dataclass
class Prepared:
    """The plan's fitted steps for one source directory.

    Like the reference's step runner, every fitted artifact (statistics tables, the
    masked table, the index, the encoded vectors) is written once as Parquet next to
    the import and reused while complete; a missing artifact is refitted. Names carry
    the parameters (threshold, inclusiveness), so different settings never collide.
    """
    spark: SparkSession
    sf_dir: str
    materialize: bool = True
    _cache: dict = field(default_factory=dict)

    def _memo(self, key, fn):
        if key not in self._cache:
            self._cache[key] = fn()
        return self._cache[key]

    @property
    def store(self) -> files.StepStore:
        return self._memo("store", lambda: files.StepStore(self.spark, import_root(self.spark, self.sf_dir)))

    @property
    def imp(self) -> DataFrame:
        """All rows with their ``subset`` column (the imported + split table, see :func:`import_path`)."""
        def build():
            if not self.materialize:
                return fx.with_subset(fx.impressions(self.spark, self.sf_dir))
            return self.spark.read.parquet(import_path(self.spark, self.sf_dir)).select(*fx.COLUMNS, "subset")
        return self._memo("imp", build)

    def step(self, name: str, build) -> DataFrame:
        """A fitted table: reuse the complete written copy, else build, write once and scan back."""
        def run():
            if not self.materialize:
                return build()
            done = self.store.resolve("fitted", name)
            if done is None:
                files.write_table(build(), self.store.fresh("fitted", name))
                done = self.store.resolve("fitted", name)
            return self.spark.read.parquet(done)
        return self._memo(("step", name), run)

    def subset(self, name: str) -> DataFrame:
        return self.imp.filter(F.col("subset") == name).drop("subset")

    @property
    def whole(self) -> DataFrame:
        return self.imp.drop("subset")

    @property
    def train(self) -> DataFrame:
        return self.subset("train")

    @property
    def num_stats_df(self) -> DataFrame:
        return self.step("num-stats", lambda: num.fit_numeric_stats(self.train, fx.NUMERIC))

    @property
    def num_stats(self) -> dict:
        return self._memo("ns", lambda: num.stats_dict(self.num_stats_df))

    def normed(self) -> DataFrame:
        """E1 over all subsets: id, subset, label, std_features, c01..c12 (NULL -> deadbeef)."""
        return num.standardize(self.imp, self.num_stats, FIXTURE_RULES, fx.CATEGORICAL,
                               keep=[fx.ID, "subset"])

    def filled(self) -> DataFrame:
        return cat.fill_categorical(self.imp, fx.CATEGORICAL)

    def cat_stats(self) -> DataFrame:
        """Category frequencies of the filled train subset (A7 fit)."""
        return self.step("cat-stats", lambda: cat.fit_category_stats(
            self.filled().filter(F.col("subset") == "train"), fx.CATEGORICAL))

    def frequent(self, minimum: int = fx.MASK_MIN, inclusive: bool = False) -> DataFrame:
        return cat.fit_frequent_values(self.cat_stats(), minimum, inclusive)

    def masked(self, minimum: int = fx.MASK_MIN, inclusive: bool = False) -> DataFrame:
        """Filled + masked categoricals for all subsets."""
        name = f"masked-{minimum:06d}{'-inclusive' if inclusive else ''}"
        return self.step(name, lambda: cat.mask_uncommon(self.filled(), fx.CATEGORICAL,
                                                         self.frequent(minimum, inclusive)))

    def masked_train_stats(self) -> DataFrame:
        return self.step("masked-stats", lambda: cat.fit_category_stats(
            self.masked().filter(F.col("subset") == "train"), fx.CATEGORICAL))

    def string_index(self) -> DataFrame:
        return self.step("index", lambda: cat.fit_string_index(self.masked_train_stats()))

    def one_hot(self) -> DataFrame:
        """(imp_id, subset, label, feature, idx, gidx) for every subset."""
        return cat.one_hot_long(self.masked(), fx.CATEGORICAL, self.gindex(), [fx.ID, "subset", fx.LABEL],
                                hot_keys=self.hot_keys())

    def hot_keys(self) -> DataFrame:
        """(feature, value) pairs heavy enough to salt in shuffle joins (bounded per feature)."""
        def build():
            rows = self.train.count()
            parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            return cat.hot_values(self.masked_train_stats(), rows, parts)
        return self._memo("hot", build)

    def cat_width(self) -> int:
        return self._memo("kw", lambda: self.string_index().count())

    def gindex(self) -> DataFrame:
        """(feature, value, idx, gidx): the bounded one-hot layout of the masked train."""
        def build():
            offs = cat.feature_offsets(self.string_index(), fx.CATEGORICAL)
            return self.string_index().join(F.broadcast(offs), "feature").select(
                "feature", "value", "idx", (F.col("offset") + F.col("idx")).alias("gidx"))
        return self.step("gindex", build)

    def std_masked(self) -> DataFrame:
        """Masked categoricals plus the standardised numerics ``n*_std`` on the same rows."""
        return num.standardize_columns(self.masked(), self.num_stats, FIXTURE_RULES)

    def encoded_structs(self) -> DataFrame:
        """std_features + cat_features of all rows as storage structs, from the relational index."""
        def build():
            m = cat.encode_places(self.std_masked(), fx.CATEGORICAL, self.gindex(), fx.ID, hot_keys=self.hot_keys())
            std = sparse.numeric_entries([f"{c}_std" for c in fx.NUMERIC])
            return m.select(fx.ID, "subset", fx.LABEL, sparse.vector(std, len(fx.NUMERIC), "std_features"),
                            sparse.one_hot_vector("places", self.cat_width(), "cat_features"))
        return self.step("encoded-structs", build)

    def encoded(self) -> DataFrame:
        """:meth:`encoded_structs` as ML vectors, for the ML stages."""
        if not self.materialize:
            raise ValueError("ML vectors are read from the written step")
        self.encoded_structs()
        return sparse.read_vectors(self.spark, self.store.resolve("fitted", "encoded-structs"))
