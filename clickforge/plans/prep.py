"""The whole feature-preparation run as materialised, resumable steps.

import -> split -> measure numbers -> standardise -> measure categories -> mask ->
encode -> pick (chi2) -> cross -> pack (+ class weights) -> toy sample, each step
written under a breadcrumb name (``train.parquet.normed.masked-000040.encode...``).
A step's manifest names its inputs, parameters and code, and it is reused only where
these are the same (:class:`~clickforge.sources.files.ManifestStore`). Statistics, the
one-hot layout and the picked columns are tables, vectors are storage structs; every
fit uses the train subset only, and only look-up tables within the broadcast budget
pass the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.functions.scalar import SENTINEL_RARE
from clickforge.operators import category as cat
from clickforge.operators import cross as crs
from clickforge.operators import numeric as num
from clickforge.operators import select as sel
from clickforge.operators import sparse
from clickforge.operators import split as spl
from clickforge.sources import files

SUBSETS = ("train", "tests", "valid")


@dataclass
class PrepConfig:
    key: str
    label: str
    numeric: list[str]
    categorical: list[str]
    rules: dict[str, str]
    minimum: int = 40
    inclusive: bool = False
    top: int | None = None          # chi2 top-N picked one-hot columns (None: keep all)
    crosses: bool = False           # numeric x one-hot interaction block
    toy_rows: int = 1000
    seed: int = 2019


class FeaturePrep:
    """Runs the steps; ``run()`` returns the packed train/tests/valid frames."""

    def __init__(self, spark: SparkSession, root: str, cfg: PrepConfig):
        self.spark, self.cfg = spark, cfg
        self.store = files.ManifestStore(spark, root)
        #: the steps of the last run, by (subset, breadcrumb)
        self.steps: dict[tuple[str, str], files.Step] = {}

    def _table(self, subset: str, name: str, inputs: list[files.Step], params: dict, build, by: str | None = None,
               crossed: bool = False) -> files.Step:
        """A step whose output is the table ``build()``."""
        def make(path: str) -> None:
            files.write_table(build(), path, by, crossed)
        step = self.store.step(subset, name, [s.key for s in inputs], params, make)
        self.steps[subset, name] = step
        return step

    def _read(self, step: files.Step) -> DataFrame:
        return self.spark.read.parquet(step.path)

    def _each(self, name: str, before: dict[str, files.Step], inputs: list[files.Step], params: dict, build,
              crossed: bool = False) -> dict[str, files.Step]:
        """``build(rows)`` of every subset's step before, with what was fitted in ``inputs``."""
        return {sub: self._table(sub, name, [before[sub], *inputs], params, lambda s=sub: build(self._read(before[s])), crossed=crossed)
                for sub in SUBSETS}

    def split(self, whole: DataFrame, source: str) -> dict[str, files.Step]:
        """Hash split written once, partitioned by subset."""
        c = self.cfg
        given = files.Step("", source, 0, False)
        split = self._table("split", "", [given], {"key": c.key, "seed": c.seed},
                            lambda: spl.hash_split(whole, c.key, c.seed), by="subset")
        return {s: files.Step(f"{split.path}/subset={s}", f"{split.key}-{s}", 0, split.ran) for s in SUBSETS}

    def run(self, whole: DataFrame, source: str | None = None) -> dict[str, DataFrame]:
        """The packed frames as ML vectors. ``source`` names the input's content (default: a fingerprint, one scan)."""
        c = self.cfg
        raw = self.split(whole, source or files.content_key(whole))
        train = self._read(raw["train"])

        measured = self._table("stats", "numeric", [raw["train"]], {"numeric": c.numeric}, lambda: num.fit_numeric_stats(train, c.numeric))
        stats = num.stats_dict(self._read(measured))
        name = "normed"
        normed = self._each(name, raw, [measured], {"rules": c.rules, "categorical": c.categorical, "label": c.label, "key": c.key},
                            lambda df: self._normed(df, stats))

        counted = self._table("stats", "categories", [raw["train"]], {"categorical": c.categorical},
                              lambda: cat.fit_category_stats(cat.fill_categorical(train, c.categorical), c.categorical))
        limit = {"minimum": c.minimum, "inclusive": c.inclusive}
        frequent = cat.fit_frequent_values(self._read(counted), c.minimum, c.inclusive)
        name += f".masked-{c.minimum:06d}"
        masked = self._each(name, normed, [counted], limit, lambda df: cat.mask_uncommon(df, c.categorical, frequent))

        laid = self._table("stats", "layout", [counted], limit | {"order": c.categorical}, lambda: cat.fit_layout(
            cat.masked_stats(self._read(counted), c.minimum, c.inclusive, SENTINEL_RARE), c.categorical))
        layout = self._read(laid)
        name += ".encode"
        encoded = self._each(name, masked, [laid], {}, lambda df: self._encoded(df, layout, laid.rows))

        blocks = ["std_features", "cat_features"]
        if c.top:
            picks = self._table("stats", f"picked-{c.top:06d}", [masked["train"], laid], {"top": c.top}, lambda: sel.chi2_top_n(
                sel.chi2_scores(self._read(masked["train"]), c.categorical, layout, c.label), c.top))
            top = [r["gidx"] for r in self._read(picks).orderBy("pos").collect()]  # at most ``top``
            name += f".picked-{c.top:06d}"
            encoded = self._each(name, encoded, [picks], {}, lambda df: self._picked(df, top))
            blocks[1] = "top_features"
        if c.crosses:
            name += ".crossed"
            encoded = self._each(name, encoded, [], {}, crs.sparse_cross, crossed=True)
            blocks.append("cxn_features")

        balance = self._table("stats", "balance", [raw["train"]], {"label": c.label}, lambda: train.agg(
            F.avg(F.col(c.label).cast("double")).alias("balance_rate")))
        rate = self._read(balance).first()["balance_rate"]
        name += ".packed"
        self.packed = self._each(name, encoded, [balance], {"blocks": blocks}, lambda df: crs.sparse_pack(df, blocks, c.label, rate, keep=[c.key]),
                                 crossed=c.crosses)
        self.packed_step = name
        return {sub: sparse.read_vectors(self.spark, step.path) for sub, step in self.packed.items()}

    def _normed(self, df: DataFrame, stats: dict) -> DataFrame:
        c = self.cfg
        std = num.standardize_columns(df, stats, c.rules)
        vector = sparse.vector(sparse.numeric_entries([f"{n}_std" for n in c.rules]), len(c.rules), "std_features")
        return cat.fill_categorical(std.select(c.key, c.label, vector, *c.categorical), c.categorical)

    def _encoded(self, df: DataFrame, layout: DataFrame, width: int) -> DataFrame:
        c = self.cfg
        placed = cat.encode_places(df, c.categorical, layout, c.key)
        return placed.select(c.key, c.label, "std_features", sparse.one_hot_vector("places", width, "cat_features"))

    def _picked(self, df: DataFrame, top: list[int]) -> DataFrame:
        entries, width = sparse.picked(sparse.vector_entries_of("cat_features"), top)
        return df.select("*", sparse.vector(entries, width, "top_features"))

    def toy(self, subset: str = "train") -> DataFrame:
        """Fixed-size reproducible toy extract of a packed subset."""
        c = self.cfg
        step = self._table(subset, f"{self.packed_step}.toy", [self.packed[subset]], {"rows": c.toy_rows, "seed": c.seed},
                           lambda: spl.hash_ordered_sample(self._read(self.packed[subset]), c.key, c.toy_rows, c.seed))
        return sparse.read_vectors(self.spark, step.path)
