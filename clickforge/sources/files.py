"""File sources and sinks: typed TSV, Parquet steps, LIBSVM, stats tables, fitted models.

Existence checks go through the Hadoop FileSystem of the session, so the same code
works on local disk and on the cluster's shared store. Nothing is ever deleted:
an interrupted step leaves a folder without ``_SUCCESS`` that is simply ignored,
and the retry writes a fresh attempt folder next to it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from importlib import resources

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from clickforge.session import LEAN, session_conf


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_complete(spark: SparkSession, path: str) -> bool:
    """A written dataset counts only when its ``_SUCCESS`` marker exists."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def attempts_of(spark: SparkSession, base: str) -> list[str]:
    """The attempt folders of a dataset, in order, and last the first name that is still free."""
    out, base = [], base.rstrip("/")
    while True:
        out.append(base if not out else f"{base}@{len(out)}")
        if not path_exists(spark, out[-1]):
            return out


#: Whole numbers as differences: those of long ascending lists of places repeat from row to row, the places do not.
DELTAS = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false"}


def write_table(df: DataFrame, path: str, by: str | None = None, crossed: bool = False) -> None:
    """Create-only Parquet write of a step: packed with zstd, and the files of its shuffles are dropped when it is done.

    ``crossed`` is for tables of outer products: a row's many places are stored as differences.
    """
    writer = df.write.mode("errorifexists")
    if crossed:
        writer = writer.options(**DELTAS)
    with session_conf(df.sparkSession, LEAN):
        (writer.partitionBy(by) if by else writer).parquet(path)


# ---- typed TSV (S1, S2, A21) -------------------------------------------------------------------

def impression_schema(label: str, numeric: list[str], categorical: list[str], ids: list[str] | None = None,
                      extra_int: list[str] | None = None, numeric_type=DoubleType) -> StructType:
    """Fixed, explicit, all-nullable schema: ids (string), label (+extra) int, numerics, categoricals."""
    fields = [StructField(i, StringType(), True) for i in (ids or [])]
    fields += [StructField(c, IntegerType(), True) for c in [label] + (extra_int or [])]
    fields += [StructField(c, numeric_type(), True) for c in numeric]
    fields += [StructField(c, StringType(), True) for c in categorical]
    return StructType(fields)


def read_tsv(spark: SparkSession, path: str, schema: StructType, header: bool = False) -> DataFrame:
    """Tab-separated text with an explicit schema, no inference; empty field -> NULL."""
    return (spark.read.schema(schema).option("sep", "\t").option("header", str(header).lower())
            .option("mode", "PERMISSIVE").csv(path))


def write_tsv(df: DataFrame, path: str, header: bool = False, compression: str = "gzip") -> None:
    """Create-only TSV export (NULL -> empty field); ``compression`` may be "none"."""
    with session_conf(df.sparkSession, LEAN):
        df.write.mode("errorifexists").option("sep", "\t").option("header", str(header).lower()).option("compression", compression).csv(path)


#: Column of a CSV scan that keeps a line its schema cannot hold.
_LINE = "__line"


@dataclass
class Imported:
    """The two sides of an import: typed rows, and (line, reason) of the lines that did not fit the schema."""
    typed: DataFrame
    rejected: DataFrame
    path: str


def _reject_reason(schema: StructType, sep: str) -> Column:
    """``fields: <n>`` for a wrong field count, else the first field whose text its type cannot hold."""
    text = F.split(_LINE, sep, -1)
    uncast = [F.when((F.get(text, F.lit(i)) != "") & F.get(text, F.lit(i)).try_cast(f.dataType).isNull(), F.lit(f.name))
              for i, f in enumerate(schema.fields) if not isinstance(f.dataType, StringType)]
    return F.when(F.size(text) != len(schema), F.concat(F.lit("fields: "), F.size(text).cast("string"))) \
        .otherwise(F.coalesce(*uncast, F.lit("unreadable")))


def import_split(spark: SparkSession, src: str, dest: str, schema: StructType, header: bool = False, sep: str = "\t") -> Imported:
    """TSV -> Parquet once, in one pass with a reject side.

    Every line is either a typed row or kept as it is with the reason it does not fit: a wrong number of fields, or the
    first field that its type cannot hold (an empty field is NULL; a line of blanks and tabs only is no row). Both sides are one write, partitioned by ``side``,
    so they appear together or not at all. A complete import is reused; one that was interrupted (no ``_SUCCESS``) is
    left alone and a fresh attempt ``<dest>@<n>`` is written.
    """
    attempts = attempts_of(spark, dest)
    path = next((p for p in reversed(attempts[:-1]) if is_complete(spark, p)), None)
    if path is None:
        path = attempts[-1]
        wide = StructType([*schema.fields, StructField(_LINE, StringType(), True)])
        lines = (spark.read.schema(wide).option("sep", sep).option("header", str(header).lower()).option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", _LINE).csv(src))
        bad = F.col(_LINE).isNotNull()
        sides = lines.select(*[F.when(~bad, F.col(f.name)).alias(f.name) for f in schema.fields], F.col(_LINE).alias("line"),
                             F.when(bad, _reject_reason(schema, sep)).alias("reason"), F.when(bad, "rejected").otherwise("typed").alias("side"))
        write_table(sides, path, by="side")
    both = StructType([*schema.fields, StructField("line", StringType()), StructField("reason", StringType()), StructField("side", StringType())])
    rows = spark.read.schema(both).parquet(path)
    return Imported(rows.where("side = 'typed'").select(*schema.names), rows.where("side = 'rejected'").select("line", "reason"), path)


def import_tsv(spark: SparkSession, src: str, dest: str, schema: StructType, header: bool = False) -> DataFrame:
    """The typed side of :func:`import_split`."""
    return import_split(spark, src, dest, schema, header).typed


def malformed_fields(spark: SparkSession, path: str, schema: StructType, header: bool = False) -> DataFrame:
    """(field, malformed): non-empty fields of a TSV that the schema's type cannot hold (they read as NULL)."""
    raw = StructType([StructField(f.name, StringType(), True) for f in schema.fields])
    text = read_tsv(spark, path, raw, header)
    counts = text.agg(*[F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
                        for f in schema.fields])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("field"), F.col(f.name).alias("malformed")) for f in schema.fields])))


def raw_field_profile(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Raw-file profile: per field position rows, empty fields and distinct values."""
    lines = spark.read.text(path)
    fields = lines.select(F.posexplode(F.split("value", sep, -1)).alias("field", "v"))
    return fields.groupBy("field").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("v") == "").alias("empty"),
        F.countDistinct(F.when(F.col("v") != "", F.col("v"))).alias("distinct_values"))


def field_counts(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Distribution of the number of fields per line."""
    return spark.read.text(path).groupBy(F.size(F.split("value", sep, -1)).alias("fields")) \
        .agg(F.count(F.lit(1)).alias("lines"))


# ---- Parquet steps (S3, S4, S5, S11) ----------------------------------------------------------

class StepStore:
    """Materialised pipeline steps named by breadcrumbs: ``<subset>.parquet.<step>.<step>``.

    ``write`` is create-only. ``run`` skips a step whose output is complete, ``fitted``
    refits a model that is missing or incomplete; neither overwrites: a partial
    output (no ``_SUCCESS``) is left alone and the new attempt goes to ``@<n>``.
    Written steps also cut the lineage of long plans (executor loss recomputes from
    the last written step, not from the raw input).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        #: one table partitioned by ``subset`` that stands for the subsets' first step
        self.whole: str | None = None

    def base(self, subset: str, step: str = "") -> str:
        return f"{self.root}/{subset}.parquet.{step}".rstrip(".")

    def _attempts(self, base: str) -> list[str]:
        return attempts_of(self.spark, base)

    def resolve(self, subset: str, step: str = "") -> str | None:
        """The latest complete attempt, or None."""
        done = [p for p in self._attempts(self.base(subset, step))[:-1] if is_complete(self.spark, p)]
        return done[-1] if done else None

    def fresh(self, subset: str, step: str = "") -> str:
        return self._attempts(self.base(subset, step))[-1]

    def read(self, subset: str, step: str = "") -> DataFrame:
        """S3: Parquet scan of a subset at a step."""
        if self.whole and not step:
            return self.spark.read.parquet(self.whole).filter(F.col("subset") == subset).drop("subset")
        p = self.resolve(subset, step)
        if p is None:
            raise FileNotFoundError(self.base(subset, step))
        return self.spark.read.parquet(p)

    def write(self, df: DataFrame, subset: str, step: str = "") -> str:
        """Create-only write: a fresh attempt folder, never over an existing one."""
        p = self.fresh(subset, step)
        write_table(df, p)
        return p

    def fitted(self, name: str, fit: Callable[[str], None]) -> str:
        """The folder of a fitted model: the latest attempt marked done, else ``fit(path)`` into a fresh one.

        A model folder counts only with its ``_DONE`` marker, so one left half written is fitted anew.
        """
        attempts = self._attempts(self.base("model", name))
        done = [p for p in attempts[:-1] if is_marked(self.spark, p)]
        if done:
            return done[-1]
        fit(attempts[-1])
        mark_done(self.spark, attempts[-1])
        return attempts[-1]

    def run(self, subset: str, step: str, build: Callable[[DataFrame], DataFrame], input_step: str = "") -> tuple[DataFrame, bool]:
        """Returns (output, ran). Skips when complete."""
        src = self.read(subset, input_step)
        out_step = f"{input_step}.{step}".strip(".")
        done = self.resolve(subset, out_step)
        if done is not None:
            return self.spark.read.parquet(done), False
        self.write(build(src), subset, out_step)
        return self.read(subset, out_step), True


# ---- steps with a manifest (S11) ------------------------------------------------------------------

@lru_cache(1)
def code_version() -> str:
    """A digest of the library's sources, read through the import system (so also from a zip)."""
    digest = hashlib.md5()
    root = resources.files(__package__.partition(".")[0])
    for part in ("functions", "operators", "plans", "sources"):
        found = {f.name: f for f in root.joinpath(part).iterdir() if f.name.endswith(".py")}
        if not found:
            raise RuntimeError(f"no sources of {part!r} found: steps cannot be told apart by their code")
        for name in sorted(found):
            digest.update(name.encode() + found[name].read_bytes())
    return digest.hexdigest()[:12]


def content_key(df: DataFrame) -> str:
    """A fingerprint of a table's rows in one scan, whatever their order: schema, count and two sums of row hashes."""
    cols = [F.col(c) for c in df.columns]
    seen = df.select(F.xxhash64(*cols).alias("x"), F.hash(*cols).alias("h")).agg(
        F.count(F.lit(1)), F.bit_xor("x"), F.sum(F.col("x") % (1 << 31)), F.sum("h")).first()
    return _digest([df.schema.json(), *map(str, seen)])


def _digest(x) -> str:
    return hashlib.md5(json.dumps(x, sort_keys=True).encode()).hexdigest()


@dataclass
class Step:
    """A materialised step: where it is, the key that its followers name as their input, and whether it was just made."""
    path: str
    key: str
    rows: int
    ran: bool


class ManifestStore(StepStore):
    """Steps that are reused by what made them, not by name alone.

    A step's manifest lists its inputs (the keys of the steps before it, or a source's fingerprint), its parameters, the
    code's version and its rows. A complete attempt whose manifest names the same inputs, parameters and code is served
    again; any other is left alone and the step runs anew under the next attempt name. A key covers all that a step
    depends on, so a changed parameter runs its step and those after it, and no other.
    """

    def manifest(self, path: str) -> dict | None:
        """The manifest of a finished attempt, None if there is none."""
        file = f"{path}/_MANIFEST"
        if not path_exists(self.spark, file):
            return None
        fs, p = _fs(self.spark, file)
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text else None

    def _finish(self, path: str, manifest: dict) -> None:
        fs, p = _fs(self.spark, f"{path}/_MANIFEST")
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            stream.close()

    def step(self, subset: str, name: str, inputs: list[str], params: dict, make: Callable[[str], None], table: bool = True) -> Step:
        """The step's output: a finished attempt of the same making, else ``make(path)`` into a fresh folder.

        A folder counts only once its manifest is written, after the data is complete.
        """
        made = {"step": name, "subset": subset, "inputs": inputs, "params": params, "code": code_version()}
        key, attempts = _digest(made), self._attempts(self.base(subset, name))
        for path in reversed(attempts[:-1]):
            found = self.manifest(path)
            if found and found["key"] == key:
                return Step(path, key, found["rows"], False)
        make(attempts[-1])
        rows = self.spark.read.parquet(attempts[-1]).count() if table else 0
        self._finish(attempts[-1], made | {"key": key, "rows": rows})
        return Step(attempts[-1], key, rows, True)


def preview(df: DataFrame, rows: int = 20, where: str | None = None, order: list | None = None) -> DataFrame:
    """Filtered preview; with ``order`` a total order makes it deterministic."""
    out = df.filter(where) if where else df
    if order:
        out = out.orderBy(*order)
    return out.limit(rows)


# ---- stats tables, histories, models, LIBSVM (S6, S8, S9, S10) --------------------------------

def save_table(df: DataFrame, path: str) -> DataFrame:
    """Statistics or histories as Parquet (create-only), read back lazily."""
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def mark_done(spark: SparkSession, path: str) -> None:
    """Write an empty ``_DONE`` marker (for outputs that have no ``_SUCCESS`` of their own)."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/_DONE")
    fs.create(p, False).close()


def is_marked(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/_DONE")


def save_model(model: PipelineModel, path: str) -> PipelineModel:
    """Persist a fitted pipeline and load it back."""
    model.write().save(path)
    return PipelineModel.load(path)


#: Gzipped text from a source without a ``compression`` option of its own.
_GZIP = {"mapreduce.output.fileoutputformat.compress": "true",
         "mapreduce.output.fileoutputformat.compress.codec": "org.apache.hadoop.io.compress.GzipCodec"}


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features", compressed: bool = True) -> None:
    """Create-only LIBSVM export, gzipped unless ``compressed`` is off."""
    rows = df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))
    rows.write.mode("errorifexists").options(**(_GZIP if compressed else {})).format("libsvm").save(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LIBSVM scan (1-based indices on disk, 0-based in vectors)."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", str(num_features))
    return r.load(path)


# ---- sparse access to stored vectors (no densifying) ------------------------------------------

def read_vectors_as_structs(spark: SparkSession, path: str, vector_cols: list[str]) -> DataFrame:
    """Scan a Parquet table whose ``vector_cols`` hold ML vectors as their storage struct
    ``(type, size, indices, values)``, so sparse entries can be read natively."""
    from pyspark.ml.linalg import VectorUDT
    schema = spark.read.parquet(path).schema
    struct_t = VectorUDT().sqlType()
    new = StructType([StructField(f.name, struct_t, True) if f.name in vector_cols else f for f in schema.fields])
    return spark.read.schema(new).parquet(path)


def vector_entries(df: DataFrame, col: str, ids: list[str]) -> DataFrame:
    """(ids..., idx, value) for the non-zero entries of a struct-typed vector column.

    Sparse vectors contribute their stored (index, value) pairs, dense ones their non-zero
    positions: work is proportional to the stored entries, never to the vector width.
    """
    v = F.col(col)
    sparse = F.arrays_zip(v["indices"].alias("idx"), v["values"].alias("value"))
    dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("idx"), x.alias("value")))
    pairs = F.when(v["type"] == 0, sparse).otherwise(dense)
    return (df.select(*ids, F.inline(pairs))
              .filter(F.col("value") != 0)
              .select(*ids, "idx", "value"))
