"""Session helpers.

The library never owns the session on a cluster: callers pass one in. These
helpers only build a local session for tests/benchmarks and resolve the shared
checkpoint folder the cluster advertises in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "clickforge",
                  driver_memory: str = "16g") -> SparkSession:
    """A local session tuned for small test data (no UI, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.extraJavaOptions", "-Dderby.system.home=/tmp")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only in local mode.

    On a cluster ``spark.checkpoint.dir`` must name a shared file system folder;
    a machine-local temporary folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="clickforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def stable_root(spark: SparkSession) -> str:
    """The configured shared folder itself (a session's checkpoint folder is a new one inside it each time)."""
    own = ensure_checkpoint_dir(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (root or own).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for materialised steps."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    import uuid
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


#: Settings of the library's own writes. A shuffle's files otherwise stay on the executors' disks until the driver
#: collects garbage, so a run would keep those of all its steps beside what the steps wrote.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, object]) -> Iterator[None]:
    """Session settings for the jobs that run inside the block; the caller's settings come back after it."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
