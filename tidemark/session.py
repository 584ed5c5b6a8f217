"""Session settings and the shared folder for data that must outlive a task."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library is tuned for. They are offered, never forced on a session
# that somebody else made.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where a later step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Rows of 80 columns make fused methods too large for the JIT compiler, which
    # then run several times slower than the split ones used beyond these limits.
    "spark.sql.codegen.maxFields": "50",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "tidemark", cores: int | str = "*", **conf: object) -> SparkSession:
    """A local session for tests and benches; extra settings as ``spark_sql_x=...``."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a folder of its own; on a
    cluster that would be a machine-local folder, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store holds it; harmless where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder to an unused name in the same store."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each action inside go when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
