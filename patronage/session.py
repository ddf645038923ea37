"""Session settings the operators count on, and where intermediate tables go."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Timestamps in the inputs carry no zone; one fixed zone keeps day arithmetic stable.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins of many rows with one row per key rely on splitting a hot partition,
    # also where the split costs one more exchange afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options above on a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests and the benchmark on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("patronage")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset and all
    runs on one machine, as in tests, it is a folder of the warehouse; on several machines that
    need not be shared, so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables are, in the shared folder; :func:`clear` removes it."""
    return f"{shared_folder(spark)}/patronage/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results not written elsewhere can't be read afterwards."""
    remove(spark, run_folder(spark))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    Cuts the lineage in a way that outlives executors, and keeps later reads
    columnar. The files stay until they are removed, or the run's folder by :func:`clear`.
    """
    return written_at(df, label)[0]


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As :func:`written`, with the path, for tables to be removed again."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    for paths in _noting.get():
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path), path


# Spark keeps the files of a shuffle until the driver collects what refers to them. Once
# their rows are in a table nothing reads them again.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of the queries run inside when they end."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


# Lists that note the tables written while they stand here, see :func:`noted`; each thread has its own.
_noting: ContextVar[tuple[list[str], ...]] = ContextVar("noting", default=())


@contextmanager
def noted() -> Iterator[list[str]]:
    """Collect the paths of the tables written inside, to be removed once nothing reads them."""
    paths: list[str] = []
    token = _noting.set((*_noting.get(), paths))
    try:
        yield paths
    finally:
        _noting.reset(token)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table made by :func:`written_at` that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def partitions_for(rows: int, rows_each: int = 100_000) -> int:
    """Partitions for ``rows`` narrow rows that an iterative fit passes over many times.

    Enough to keep every task at ``rows_each`` rows, and no more: each pass
    schedules all of them.
    """
    return max(1, -(-rows // rows_each))


def full_rounds(spark: SparkSession, rows: int, rows_each: int = 200_000) -> int:
    """As :func:`partitions_for`, but a few also for few rows, and a multiple of the cores for many.

    A pass waits for its longest task, so no round of tasks leaves cores idle.
    """
    cores = spark.sparkContext.defaultParallelism
    if rows <= rows_each:
        return max(1, min(cores, -(-rows // 2_000)))
    return -(-partitions_for(rows, rows_each) // cores) * cores
