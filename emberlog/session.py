"""Session settings and shared working storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "emberlog", cpus: str | int = "*", partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own session to the operators."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions or 8))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone, which every calendar expression here relies on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_OWN_DIRS: dict[str, str] = {}
_SCRATCH: ContextVar[str | None] = ContextVar("emberlog_scratch", default=None)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Where it is unset a local session, as in tests, gets a temporary folder; on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = spark.conf.get("spark.app.id", "")
    if key not in _OWN_DIRS:
        _OWN_DIRS[key] = tempfile.mkdtemp(prefix="emberlog-")
    return _OWN_DIRS[key]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_SCRATCH.get() or work_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Keep intermediate tables of the block in a folder of its own and drop it afterwards.

    For work that ends with its results written, such as a micro-batch.
    """
    folder = fresh_path(spark, "scratch")
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def unsorted_writes(spark: SparkSession, writers: int = 8) -> Iterator[None]:
    """Partitioned writes of the block keep up to ``writers`` files open in a task; only rows for more partitions are sorted first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, writers)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Several later passes then share one computation, keep column pruning and pushdown, and survive the
    loss of an executor without recomputing the lineage behind it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
