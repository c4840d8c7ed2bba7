"""What the operators of this subpackage share: inputs, shared storage, batch bounds."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that one Arrow batch carries to a Python worker: whichever is reached first ends it.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20
#: With it, Spark deletes the shuffle files of a statement when the statement ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory of Python workers: lowers the session's bounds on a batch, never raises them. They hold when a plan is
    run, which is after an operator returns; so they stay lowered."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(name).removesuffix("b")
        if now.lstrip("-").isdigit() and not 0 < int(now) <= most:
            spark.conf.set(name, most)


def release() -> None:
    """Give what a Python worker has freed back to the system: workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def releasing(run):
    """A function of Arrow batches that releases memory at the end of its task."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; only where none is configured (tests, one machine) a local one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        at = tempfile.mkdtemp(prefix="attesta-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored tables that nothing will read again."""
    for df in frames:
        at, files = _path(df.sparkSession, df._stored_at)
        files.delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside go at the end, but for those stored as ``outer``: these belong to the scope around, if there is one."""
    token = _scopes.set((*_scopes.get(), []))
    try:
        yield
    finally:
        held = _scopes.get()[-1]
        _scopes.reset(token)
        for path in held:
            at, files = _path(spark, path)
            files.delete(at, True)


def stored(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again: cuts the lineage, and outlives any executor. The
    shuffle files behind it go at once; the table goes with its scope (see scratch), or when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    at, files = _path(spark, path)
    files.deleteOnExit(at)
    scopes = _scopes.get()[:-1] if outer else _scopes.get()
    if scopes:
        scopes[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))
