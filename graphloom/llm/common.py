"""Shared plumbing: the cluster's shared folder, written tables, Arrow batch limits."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can see.

    Only where the session names no such folder is one set, and only on local[*] may it
    be a temporary folder; elsewhere the lack is an error.  A path without a scheme
    belongs to the cluster's default file system.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='graphloom-')}"
        spark.sparkContext.setCheckpointDir(base)
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(base)
    whole = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if whole.startswith("file:/") and not whole.startswith("file://"):
        whole = f"file://{whole.removeprefix('file:')}"
    return f"{whole.rstrip('/')}/graphloom-{label}-{uuid.uuid4().hex[:12]}"


def unused(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with as many underscores before it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def within(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of consecutive items whose sizes add up to ``most``, or of one larger item."""
    first, total = 0, 0
    for k, size in enumerate(sizes):
        if k > first and total + size > most:
            yield slice(first, k)
            first, total = k, 0
        total += size
    if first < len(sizes):
        yield slice(first, len(sizes))


def give_back() -> None:
    """Return what a finished task held to the system: workers are used again by other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which keeps its own counsel


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete written tables that no later step reads, and let Spark drop finished shuffles.

    Shuffle files go once the driver's JVM has collected what referred to them, which
    on a quiet driver would otherwise happen long after the next large shuffle.
    """
    for table_ in tables:
        context = table_.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table_.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        context._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Bound what one Arrow batch holds, so whole long texts fit a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def whole_text(column: str = "text"):
    """The text with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
