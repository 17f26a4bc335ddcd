"""Small helpers the operators share: tables, scratch folders and Arrow columns."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: A word is a run of anything but space, tab, newline, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Spark's own option that removes the files of a query's exchanges when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a folder of the warehouse where that is unset."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


@contextmanager
def exchanges_removed(spark: SparkSession) -> Iterator[None]:
    """The exchanges of a query run here leave no files behind. For frames that are stored: what was exchanged for them is not read again, and would
    otherwise stay until the driver happens to collect garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def kept(df: DataFrame) -> DataFrame:
    """The rows, computed once and cut from their lineage by a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    with exchanges_removed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a frame goes by the setting under which it was made


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as parquet to the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with exchanges_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column_type(df: DataFrame, name: str) -> str:
    """SQL name of a column's type, for the schemas of Arrow functions."""
    return df.schema[name].dataType.simpleString()


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A text column as bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def release() -> None:
    """Gives the memory that a worker has freed back to the system. Workers live on after a task, and those of a long job would otherwise keep the
    most that any of its steps took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``size`` bytes of text, one row at least; at their end the worker's freed memory is released."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at, used = 0, 0
        for i, n in enumerate(lengths):
            if i > at and used + n > size:
                yield batch.slice(at, i - at)
                at, used = i, 0
            used += n
        if batch.num_rows > at:
            yield batch.slice(at)
    batch = lengths = None
    release()
