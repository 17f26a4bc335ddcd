"""Layer tables as parquet folders: ``root/<layer>/<table>``."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataudit.config import INGEST_SEQ


def scratch_root(spark: SparkSession) -> str:
    """A new folder below the shared folder of the cluster, or below the warehouse where none is configured: executors
    share both."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")
    return os.path.join(shared, f"layers-{uuid.uuid4().hex}")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, base: str | None = None) -> DataFrame:
    """A table that was never written reads as empty. ``base`` is its root where ``path`` is a folder below."""
    try:
        return spark.read.option("basePath", base or path).schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _row_order(df: DataFrame) -> Column | None:
    """When and where a row arrived, as one number: time of its file (microseconds), path by its hash, position in the file.

    The same for every partitioning of the same files. A number of 38 digits: 16 for the time, 9 for the path, 13 for the position.
    None for rows that do not come straight from parquet files.
    """
    at, part, row = F.unix_micros("_metadata.file_modification_time"), F.pmod(F.xxhash64("_metadata.file_path"), F.lit(10 ** 9)), F.col("_metadata.row_index")
    order = F.concat(F.lpad(at.cast("string"), 16, "0"), F.lpad(part.cast("string"), 9, "0"), F.lpad(row.cast("string"), 13, "0"))
    try:
        df.select(order)
    except AnalysisException:
        return None
    return order.cast("decimal(38,0)")


class LayerStore:
    """Reads and replaces whole layer tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str:
        layer, table = name.split(".", 1)
        return os.path.join(self.root, layer, table)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def read_or_empty(self, name: str, schema: T.StructType | str) -> DataFrame:
        return read_or_empty(self.spark, self.path(name), schema)

    def write(self, name: str, df: DataFrame) -> int:
        """Replace a table with what arrives, whatever its schema; the row count comes from the write itself."""
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(self.path(name))
        return seen.get["rows"]

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table and read it back with the schema it was written with."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def land(self, name: str, df: DataFrame, arrival: str | None = None) -> int:
        """Write an arriving table together with the order in which its rows arrived.

        ``arrival`` names a column that tells it, or an expression. Without one, rows read straight from parquet files go by the time of
        their file, its path and their position in it, whatever the partitioning. Other rows get no number: which row of a
        key came first is then told by their content, which does not depend on partitioning either.
        """
        order = F.expr(arrival) if arrival else _row_order(df)
        return self.write(name, df if order is None or INGEST_SEQ in df.columns and not arrival else df.withColumn(INGEST_SEQ, order))

    def row_count(self, name: str) -> int:
        return self.read(name).count()

    def preview(self, name: str, rows: int = 100) -> DataFrame:
        return self.read(name).limit(rows)
