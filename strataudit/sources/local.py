"""Small frames made of configuration or findings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """A frame whose rows are part of the plan, so that Spark knows how small it is.

    For rows bounded by the contracts (columns, checks, findings), never for data.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = [dict(zip(struct.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(struct)), struct)


def as_local(df: DataFrame) -> DataFrame:
    """Run a frame that is bounded by the contracts and keep its rows as part of the plan."""
    rows = [tuple(_plain(v) for v in row) for row in df.collect()]
    return local_frame(df.sparkSession, rows, df.schema)


def _plain(value):
    if isinstance(value, T.Row):
        return {k: _plain(v) for k, v in value.asDict().items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return value


def cached_aggregate(df: DataFrame) -> DataFrame:
    """Keep an aggregate that several figures are read from, in memory and on disk, in the partitions it was made in. It
    can be a row per key, as large as a table, so it is never drawn together into few tasks; a lost executor's
    part is computed again."""
    return df.persist()


def together(*actions: Callable[[], object]) -> list:
    """Submit independent jobs at once, so that the cluster is not idle at the tail of each."""
    with ThreadPoolExecutor(len(actions)) as pool:
        inherit = inheritable_thread_target(SparkSession.active())
        return [f.result() for f in [pool.submit(inherit(a)) for a in actions]]
