"""Run history as parquet tables, in folders by a hash of the run id.

Rows are only ever appended, or replace the rows of the same run; the current state of a run or layer is the
latest of its rows. A reader of one run lists one bucket, however many runs there are.
"""

from __future__ import annotations

import os
import zlib

from pyspark.sql import DataFrame, SparkSession

from strataudit.functions import lit
from strataudit.plans.findings import FINDING_DDL, SEGMENT_DDL
from strataudit.sources.layers import read_or_empty
from strataudit.sources.local import local_frame

EVENT_DDL = ("run_id string, event string, scenario string, seed bigint, layer string, "
             "row_counts map<string, bigint>, truth string, at timestamp_ntz")
PROFILE_DDL = ("run_id string, layer string, table string, column_idx int, column string, dtype string, "
               "row_count bigint, null_count bigint, null_pct double, distinct_count bigint, min_value double, "
               "max_value double, sum_value double, min_text string, max_text string, duplicate_keys bigint")
# Tables whose rows belong to one run and are replaced when that run is diagnosed again.
RUN_TABLES = {
    "layer_profiles": PROFILE_DDL,
    "findings": FINDING_DDL,
    "finding_segments": SEGMENT_DDL,
    "finding_values": "run_id string, verdict string, table string, kind string, value string",
    "diagnoses": "run_id string, created_at timestamp_ntz, status string, root_cause string, report string",
    "incident_reports": "run_id string, created_at timestamp_ntz, source string, author string, grounded boolean, "
                        "seconds double, note string, markdown string",
}
APPENDED_TABLES = {
    "run_events": EVENT_DDL,
    "layer_writes": "layer string, run_id string, written_at timestamp_ntz",
}
BUCKETS = 64
BUCKET = f"cast(pmod(crc32(cast(run_id AS binary)), {BUCKETS}) AS int)"
# A folder name that a reader recognises; the hash tells ids apart that look alike without their special characters.
SAFE_ID = "concat(regexp_replace(run_id, '[^A-Za-z0-9_-]', '_'), '-', left(md5(cast(run_id AS binary)), 16))"
NOTE_DDL = "value string, bucket int, run string"


def bucket_of(run_id: str) -> int:
    return zlib.crc32(run_id.encode()) % BUCKETS


class History:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, table: str) -> str:
        return os.path.join(self.root, "meta", table)

    def read(self, table: str) -> DataFrame:
        """A history table; empty if nothing was recorded yet."""
        return self._read(table, self.path(table))

    def _read(self, table: str, path: str) -> DataFrame:
        schema = (RUN_TABLES | APPENDED_TABLES)[table] + ", bucket int"
        return read_or_empty(self.spark, path, schema, self.path(table)).drop("bucket")

    def of_run(self, table: str, run_id: str) -> DataFrame:
        """Rows of one run. Only the run's bucket is listed, and of it only the run's folder is read where the table has one."""
        return self._read(table, f"{self.path(table)}/bucket={bucket_of(run_id)}").filter(f"run_id = {lit(run_id)}")

    def append(self, table: str, rows: list[tuple]) -> None:
        new = local_frame(self.spark, rows, APPENDED_TABLES[table])
        new.selectExpr("*", f"{BUCKET} AS bucket").coalesce(1).write.mode("append").partitionBy("bucket").parquet(self.path(table))

    def compact(self, table: str, rows_per_file: int = 1 << 20) -> None:
        """Rewrite an appended table, which has a file for every append, as one file a bucket, or more where a bucket has more than
        ``rows_per_file`` rows. Nothing may be appended meanwhile."""
        rows = self.read(table)
        self.spark.sparkContext.getCheckpointDir() or self.spark.sparkContext.setCheckpointDir(os.path.join(self.root, "_checkpoints"))
        held = rows.selectExpr("*", f"{BUCKET} AS bucket").repartition(BUCKETS, "bucket").checkpoint()  # the files read are about to be replaced
        held.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file).partitionBy(
            "bucket").parquet(self.path(table))

    def replace_run(self, table: str, df: DataFrame) -> None:
        """Write rows of one or many runs; runs that are not in ``df`` stay as they are."""
        df.selectExpr("*", f"{BUCKET} AS bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "bucket", "run_id").parquet(self.path(table))

    def write_markdown(self, reports: DataFrame) -> None:
        """One folder of text per run, named after the run id."""
        reports.selectExpr("markdown AS value", f"{BUCKET} AS bucket", f"{SAFE_ID} AS run").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("bucket", "run").text(self.path("markdown"))

    def notes(self, runs: DataFrame) -> DataFrame:
        """``run_id`` and ``markdown`` of the runs (``run_id``) that have a stored note."""
        texts = self.spark.read.schema(NOTE_DDL).text(self.path("markdown"), wholetext=True)
        named = runs.select("run_id").distinct().selectExpr("run_id", f"{BUCKET} AS bucket", f"{SAFE_ID} AS run")
        return texts.join(named, ["bucket", "run"]).selectExpr("run_id", "rtrim('\n', value) AS markdown")
