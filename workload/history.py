"""Run history derived from the ``events`` table: one run per user and day.

Every text runs unchanged on Spark and on the oracle engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataudit.plans.findings import EVIDENCE_DDL
from workload.domain import table

RUN_ID = "'u' || cast(user_id AS string) || '-' || cast(cast(ts AS date) AS string)"
SCENARIO = """CASE user_id % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'type_change' WHEN 2 THEN 'null_spike'
    WHEN 3 THEN 'dropped_join_key' ELSE 'duplicate_rows' END"""

RUNS_SQL = f"""
SELECT {RUN_ID} AS run_id, {SCENARIO} AS scenario, min(ts) AS started_at,
  max(CASE WHEN event_type <> 'signup' THEN ts END) AS finished_at
FROM events GROUP BY {RUN_ID}, {SCENARIO}
"""

# Eight failure categories and three transitions, spread over the events; views are expected changes. As contracts
# guarantee for real runs, a run has at most one finding per category and transition.
CATEGORY = """CASE WHEN event_type = 'view' THEN 'EXPECTED_CHANGE' WHEN event_id % 8 = 0 THEN 'SCHEMA_DRIFT'
    WHEN event_id % 8 = 1 THEN 'JOIN_KEY_MISMATCH' WHEN event_id % 8 = 2 THEN 'DUPLICATE_ROWS'
    WHEN event_id % 8 = 3 THEN 'NULL_SPIKE' WHEN event_id % 8 = 4 THEN 'ROW_INFLATION'
    WHEN event_id % 8 = 5 THEN 'ROW_LOSS' WHEN event_id % 8 = 6 THEN 'MEASURE_DRIFT'
    ELSE 'DISTRIBUTION_SHIFT' END"""
FINDINGS_SQL = f"""
SELECT run_id, check_idx, item_idx, verdict, verdict AS "check", category, severity,
  CASE transition_idx WHEN 0 THEN 'source->raw' WHEN 1 THEN 'raw->staging' ELSE 'staging->final' END AS transition,
  transition_idx, place AS "table", spot AS "column",
  category || ' in ' || place || ' by event ' || cast(item_idx AS string) AS message,
  cast(item_idx AS string) AS expected, cast(item_idx + 1 AS string) AS actual
FROM (SELECT *,
    CASE WHEN transition_idx = 2 THEN 'final.loan_portfolio'
      ELSE (CASE WHEN transition_idx = 0 THEN 'raw.' ELSE 'staging.' END)
        || (CASE WHEN category = 'NULL_SPIKE' THEN 'customers' ELSE 'loans' END) END AS place,
    CASE WHEN category IN ('SCHEMA_DRIFT', 'MEASURE_DRIFT') THEN 'balance' WHEN category = 'NULL_SPIKE' THEN
      'credit_score' WHEN category = 'JOIN_KEY_MISMATCH' THEN 'customer_id' WHEN category = 'DUPLICATE_ROWS' THEN
      'loan_id' WHEN category = 'DISTRIBUTION_SHIFT' THEN 'risk_band' END AS spot,
    CASE category WHEN 'SCHEMA_DRIFT' THEN 0 WHEN 'JOIN_KEY_MISMATCH' THEN 1 WHEN 'DUPLICATE_ROWS' THEN 2
      WHEN 'NULL_SPIKE' THEN 3 WHEN 'MEASURE_DRIFT' THEN 5 WHEN 'DISTRIBUTION_SHIFT' THEN 6 ELSE 4 END AS check_idx,
    CASE category WHEN 'SCHEMA_DRIFT' THEN 'schema' WHEN 'JOIN_KEY_MISMATCH' THEN 'key_integrity'
      WHEN 'DUPLICATE_ROWS' THEN 'uniqueness' WHEN 'NULL_SPIKE' THEN 'nulls' WHEN 'MEASURE_DRIFT' THEN 'measures'
      WHEN 'DISTRIBUTION_SHIFT' THEN 'distribution' ELSE 'row_counts' END AS verdict
  FROM (SELECT {RUN_ID} AS run_id, cast(min(event_id) AS int) AS item_idx, cast(event_id % 3 AS int) AS transition_idx,
      {CATEGORY} AS category,
      CASE WHEN {CATEGORY} = 'EXPECTED_CHANGE' THEN 'info' WHEN max(value) > 20 THEN 'critical' ELSE 'warning' END
        AS severity
    FROM events WHERE event_type <> 'signup' GROUP BY {RUN_ID}, cast(event_id % 3 AS int), {CATEGORY}) e) f
"""

# Runs with a single event were never diagnosed; a click wrote a report; an error failed the gate.
DIAGNOSED_SQL = f"SELECT {RUN_ID} AS run_id FROM events GROUP BY {RUN_ID} HAVING count(*) >= 2"
REPORTS_SQL = f"""
SELECT {RUN_ID} AS run_id, CASE WHEN max(value) > 30 THEN 'draft' ELSE 'template' END AS source
FROM events WHERE event_type = 'click' GROUP BY {RUN_ID}
"""
GATES_SQL = f"SELECT {RUN_ID} AS run_id, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) = 1 AS gate_failed " \
            f"FROM events GROUP BY {RUN_ID}"
TRUTH_SQL = f"""
SELECT {RUN_ID} AS run_id, {SCENARIO} AS scenario,
  CASE user_id % 5 WHEN 1 THEN 'extract:loans' WHEN 2 THEN 'extract:customers' ELSE 'staging:loans' END AS injected_at,
  count(*) AS rows_affected
FROM events WHERE user_id % 5 <> 0 GROUP BY {RUN_ID}, {SCENARIO},
  CASE user_id % 5 WHEN 1 THEN 'extract:loans' WHEN 2 THEN 'extract:customers' ELSE 'staging:loans' END
"""
# Sizes of the loan tables of a run: every event lands, views are filtered out, errors are lost.
PROFILES_SQL = f"""
SELECT run_id, layer, place AS "table", spot AS "column", row_count, duplicate_keys, null_pct, sum_value
FROM (
  SELECT run_id, 'raw' AS layer, 'raw.loans' AS place, 'balance' AS spot, count(*) AS row_count,
    cast(0 AS bigint) AS duplicate_keys, cast(0 AS double) AS null_pct, round(sum(value), 2) AS sum_value
  FROM (SELECT *, {RUN_ID} AS run_id FROM events) e GROUP BY run_id
  UNION ALL
  SELECT run_id, 'staging', 'staging.loans', 'balance', count(CASE WHEN event_type <> 'view' THEN 1 END),
    cast(0 AS bigint), cast(0 AS double), round(sum(CASE WHEN event_type <> 'view' THEN value ELSE 0 END), 2)
  FROM (SELECT *, {RUN_ID} AS run_id FROM events) e GROUP BY run_id
  UNION ALL
  SELECT run_id, 'final', 'final.loan_portfolio', 'balance',
    count(CASE WHEN event_type NOT IN ('view', 'error') THEN 1 END), cast(0 AS bigint), cast(0 AS double),
    round(sum(CASE WHEN event_type NOT IN ('view', 'error') THEN value ELSE 0 END), 2)
  FROM (SELECT *, {RUN_ID} AS run_id FROM events) e GROUP BY run_id) p
"""


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("events")
    return spark.sql(text.replace('"', "`"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, RUNS_SQL)


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, FINDINGS_SQL).selectExpr("*", f"cast(null AS {EVIDENCE_DDL}) AS evidence")


def diagnosed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, DIAGNOSED_SQL)


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, REPORTS_SQL)


def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, GATES_SQL)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, TRUTH_SQL)


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, PROFILES_SQL)
