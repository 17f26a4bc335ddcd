"""Queries over run history; every frame carries ``run_id``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataudit.config import INFO, TRANSITIONS
from strataudit.functions import exprs, lit
from strataudit.plans.findings import EVIDENCE_DDL

_FINDING = ("struct<category: string, severity: string, transition: string, table: string, column: string, "
            f"message: string, expected: string, actual: string, evidence: {EVIDENCE_DDL}>")
REPORT_DDL = (f"run_id string, status string, root_cause {_FINDING}, symptom_count bigint, symptoms array<{_FINDING}>, "
              "expected_changes array<string>, checks map<string, string>, "
              "layers map<string, struct<rows: bigint, duplicate_keys: bigint>>, "
              "impact struct<final_loan_rows: bigint, final_distinct_loans: bigint, final_total_balance: double, "
              "staging_loan_rows: bigint>")


def current_runs(events: DataFrame) -> DataFrame:
    """The state each run is in, folded from its events: the last known value of every field."""
    def last(field: str) -> str:
        return f"max_by({field}, CASE WHEN {field} IS NOT NULL THEN at END) AS {field}"

    runs = events.groupBy("run_id").agg(*exprs(
        last("scenario"), last("seed"), "min(CASE WHEN event = 'started' THEN at END) AS started_at",
        "max(CASE WHEN event = 'finished' THEN at END) AS finished_at", last("truth")))
    counts = events.filter("event = 'stage'").groupBy("run_id", "layer").agg(*exprs(
        "max_by(row_counts, at) AS tables")).groupBy("run_id").agg(*exprs(
        "map_from_entries(array_sort(collect_list(struct(layer, map_entries(tables) AS e)))) AS listed"))
    layers = counts.selectExpr("run_id", "transform_values(listed, (k, e) -> map_from_entries(e)) AS row_counts")
    return runs.join(layers, "run_id", "left")


def layer_owners(layer_writes: DataFrame) -> DataFrame:
    """Which run wrote each layer last."""
    return layer_writes.groupBy("layer").agg(*exprs(
        "max_by(run_id, written_at) AS run_id", "max(written_at) AS written_at"))


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1)


def latest_flags(runs: DataFrame) -> DataFrame:
    """Every run with ``is_latest``; the latest is found once, by an aggregate with a row for each task."""
    newest = "max(struct(started_at, run_id)).run_id AS newest"
    return runs.sparkSession.sql(f"SELECT r.*, r.run_id = (SELECT {newest} FROM {{runs}}) AS is_latest FROM {{runs}} r", runs=runs)


def is_latest(runs: DataFrame, run_id: str) -> bool:
    row = latest_run(runs).select("run_id").first()
    return row is not None and row.run_id == run_id


def recent_runs(runs: DataFrame, diagnoses: DataFrame, n: int = 20) -> DataFrame:
    """The last diagnosed runs, newest first; each task keeps only ``n`` rows."""
    return (runs.join(diagnoses.select("run_id", "status", "root_cause"), "run_id", "left")
            .filter("status IS NOT NULL").orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)
            .select("run_id", "scenario", "started_at", "status", "root_cause"))


def layer_flow(profiles: DataFrame, findings: DataFrame, tables: Mapping[str, str], measure: str = "balance") -> DataFrame:
    """Rows per layer, their change against the layer before, and whether the step into the layer is where the
    problem started (root), a knock-on effect (symptom) or fine (ok)."""
    layer_idx = "CASE table " + " ".join(f"WHEN {lit(t)} THEN {i}" for i, t in enumerate(tables.values())) + " END"
    transition = "CASE layer_idx " + " ".join(f"WHEN {i} THEN {lit(t)}" for i, t in enumerate(TRANSITIONS)) + " END"
    sizes = profiles.selectExpr("*", f"{layer_idx} AS layer_idx").filter("layer_idx IS NOT NULL").groupBy(
        "run_id", "layer", "table", "layer_idx").agg(*exprs(
            "max(row_count) AS rows", f"max(CASE WHEN column = {lit(measure)} THEN sum_value END) AS balance"))
    failing = findings.filter(f"severity <> '{INFO}'").groupBy("run_id", "transition").agg(*exprs("count(*) AS failures"))
    joined = sizes.selectExpr("*", f"{transition} AS transition").join(failing, ["run_id", "transition"], "left")
    # one row per layer and run in these windows; the root lies at the earliest step that fails
    w = "OVER (PARTITION BY run_id ORDER BY layer_idx)"
    return joined.selectExpr(
        "run_id", "layer_idx", "layer", "transition", "rows", f"rows - lag(rows) {w} AS delta", "balance",
        "CASE WHEN failures IS NULL THEN 'ok' WHEN layer_idx = min(CASE WHEN failures > 0 THEN layer_idx END) "
        f"{w} THEN 'root' ELSE 'symptom' END AS mark")


def audit_runs(runs: DataFrame, diagnoses: DataFrame, reports: DataFrame, gates: DataFrame,
               expected_scenario: str = "scenario") -> DataFrame:
    """Codes of what is missing or contradictory about each run; no problems means the run did all it should.

    ``gates`` has (run_id, gate_failed). ``expected_scenario`` is an expression over the runs, by default the
    scenario they were started with.
    """
    joined = (runs.selectExpr("*", f"{expected_scenario} AS expected")
              .join(diagnoses.select("run_id", "status"), "run_id", "left")
              .join(reports.selectExpr("run_id", "source AS report_by"), "run_id", "left")
              .join(gates.select("run_id", "gate_failed"), "run_id", "left"))
    failed = "coalesce(gate_failed, false)"
    problems = {
        "scenario <> expected": "'other_scenario'",
        "finished_at IS NULL": "'unfinished'",
        "status IS NULL": "'no_diagnosis'",
        "report_by IS NULL": "'no_report'",
        "expected = 'none' AND status <> 'HEALTHY'": "'sound_run_diagnosed'",
        f"expected = 'none' AND {failed}": "'sound_run_gated'",
        "expected <> 'none' AND status <> 'FAILED'": "'fault_not_diagnosed'",
        f"expected <> 'none' AND NOT {failed}": "'fault_not_gated'",
    }
    listed = ", ".join(f"CASE WHEN {c} THEN {m} END" for c, m in problems.items())
    return joined.selectExpr("run_id", "scenario", "status", "report_by", f"{failed} AS gate_failed",
                             f"array_compact(array({listed})) AS problems")


def truth_view(runs: DataFrame, scores: DataFrame, truth: DataFrame) -> DataFrame:
    """What was broken next to what was found."""
    return (scores.join(runs.select("run_id", "started_at"), "run_id")
            .join(truth.select("run_id", "injected_at", "rows_affected"), "run_id", "left")
            .selectExpr("run_id", "scenario", "injected_at", "coalesce(rows_affected, 0L) AS rows_affected",
                        "diagnosed_as", "location_found", "correct"))


def diagnosis_rows(report: DataFrame, created_at: str) -> DataFrame:
    """Assembled diagnoses in the shape they are stored in: the report as JSON next to its key facts."""
    return report.selectExpr("run_id", f"cast({lit(created_at)} AS timestamp_ntz) AS created_at", "status",
                             "root_cause.category AS root_cause", "to_json(struct(*)) AS report")


def load_report(diagnoses: DataFrame) -> DataFrame:
    """Rebuild stored diagnoses from their JSON."""
    return diagnoses.selectExpr(f"from_json(report, '{REPORT_DDL}') AS r").select("r.*")


def report_rows(notes: DataFrame, created_at: str) -> DataFrame:
    """Rendered notes in the shape they are stored in."""
    return notes.selectExpr("run_id", f"cast({lit(created_at)} AS timestamp_ntz) AS created_at", "source", "author",
                            "grounded", "seconds", "note", "markdown")
