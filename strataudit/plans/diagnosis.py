"""From findings to a diagnosis: rank, name the root cause, score it, gate on it.

Every function here works on frames keyed by ``run_id`` and serves one run or a whole history of runs.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from strataudit.config import (
    CATEGORY_PRIORITY,
    CATEGORY_TO_SCENARIO,
    CHECKS,
    INFO,
    STAGE_LAYER,
    STAGE_TRANSITION,
    UNKNOWN_PRIORITY,
    AuditConfig,
    MeasureRule,
)
from strataudit.functions import exprs, lit
from strataudit.operators import reconcile as R
from strataudit.operators.profile import profile_layers, table_profiles
from strataudit.plans.checks import VALUES_DDL, Checks, Details, Layers, attach_details, key_changes, layer_facts
from strataudit.plans.findings import SEGMENT_DDL
from strataudit.sources.local import as_local, cached_aggregate, local_frame

SEGMENTS_IN_REPORT = 4


def runnable(layers: Layers, cfg: AuditConfig) -> tuple[AuditConfig, tuple[str, ...]]:
    """The configuration without the rules that need a column which a table has lost, and what these rules are.

    The lost column itself is a finding of the schema check; a rule about it would fail or compare nothing.
    """
    has = {t: set(df.columns) for t, df in layers.items()}
    out = lambda rule: [rule.exclusion.column] if rule.exclusion else []
    seg = cfg.segment_column
    needs = {
        "key_rules": lambda r: {r.before: [r.row_key, r.column, seg], r.after: [r.row_key, r.column], r.reference: [r.column]},
        "distinct_rules": lambda r: {r.before: [r.key, *out(r)], r.after: [r.key]},
        "pass_through_rules": lambda r: {r.before: [r.column, r.group_column], r.after: [r.group_column], r.reference: [r.column]},
        "measure_rules": lambda r: {t: [r.measure, seg, *([r.key, *out(r)] if i == 0 else [])] for i, t in enumerate(r.tables)},
        "distribution_rules": lambda r: {r.table: [r.column, r.cause_column]},
    }
    kept, not_run = {}, []
    for field_name, of in needs.items():
        rules = getattr(cfg, field_name)
        lost = [[f"{t}.{c}" for t, cs in of(r).items() for c in cs if c not in has[t]] for r in rules]
        kept[field_name] = tuple(r for r, gone in zip(rules, lost, strict=True) if not gone)
        not_run += [f"{field_name}[{i}]: no {', '.join(gone)}" for i, gone in enumerate(lost) if gone]
    return replace(cfg, **kept), tuple(not_run)


class DataQualityError(RuntimeError):
    """Raised by the quality gate, so that the job fails."""


def _case(column: str, mapping: Mapping[str, object], otherwise: str) -> str:
    arms = " ".join(f"WHEN {lit(k)} THEN {v if isinstance(v, int) else lit(v)}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {otherwise} END"


# ---------------------------------------------------------------- ranking

def priority(category: str = "category") -> str:
    return _case(category, CATEGORY_PRIORITY, str(UNKNOWN_PRIORITY))


def rank_failures(findings: DataFrame) -> DataFrame:
    """Failures of each run in order of cause: earliest transition first, then the more specific category, then
    the order of the checks. Rank 1 is the root cause, the rest are its symptoms.

    A run has at most a few findings per contract column, so the window of one run is small.
    """
    order = f"transition_idx, {priority()}, check_idx, item_idx"
    return findings.filter(f"severity <> '{INFO}'").selectExpr(
        "*", f"row_number() OVER (PARTITION BY run_id ORDER BY {order}) AS rank").selectExpr(
        "*", "CASE WHEN rank = 1 THEN 'root' ELSE 'symptom' END AS role")


def root_causes(findings: DataFrame) -> DataFrame:
    """The root cause of each failed run, without ranking the rest: tasks keep one candidate per run before the
    shuffle."""
    order = f"transition_idx, {priority()}, check_idx, item_idx"
    w = f"row_number() OVER (PARTITION BY run_id ORDER BY {order})"
    return findings.filter(f"severity <> '{INFO}'").selectExpr("*", f"{w} AS _r").filter("_r = 1").drop("_r")


def verdicts(findings: DataFrame, runs: DataFrame) -> DataFrame:
    """PASS or FAIL of every check of every run, including the checks that found nothing."""
    names = ", ".join(f"struct({i} AS check_idx, {lit(v)} AS verdict)" for i, (v, _) in enumerate(CHECKS))
    grid = runs.select("run_id").distinct().selectExpr("run_id", f"inline(array({names}))")
    failed = findings.filter(f"severity <> '{INFO}'").groupBy("run_id", "verdict").agg(*exprs("count(*) AS failures"))
    return grid.join(failed, ["run_id", "verdict"], "left").selectExpr(
        "run_id", "check_idx", "verdict", "CASE WHEN failures > 0 THEN 'FAIL' ELSE 'PASS' END AS result")


def run_status(findings: DataFrame, runs: DataFrame) -> DataFrame:
    """FAILED or HEALTHY per run, with the number of failures."""
    failed = findings.filter(f"severity <> '{INFO}'").groupBy("run_id").agg(*exprs("count(*) AS failures"))
    return runs.select("run_id").distinct().join(failed, "run_id", "left").selectExpr(
        "run_id", "CASE WHEN failures > 0 THEN 'FAILED' ELSE 'HEALTHY' END AS status",
        "coalesce(failures, 0L) AS failures")


def impact(profiles: DataFrame, before: str = "staging.loans", after: str = "final.loan_portfolio",
           measure: str = "balance") -> DataFrame:
    """Size of the last layer next to the one before it, one row per run."""
    return profiles.groupBy("run_id").agg(*exprs(
        f"max(CASE WHEN table = {lit(after)} THEN row_count END) AS final_loan_rows",
        f"max(CASE WHEN table = {lit(after)} THEN row_count - duplicate_keys END) AS final_distinct_loans",
        f"max(CASE WHEN table = {lit(after)} AND column = {lit(measure)} THEN sum_value END) AS final_total_balance",
        f"max(CASE WHEN table = {lit(before)} THEN row_count END) AS staging_loan_rows"))


FINDING_IN_REPORT = ("struct(category, severity, transition, table, column, message, expected, actual, evidence)")


def assemble(findings: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row per run: status, root cause, symptoms in order, expected changes, verdicts, layer sizes, impact.

    The lists of a run are bounded by its contracts and checks.
    """
    runs = profiles.select("run_id").distinct()
    ranked = rank_failures(findings).groupBy("run_id").agg(*exprs(
        f"max(CASE WHEN rank = 1 THEN {FINDING_IN_REPORT} END) AS root_cause",
        "count_if(rank > 1) AS symptom_count",
        "transform(array_sort(collect_list(CASE WHEN rank > 1 THEN struct(rank, "
        f"{FINDING_IN_REPORT} AS f) END)), e -> e.f) AS symptoms"))
    expected = findings.filter(f"severity = '{INFO}'").groupBy("run_id").agg(*exprs(
        "transform(array_sort(collect_list(struct(check_idx, item_idx, message))), e -> e.message) "
        "AS expected_changes"))
    checks = verdicts(findings, runs).groupBy("run_id").agg(*exprs(
        "map_from_entries(transform(array_sort(collect_list(struct(check_idx, verdict, result))), "
        "e -> struct(e.verdict, e.result))) AS checks"))
    sizes = table_profiles(profiles).groupBy("run_id").agg(*exprs(
        "map_from_entries(array_sort(collect_list(struct(table, struct(row_count AS rows, duplicate_keys))))) "
        "AS layers"))
    numbers = impact(profiles).selectExpr(
        "run_id", "struct(final_loan_rows, final_distinct_loans, final_total_balance, staging_loan_rows) AS impact")
    joined = runs
    for part, kind in ((ranked, "left"), (expected, "left"), (checks, "inner"), (sizes, "inner"), (numbers, "inner")):
        joined = joined.join(part, "run_id", kind)
    return joined.selectExpr(
        "run_id", "CASE WHEN root_cause IS NULL THEN 'HEALTHY' ELSE 'FAILED' END AS status", "root_cause",
        "coalesce(symptom_count, 0L) AS symptom_count", "coalesce(symptoms, array()) AS symptoms",
        "coalesce(expected_changes, array()) AS expected_changes", "checks", "layers", "impact")


def summary(diagnoses: DataFrame) -> DataFrame:
    """What a scheduler needs to know about a run."""
    return diagnoses.selectExpr(
        "run_id", "status", "checks", "root_cause.category AS category", "root_cause.transition AS transition",
        "root_cause.table AS table", "root_cause.column AS column", "root_cause.message AS message",
        "symptom_count AS symptoms")


# ---------------------------------------------------------------- scoring

def evaluate(runs: DataFrame, roots: DataFrame, truth: DataFrame) -> DataFrame:
    """Score each run against what is known to have been broken: the fault and its place must both be right.
    A run without a known fault is right if nothing was found.

    ``roots`` has (run_id, category, transition, table), ``truth`` (run_id, scenario, injected_at).
    """
    stage, table = "split_part(injected_at, ':', 1)", "split_part(injected_at, ':', 2)"
    known = truth.selectExpr(
        "run_id", "scenario", f"{_case(stage, STAGE_TRANSITION, 'null')} AS expected_transition",
        f"concat({_case(stage, STAGE_LAYER, stage)}, '.', {table}) AS expected_table")
    joined = runs.select("run_id").join(roots.select("run_id", "category", "transition", "table"), "run_id", "left") \
        .join(known, "run_id", "left")
    found = _case("category", CATEGORY_TO_SCENARIO, "null")
    place = "coalesce(transition = expected_transition AND table = expected_table, false)"
    return joined.selectExpr(
        "run_id", "coalesce(scenario, 'none') AS scenario", f"{found} AS diagnosed_as",
        f"CASE WHEN scenario IS NOT NULL THEN coalesce({found} = scenario, false) END AS scenario_correct",
        "concat(expected_transition, ' ', expected_table) AS location_expected",
        "concat(transition, ' ', table) AS location_found",
        f"CASE WHEN scenario IS NOT NULL THEN {place} END AS location_correct",
        f"CASE WHEN scenario IS NULL THEN category IS NULL ELSE coalesce({found} = scenario, false) AND {place} END "
        "AS correct")


# ---------------------------------------------------------------- one run

@dataclass
class Diagnosis:
    """Results of one run. ``profiles`` and ``findings`` are bounded by the contracts and held as part of their
    plans. ``segments`` has a row per segment of each finding and ``finding_values`` a row per value
    that a finding shows a part of; both stay lazy, and until :meth:`close` they read aggregates that are already there."""

    run_id: str
    profiles: DataFrame
    findings: DataFrame
    segments: DataFrame
    finding_values: DataFrame
    not_run: tuple[str, ...] = ()
    kept: list[DataFrame] = field(default_factory=list)

    def ranked(self) -> DataFrame:
        return rank_failures(self.findings)

    def report(self) -> DataFrame:
        return assemble(self.findings, self.profiles)

    def top_segments(self) -> DataFrame:
        """The few segments a report prints, kept with the findings; read them before :meth:`close`."""
        return as_local(top_segments(self.segments).drop("position"))

    def close(self) -> Diagnosis:
        for df in self.kept:
            df.unpersist()
        self.kept.clear()
        return self


def top_segments(segments: DataFrame, n: int = SEGMENTS_IN_REPORT) -> DataFrame:
    """The segments hit hardest, per finding."""
    w = "PARTITION BY run_id, verdict, table, column ORDER BY magnitude DESC, segment"
    return segments.selectExpr("*", f"row_number() OVER ({w}) AS position").filter(f"position <= {n}")


def _keyed(cfg: AuditConfig, rule: MeasureRule) -> bool:
    return cfg.contract(rule.tables[0]).keys == (rule.key,)


def diagnose(layers: Layers, cfg: AuditConfig, run_id: str = "adhoc", distinct: str = "none", evidence: bool = True) -> Diagnosis:
    """Profile the layers, run the checks, and explain what they flag.

    Two jobs read the data of a healthy run: the profiles and the facts. No check needs distinct counts, so profiles are made without
    them unless ``distinct`` says ``exact`` or ``approx``. Evidence is queried only for flagged
    columns and rules; without ``evidence`` it is not queried at all, and findings say what the profiles and facts tell: for those who
    want the segments or values only. What comes back to the driver is bounded by the contracts: a row per column, a row per
    rule, and the findings. Rules that need a column which a table has lost are not run; ``not_run`` names them.
    """
    spark = next(iter(layers.values())).sparkSession
    cfg, not_run = runnable(layers, cfg)
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(cached_aggregate(df))
        return kept[-1]

    try:
        profiles = as_local(profile_layers(layers, cfg, run_id, distinct))
        tables = as_local(profiles.select("run_id", "layer", "table", "row_count", "duplicate_keys").distinct())
        # a table without surplus keys needs no de-duplication in any of the comparisons below
        unique = {r.table for r in tables.filter("duplicate_keys = 0").collect()}
        changed = {i: keep(key_changes(layers, cfg, i, unique).filter("changed > 0")) for i in range(len(cfg.key_rules))}
        changes = {i: keep(rows.groupBy("segment").agg(*exprs("sum(changed) AS changed", "sum(padded) AS padded")))
                   for i, rows in changed.items()}
        totals = {i: keep(R.segment_totals(layers, rule, cfg.segment_column, unique if _keyed(cfg, rule) else ()))
                  for i, rule in enumerate(cfg.measure_rules)}
        facts = as_local(layer_facts(layers, cfg, run_id, changes, totals, unique))
        findings = as_local(Checks(spark, cfg, profiles, facts, tables).all())
        flagged = findings.filter(f"severity <> '{INFO}'").collect()
        segments, lost = local_frame(spark, [], SEGMENT_DDL), local_frame(spark, [], VALUES_DDL)
        if flagged:
            details = Details(layers, cfg, run_id, changed, changes, totals, flagged, evidence)
            kept += details.kept
            segments, lost = details.segment_frame(spark), details.lost_frame(spark)
            rows = details.detail_rows() if evidence else None
            if rows is not None:
                findings = as_local(attach_details(findings, as_local(rows)))
    except BaseException:
        for df in kept:
            df.unpersist()
        raise
    return Diagnosis(run_id, profiles, findings, segments, lost, not_run, kept)


SHOWN_FAILURES = 20


def gate_frame(diagnoses: DataFrame, shown: int = SHOWN_FAILURES) -> DataFrame:
    """One row: how many runs failed, and lines about the first ``shown`` of them in order of run. However long the history, a task
    passes on a count and ``shown`` lines."""
    place = "concat_ws('.', root_cause.table, root_cause.column)"
    failed = diagnoses.filter("status <> 'HEALTHY'").selectExpr(
        "run_id", f"concat_ws(' ', run_id, root_cause.category, root_cause.transition, {place}, root_cause.message) AS line")
    return diagnoses.sparkSession.sql(f"""
        SELECT (SELECT count(*) FROM {{failed}}) AS failures,
          (SELECT transform(array_sort(collect_list(struct(run_id, line))), f -> f.line)
           FROM (SELECT run_id, line FROM {{failed}} ORDER BY run_id LIMIT {shown}) first) AS first_failures""", failed=failed)


def _gate_text(shown: int) -> str:
    more = f"CASE WHEN failures > {shown} THEN array(concat('and ', failures - {shown}, ' more')) ELSE array() END"
    return f"array_join(concat(array(concat(failures, ' of the diagnosed runs failed:')), first_failures, {more}), chr(10))"


def gate(diagnoses: DataFrame, shown: int = SHOWN_FAILURES) -> DataFrame:
    """One row with ``status`` HEALTHY, in a plan that fails where a run did: put it in front of what only sound data may reach."""
    return gate_frame(diagnoses, shown).selectExpr(
        f"CASE WHEN failures = 0 THEN 'HEALTHY' ELSE raise_error({_gate_text(shown)}) END AS status")


def quality_gate(diagnoses: DataFrame, shown: int = SHOWN_FAILURES) -> str:
    """``HEALTHY``, or an error with the number of failed runs and the root causes of the first of them: one row for the driver."""
    found = gate_frame(diagnoses, shown).selectExpr("failures", f"{_gate_text(shown)} AS text").first()
    if found.failures:
        raise DataQualityError(found.text)
    return "HEALTHY"
