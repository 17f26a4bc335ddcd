"""The seven checks.

Each check is a query over small frames: profiles (one row per column), facts (one row per rule) and details (one
row per reported problem). They carry a run id throughout, so the same queries serve one run or a whole history.
The only passes over data are the ones behind those frames: :func:`layer_facts` for every run, and
:func:`detail_rows` for the columns and rules that were flagged.

A problem is reported where it first appears. Tables further down that show it too are listed under
``persists_in``.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession

from strataudit.config import CHECKS, CRITICAL, INFO, TRANSITIONS, WARNING, AuditConfig
from strataudit.functions import exprs, is_numeric, lit, name, percent_of
from strataudit.operators import evidence as E
from strataudit.operators import reconcile as R
from strataudit.operators.profile import table_profiles
from strataudit.plans.findings import (
    EVIDENCE,
    FINDING,
    FINDING_DDL,
    SEGMENT_DDL,
    evidence_struct,
    finding_columns,
    segment_columns,
)
from strataudit.sources.local import cached_aggregate, local_frame

Layers = Mapping[str, DataFrame]

FACTS_DDL = ("run_id string, kind string, rule int, step int, a bigint, b bigint, c bigint, d bigint, "
             "x double, y double, z double, label string")
# Values shown inside a finding, with the number of the others; ``finding_values`` has them all.
SHOWN_VALUES = 100


def strides(cfg: AuditConfig) -> dict[str, int]:
    """How far apart the items of two tables, or of two rules, lie within a check: further than any has columns or steps."""
    return {"column": max([1000, *(len(c.schema.fields) + 1 for c in cfg.contracts)]),
            "pass": max(1000, 10 * len(cfg.distinct_rules) + 10),
            "step": max([100, *(len(r.transitions) + 1 for r in cfg.measure_rules)])}


def _check(verdict: str) -> dict[str, str]:
    idx = [v for v, _ in CHECKS].index(verdict)
    return {"check_idx": str(idx), "verdict": lit(verdict), "check": lit(CHECKS[idx][1])}


def _transition(transition: str) -> dict[str, str]:
    return {"transition": lit(transition), "transition_idx": str(TRANSITIONS.index(transition))}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- facts: one pass per rule

def key_changes(layers: Layers, cfg: AuditConfig, rule_idx: int, unique: Collection[str] = ()) -> DataFrame:
    rule = cfg.key_rules[rule_idx]

    def is_unique(table: str) -> bool:
        return table in unique and cfg.contract(table).keys == (rule.row_key,)

    return E.changed_keys(layers[rule.before], layers[rule.after], rule.row_key, rule.column, cfg.segment_column,
                          is_unique(rule.before), is_unique(rule.after))


def _facts(df: DataFrame, run_id: str, kind: str, rule: int, **given: str) -> DataFrame:
    fixed = {"run_id": lit(run_id), "kind": lit(kind), "rule": str(rule)}
    columns = [c.strip().split(" ") for c in FACTS_DDL.split(",")]
    return df.selectExpr(*[f"cast({(fixed | given).get(c, 'null')} AS {t}) AS {c}" for c, t in columns])


def layer_facts(layers: Layers, cfg: AuditConfig, run_id: str, changes: Mapping[int, DataFrame],
                totals: Mapping[int, DataFrame], unique: Collection[str] = ()) -> DataFrame:
    """The figures the rules compare, one row per rule (and step), from one job.

    ``changes`` and ``totals`` are the per-segment frames of the key and measure rules; ``unique`` names the
    tables whose profile shows no surplus key.
    """
    parts = []
    for i, per_segment in changes.items():
        summed = per_segment.agg(*exprs("sum(changed) AS changed", "sum(padded) AS padded",
                                        E.sole_segment("changed", cfg.segment_column) + " AS sole"))
        parts.append(_facts(summed, run_id, "key", i, a="coalesce(changed, 0)", b="coalesce(padded, 0)", label="sole"))
    for i, rule in enumerate(cfg.distinct_rules):
        known = rule.before in unique and cfg.contract(rule.before).keys == (rule.key,)
        parts.append(_facts(R.expected_keys(layers[rule.before], rule, known), run_id, "distinct", i,
                            a="source_rows", b="expected_rows", c="excluded_keys", d="surplus_keys"))
    for i, rule in enumerate(cfg.measure_rules):
        parts.append(_facts(R.measure_drift(totals[i], rule), run_id, "measure", i, step="step",
                            x="expected_total", y="actual_total", z="drift_pct"))
    for i, rule in enumerate(cfg.distribution_rules):
        parts.append(_facts(R.category_share(layers[rule.table], rule), run_id, "share", i,
                            a="rows", b="category_rows", c="with_null_cause", x="share_pct"))
    return _union(parts)


# ---------------------------------------------------------------- findings

class Checks:
    """Evaluates the checks over the profiles and facts of one or many runs."""

    def __init__(self, spark: SparkSession, cfg: AuditConfig, profiles: DataFrame, facts: DataFrame | None = None,
                 tables: DataFrame | None = None):
        self.spark, self.cfg, self.stride = spark, cfg, strides(cfg)
        self.frames = {
            "profiles": profiles,
            "tables": tables if tables is not None else table_profiles(profiles),
            "facts": facts if facts is not None else local_frame(spark, [], FACTS_DDL),
            "contracts": cfg.contract_frame(spark),
            "keys": cfg.key_frame(spark),
            "downstream": cfg.downstream_frame(spark),
        }

    def _sql(self, text: str) -> DataFrame:
        used = {k: v for k, v in self.frames.items() if "{" + k + "}" in text}
        return self.spark.sql(text, **used)

    def all(self) -> DataFrame:
        """Findings of every check, in check order within a run (``check_idx``, ``item_idx``)."""
        return _union([self.schema(), self.key_integrity(), self.uniqueness(), self.nulls(), self.row_counts(),
                       self.measures(), self.distribution()])

    def _none(self) -> DataFrame:
        return local_frame(self.spark, [], FINDING_DDL)

    def schema(self) -> DataFrame:
        """Contract columns that are missing or of another type."""
        columns = finding_columns(
            **_check("schema"), run_id="t.run_id", item_idx=f"c.table_idx * {self.stride['column']} + c.column_idx",
            category="'SCHEMA_DRIFT'", severity=lit(CRITICAL), transition="c.transition",
            transition_idx="c.transition_idx", table="c.table", column="c.column",
            message="CASE WHEN p.dtype IS NULL THEN concat(c.table, '.', c.column, ' is missing') ELSE "
                    "concat(c.table, '.', c.column, ' arrived as ', p.dtype, ', contract says ', c.expected_type) END",
            expected="c.expected_type", actual="p.dtype")
        return self._sql(f"""
            SELECT {columns} FROM {{contracts}} c JOIN {{tables}} t ON t.table = c.table
            LEFT JOIN {{profiles}} p ON p.run_id = t.run_id AND p.table = c.table AND p.column = c.column
            WHERE p.dtype IS NULL OR p.dtype <> c.expected_type""")

    def nulls(self) -> DataFrame:
        """Columns over their null limit whose upstream column is not."""
        columns = finding_columns(
            **_check("nulls"), run_id="p.run_id", item_idx=f"c.table_idx * {self.stride['column']} + c.column_idx",
            category="'NULL_SPIKE'",
            severity=f"CASE WHEN p.null_pct > {self.cfg.null_critical_pct} THEN {lit(CRITICAL)} ELSE {lit(WARNING)} END",
            transition="c.transition", transition_idx="c.transition_idx", table="c.table", column="c.column",
            message="concat(c.table, '.', c.column, CASE WHEN c.transition_idx = 0 THEN ' arrived with ' ELSE "
                    "concat(' picked up during ', c.transition, ': ') END, p.null_pct, '% nulls (limit ', "
                    "c.null_limit, '%)')",
            expected="concat('<= ', c.null_limit, '%')", actual="concat(p.null_pct, '%')",
            evidence=evidence_struct(
                null_rows="p.null_count", limit_pct="c.null_limit",
                upstream_table="CASE WHEN u.dtype IS NOT NULL THEN c.upstream_table END",
                upstream_null_pct="u.null_pct", upstream_dtype="u.dtype",
                note="CASE WHEN u.dtype <> p.dtype THEN concat('upstream column is ', u.dtype, "
                     "'; values that failed the cast to ', p.dtype, ' became NULL') END",
                persists_in="coalesce(x.found, array())"))
        return self._sql(f"""
            WITH persisting AS (
                SELECT p.run_id, c.table, c.column, transform(array_sort(collect_list(
                    struct(w.descendant_idx, w.descendant))), e -> e.descendant) AS found
                FROM {{contracts}} c JOIN {{profiles}} p ON p.table = c.table AND p.column = c.column
                JOIN {{downstream}} w ON w.table = c.table
                JOIN {{profiles}} q ON q.run_id = p.run_id AND q.table = w.descendant AND q.column = c.column
                WHERE p.null_pct > c.null_limit AND q.null_pct > c.null_limit GROUP BY ALL)
            SELECT {columns} FROM {{contracts}} c JOIN {{profiles}} p ON p.table = c.table AND p.column = c.column
            LEFT JOIN {{profiles}} u ON u.run_id = p.run_id AND u.table = c.upstream_table AND u.column = c.column
            LEFT JOIN persisting x ON x.run_id = p.run_id AND x.table = c.table AND x.column = c.column
            WHERE p.null_pct > c.null_limit AND (u.null_pct IS NULL OR u.null_pct <= c.null_limit)""")

    def uniqueness(self) -> DataFrame:
        """Tables with more surplus keys than the table that feeds them."""
        inherited = "coalesce(u.duplicate_keys, 0L)"
        columns = finding_columns(
            **_check("uniqueness"), run_id="t.run_id", item_idx="k.table_idx", category="'DUPLICATE_ROWS'",
            severity=lit(CRITICAL), transition="k.transition", transition_idx="k.transition_idx", table="k.table",
            column="k.key",
            message=f"CASE WHEN {inherited} = 0 THEN concat(k.table, ' has ', format_number(t.duplicate_keys, 0), "
                    f"' duplicate ', k.key, ' rows, none upstream') ELSE concat(k.table, ' has ', "
                    f"format_number(t.duplicate_keys - {inherited}, 0), ' more duplicate ', k.key, "
                    f"' rows than upstream') END",
            expected="'0'", actual="t.duplicate_keys",
            evidence=evidence_struct(
                duplicate_rows="t.duplicate_keys", upstream_duplicate_rows=inherited,
                persists_in="coalesce(x.found, array())"))
        return self._sql(f"""
            WITH persisting AS (
                SELECT q.run_id, w.table, transform(array_sort(collect_list(
                    struct(w.descendant_idx, w.descendant))), e -> e.descendant) AS found
                FROM {{downstream}} w JOIN {{tables}} q ON q.table = w.descendant
                WHERE q.duplicate_keys > 0 GROUP BY ALL)
            SELECT {columns} FROM {{keys}} k JOIN {{tables}} t ON t.table = k.table
            LEFT JOIN {{tables}} u ON u.run_id = t.run_id AND u.table = k.upstream_table
            LEFT JOIN persisting x ON x.run_id = t.run_id AND x.table = k.table
            WHERE t.duplicate_keys - {inherited} > 0""")

    def key_integrity(self) -> DataFrame:
        """Keys that changed between two layers."""
        parts = []
        for i, rule in enumerate(self.cfg.key_rules):
            columns = finding_columns(
                **_check("key_integrity"), **_transition(rule.transition), run_id="f.run_id", item_idx=str(i),
                category="'JOIN_KEY_MISMATCH'", severity=lit(CRITICAL), table=lit(rule.after), column=lit(rule.column),
                message=f"concat({lit(rule.column)}, ' changed on ', format_number(f.a, 0), "
                        f"{lit(f' {rule.noun} between {_layer(rule.before)} and {_layer(rule.after)}')})",
                expected="'unchanged'", actual="concat(format_number(f.a, 0), ' changed')",
                evidence=evidence_struct(
                    changed_rows="f.a", affected_segment="f.label",
                    pattern="CASE WHEN f.a = f.b THEN "
                            "'leading zeros stripped - looks like the key was cast to an integer' END"))
            parts.append(self._sql(f"""
                SELECT {columns} FROM {{facts}} f WHERE f.kind = 'key' AND f.rule = {i} AND f.a > 0"""))
        return _union(parts) if parts else self._none()

    def _count_finding(self, table: str, transition: str, item_idx: int, run_id: str, expected: str, actual: str,
                       evidence: str) -> str:
        pct = f"CASE WHEN {expected} <> 0 THEN round(100.0D * ({actual} - {expected}) / {expected}, 1) ELSE 0.0D END"
        diff = f"({actual} - {expected})"
        return finding_columns(
            **_check("row_counts"), **_transition(transition), run_id=run_id, item_idx=str(item_idx),
            category=f"CASE WHEN {diff} > 0 THEN 'ROW_INFLATION' ELSE 'ROW_LOSS' END",
            severity=f"CASE WHEN abs({pct}) >= {self.cfg.count_critical_pct} THEN {lit(CRITICAL)} "
                     f"ELSE {lit(WARNING)} END",
            table=lit(table), column="null",
            message=f"CASE WHEN {diff} > 0 THEN concat({lit(table)}, ' has ', format_number({diff}, 0), "
                    f"' more rows than expected (+', {pct}, '%)') ELSE concat(format_number(-{diff}, 0), "
                    f"{lit(f' rows lost during {transition} (')}, {pct}, '%)') END",
            expected=expected, actual=actual, evidence=evidence)

    def row_counts(self) -> DataFrame:
        """Rows lost or gained that no business rule explains, and the ones a rule does."""
        parts = []
        for i, rule in enumerate(self.cfg.distinct_rules):
            source = f"""FROM {{facts}} f JOIN {{tables}} t ON t.run_id = f.run_id AND t.table = {lit(rule.after)}
                JOIN {{tables}} s ON s.run_id = f.run_id AND s.table = {lit(rule.before)}
                WHERE f.kind = 'distinct' AND f.rule = {i}"""
            if rule.exclusion:
                values = ", ".join(rule.exclusion.values)
                columns = finding_columns(
                    **_check("row_counts"), **_transition(rule.transition), run_id="f.run_id", item_idx=str(10 * i),
                    category="'EXPECTED_CHANGE'", severity=lit(INFO), table=lit(rule.after), column="null",
                    message=f"concat(format_number(s.row_count - f.b, 0), "
                            f"{lit(f' {rule.noun} are expected to drop out in {_layer(rule.after)}: ')}, "
                            f"format_number(f.c, 0), {lit(f' {values} (business rule) and ')}, "
                            f"format_number(s.duplicate_keys, 0), ' duplicate keys')",
                    expected="f.b", actual="f.b",
                    evidence=evidence_struct(raw_rows="s.row_count", withdrawn="f.c",
                                             raw_duplicates="s.duplicate_keys"))
                parts.append(self._sql(f"SELECT {columns} {source}"))
            evidence = evidence_struct(raw_rows="s.row_count") if rule.exclusion else evidence_struct()
            columns = self._count_finding(rule.after, rule.transition, 10 * i + 1, "f.run_id", "f.b", "t.row_count",
                                          evidence)
            parts.append(self._sql(f"SELECT {columns} {source} AND t.row_count <> f.b"))
        for i, rule in enumerate(self.cfg.pass_through_rules):
            columns = self._count_finding(rule.after, rule.transition, self.stride["pass"] + i, "s.run_id", "s.row_count",
                                          "t.row_count", evidence_struct())
            parts.append(self._sql(f"""
                SELECT {columns} FROM {{tables}} s JOIN {{tables}} t ON t.run_id = s.run_id
                WHERE s.table = {lit(rule.before)} AND t.table = {lit(rule.after)} AND t.row_count <> s.row_count"""))
        return _union(parts) if parts else self._none()

    def measures(self) -> DataFrame:
        """Totals that do not reconcile."""
        parts = []
        for i, rule in enumerate(self.cfg.measure_rules):
            for step, transition in enumerate(rule.transitions):
                table = rule.tables[step + 1]
                columns = finding_columns(
                    **_check("measures"), **_transition(transition), run_id="f.run_id", item_idx=str(self.stride["step"] * i + step),
                    category="'MEASURE_DRIFT'",
                    severity=f"CASE WHEN abs(f.z) >= {rule.critical_pct} THEN {lit(CRITICAL)} ELSE {lit(WARNING)} END",
                    table=lit(table), column=lit(rule.measure),
                    message=f"concat({lit(f'total {rule.measure} in {table} is ')}, CASE WHEN f.y < f.x THEN 'short' "
                            f"ELSE 'over' END, ' by $', format_number(abs(f.y - f.x), 0), ' (', "
                            f"format_string('%+.1f', f.z), '%) vs the layer before')",
                    expected="format_string('%.2f', f.x)", actual="format_string('%.2f', f.y)",
                    evidence=evidence_struct(delta="round(f.y - f.x, 2)", delta_pct="round(f.z, 2)"))
                parts.append(self._sql(f"""
                    SELECT {columns} FROM {{facts}} f WHERE f.kind = 'measure' AND f.rule = {i} AND f.step = {step}
                    AND abs(f.z) > {rule.tolerance_pct}"""))
        return _union(parts) if parts else self._none()

    def distribution(self) -> DataFrame:
        """A category that must stay rare and does not."""
        parts = []
        for i, rule in enumerate(self.cfg.distribution_rules):
            columns = finding_columns(
                **_check("distribution"), **_transition(rule.transition), run_id="f.run_id", item_idx=str(i),
                category="'DISTRIBUTION_SHIFT'",
                severity=f"CASE WHEN f.x > {rule.critical_pct} THEN {lit(CRITICAL)} ELSE {lit(WARNING)} END",
                table=lit(rule.table), column=lit(rule.column),
                message=f"concat(f.x, {lit(f'% of {rule.noun} in {_layer(rule.table)} have {rule.column} = {rule.category} (limit {rule.limit_pct}%)')})",
                expected=lit(f"<= {rule.limit_pct}%"), actual="concat(f.x, '%')",
                evidence=evidence_struct(
                    unknown_rows="f.b", unknown_with_null_credit_score="f.c",
                    note=lit(f"{rule.column} is {rule.category} whenever {rule.cause_column} is NULL")))
            parts.append(self._sql(f"""
                SELECT {columns} FROM {{facts}} f WHERE f.kind = 'share' AND f.rule = {i}
                AND f.x > {rule.limit_pct}"""))
        return _union(parts) if parts else self._none()


def _layer(table: str) -> str:
    return table.split(".", 1)[0]


# ---------------------------------------------------------------- details: only what was flagged

def folded_details(rows: DataFrame) -> DataFrame:
    """One row per reported problem, from one row per figure."""
    def number(metric: str) -> str:
        return f"max(CASE WHEN metric = '{metric}' THEN number END) AS {metric}"

    def text(metric: str) -> str:
        return f"max(CASE WHEN metric = '{metric}' THEN text END) AS {metric}"

    def texts(metric: str, alias: str) -> str:
        return f"array_sort(collect_list(CASE WHEN metric = '{metric}' THEN text END)) AS {alias}"

    return rows.groupBy("run_id", "verdict", "table", "item_idx").agg(*exprs(
        number("affected_rows"), number("all_rows"), text("sole"), texts("sample", "samples"),
        texts("missing", "missing"), number("missing_count"), number("exact_copies"), number("duplicated_keys"), text("date_from"),
        text("date_to"), text("table_start"), text("cause"), number("unmatched_rows"), number("key_length"), number("padded")))


# Evidence fields that details fill, per check.
DETAIL_EVIDENCE = {
    "schema": {
        "non_numeric_rows": "affected_rows",
        "non_numeric_pct": percent_of("affected_rows", "all_rows", 1),
        "sample_values": "samples",
        "pattern": "CASE WHEN exists(samples, v -> v RLIKE '[$,]') THEN "
                   "'values contain currency symbols / thousands separators' END",
        "affected_segment": "sole",
    },
    "nulls": {"affected_segment": "sole"},
    "uniqueness": {
        "exact_copies": "exact_copies",
        "duplicated_keys": "duplicated_keys",
        "origination_date_range": "CASE WHEN date_from IS NOT NULL THEN array(date_from, date_to) END",
        "table_origination_start": "table_start",
    },
    "key_integrity": {"examples": "samples", "rows_now_unmatched_in_customers": "coalesce(unmatched_rows, 0L)"},
    "row_counts": {
        "cause": "cause",
        "unmatched_rows": "unmatched_rows",
        "affected_segment": "sole",
        "sample_unmatched_keys": "samples",
        "customer_key_length": "key_length",
        "match_if_zero_padded": "coalesce(padded, 0L)",
        "loan_types_missing_from_final":
            "CASE WHEN missing_count > size(missing) THEN concat(missing, array(concat('and ', missing_count - size(missing), "
            "' more in finding_values'))) WHEN size(missing) > 0 THEN missing END",
    },
}


def attach_details(findings: DataFrame, rows: DataFrame) -> DataFrame:
    """Findings with the evidence that needed a look at the data."""
    key = ["run_id", "verdict", "table", "item_idx"]
    joined = findings.join(folded_details(rows), key, "left")
    fields = {}
    for field in EVIDENCE:
        arms = [f"WHEN verdict = {lit(v)} AND samples IS NOT NULL"
                + (" AND unmatched_rows > 0" if v == "row_counts" else "") + f" THEN {given[field]}"
                for v, given in DETAIL_EVIDENCE.items() if field in given]
        old = f"evidence.{field}"
        fields[field] = f"coalesce(CASE {' '.join(arms)} END, {old})" if arms else old
    return joined.selectExpr(*[c for c in FINDING if c != "evidence"], f"{evidence_struct(**fields)} AS evidence")


VALUES_DDL = "run_id string, verdict string, table string, kind string, value string"


class Details:
    """Figures, samples and segments behind the findings that need a look at the data.

    ``flagged`` are findings, collected: at most one per contract column and check. Without ``evidence``, only segments and values are
    wanted, and repeated rows are counted by their keys alone.
    """

    def __init__(self, layers: Layers, cfg: AuditConfig, run_id: str, changed: Mapping[int, DataFrame],
                 changes: Mapping[int, DataFrame], totals: Mapping[int, DataFrame], flagged: list[Row], evidence: bool = True):
        self.layers, self.cfg, self.run_id = layers, cfg, run_id
        self.changed, self.changes, self.totals, self.flagged, self.evidence = changed, changes, totals, flagged, evidence
        self.unmatched: dict[tuple[str, str, str], DataFrame] = {}
        self.rows: list[DataFrame] = []
        self.segments: list[DataFrame] = []
        self.lost: list[DataFrame] = []
        self.kept: list[DataFrame] = []
        self._columns()
        for f in flagged:
            match f.verdict:
                case "uniqueness":
                    self._uniqueness(f)
                case "key_integrity":
                    self._key_integrity(f)
                case "row_counts" if f.category == "ROW_LOSS":
                    self._row_loss(f)
                case "measures":
                    self._measures(f)

    def _segment_column(self, table: str) -> str | None:
        return self.cfg.segment_column if self.cfg.segment_column in self.layers[table].columns else None

    def _row(self, df: DataFrame, f: Row, metric: str, number: str = "null", text: str = "null") -> None:
        self._figures(df, f, {metric: (number, text)})

    def _figures(self, df: DataFrame, f: Row, figures: Mapping[str, tuple[str, str]]) -> None:
        """Figures ``{metric: (number, text)}`` read off the rows of one frame."""
        cells = ", ".join(f"struct({lit(m)} AS metric, cast({n} AS bigint) AS number, cast({t} AS string) AS text)"
                          for m, (n, t) in figures.items())
        self.rows.append(df.selectExpr(
            f"{lit(self.run_id)} AS run_id", f"{lit(f.verdict)} AS verdict", f"{lit(f.table)} AS table",
            f"{f.item_idx} AS item_idx", f"inline(array({cells}))"))

    def _segment(self, df: DataFrame, f: Row, magnitude: str, **figures: str) -> None:
        self.segments.append(df.selectExpr(*segment_columns(
            run_id=lit(self.run_id), verdict=lit(f.verdict), table=lit(f.table), column=lit(f.column),
            segment="segment", magnitude=magnitude, **figures)))

    def _columns(self) -> None:
        """Schema and null findings: one scan per table for all its flagged columns."""
        by_table: dict[str, dict[str, tuple[Row, str]]] = {}
        for f in self.flagged:
            df = self.layers[f.table]
            if f.verdict == "nulls":
                condition = f"{name(f.column)} IS NULL"
            elif f.verdict == "schema" and f.actual == "VARCHAR" and self._expects_number(f):
                condition = E.failed_cast(f.column, df.schema[f.column].dataType)
                self._row(E.smallest_values(df.filter(condition), f.column), f, "sample", text="value")
            else:
                continue
            by_table.setdefault(f.table, {})[f"{f.verdict} {f.column}"] = (f, condition)
        for table, items in by_table.items():
            segment = self._segment_column(table)
            counts = self._keep(E.segment_counts(self.layers[table], segment, {k: c for k, (_, c) in items.items()}))
            for item, (f, _) in items.items():
                mine = counts.filter(f"item = {lit(item)}")
                summed = mine.agg(*exprs("coalesce(sum(affected), 0L) AS n", "coalesce(sum(rows), 0L) AS m",
                                         (E.sole_segment("affected", segment) if segment else lit(None)) + " AS sole"))
                self._figures(summed, f, {"affected_rows": ("n", "null"), "all_rows": ("m", "null"),
                                         "sole": ("null", "sole")})
                if segment:
                    self._segment(mine, f, "affected", rows="rows", affected="affected", affected_pct="affected_pct")

    def _expects_number(self, f: Row) -> bool:
        return is_numeric(self.cfg.contract(f.table).schema[f.column].dataType)

    def _keep(self, df: DataFrame) -> DataFrame:
        self.kept.append(cached_aggregate(df))
        return self.kept[-1]

    def _orphans(self, table: str, reference: str, column: str) -> DataFrame:
        """Unmatched keys of a table, joined once however many findings speak of them."""
        at = (table, reference, column)
        if at not in self.unmatched:
            self.unmatched[at] = self._keep(E.orphan_keys(self.layers[table], self.layers[reference], column, self._segment_column(table)))
        return self.unmatched[at]

    def _uniqueness(self, f: Row) -> None:
        df, keys, segment = self.layers[f.table], self.cfg.contract(f.table).keys, self._segment_column(f.table)
        if not self.evidence:
            if segment:
                self._segment(E.surplus_among(E.key_rows(df, keys, segment), keys), f, "extra_rows", extra_rows="extra_rows")
            return
        date = self.cfg.date_column if self.cfg.date_column in df.columns else None
        counted = self._keep(E.counted_rows(df, keys, segment, date))
        self._row(E.copies_among(counted), f, "exact_copies", number="exact_copies")
        if date:
            span = E.duplicate_span(E.repeated_among(counted, keys))
            self._figures(span, f, {"duplicated_keys": ("duplicated_keys", "null"), "date_from": ("null", "date_from"),
                                    "date_to": ("null", "date_to")})
            start = counted.agg(*exprs("cast(cast(min(first_date) AS date) AS string) AS start"))
            self._row(start, f, "table_start", text="start")
        if segment:
            self._segment(E.surplus_among(counted, keys), f, "extra_rows", extra_rows="extra_rows")

    def _key_integrity(self, f: Row) -> None:
        rule = self.cfg.key_rules[f.item_idx]
        self._row(E.changed_key_examples(self.changed[f.item_idx]), f, "sample", text="value")
        orphans = self._orphans(rule.after, rule.reference, rule.column)
        self._row(orphans.agg({"unmatched_rows": "sum"}), f, "unmatched_rows", number="`sum(unmatched_rows)`")
        self._segment(self.changes[f.item_idx], f, "changed", changed_rows="changed")

    def _row_loss(self, f: Row) -> None:
        rule = next((r for r in self.cfg.pass_through_rules if r.after == f.table), None)
        if rule is None:
            return
        before, reference = self.layers[rule.before], self.layers[rule.reference]
        segment = self._segment_column(rule.before)
        orphans = self._orphans(rule.before, rule.reference, rule.column)
        per_segment = orphans.groupBy("segment").agg(*exprs("sum(unmatched_rows) AS unmatched_rows"))
        summed = per_segment.agg(*exprs("sum(unmatched_rows) AS n",
                                        E.sole_segment("unmatched_rows", self.cfg.segment_column) + " AS sole"))
        cause = lit(f"{rule.noun} whose {rule.column} has no match in {rule.reference} are dropped by the inner join")
        self._figures(summed, f, {"unmatched_rows": ("n", "null"), "sole": ("null", "sole"), "cause": ("null", cause)})
        self._row(E.smallest_values(orphans.filter(f"{name(rule.column)} IS NOT NULL"), rule.column), f, "sample",
                  text="value")
        self._row(E.modal_length(reference, rule.column), f, "key_length", number="key_length")
        padded = E.zero_padded_matches(orphans, reference, rule.column)
        self._row(padded.agg({"unmatched_rows": "sum"}), f, "padded", number="coalesce(`sum(unmatched_rows)`, 0L)")
        lost = E.lost_groups(before, self.layers[rule.after], rule.group_column)
        self.lost.append(lost.selectExpr(f"{lit(self.run_id)} AS run_id", f"{lit(f.verdict)} AS verdict", f"{lit(f.table)} AS table",
                                         f"{lit('missing ' + rule.group_column)} AS kind", f"cast({name(rule.group_column)} AS string) AS value"))
        self._row(lost.orderBy(name(rule.group_column)).limit(SHOWN_VALUES), f, "missing", text=f"cast({name(rule.group_column)} AS string)")
        self._row(lost.agg(*exprs(f"count({name(rule.group_column)}) AS n")), f, "missing_count", number="n")
        if segment:
            self._segment(per_segment, f, "unmatched_rows", unmatched_rows="unmatched_rows")

    def _measures(self, f: Row) -> None:
        rule_idx = f.item_idx // strides(self.cfg)["step"]
        steps = R.measure_steps(self.totals[rule_idx], self.cfg.measure_rules[rule_idx])
        mine = steps.filter(f"transition = {lit(f.transition)}")
        self._segment(mine, f, "abs(delta)", expected="expected", actual="actual", delta="delta")

    def detail_rows(self) -> DataFrame | None:
        return _union(self.rows) if self.rows else None

    def lost_frame(self, spark: SparkSession) -> DataFrame:
        return _union(self.lost) if self.lost else local_frame(spark, [], VALUES_DDL)

    def segment_frame(self, spark: SparkSession) -> DataFrame:
        return _union(self.segments) if self.segments else local_frame(spark, [], SEGMENT_DDL)
