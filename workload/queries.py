"""The registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from strataudit.functions import exprs
from strataudit.operators import evidence as E
from strataudit.operators import layers as L
from strataudit.operators import mutations as M
from strataudit.operators import profile as P
from strataudit.operators import reconcile as R
from strataudit.plans import diagnosis as G
from strataudit.plans import history as H
from strataudit.plans import reports as N
from strataudit.plans.checks import Checks
from strataudit.plans.findings import SEGMENT_DDL
from strataudit.plans.lineage import closure
from strataudit.plans.runs import Runs, truth_frame
from strataudit.sources.history import History
from strataudit.sources.layers import LayerStore, scratch_root
from strataudit.sources.local import local_frame
from workload import domain as D
from workload import history as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CFG = D.config()
COUNT_RULES, MEASURE, SHARE = CFG.distinct_rules, CFG.measure_rules[0], CFG.distribution_rules[0]
SEGMENT = CFG.segment_column


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------- layers

@query
def clean_customers(spark, sf):
    return D.layers(spark, sf)["staging.customers"]


@query
def clean_loans(spark, sf):
    return D.layers(spark, sf)["staging.loans"]


@query
def clean_customers_blanks(spark, sf):
    """States and keys between blanks of several kinds, ASCII and not."""
    raw = D.raw_tables(spark, sf)["raw.customers"].selectExpr(
        "concat('\\u00a0', customer_id, '\\u2003') AS customer_id", "full_name",
        "concat('\\u001c\\t', state, '\\u3000\\u0085') AS state", "credit_score", "annual_income")
    return L.clean_customers(raw)


@query
def clean_loans_repeated_keys(spark, sf):
    return L.clean_loans(D.repeated_loans(spark, sf)).select("loan_id", "source_system", "status", "balance")


@query
def measure_drift_repeated_keys(spark, sf):
    raw = D.repeated_loans(spark, sf)
    staged = L.clean_loans(raw)
    layers = {"raw.loans": raw, "staging.loans": staged, "final.loan_portfolio": staged}
    return R.measure_drift(R.segment_totals(layers, MEASURE, SEGMENT), MEASURE).selectExpr(
        "transition", "round(expected_total, 2) AS expected_total", "round(actual_total, 2) AS actual_total", "round(drift_pct, 4) AS drift_pct")


@query
def clean_loans_text_balance(spark, sf):
    return D.layers(spark, sf, "type_change")["staging.loans"].select("loan_id", "source_system", "status", "balance")


@query
def loan_portfolio(spark, sf):
    return D.layers(spark, sf)["final.loan_portfolio"]


@query
def portfolio_summary(spark, sf):
    return L.portfolio_summary(D.layers(spark, sf)["final.loan_portfolio"])


@query
def risk_band_distribution(spark, sf):
    portfolio = D.layers(spark, sf, "null_spike")["final.loan_portfolio"]
    return portfolio.groupBy("risk_band").agg(*exprs(
        "count(*) AS loans", "count_if(credit_score IS NULL) AS without_score", "count_if(is_delinquent) AS delinquent"))


@query
def unknown_share(spark, sf):
    return R.category_share(D.layers(spark, sf, "null_spike")["final.loan_portfolio"], SHARE)


def _row_counts(layers: dict) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(*exprs("count(*) AS rows")).selectExpr(f"'{name}' AS table", "rows") for name, df in layers.items()])


@query
def layer_row_counts(spark, sf):
    return _row_counts(D.layers(spark, sf))


@query
def table_preview(spark, sf):
    """The first 100 rows by key; the limit is the feature."""
    return D.layers(spark, sf)["staging.loans"].orderBy("loan_id").limit(100)


@query
def balance_by_source(spark, sf):
    return L.balance_by_source(D.layers(spark, sf, "type_change"), D.LOAN_TABLES)


@query
def balance_by_source_pivot(spark, sf):
    by_source = L.balance_by_source(D.layers(spark, sf, "dropped_join_key"), D.LOAN_TABLES)
    return L.pivot_by_layer(by_source, "balance", D.LAYER_NAMES, D.SOURCES)


@query
def loans_by_source_pivot(spark, sf):
    by_source = L.balance_by_source(D.layers(spark, sf, "dropped_join_key"), D.LOAN_TABLES)
    return L.pivot_by_layer(by_source, "loans", D.LAYER_NAMES, D.SOURCES)


# ---------------------------------------------------------------- profiles

@query
def profile_raw_loans(spark, sf):
    return P.profile_tables([("raw.loans", D.raw_tables(spark, sf)["raw.loans"], ("loan_id",))])


@query
def profile_lineitem(spark, sf):
    """A table with a key of two columns."""
    return P.profile_tables([("lineitem", D.table(spark, sf, "lineitem"), ("l_orderkey", "l_linenumber"))])


@query
def profile_layers(spark, sf):
    return P.profile_layers(D.stored_layers(spark, sf, "type_change"), CFG, "type_change")


@query
def table_profiles(spark, sf):
    return P.table_profiles(P.profile_layers(D.stored_layers(spark, sf, "duplicate_rows"), CFG, "duplicate_rows"))


@query
def column_grid(spark, sf):
    profiled = P.profile_tables([("raw.loans", D.raw_tables(spark, sf)["raw.loans"], ("loan_id",))])
    return P.column_grid(profiled.selectExpr("'clean' AS run_id", "*"))


# ---------------------------------------------------------------- duplicates

def _duplicated(spark, sf):
    return D.layers(spark, sf, "duplicate_rows")["staging.loans"]


@query
def duplicate_keys_lineitem(spark, sf):
    return D.table(spark, sf, "lineitem").agg(*exprs(
        "count(*) AS rows", P.surplus_keys(("l_orderkey", "l_linenumber")) + " AS surplus"))


@query
def duplicate_groups_lineitem(spark, sf):
    return E.duplicate_keys(D.table(spark, sf, "lineitem"), ("l_orderkey", "l_linenumber"), "l_shipdate").selectExpr(
        "l_orderkey", "l_linenumber", "copies", "cast(first_date AS date) AS first_date")


@query
def duplicate_spans(spark, sf):
    return E.duplicate_span(E.duplicate_keys(_duplicated(spark, sf), ("loan_id",), "origination_date"))


@query
def surplus_by_segment(spark, sf):
    return E.surplus_by_segment(_duplicated(spark, sf), ("loan_id",), SEGMENT)


@query
def surplus_by_flag_lineitem(spark, sf):
    return E.surplus_by_segment(D.table(spark, sf, "lineitem"), ("l_orderkey", "l_linenumber"), "l_returnflag")


@query
def exact_copies(spark, sf):
    return E.exact_copies(_duplicated(spark, sf), ("loan_id",))


@query
def first_row_per_key_lineitem(spark, sf):
    """Of the rows that share a key, the one that comes first by its other columns."""
    return L.first_per_key(D.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- orphans and changed keys

def _unmatched(spark, sf):
    layers = D.layers(spark, sf, "dropped_join_key")
    return layers, E.orphan_keys(layers["staging.loans"], layers["staging.customers"], "customer_id", SEGMENT)


@query
def orphans(spark, sf):
    layers = D.layers(spark, sf, "dropped_join_key")
    return E.orphan_rows(layers["staging.loans"], layers["staging.customers"], "customer_id")


@query
def orphans_by_source(spark, sf):
    return _unmatched(spark, sf)[1].groupBy("segment").agg(*exprs("sum(unmatched_rows) AS unmatched_rows"))


@query
def orphans_zero_padded(spark, sf):
    layers, keys = _unmatched(spark, sf)
    padded = E.zero_padded_matches(keys, layers["staging.customers"], "customer_id")
    return padded.agg(*exprs("coalesce(sum(unmatched_rows), 0L) AS match_if_zero_padded"))


@query
def orphan_samples(spark, sf):
    return E.smallest_values(_unmatched(spark, sf)[1], "customer_id")


@query
def lost_loan_types(spark, sf):
    layers = D.layers(spark, sf, "dropped_join_key")
    return E.lost_groups(layers["staging.loans"], layers["final.loan_portfolio"], "loan_type")


@query
def modal_key_length(spark, sf):
    return E.modal_length(D.layers(spark, sf, "dropped_join_key")["staging.loans"], "customer_id")


def _changed(spark, sf):
    layers = D.layers(spark, sf, "dropped_join_key")
    return E.changed_keys(layers["raw.loans"], layers["staging.loans"], "loan_id", "customer_id", SEGMENT)


@query
def changed_keys(spark, sf):
    return _changed(spark, sf).agg(*exprs("sum(changed) AS changed", "sum(padded) AS zero_padded"))


@query
def changed_keys_by_source(spark, sf):
    return _changed(spark, sf).groupBy("segment").agg(*exprs("sum(changed) AS changed", "sum(padded) AS zero_padded"))


@query
def changed_key_samples(spark, sf):
    return E.changed_key_examples(_changed(spark, sf))


@query
def changed_suppliers_lineitem(spark, sf):
    """Orders have many suppliers on both sides here: lines of even against lines of odd line numbers."""
    lines = D.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "lpad(cast(l_suppkey AS string), 4, '0') AS padded", "cast(l_suppkey AS string) AS plain",
        "l_returnflag", "l_linenumber")
    before = lines.filter("l_linenumber % 2 = 0").selectExpr("l_orderkey", "padded AS supplier", "l_returnflag")
    after = lines.filter("l_linenumber % 2 = 1").selectExpr(
        "l_orderkey", "CASE WHEN l_linenumber = 1 THEN padded ELSE plain END AS supplier")
    changed = E.changed_keys(before, after, "l_orderkey", "supplier", "l_returnflag")
    return changed.groupBy("segment").agg(*exprs("sum(changed) AS changed", "sum(padded) AS zero_padded"))


# ---------------------------------------------------------------- failed casts, nulls, schema

@query
def non_numeric_segments(spark, sf):
    loans = D.raw_tables(spark, sf, "type_change")["raw.loans"]
    flag = E.failed_cast("balance", loans.schema["balance"].dataType)
    return E.segment_counts(loans, SEGMENT, {"balance": flag})


@query
def non_numeric_sole_segment(spark, sf):
    return non_numeric_segments(spark, sf).groupBy("item").agg(*exprs(
        "sum(affected) AS affected", E.sole_segment("affected", SEGMENT) + " AS affected_segment"))


@query
def non_numeric_samples(spark, sf):
    loans = D.raw_tables(spark, sf, "type_change")["raw.loans"]
    return E.smallest_values(loans.filter(E.failed_cast("balance", loans.schema["balance"].dataType)), "balance")


@query
def null_segments(spark, sf):
    portfolio = D.layers(spark, sf, "null_spike")["final.loan_portfolio"]
    return E.segment_counts(portfolio, SEGMENT, {"credit_score": "credit_score IS NULL", "state": "state IS NULL"})


FINDING_KEYS = ["run_id", "check", "category", "severity", "transition", "table", "column", "message", "expected",
                "actual"]


@query
def schema_drift(spark, sf):
    """Declared against arrived types, with the values that no longer read as numbers."""
    with_details = _diagnosis(spark, sf, "type_change").findings.filter("verdict = 'schema'")
    return with_details.selectExpr("table", "column", "expected", "actual", "evidence.non_numeric_rows",
                                   "evidence.non_numeric_pct", "evidence.affected_segment", "evidence.pattern")


@query
def null_spike_first_appearance(spark, sf):
    """Nulls reported where they start, with the tables they persist in."""
    profiled = P.profile_layers(D.stored_layers(spark, sf, "null_spike"), CFG, "null_spike")
    return Checks(spark, CFG, profiled).nulls().selectExpr(
        "table", "column", "severity", "evidence.null_rows", "evidence.limit_pct",
        "array_join(evidence.persists_in, ', ') AS persists_in")


@query
def lineage_closure(spark, sf):
    """Every table that depends on another, directly or not, with the rows at both ends, for loans and for supplies."""
    supplies = L.build_layers({f"raw.{n}": df for n, df in D.supply_sources(spark, sf).items()}, D.supply_config().transforms)
    counts = layer_row_counts(spark, sf).unionByName(_row_counts(supplies))
    edges = CFG.lineage_frame(spark).unionByName(D.supply_config().lineage_frame(spark))
    return (closure(edges).join(counts.selectExpr("table AS src_table", "rows AS src_rows"), "src_table")
            .join(counts.selectExpr("table AS dst_table", "rows AS dst_rows"), "dst_table")
            .select("src_table", "dst_table", "depth", "src_rows", "dst_rows"))


# ---------------------------------------------------------------- reconciliation

@query
def row_reconciliation(spark, sf):
    layers = D.layers(spark, sf, "duplicate_rows")
    parts = [R.expected_keys(layers[r.before], r).selectExpr(f"'{r.after}' AS table", "*") for r in COUNT_RULES]
    return parts[0].unionByName(parts[1])


@query
def measure_reconciliation(spark, sf):
    layers = D.stored_layers(spark, sf, "dropped_join_key")
    return R.measure_steps(R.segment_totals(layers, MEASURE, SEGMENT), MEASURE)


@query
def measure_drift(spark, sf):
    layers = D.stored_layers(spark, sf, "type_change")
    return R.measure_drift(R.segment_totals(layers, MEASURE, SEGMENT), MEASURE).selectExpr(
        "step", "transition", "table", "round(expected_total, 2) AS expected_total",
        "round(actual_total, 2) AS actual_total", "round(drift_pct, 4) AS drift_pct")


# ---------------------------------------------------------------- mutations

@query
def mutate_type_change(spark, sf):
    return D.raw_tables(spark, sf, "type_change")["raw.loans"].select("loan_id", "source_system", "balance")


@query
def mutate_null(spark, sf):
    return D.raw_tables(spark, sf, "null_spike")["raw.customers"]


@query
def mutate_key(spark, sf):
    return D.layers(spark, sf, "dropped_join_key")["staging.loans"].select("loan_id", "source_system", "customer_id")


@query
def mutate_duplicate(spark, sf):
    return _duplicated(spark, sf)


@query
def mutate_messy_case(spark, sf):
    """A tenth of the codes in lower case, a twentieth with a trailing blank, by loan number."""
    number = "cast(substr(loan_id, 2) AS bigint)"
    return M.messy_case(D.layers(spark, sf)["staging.loans"], "status", f"{number} % 10 = 3",
                        f"{number} % 20 = 3").select("loan_id", "status")


@query
def mutation_truth(spark, sf):
    loans = D.raw_tables(spark, sf)["raw.loans"]
    staged = D.layers(spark, sf)["staging.loans"]
    return M.truth(loans, "type_change", "type_change", "extract:loans", "balance", "source_system = 'CORE_BANKING'",
                   "source_system = 'CORE_BANKING'").unionByName(
        M.truth(staged, "duplicate_rows", "duplicate_rows", "staging:loans", "loan_id",
                M.recent("origination_date", D.AS_OF))).drop("description")


# ---------------------------------------------------------------- findings and diagnoses of the scenarios

def _diagnosis(spark, sf, scenario):
    return G.diagnose(D.stored_layers(spark, sf, scenario), CFG, scenario).close()


def _diagnosis_columns(report: DataFrame) -> DataFrame:
    return report.selectExpr(
        "run_id", "status", "root_cause.category AS root_category", "root_cause.transition AS root_transition",
        "root_cause.table AS root_table", "root_cause.column AS root_column", "symptom_count",
        "array_join(transform(symptoms, s -> concat(s.category, ' at ', s.transition)), ', ') AS symptoms",
        "array_join(expected_changes, ', ') AS expected_changes",
        "array_join(array_sort(map_keys(map_filter(checks, (k, v) -> v = 'FAIL'))), ', ') AS failed_checks",
        "impact.final_loan_rows", "impact.final_distinct_loans", "impact.final_total_balance",
        "impact.staging_loan_rows")


def _register_scenario(scenario: str) -> None:
    def findings(spark, sf):
        return _diagnosis(spark, sf, scenario).findings.select(*FINDING_KEYS)

    def diagnosis(spark, sf):
        return _diagnosis_columns(_diagnosis(spark, sf, scenario).report())

    QUERIES[f"findings_{scenario}"] = findings
    QUERIES[f"diagnosis_{scenario}"] = diagnosis


for _scenario in D.SCENARIOS:
    _register_scenario(_scenario)


@query
def finding_evidence(spark, sf):
    """Evidence of the key fault: one row per finding, scalar fields only."""
    found = _diagnosis(spark, sf, "dropped_join_key").findings.filter("severity <> 'info'")
    return found.selectExpr(
        "check", "evidence.affected_segment", "evidence.pattern", "evidence.changed_rows", "evidence.unmatched_rows",
        "evidence.match_if_zero_padded", "evidence.customer_key_length", "evidence.rows_now_unmatched_in_customers",
        "evidence.delta", "array_join(evidence.sample_unmatched_keys, ', ') AS sample_unmatched_keys",
        "array_join(evidence.loan_types_missing_from_final, ', ') AS missing_types")


@query
def finding_segments(spark, sf):
    found = G.diagnose(D.stored_layers(spark, sf, "duplicate_rows"), CFG, "duplicate_rows", evidence=False)
    return _closing(found, found.segments.select(
        "verdict", "table", "segment", "extra_rows", "expected", "actual", "delta"))


def _closing(found: G.Diagnosis, rows: DataFrame) -> DataFrame:
    """Rows that read what a diagnosis keeps: stored first, then it is closed."""
    stored = LayerStore(rows.sparkSession, scratch_root(rows.sparkSession)).save("found.rows", rows)
    found.close()
    return stored


@query
def finding_values_dropped_join_key(spark, sf):
    """All values behind a finding that shows a part of them."""
    found = G.diagnose(D.stored_layers(spark, sf, "dropped_join_key"), CFG, "dropped_join_key")
    values = found.finding_values.select("run_id", "table", "kind", "value")
    return _closing(found, values)


@query
def findings_missing_column(spark, sf):
    """A diagnosis of raw loans that lost a column, for each of four columns, from the lost column's own finding."""
    parts, layers = [], D.stored_layers(spark, sf)
    for column in ("balance", "source_system", "status", "customer_id"):
        found = G.diagnose(layers | {"raw.loans": layers["raw.loans"].drop(column)}, CFG, column)
        parts.append(found.findings.filter("severity <> 'info'").select("run_id", "category", "transition", "table", "column"))
        found.close()
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# ---------------------------------------------------------------- sinks: written to a new root, read back

def _runs(spark) -> Runs:
    root = scratch_root(spark)
    return Runs(LayerStore(spark, root), History(spark, root), CFG)


def _sources(spark, sf) -> dict:
    return {name.split(".")[1]: df for name, df in D.raw_tables(spark, sf).items()}


@query
def landed_then_cleaned(spark, sf):
    """Loans landed, then cleaned from what landing wrote."""
    runs = _runs(spark)
    run = runs.start()
    runs.run_stage("extract", run, _sources(spark, sf), arrival={"loans": "loan_id", "customers": "customer_id"})
    runs.run_stage("staging", run)
    return runs.store.read("staging.loans")


@query
def run_state(spark, sf):
    """Rows per table of each layer that a run recorded."""
    runs = _runs(spark)
    runs.run_all(_sources(spark, sf), "none", "r1")
    state = H.current_runs(runs.history.of_run("run_events", "r1"))
    return state.selectExpr("run_id", "scenario", "finished_at >= started_at AS finished", "explode(row_counts) AS (layer, tables)").selectExpr(
        "run_id", "scenario", "finished", "layer", "explode(tables) AS (table, rows)")


@query
def layer_owner(spark, sf):
    """Who wrote each layer, after a second run has written the first layer again."""
    runs = _runs(spark)
    runs.run_all(_sources(spark, sf), "none", "r1")
    runs.run_stage("extract", runs.start(run_id="r2"), _sources(spark, sf))
    return H.layer_owners(runs.history.read("layer_writes")).select("layer", "run_id")


@query
def landed_files_in_order(spark, sf):
    """Files with the same keys, landed in two orders and two partitionings: of each key the first to arrive stays."""
    loans = D.raw_tables(spark, sf)["raw.loans"]
    again = loans.filter("cast(substr(loan_id, 2) AS bigint) % 5 = 0").selectExpr(
        *[c if c != "balance" else "balance + 1000 AS balance" for c in loans.columns])
    parts = []
    for label, arrivals, by in (("as_is", (loans, again), "loan_type"), ("turned", (again, loans), "loan_id")):
        root = scratch_root(spark)
        for df in arrivals:
            df.repartition(by, "customer_id").write.mode("append").parquet(f"{root}/arriving")
        store = LayerStore(spark, root)
        store.land("raw.loans", spark.read.parquet(f"{root}/arriving"))
        landed = store.read("raw.loans").repartition("origination_date")
        parts.append(L.clean_loans(landed).selectExpr(f"'{label}' AS arrival", "loan_id", "balance"))
    return parts[0].unionByName(parts[1])


def _supply_runs(spark, sf, run: str, edits=None) -> Runs:
    root = scratch_root(spark)
    runs = Runs(LayerStore(spark, root), History(spark, root), D.supply_config())
    runs.run_all(D.supply_sources(spark, sf), "none", run, edits)
    return runs


@query
def other_tables_run(spark, sf):
    """Rows per table after a run over nations, suppliers and shipments."""
    runs = _supply_runs(spark, sf, "supplies")
    return H.current_runs(runs.history.of_run("run_events", "supplies")).selectExpr("run_id", "explode(row_counts) AS (layer, tables)").selectExpr(
        "run_id", "layer", "explode(tables) AS (table, rows)")


@query
def other_tables_final(spark, sf):
    """The last table of that run."""
    return _supply_runs(spark, sf, "supplies").store.read("final.nation_revenue")


@query
def other_tables_findings(spark, sf):
    """What a diagnosis finds after every tenth supplier was lost in staging, with what explains it."""
    runs = _supply_runs(spark, sf, "lost_suppliers", {"staging.suppliers": lambda df: df.filter("cast(substr(supplier_id, 2) AS bigint) % 10 <> 3")})
    runs.diagnose().close()
    return runs.history.of_run("findings", "lost_suppliers").filter("severity <> 'info'").selectExpr(
        "run_id", "category", "transition", "table", "column", "expected", "actual", "evidence.unmatched_rows")


@query
def lost_customers_findings(spark, sf):
    """Every seventh customer lost in staging: the count of customers tells."""
    runs = _runs(spark)
    runs.run_all(_sources(spark, sf), "none", "lost_customers",
                 {"staging.customers": lambda df: df.filter("cast(customer_id AS bigint) % 7 <> 0")})
    runs.diagnose().close()
    return runs.history.of_run("findings", "lost_customers").filter("severity <> 'info'").select(
        "run_id", "check", "category", "transition", "table", "expected", "actual")


@query
def stored_profiles(spark, sf):
    """Profiles as a run stores them, distinct counts and all."""
    runs = _runs(spark)
    runs.run_all(_sources(spark, sf), "none", "r1")
    runs.diagnose("r1").close()
    return runs.history.of_run("layer_profiles", "r1").select("table", "column", "row_count", "null_count", "distinct_count", "duplicate_keys")


@query
def summary_in_order(spark, sf):
    """The portfolio summary as a reader shows it: largest balance first, with its place."""
    made = L.ordered_summary(L.portfolio_summary(D.layers(spark, sf)["final.loan_portfolio"]))
    return made.selectExpr("row_number() OVER (ORDER BY total_balance DESC, loan_type) AS place", "loan_type", "total_balance")


@query
def schema_scan(spark, sf):
    """Columns of each loan table by position, next to its rows."""
    layers = D.layers(spark, sf)
    parts = [P.schema_scan(layers[t]).selectExpr(f"'{t}' AS table", "position", "column", "dtype") for t in D.LOAN_TABLES.values()]
    return reduce(DataFrame.unionByName, parts).join(layer_row_counts(spark, sf), "table")


@query
def latest_run_flags(spark, sf):
    """Every run of the history, and whether it is the latest."""
    runs = W.runs(spark, sf)
    return H.latest_flags(runs).select("run_id", "is_latest")


NOTES_SQL = " UNION ALL ".join(f"""
SELECT event_type || '{sign}' || cast(user_id % 2 AS string) AS run_id,
  '## Summary' || chr(10) || cast(count(*) AS string) || '{sign}' || cast(min(event_id) AS string) AS markdown
FROM events GROUP BY event_type, user_id % 2""" for sign in ("/", "_"))


@query
def notes_stored(spark, sf):
    """Notes of runs whose ids look alike once cleaned, written, overwritten and read back."""
    history = History(spark, scratch_root(spark))
    D.table(spark, sf, "events").createOrReplaceTempView("events")
    ids = spark.sql(NOTES_SQL)
    history.write_markdown(ids.selectExpr("run_id", "'first' AS markdown"))
    history.write_markdown(ids.filter("run_id LIKE '%/%'"))
    history.write_markdown(ids.filter("run_id NOT LIKE '%/%'"))
    return history.notes(ids).selectExpr("run_id", "md5(cast(markdown AS binary)) AS markdown_md5")


@query
def recorded_truth(spark, sf):
    """What runs are on record to have broken, with the rows it touched."""
    runs = _runs(spark)
    for name, scenario, place, rows in (("r1", "type_change", "extract:loans", "source_system = 'CORE_BANKING'"), ("r2", "none", None, None)):
        hit = D.raw_tables(spark, sf)["raw.loans"].filter(rows).count() if rows else None
        run = runs.start(scenario, run_id=name)
        runs.run_stage("extract", run, _sources(spark, sf), truth={"scenario": scenario, "injected_at": place, "rows_affected": hit, "description": rows} if rows else None)
    return truth_frame(H.current_runs(runs.history.read("run_events")))


@query
def gate_in_plan(spark, sf):
    """The gate over the sound and over the failed part of a history, without a row per run for the driver."""
    status = G.run_status(W.findings(spark, sf), W.diagnosed(spark, sf))
    roots = G.root_causes(W.findings(spark, sf)).selectExpr(
        "run_id", "struct(category, transition, table, column, message) AS root_cause")
    diagnosed = status.join(roots, "run_id", "left")
    parts = []
    for label, rows in (("sound", diagnosed.filter("status = 'HEALTHY'")), ("all", diagnosed)):
        parts.append(G.gate_frame(rows, 3).selectExpr(f"'{label}' AS history", "failures", "array_join(first_failures, '; ') AS first_failures"))
    passed = G.gate(diagnosed.filter("status = 'HEALTHY'"))
    return spark.sql("SELECT *, CASE WHEN history = 'sound' THEN (SELECT status FROM {passed}) END AS status FROM {both}",
                     passed=passed, both=parts[0].unionByName(parts[1]))


@query
def mutate_null_hashed(spark, sf):
    """A third of the loans, by a hash of their key, lose their balance."""
    loans = D.raw_tables(spark, sf)["raw.loans"]
    return M.null_out(loans, "balance", M.hashed_share("loan_id", 35)).select("loan_id", "balance")


@query
def profiles_replaced(spark, sf):
    """Profiles of a run that were stored twice: the second replace the first."""
    history = History(spark, scratch_root(spark))
    made = P.profile_tables([("raw.loans", D.raw_tables(spark, sf)["raw.loans"], ("loan_id",))]).selectExpr(
        "'r1' AS run_id", "'raw' AS layer", "*")
    history.replace_run("layer_profiles", made.selectExpr(*[c if c != "row_count" else "0L AS row_count" for c in made.columns]))
    history.replace_run("layer_profiles", made)
    return history.of_run("layer_profiles", "r1").drop("run_id", "layer")


@query
def report_roundtrip(spark, sf):
    """A diagnosis stored as JSON and rebuilt from it."""
    runs = _runs(spark)
    runs.run_all(_sources(spark, sf), "null_spike", "null_spike",
                 {"raw.customers": lambda df: M.null_out(df, "credit_score", D.THIRD_OF_CUSTOMERS)})
    runs.diagnose().close()
    rebuilt = H.load_report(runs.history.of_run("diagnoses", "null_spike"))
    return _diagnosis_columns(rebuilt)


@query
def gate_summary(spark, sf):
    """What a scheduler sees of each scenario, and whether the gate stops it."""
    parts = []
    for scenario in ("clean", "null_spike"):
        report = _diagnosis(spark, sf, scenario).report()
        try:
            G.quality_gate(report)
            stopped = False
        except G.DataQualityError:
            stopped = True
        parts.append(G.summary(report).selectExpr("run_id", "status", "category", "transition", "table", "column", "symptoms", f"{stopped} AS stopped"))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- run history

@query
def ranked_findings(spark, sf):
    return G.rank_failures(W.findings(spark, sf)).select(
        "run_id", "rank", "role", "category", "transition", "table", "item_idx")


@query
def root_causes(spark, sf):
    return G.root_causes(W.findings(spark, sf)).select("run_id", "category", "transition", "table", "column", "message")


@query
def check_verdicts(spark, sf):
    return G.verdicts(W.findings(spark, sf), W.runs(spark, sf)).select("run_id", "verdict", "result")


@query
def run_status(spark, sf):
    return G.run_status(W.findings(spark, sf), W.runs(spark, sf))


@query
def diagnosis_scores(spark, sf):
    return G.evaluate(W.runs(spark, sf), G.root_causes(W.findings(spark, sf)), W.truth(spark, sf))


@query
def scores_by_scenario(spark, sf):
    return diagnosis_scores(spark, sf).groupBy("scenario").agg(*exprs(
        "count(*) AS runs", "round(avg(cast(correct AS int)), 4) AS accuracy"))


def _diagnoses(spark, sf):
    found = W.findings(spark, sf)
    status = G.run_status(found, W.diagnosed(spark, sf))
    roots = G.root_causes(found).selectExpr("run_id", "category AS root_cause")
    return status.join(roots, "run_id", "left").select("run_id", "status", "root_cause")


@query
def recent_runs(spark, sf):
    """The last 20 diagnosed runs; the limit is the feature."""
    return H.recent_runs(W.runs(spark, sf), _diagnoses(spark, sf))


@query
def latest_run(spark, sf):
    return H.latest_run(W.runs(spark, sf))


@query
def run_audit(spark, sf):
    audited = H.audit_runs(W.runs(spark, sf), _diagnoses(spark, sf), W.reports(spark, sf), W.gates(spark, sf))
    return audited.selectExpr("run_id", "scenario", "status", "report_by", "gate_failed",
                              "array_join(problems, '; ') AS problems")


@query
def layer_flow(spark, sf):
    return H.layer_flow(W.profiles(spark, sf), W.findings(spark, sf), D.LOAN_TABLES)


@query
def impact_by_run(spark, sf):
    return G.impact(W.profiles(spark, sf))


@query
def truth_and_diagnosis(spark, sf):
    runs, truth = W.runs(spark, sf), W.truth(spark, sf)
    return H.truth_view(runs, G.evaluate(runs, G.root_causes(W.findings(spark, sf)), truth), truth)


# ---------------------------------------------------------------- reports

DRAFTS_SQL = """
SELECT 'doc' || cast(doc_id AS string) AS run_id, 'writer' AS author, cast(n_chars AS double) / 1000 AS seconds,
  CASE doc_id % 5
    WHEN 0 THEN '  ' || text
    WHEN 1 THEN 'Sure, here it is.' || chr(10) || '## Summary' || chr(10) || 'staging.LOANS lost the zeros of customer_id. '
      || chr(10) || '## root cause' || chr(10) || text || chr(10)
    WHEN 2 THEN '```markdown' || chr(10) || '## Summary' || chr(10) || text || ' loans balance' || chr(10) || '```' || chr(10)
    WHEN 3 THEN '## Summary' || chr(10) || text || ' Final.Loan_Portfolio'
    ELSE '## Summary' || chr(10) || '## Where it broke' || chr(10) || '## Root cause' || chr(10) || text || ' customers'
      || chr(10) || '## Downstream impact' || chr(10) || '## Recommended fix' || chr(10) END AS text
FROM documents
"""
DRAFT_ROOTS_SQL = """
SELECT 'doc' || cast(doc_id AS string) AS run_id,
  CASE doc_id % 5 WHEN 1 THEN 'staging.loans' WHEN 2 THEN 'raw.loans' WHEN 3 THEN 'final.loan_portfolio'
    WHEN 4 THEN 'raw.customers' ELSE 'raw.loans' END AS "table",
  CASE doc_id % 5 WHEN 1 THEN 'customer_id' WHEN 2 THEN 'balance' WHEN 4 THEN 'credit_score' WHEN 0 THEN 'balance' END
    AS "column"
FROM documents
"""


def _judged(spark, sf):
    D.table(spark, sf, "documents").createOrReplaceTempView("documents")
    return N.judge_drafts(spark.sql(DRAFTS_SQL), spark.sql(DRAFT_ROOTS_SQL.replace('"', "`")))


@query
def grounding(spark, sf):
    """Whole drafts checked for the names of what broke."""
    return _judged(spark, sf).selectExpr("run_id", "grounded", "md5(cast(draft AS binary)) AS draft_md5")


@query
def fill_sections(spark, sf):
    return _judged(spark, sf).selectExpr("run_id", "size(missing) AS missing_count",
                                         "array_join(missing, ', ') AS missing")


NOTE_DRAFTS_SQL = f"""
SELECT run_id, 'writer' AS author, cast(1.5 AS double) AS seconds,
  '## Summary' || chr(10) || cast(count(*) AS string) || ' errors hit loans balance' AS text
FROM (SELECT *, {W.RUN_ID} AS run_id FROM events) e WHERE event_type = 'error' GROUP BY run_id
"""


def _notes(spark, sf):
    runs, found = W.runs(spark, sf), W.findings(spark, sf)
    return N.render_reports(runs, found, local_frame(spark, [], SEGMENT_DDL), spark.sql(NOTE_DRAFTS_SQL))


@query
def report_sources(spark, sf):
    """Which runs get their draft, which the template, and why."""
    return _notes(spark, sf).select("run_id", "status", "source", "author", "grounded", "note")


@query
def report_markdown(spark, sf):
    """Incident notes of every run in the history."""
    return _notes(spark, sf).select("run_id", "status", "source", "markdown")


@query
def scenario_report(spark, sf):
    """The full note of the key fault, with segments and evidence."""
    d = G.diagnose(D.stored_layers(spark, sf, "dropped_join_key"), CFG, "dropped_join_key")
    top = d.top_segments()
    d.close()
    return N.render_reports(d.profiles, d.findings, top).select("run_id", "status", "note", "markdown")


@query
def fact_sheets(spark, sf):
    runs, found = W.runs(spark, sf), W.findings(spark, sf)
    return N.fact_sheets(runs, found, W.profiles(spark, sf), local_frame(spark, [], SEGMENT_DDL),
                         G.verdicts(found, runs))
