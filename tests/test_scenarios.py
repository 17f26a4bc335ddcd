"""Break the layers in a known way, diagnose them, and compare with what was broken."""

from functools import reduce

import pytest
from strataudit.operators import layers as L
from strataudit.operators import mutations as M
from strataudit.plans import diagnosis as G
from workload import domain as D

CFG = D.config()
COLUMNS = ["category", "transition", "table", "column"]


def ranked(d):
    return [tuple(r[c] for c in COLUMNS) for r in d.ranked().orderBy("rank").collect()]


EXPECTED = {
    "clean": [],
    "type_change": [("SCHEMA_DRIFT", "source->raw", "raw.loans", "balance"),
                    ("NULL_SPIKE", "raw->staging", "staging.loans", "balance"),
                    ("MEASURE_DRIFT", "raw->staging", "staging.loans", "balance")],
    "null_spike": [("NULL_SPIKE", "source->raw", "raw.customers", "credit_score"),
                   ("DISTRIBUTION_SHIFT", "staging->final", "final.loan_portfolio", "risk_band")],
    "dropped_join_key": [("JOIN_KEY_MISMATCH", "raw->staging", "staging.loans", "customer_id"),
                         ("ROW_LOSS", "staging->final", "final.loan_portfolio", None),
                         ("MEASURE_DRIFT", "staging->final", "final.loan_portfolio", "balance")],
    "duplicate_rows": [("DUPLICATE_ROWS", "raw->staging", "staging.loans", "loan_id"),
                       ("ROW_INFLATION", "raw->staging", "staging.loans", None),
                       ("MEASURE_DRIFT", "raw->staging", "staging.loans", "balance")],
}


@pytest.fixture(scope="module")
def diagnosed(spark, sf_mid):
    cache = {}

    def get(scenario):
        if scenario not in cache:
            cache[scenario] = G.diagnose(D.stored_layers(spark, sf_mid, scenario), CFG, scenario).close()
        return cache[scenario]

    return get


@pytest.mark.parametrize("scenario", D.SCENARIOS)
def test_root_and_symptoms(diagnosed, scenario):
    assert ranked(diagnosed(scenario)) == EXPECTED[scenario]


def evidence(d, category):
    return d.findings.filter(f"category = '{category}'").first()


def test_clean_run_reports_only_the_expected_change(diagnosed):
    [f] = diagnosed("clean").findings.collect()
    assert f.severity == "info" and "450 WITHDRAWN" in f.message


def test_type_change_evidence(diagnosed):
    f = evidence(diagnosed("type_change"), "SCHEMA_DRIFT")
    assert f.evidence.non_numeric_rows == 9026
    assert f.evidence.affected_segment == "source_system = 'CORE_BANKING'" and "currency" in f.evidence.pattern
    n = evidence(diagnosed("type_change"), "NULL_SPIKE")
    assert n.evidence.null_rows == 8761 and n.evidence.upstream_dtype == "VARCHAR"
    assert n.evidence.persists_in == ["final.loan_portfolio"]
    assert evidence(diagnosed("type_change"), "MEASURE_DRIFT").evidence.delta == -2193264807.49


def test_null_spike_evidence(diagnosed):
    f = evidence(diagnosed("null_spike"), "NULL_SPIKE")
    assert f.evidence.null_rows == 525
    assert f.evidence.persists_in == ["staging.customers", "final.loan_portfolio"]
    s = evidence(diagnosed("null_spike"), "DISTRIBUTION_SHIFT")
    assert s.evidence.unknown_rows == s.evidence.unknown_with_null_credit_score == 5077


def test_dropped_key_evidence(diagnosed):
    d = diagnosed("dropped_join_key")
    f = evidence(d, "JOIN_KEY_MISMATCH")
    assert f.evidence.changed_rows == f.evidence.rows_now_unmatched_in_customers == 2900
    assert "leading zeros" in f.evidence.pattern
    loss = evidence(d, "ROW_LOSS")
    assert loss.evidence.unmatched_rows == int(loss.expected) - int(loss.actual) == 2900
    assert loss.evidence.match_if_zero_padded == 2900
    assert loss.evidence.loan_types_missing_from_final == ["CREDIT_CARD"]
    assert [r.value for r in d.finding_values.collect()] == ["CREDIT_CARD"]
    worst = d.segments.filter("verdict = 'measures'").orderBy("magnitude", ascending=False).first()
    assert worst.segment == "CARD_PLATFORM" and worst.actual == 0


def test_duplicates_are_reported_once(diagnosed):
    d = diagnosed("duplicate_rows")
    [f] = d.findings.filter("category = 'DUPLICATE_ROWS'").collect()
    assert f.evidence.exact_copies == int(f.actual) == 2233
    assert f.evidence.persists_in == ["final.loan_portfolio"]
    assert f.evidence.origination_date_range == ["2000-08-01", "2001-08-01"]


def test_scores(spark, diagnosed):
    places = {"type_change": "extract:loans", "null_spike": "extract:customers", "dropped_join_key": "staging:loans",
              "duplicate_rows": "staging:loans"}
    found = reduce(lambda a, b: a.unionByName(b), [diagnosed(s).findings for s in D.SCENARIOS])
    runs = spark.createDataFrame([(s,) for s in D.SCENARIOS], "run_id string")
    truth = spark.createDataFrame([(s, s, p) for s, p in places.items()],
                                  "run_id string, scenario string, injected_at string")
    scores = G.evaluate(runs, G.root_causes(found), truth).collect()
    assert len(scores) == 5 and all(r.correct for r in scores)
    swapped = spark.createDataFrame([("clean", "null_spike", "extract:customers")],
                                    "run_id string, scenario string, injected_at string")
    wrong = {r.run_id: r.correct for r in G.evaluate(runs, G.root_causes(found), swapped).collect()}
    assert wrong["clean"] is False and wrong["type_change"] is False


def test_report_and_gate(diagnosed):
    report = diagnosed("dropped_join_key").report()
    row = report.first()
    assert row.status == "FAILED" and row.symptom_count == 2 and row.checks["key_integrity"] == "FAIL"
    assert row.checks["schema"] == "PASS" and len(row.checks) == 7
    assert row.impact.final_loan_rows == 11650 and row.layers["raw.loans"].rows == 15000
    with pytest.raises(G.DataQualityError, match="JOIN_KEY_MISMATCH raw->staging"):
        G.quality_gate(report)
    assert G.quality_gate(diagnosed("clean").report()) == "HEALTHY"
    assert G.summary(report).first().symptoms == 2


def both(spark, sf, first, second):
    raw = D.raw_tables(spark, sf, first)
    staged = D.staged_tables(raw, second)
    return raw | staged | {"final.loan_portfolio": L.loan_portfolio(staged["staging.loans"], staged["staging.customers"])}


def test_two_faults_type_and_key(spark, sf_small):
    d = G.diagnose(both(spark, sf_small, "type_change", "dropped_join_key"), CFG, "two")
    got = ranked(d)
    assert got[0] == ("SCHEMA_DRIFT", "source->raw", "raw.loans", "balance")
    assert got[1] == ("JOIN_KEY_MISMATCH", "raw->staging", "staging.loans", "customer_id")
    assert {g[0] for g in got[2:]} == {"NULL_SPIKE", "MEASURE_DRIFT", "ROW_LOSS"}
    d.close()


def test_two_faults_nulls_and_duplicates(spark, sf_small):
    d = G.diagnose(both(spark, sf_small, "null_spike", "duplicate_rows"), CFG, "two")
    got = ranked(d)
    assert got[0][0] == "NULL_SPIKE" and got[1][0] == "DUPLICATE_ROWS"
    assert [g[0] for g in got].count("NULL_SPIKE") == 1
    d.close()


@pytest.mark.parametrize("partitions", [1, 37])
def test_findings_do_not_depend_on_partitioning(spark, sf_small, partitions):
    def found(layers):
        d = G.diagnose(layers, CFG, "x").close()
        return sorted(map(str, d.findings.collect()))

    layers = D.layers(spark, sf_small, "dropped_join_key")
    shuffled = {n: df.repartition(partitions) for n, df in layers.items()}
    assert found(layers) == found(shuffled)


def test_hashed_mutations_do_not_depend_on_partitioning(spark, sf_small):
    loans = D.raw_tables(spark, sf_small)["raw.loans"]
    for edit in (lambda d: M.null_out(d, "balance", M.hashed_share("loan_id", 35)),
                 lambda d: M.messy_case(d, "status", M.hashed_share("loan_id", 10), M.hashed_share("loan_id", 5, 43))):
        a, b = edit(loans), edit(loans.repartition(13))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    share = M.null_out(loans, "balance", M.hashed_share("loan_id", 35)).filter("balance IS NULL").count() / loans.count()
    assert 0.25 < share < 0.45


def test_approximate_profile_keeps_exact_keys(spark, sf_small):
    from strataudit.operators.profile import profile_layers
    layers = D.layers(spark, sf_small, "duplicate_rows")
    exact = {(r.table, r.column): r for r in profile_layers(layers, CFG).collect()}
    for r in profile_layers(layers, CFG, distinct="approx").collect():
        e = exact[r.table, r.column]
        assert (r.row_count, r.null_count, r.duplicate_keys, r.min_value, r.max_value, r.min_text) == \
            (e.row_count, e.null_count, e.duplicate_keys, e.min_value, e.max_value, e.min_text)
        assert abs(r.distinct_count - e.distinct_count) <= max(2, 0.15 * e.distinct_count)


@pytest.mark.parametrize("scenario", ["duplicate_rows", "dropped_join_key"])
def test_segments_without_evidence(spark, sf_small, scenario):
    """Who wants only segments and values gets the same ones without the evidence being looked up."""
    layers = D.stored_layers(spark, sf_small, scenario)
    full, lean = G.diagnose(layers, CFG, scenario), G.diagnose(layers, CFG, scenario, evidence=False)
    for part in ("segments", "finding_values"):
        assert sorted(map(str, getattr(lean, part).collect())) == sorted(map(str, getattr(full, part).collect()))
    assert lean.segments.count() > 0 and ranked(lean) == ranked(full)
    if scenario == "duplicate_rows":
        assert len(lean.kept) < len(full.kept)  # the rows of the table are not counted by their fingerprints
    full.close(), lean.close()
