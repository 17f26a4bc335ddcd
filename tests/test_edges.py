"""Rows that engines disagree about: missing keys, odd whitespace, odd numerals, hot keys, empty tables."""

from itertools import product

import pytest
from strataudit.config import INGEST_SEQ, DistinctRule, Exclusion, loan_config
from strataudit.functions import currency_to_double, strip, to_double, to_long
from strataudit.operators import evidence as E
from strataudit.operators import layers as L
from strataudit.operators import profile as P
from strataudit.operators import reconcile as R
from strataudit.plans.checks import Checks
from pyspark.sql import types as T

TEXT = T.StringType()
CFG = loan_config()
MEASURE = CFG.measure_rules[0]


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [r.x for r in df.selectExpr("i", f"{expression} AS x").orderBy("i").collect()]


def test_numbers(spark):
    texts = ["1d", "1_000", " 1.5 ", "$1,234.50", "nan", "1e3", "", None, "-.5", "0x10", "infinity"]
    assert values(spark, texts, to_double("v", TEXT)) == [None, None, 1.5, None, None, 1000.0, None, None, -0.5, None, None]
    assert values(spark, ["$1,234.50", "12", None, "abc"], currency_to_double("v", TEXT)) == [1234.5, 12.0, None, None]
    assert values(spark, ["720.0", "720.5", " 7 ", "9007199254740993", "x"], to_long("v", TEXT)) == \
        [720, None, 7, 9007199254740993, None]


def test_strip_takes_every_whitespace(spark):
    assert values(spark, ["\ta b\n", " x ", "\x0b\fy\r", None], strip("v")) == ["a b", "x", "y", None]


def loans(spark, rows):
    """(loan_id, customer_id, source_system, balance, status)"""
    return spark.createDataFrame(rows, "loan_id string, customer_id string, source_system string, balance double, status string")


def test_missing_status_is_kept_on_every_side(spark):
    df = loans(spark, [("L1", "1", "A", 1.0, None), ("L2", "1", "A", 2.0, " withdrawn\t"), ("L3", "1", "A", 3.0, "CURRENT")])
    assert sorted(r.loan_id for r in L.clean_loans(df).collect()) == ["L1", "L3"]
    rule = DistinctRule("raw.loans", "staging.loans", "loan_id", "raw->staging", "loans",
                        exclusion=Exclusion("status", ("WITHDRAWN",)))
    row = R.expected_keys(df, rule).first()
    assert (row.source_rows, row.expected_rows, row.excluded_keys, row.surplus_keys) == (3, 2, 1, 0)
    totals = R.one_value_per_key(df, MEASURE, "source_system").agg({"amount": "sum"}).first()[0]
    assert totals == 4.0


def test_missing_keys_stay_missing(spark):
    df = loans(spark, [("L1", None, "A", 1.0, "X"), ("L2", "  ", "A", 1.0, "X"), ("L3", "\t7", "A", 1.0, "X")])
    got = {r.loan_id: r.customer_id for r in L.clean_loans(df).collect()}
    assert got == {"L1": None, "L2": "", "L3": "7"}
    reference = spark.createDataFrame([("7",), (None,)], "customer_id string")
    assert sorted(r.loan_id for r in E.orphan_rows(L.clean_loans(df), reference, "customer_id").collect()) == ["L1", "L2"]


def test_first_arrival_wins(spark):
    rows = [(i, "L1", f"c{9 - i}", float(i)) for i in range(5)] + [(9, "L2", "x", 9.0)]
    df = spark.createDataFrame(rows, f"{INGEST_SEQ} long, loan_id string, customer_id string, balance double")
    got = {r.loan_id: r.balance for r in L.first_per_key(df.repartition(7), ["loan_id"]).collect()}
    assert got == {"L1": 0.0, "L2": 9.0}
    assert "WindowGroupLimit" in L.first_per_key(df, ["loan_id"])._jdf.queryExecution().executedPlan().toString()


def test_hot_key_keeps_one_row(spark):
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS loan_id",
                                       f"id AS {INGEST_SEQ}")
    assert L.first_per_key(df, ["loan_id"]).count() == 20001


def test_duplicate_counts(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), ("b", None, "z"), ("b", None, "z"), (None, 2, "w")],
                               "k string, n int, v string")
    assert df.selectExpr(P.surplus_keys(["k"])).first()[0] == 4  # the row without a key counts as surplus
    assert df.selectExpr(P.surplus_keys(["k", "n"])).first()[0] == 3
    assert E.exact_copies(df, ["k", "n"]).first().exact_copies == 2
    assert E.exact_copies(df, ["k"]).first().exact_copies == 2
    [p] = {r.duplicate_keys for r in P.profile_tables([("t", df, ("k", "n"))]).collect()}
    assert p == 3
    assert {r.segment: r.extra_rows for r in E.surplus_by_segment(df, ["k"], "k").collect()} == {"a": 2, "b": 1, None: 1}
    counted = E.counted_rows(df, ["k"], "k")
    assert {r.segment: r.extra_rows for r in E.surplus_among(counted, ["k"]).collect()} == {"a": 2, "b": 1, None: 1}
    assert E.repeated_among(counted, ["k"]).count() == 2
    assert E.exact_copies(df.limit(0), ["k"]).first().exact_copies == 0


def test_fingerprints_tell_missing_values_apart(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", "x", None), ("a", None, None), ("a", None, None), ("a", "", None), ("a", None, "")],
                               "k string, v string, w string")
    assert E.exact_copies(df, ["k"]).first().exact_copies == 1


def test_profile_of_every_type(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1Y, 1.5BD, DATE'2020-01-02', TIMESTAMP'2020-01-02 03:04:05', X'01', array(1), true, double('NaN'), 'a'),
        (2Y, 2.5BD, NULL, NULL, NULL, NULL, false, 1.0D, 'a'),
        (2Y, NULL, DATE'2019-01-02', TIMESTAMP'2019-01-02 03:04:05', X'01', array(2), NULL, NULL, NULL)
        AS t(i, d, dt, ts, b, arr, flag, x, s)""")
    p = {r.column: r for r in P.profile_tables([("t", df, ("s",))]).collect()}
    assert (p["i"].min_value, p["i"].max_value, p["i"].sum_value, p["i"].distinct_count) == (1.0, 2.0, 5.0, 2)
    assert (p["d"].null_count, p["d"].sum_value, p["d"].dtype) == (1, 4.0, "DECIMAL(2,1)")
    assert (p["dt"].min_text, p["ts"].max_text) == ("2019-01-02", "2020-01-02 03:04:05")
    assert (p["b"].distinct_count, p["arr"].distinct_count, p["flag"].distinct_count) == (1, 2, 2)
    assert p["x"].max_value is None and p["x"].distinct_count == 2
    assert {r.duplicate_keys for r in p.values()} == {2}


def test_empty_table(spark):
    df = spark.createDataFrame([], "loan_id string, balance double, d date")
    rows = P.profile_tables([("t", df, ("loan_id",))]).collect()
    assert [(r.row_count, r.null_pct, r.sum_value, r.duplicate_keys) for r in rows] == [(0, 0.0, None, 0)] * 3
    assert R.category_share(spark.createDataFrame([], "risk_band string, credit_score long"),
                            CFG.distribution_rules[0]).first().share_pct == 0.0


def test_measures_on_one_side_only(spark):
    raw = loans(spark, [("L1", "1", "A", 10.0, "X"), ("L2", "1", "B", None, "X"), ("L3", "1", None, 5.0, "X")])
    staged = loans(spark, [("L1", "1", "A", 10.0, "X"), ("L9", "1", "C", 7.0, "X")])
    totals = R.segment_totals({"raw.loans": raw, "staging.loans": staged, "final.loan_portfolio": staged}, MEASURE, "source_system")
    got = {r.segment: (r.expected, r.actual, r.delta) for r in R.measure_steps(totals, MEASURE).collect() if r.table == "staging.loans"}
    assert got == {"A": (10.0, 10.0, 0.0), "B": (0.0, 0.0, 0.0), None: (5.0, 0.0, -5.0), "C": (0.0, 7.0, 7.0)}


def test_expected_total_of_zero_is_no_drift(spark):
    raw = loans(spark, [("L1", "1", "A", 0.0, "X")])
    staged = loans(spark, [("L1", "1", "A", 7.0, "X")])
    totals = R.segment_totals({"raw.loans": raw, "staging.loans": staged, "final.loan_portfolio": staged}, MEASURE, "source_system")
    first = R.measure_drift(totals, MEASURE).filter("step = 0").first()
    assert (first.expected_total, first.actual_total, first.drift_pct) == (0.0, 7.0, 0.0)


KEY_SETS = [[], ["007"], ["007", "7"], ["07", "7", "0071", "8"], ["", "0"], ["000", "00", "0"], [None, "7"]]


def test_changed_keys_against_all_pairs(spark):
    """Counting without pairing gives what pairing gives, for one and for many keys per row."""
    cases = list(product(KEY_SETS, KEY_SETS))
    before = [(f"r{i}", k, s) for i, (a, _) in enumerate(cases) for k in a for s in ("A", None)]
    after = [(f"r{i}", k) for i, (_, b) in enumerate(cases) for k in b]
    want = {}
    for i, (a, b) in enumerate(cases):
        for x, s, y in product(set(a), ("A", None), set(b)):
            if x is not None and y is not None and x != y:
                padded = y.rjust(len(x), "0")[: len(x)] == x
                n, z = want.get((f"r{i}", s), (0, 0))
                want[f"r{i}", s] = (n + 1, z + padded)
    b_df = spark.createDataFrame(before * 2, "loan_id string, customer_id string, source_system string")
    a_df = spark.createDataFrame(after * 2, "loan_id string, customer_id string")
    got = E.changed_keys(b_df, a_df, "loan_id", "customer_id", "source_system").groupBy("row_key", "segment").agg(
        {"changed": "sum", "padded": "sum"}).filter("`sum(changed)` > 0")
    assert {(r.row_key, r.segment): (r["sum(changed)"], r["sum(padded)"]) for r in got.collect()} == want


def test_sole_segment_is_strict(spark):
    df = spark.createDataFrame([("A", 1), ("A", None), ("B", 2)], "source_system string, v int")
    one = E.segment_counts(df, "source_system", {"v": "v IS NULL"})
    assert one.selectExpr(E.sole_segment("affected", "source_system")).first()[0] == "source_system = 'A'"
    two = E.segment_counts(df, "source_system", {"v": "true"})
    assert two.selectExpr(E.sole_segment("affected", "source_system")).first()[0] is None


def profiles(spark, rows):
    """(table, column, dtype, row_count, null_count, null_pct, duplicate_keys)"""
    return spark.createDataFrame([("r", t.split(".")[0], *rest) for t, *rest in [(r[0], r) for r in rows] for rest in [rest[0]]],
                                 "run_id string, layer string, table string, column string, dtype string, row_count long, "
                                 "null_count long, null_pct double, duplicate_keys long")


def test_missing_and_renamed_columns(spark):
    """A change of case is a missing column, and nothing else is reported for it."""
    rows = [("raw.customers", f.name if f.name != "state" else "STATE", "VARCHAR" if f.dataType == TEXT else
             {"bigint": "BIGINT", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}[f.dataType.simpleString()], 10, 0, 0.0, 0)
            for f in CFG.contract("raw.customers").schema.fields]
    found = Checks(spark, CFG, profiles(spark, rows)).schema().collect()
    assert [(f.table, f.column, f.actual, f.message) for f in found] == [
        ("raw.customers", "state", None, "raw.customers.state is missing")]


def test_nulls_are_inherited_per_column(spark):
    """Nulls of a column fed by customers must not hide nulls of a column fed by loans, and the other way round."""
    rows = [("raw.customers", "credit_score", "BIGINT", 100, 35, 35.0, 0),
            ("staging.customers", "credit_score", "BIGINT", 100, 35, 35.0, 0),
            ("raw.loans", "balance", "DOUBLE", 100, 0, 0.0, 0), ("staging.loans", "balance", "DOUBLE", 100, 1, 1.0, 0),
            ("final.loan_portfolio", "credit_score", "BIGINT", 100, 34, 34.0, 0),
            ("final.loan_portfolio", "balance", "DOUBLE", 100, 2, 2.0, 0)]
    found = Checks(spark, CFG, profiles(spark, rows)).nulls().collect()
    got = {(f.table, f.column): (f.severity, f.evidence.persists_in) for f in found}
    assert got == {("raw.customers", "credit_score"): ("critical", ["staging.customers", "final.loan_portfolio"]),
                   ("final.loan_portfolio", "balance"): ("warning", [])}


def test_inherited_duplicates_are_not_reported_again(spark):
    rows = [("raw.loans", "loan_id", "VARCHAR", 100, 0, 0.0, 5), ("staging.loans", "loan_id", "VARCHAR", 100, 0, 0.0, 5),
            ("final.loan_portfolio", "loan_id", "VARCHAR", 100, 0, 0.0, 8)]
    found = {f.table: f for f in Checks(spark, CFG, profiles(spark, rows)).uniqueness().collect()}
    assert set(found) == {"raw.loans", "final.loan_portfolio"}
    assert found["final.loan_portfolio"].message == "final.loan_portfolio has 3 more duplicate loan_id rows than upstream"
    assert found["raw.loans"].evidence.persists_in == ["staging.loans", "final.loan_portfolio"]


def test_lineage():
    assert CFG.upstream("final.loan_portfolio", "state") == "staging.customers"
    assert CFG.upstream("final.loan_portfolio", "balance") == "staging.loans"
    assert CFG.upstream("raw.loans", "balance") is None
    assert CFG.downstream("raw.customers") == ["staging.customers", "final.loan_portfolio"]
    assert CFG.downstream("final.loan_portfolio") == []


@pytest.mark.parametrize("text, rows", [("TIMESTAMP", "timestamp"), ("TIMESTAMP", "timestamp_ntz"), ("DECIMAL(10,2)", "decimal(10,2)")])
def test_logical_types(spark, text, rows):
    df = spark.createDataFrame([], f"c {rows}")
    assert P.schema_scan(df).first().dtype == text
