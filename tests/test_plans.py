"""What must hold for the plans, whatever the size of the tables."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F
from strataudit.operators import evidence as E
from strataudit.operators import profile as P
from workload import domain as D
from workload.queries import QUERIES

ROOT = pathlib.Path(__file__).parent.parent
# their plans only exist once a diagnosis has run
DIAGNOSED = {n for n in QUERIES if n.startswith(("findings_", "diagnosis_"))} | {
    "finding_evidence", "finding_segments", "schema_drift", "scenario_report"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - DIAGNOSED))
def test_no_products_and_no_python(spark, sf_small, name):
    text = plan(QUERIES[name](spark, sf_small))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert bad not in text


def test_profile_reads_each_column_once(spark, sf_small):
    lines = D.table(spark, sf_small, "lineitem")
    text = plan(P.profile_tables([("lineitem", lines, ("l_returnflag",))]))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    read = [c.split(":")[0] for s in schemas for c in s.split(",")]
    assert sorted(read) == sorted(lines.columns) and len(schemas) <= len(P.FAMILIES)


def test_column_pruning(spark, sf_small):
    text = plan(E.surplus_by_segment(D.table(spark, sf_small, "lineitem"), ("l_orderkey",), "l_returnflag"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def test_expected_filters_reach_the_scan(spark, sf_small):
    from strataudit.config import Exclusion
    from strataudit.operators.layers import keep_unexcluded
    lines = D.table(spark, sf_small, "lineitem")
    text = plan(keep_unexcluded(lines, Exclusion("l_returnflag", ("A",))))
    assert "PushedFilters: [Or(IsNull(l_returnflag),Not(EqualTo(l_returnflag,A)))]" in text


def test_small_sides_are_recognised_without_hints(spark):
    for source in (ROOT / "strataudit").rglob("*.py"):
        text = source.read_text()
        assert "localCheckpoint" not in text and "crossJoin" not in text
        # The text operators send models and sets of stated size to the workers; the audit has none.
        assert "broadcast(" not in text or source.parent.name == "llm"


def test_repeated_rows_take_one_exchange(spark, sf_small):
    lines = D.table(spark, sf_small, "lineitem")
    keys = ("l_orderkey", "l_linenumber")
    counted = E.counted_rows(lines, keys, "l_returnflag", "l_shipdate")
    text = plan(counted)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    # narrow rows, counted before they move: two hashes stand for all columns
    assert "partial_count" in text[text.index("Exchange"):] and "l_comment" not in text[:text.index("Exchange")]
    counted = counted.persist()
    try:
        for figures in (E.copies_among(counted), E.duplicate_span(E.repeated_among(counted, keys)), E.surplus_among(counted, keys)):
            above = plan(figures).split("InMemoryRelation")
            assert len(above) == 2 and "FileScan" not in above[0]
    finally:
        counted.unpersist()


@pytest.fixture(params=["10MB", "-1"])
def broadcast_up_to(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_orphans_are_counted_before_rows_move(spark, sf_small, broadcast_up_to):
    """A key that holds a third of the rows leaves each task as one row, or does not leave it at all."""
    loans = D.table(spark, sf_small, "lineitem").selectExpr("if(l_orderkey % 3 = 0, -7, l_suppkey) AS s_suppkey", "l_returnflag")
    supplier = D.table(spark, sf_small, "supplier").filter("s_suppkey % 10 <> 3")
    orphans = E.orphan_keys(loans, supplier, "s_suppkey", "l_returnflag")
    text = plan(orphans)
    at = text.index("FileScan parquet [l_orderkey")
    last_exchange = text.rindex("Exchange hashpartitioning", 0, at)
    assert "partial_count" in text[last_exchange:at]
    assert ("SortMergeJoin" in text) == (broadcast_up_to == "-1")
    known = {r[0] for r in supplier.select("s_suppkey").collect()}
    wanted = {}
    for r in loans.collect():
        if r[0] not in known:
            wanted[tuple(r)] = wanted.get(tuple(r), 0) + 1
    assert {(r[0], r[1]): r[2] for r in orphans.collect()} == wanted and any(k[0] == -7 for k in wanted)


@pytest.mark.parametrize("scenario", ["dropped_join_key", "duplicate_rows"])
def test_a_diagnosis_joins_and_counts_once(spark, sf_small, broadcast_up_to, monkeypatch, scenario):
    from strataudit.plans import diagnosis as G
    from workload.queries import CFG
    calls = []
    for f in ("changed_keys", "orphan_keys", "counted_rows"):
        def counting(*given, _real=getattr(E, f), _name=f, **more):
            calls.append((_name, *(x for x in given[2:] if isinstance(x, str))))
            return _real(*given, **more)
        monkeypatch.setattr(E, f, counting)
    layers = D.stored_layers(spark, sf_small, scenario)
    found = G.diagnose(layers, CFG, scenario)
    try:
        assert len(calls) == len(set(calls)) and any(c[0] != "changed_keys" for c in calls)
        for name in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
            assert name not in plan(found.segments)
        hot = layers["staging.loans"].withColumn("loan_id", F.expr("if(hash(loan_id) % 3 = 0, 'L1', loan_id)"))
        per_key = hot.groupBy("loan_id").count().filter("count > 1")
        assert E.duplicate_span(E.repeated_among(E.counted_rows(hot, ["loan_id"]), ["loan_id"])).first()[0] == per_key.count()
        rows = hot.drop(*E.TECHNICAL_COLUMNS)
        assert E.exact_copies(hot, ["loan_id"]).first()[0] == rows.count() - rows.distinct().count()
    finally:
        found.close()


def test_surplus_keys_are_dealt_to_a_fixed_number_of_tasks(spark):
    """Adaptive execution does not draw tasks that hold a row per key together; a key's rows go to several of them first."""
    rows = spark.range(5_000).selectExpr("if(id % 3 = 0, 7, id) AS k", "if(id % 2 = 0, 'a', 'b') AS s")
    found = E.surplus_by_segment(rows, ("k",), "s")
    text = plan(found)
    assert text.count(f", {E.PARTS}), REPARTITION_BY_NUM") == 2 and "_salt" in text
    want = {r.s: r.n - r.keys for r in rows.groupBy("s").agg(F.count("*").alias("n"), F.count_distinct("k").alias("keys")).collect()}
    assert {r.segment: r.extra_rows for r in found.collect()} == want


def test_arrivals_and_shared_layers_grow_with_the_input(spark, sf_small, monkeypatch):
    """No query draws a table into a fixed number of files; layers that several diagnoses read are stored once."""
    from workload import queries as Q

    frame, counts = type(spark.range(1)), []
    plain = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda df, *by: counts.extend(b for b in by if isinstance(b, int)) or plain(df, *by))
    Q.QUERIES["landed_files_in_order"](spark, sf_small)
    assert counts == []
    stored, made = [], Q.D.stored_layers
    monkeypatch.setattr(Q.D, "stored_layers", lambda *args: stored.append(args) or made(*args))
    Q.QUERIES["findings_missing_column"](spark, sf_small)
    assert len(stored) == 1
