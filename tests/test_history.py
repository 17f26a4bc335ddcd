"""Stage by stage runs, ownership of layers, history tables and what is read back from them."""

from dataclasses import replace

import pytest
from strataudit.config import Transform
from strataudit.operators import layers as L
from strataudit.operators import profile as P
from strataudit.plans import diagnosis as G
from strataudit.plans import history as H
from strataudit.plans import reports as N
from strataudit.plans.runs import ForeignLayer, NoSuchRun, Runs, truth_frame
from strataudit.operators import mutations as M
from strataudit.plans.lineage import closure
from strataudit.sources.history import BUCKET, BUCKETS, History, bucket_of
from strataudit.sources.layers import LayerStore
from workload import domain as D

CFG = D.config()
LAYERS = [c.name for c in CFG.contracts]


@pytest.fixture
def runs(spark, tmp_path):
    return Runs(LayerStore(spark, str(tmp_path / "lake")), History(spark, str(tmp_path / "lake")))


@pytest.fixture(scope="module")
def sources(spark, sf_small):
    raw = D.raw_tables(spark, sf_small)
    return {n.split(".")[1]: df for n, df in raw.items()}


def test_all_stages(spark, runs, sources):
    run = runs.start("duplicate_rows", run_id="r1")
    assert runs.run_stage("extract", run, sources) == {"customers": 150, "loans": 1500}
    edits = {"staging.loans": lambda df: M.repeat_recent(df, "origination_date", D.AS_OF)}
    counts = runs.run_stage("staging", run, edits=edits, truth={"injected_at": "staging:loans"})
    assert counts["loans"] > 1455
    assert runs.run_stage("final", run) == {"loan_portfolio": counts["loans"], "portfolio_summary": 5}
    state = runs.finish(run)
    assert state.scenario == "duplicate_rows" and state.finished_at >= state.started_at
    assert state.row_counts == {"raw": {"customers": 150, "loans": 1500}, "staging": counts,
                                "final": {"loan_portfolio": counts["loans"], "portfolio_summary": 5}}
    assert "staging:loans" in state.truth

    d = G.diagnose(runs.layers(LAYERS), CFG, run).close()
    assert d.ranked().filter("rank = 1").first().category == "DUPLICATE_ROWS"
    history = runs.history
    for _ in range(2):  # a second diagnosis of the run replaces the first
        history.replace_run("layer_profiles", d.profiles)
        history.replace_run("findings", d.findings)
        history.replace_run("diagnoses", H.diagnosis_rows(d.report(), "2026-01-01 00:00:00"))
    other = d.findings.selectExpr("'other run/1' AS run_id", *[c for c in d.findings.columns if c != "run_id"])
    history.replace_run("findings", other)
    assert history.of_run("findings", run).count() == d.findings.count()
    assert history.of_run("findings", "other run/1").count() == d.findings.count()
    assert history.of_run("layer_profiles", run).count() == d.profiles.count()

    stored = history.of_run("diagnoses", run)
    assert (stored.first().status, stored.first().root_cause) == ("FAILED", "DUPLICATE_ROWS")
    rebuilt, report = H.load_report(stored).first(), d.report().first()
    assert rebuilt.root_cause == report.root_cause
    assert [s.category for s in rebuilt.symptoms] == [s.category for s in report.symptoms]
    assert rebuilt.checks == report.checks and rebuilt.impact == report.impact and rebuilt.layers == report.layers

    notes = N.render_reports(d.profiles, d.findings, d.segments)
    history.write_markdown(notes)
    history.replace_run("incident_reports", H.report_rows(notes, "2026-01-01 00:00:00"))
    assert history.of_run("incident_reports", run).first().source == "template"
    assert runs.store.preview("final.portfolio_summary").count() == 5 == runs.store.row_count("final.portfolio_summary")
    assert runs.store.read_or_empty("final.nothing", "a int").count() == 0
    assert history.notes(notes).first().markdown == notes.first().markdown.rstrip("\n")

    flow = H.layer_flow(history.of_run("layer_profiles", run), history.of_run("findings", run), D.LOAN_TABLES)
    marks = {r.layer: (r.rows, r.delta, r.mark) for r in flow.collect()}
    assert marks["raw"] == (1500, None, "ok") and marks["staging"][2] == "root" and marks["final"][1] == 0


def test_run_all_then_diagnose(spark, tmp_path, sources):
    runs = Runs(LayerStore(spark, str(tmp_path / "lake")), History(spark, str(tmp_path / "lake")), CFG)
    with pytest.raises(NoSuchRun):
        runs.diagnose()
    edits = {"staging.loans": lambda df: M.repeat_recent(df, "origination_date", D.AS_OF)}
    state = runs.run_all(sources, "duplicate_rows", edits=edits, truth={"scenario": "duplicate_rows", "injected_at": "staging:loans"})
    assert state.finished_at is not None and set(state.row_counts) == {"raw", "staging", "final"}
    runs.diagnose().close()  # the latest run
    stored = runs.history.of_run("findings", state.run_id)
    truth = truth_frame(H.current_runs(runs.history.read("run_events")))
    assert G.evaluate(truth.select("run_id"), G.root_causes(stored), truth).first().correct
    assert runs.history.of_run("diagnoses", state.run_id).first().root_cause == "DUPLICATE_ROWS"
    assert runs.history.of_run("finding_values", state.run_id).count() == 0


def test_unknown_runs_and_stages(runs, sources):
    with pytest.raises(NoSuchRun):
        runs.get("nope")
    with pytest.raises(NoSuchRun):
        runs.run_stage("extract", "nope", sources)
    run = runs.start()
    with pytest.raises(NoSuchRun):
        runs.finish("nope")
    with pytest.raises(ValueError, match="no stage"):
        runs.run_stage("transform", run)


def test_stage_order(runs, sources):
    run = runs.start()
    with pytest.raises(ForeignLayer, match="raw, written by nobody"):
        runs.run_stage("staging", run)
    with pytest.raises(ForeignLayer, match="staging, written by nobody"):
        runs.run_stage("final", run)


def test_interleaved_runs(runs, sources):
    a, b = runs.start(run_id="a"), runs.start(run_id="b")
    runs.run_stage("extract", a, sources)
    with pytest.raises(ForeignLayer, match="written by a"):
        runs.run_stage("staging", b)
    runs.run_stage("extract", b, sources)
    runs.run_stage("extract", b, sources)  # a retry
    with pytest.raises(ForeignLayer, match="written by b"):
        runs.run_stage("staging", a)
    runs.run_stage("staging", b)


def test_empty_history(spark, tmp_path):
    history = History(spark, str(tmp_path / "none"))
    for table in ("run_events", "findings", "diagnoses"):
        assert history.read(table).count() == 0
    assert H.latest_run(H.current_runs(history.read("run_events"))).count() == 0


def test_latest_and_audit(spark):
    runs = spark.sql("""SELECT * FROM VALUES ('a', 'none', TIMESTAMP_NTZ'2026-01-01 00:00:00', TIMESTAMP_NTZ'2026-01-01 01:00:00'),
        ('b', 'null_spike', TIMESTAMP_NTZ'2026-01-02 00:00:00', NULL) AS t(run_id, scenario, started_at, finished_at)""")
    diagnoses = spark.sql("SELECT * FROM VALUES ('a', 'HEALTHY', cast(NULL AS string)), ('b', 'FAILED', 'NULL_SPIKE') AS t(run_id, status, root_cause)")
    reports = spark.sql("SELECT 'a' AS run_id, 'template' AS source")
    gates = spark.sql("SELECT * FROM VALUES ('a', false), ('b', false) AS t(run_id, gate_failed)")
    assert H.is_latest(runs, "b") and not H.is_latest(runs, "a")
    assert [r.run_id for r in H.recent_runs(runs, diagnoses, 1).collect()] == ["b"]
    audit = {r.run_id: r.problems for r in H.audit_runs(runs, diagnoses, reports, gates).collect()}
    assert audit["a"] == []
    assert audit["b"] == ["unfinished", "no_report", "fault_not_gated"]
    wrong = H.audit_runs(runs.filter("run_id = 'a'"), diagnoses, reports, gates, "'null_spike'").first().problems
    assert "other_scenario" in wrong and "fault_not_diagnosed" in wrong


def test_one_bucket_is_listed(spark, tmp_path):
    history = History(spark, str(tmp_path))
    for i in range(12):
        history.append("run_events", [(f"r{i}", "started", "none", i, None, None, None, Runs._clock())])
    of = history.of_run("run_events", "r7")
    assert {f.split("bucket=")[1].split("/")[0] for f in of.inputFiles()} == {str(bucket_of("r7"))}
    assert [r.seed for r in of.collect()] == [7] and history.of_run("run_events", "nobody").count() == 0
    assert history.read("run_events").selectExpr(f"max(abs({BUCKET} - {bucket_of('r3')} * cast(run_id = 'r3' AS int)) * cast(run_id = 'r3' AS int)) AS d").first().d == 0


def test_many_events_are_few_files_once_compacted(spark, tmp_path):
    """Ten thousand events as they are after as many appends: a file of its own for each bucket and append."""
    history = History(spark, str(tmp_path))
    events = spark.range(10_000).selectExpr(
        "concat('r', id % 700) AS run_id", "'stage' AS event", "'none' AS scenario", "id AS seed", "'raw' AS layer",
        "map('loans', id) AS row_counts", "cast(null AS string) AS truth", "timestamp_ntz'2026-01-01' AS at", )
    events.selectExpr("*", f"{BUCKET} AS bucket").repartition(4).write.partitionBy("bucket").parquet(history.path("run_events"))
    before = {tuple(r[:4]) for r in history.read("run_events").collect()}
    assert len(history.read("run_events").inputFiles()) > 100
    history.compact("run_events")
    assert len(history.read("run_events").inputFiles()) <= BUCKETS
    assert {tuple(r[:4]) for r in history.read("run_events").collect()} == before
    history.append("run_events", [("r1", "finished", None, None, None, None, None, Runs._clock())])
    assert history.of_run("run_events", "r1").filter("event = 'finished'").count() == 1


def test_notes_of_like_ids_stay_apart(spark, tmp_path):
    history = History(spark, str(tmp_path))
    ids = ["a/b", "a_b", "a b", "", "日本", "a" * 150]
    notes = spark.createDataFrame([(i, f"## Summary\nof {i}\n\nend") for i in ids], "run_id string, markdown string")
    history.write_markdown(notes)
    history.write_markdown(notes.filter("run_id = 'a/b'").selectExpr("run_id", "'again' AS markdown"))
    found = {r.run_id: r.markdown for r in history.notes(notes).collect()}
    assert found == {i: f"## Summary\nof {i}\n\nend" for i in ids} | {"a/b": "again"}


def test_closure_of_any_depth_and_cycles(spark):
    chain = [(f"t{i}", f"t{i + 1}", "*") for i in range(12)] + [("t0", "t2", "c")]
    found = {(r.src_table, r.dst_table): r.depth for r in closure(spark.createDataFrame(chain, "src_table string, dst_table string, column string")).collect()}
    assert len(found) == 13 * 12 // 2 and found["t0", "t12"] == 11 and found["t0", "t2"] == 1
    for cycle in ([("a", "a")], [("a", "b"), ("b", "c"), ("c", "a")]):
        with pytest.raises(Exception, match="lineage cycle"):
            closure(spark.createDataFrame([*cycle, ("x", "a")], "src_table string, dst_table string")).collect()


def test_transforms_in_any_order_and_cycles():
    cfg = D.supply_config()
    assert [t.table for t in cfg.of_layer("final")] == ["final.supplies", "final.nation_revenue"]
    assert cfg.feeding_layers("final") == ["staging"] and cfg.feeding_layers("raw") == []
    loop = replace(cfg, transforms=(Transform("final.a", ("final.b",), dict), Transform("final.b", ("final.a",), dict)))
    with pytest.raises(ValueError, match="from each other"):
        loop.of_layer("final")
    with pytest.raises(ValueError, match="no tables to make"):
        L.build_layers({}, loop.transforms)


def test_gate_names_the_first_failures_only(spark):
    rows = [(f"r{i:03}", "FAILED" if i % 2 else "HEALTHY") for i in range(200)]
    diagnosed = spark.createDataFrame(rows, "run_id string, status string").selectExpr(
        "*", "named_struct('category', 'ROW_LOSS', 'transition', 'x', 'table', 't', 'column', cast(null AS string), 'message', 'm') AS root_cause")
    with pytest.raises(G.DataQualityError) as e:
        G.quality_gate(diagnosed, 2)
    assert str(e.value) == "100 of the diagnosed runs failed:\nr001 ROW_LOSS x t m\nr003 ROW_LOSS x t m\nand 98 more"
    with pytest.raises(Exception, match="100 of the diagnosed runs failed"):
        G.gate(diagnosed).collect()
    assert G.gate(diagnosed.filter("status = 'HEALTHY'")).first().status == "HEALTHY" == G.quality_gate(diagnosed.limit(0))


def test_profiles_of_two_tiers_agree(spark, sf_small):
    layers = D.layers(spark, sf_small)
    exact, scanned = (P.profile_layers(layers, CFG, "r", d) for d in ("exact", "none"))
    assert sorted(map(str, scanned.drop("distinct_count").collect())) == sorted(map(str, exact.drop("distinct_count").select(scanned.drop("distinct_count").columns).collect()))
    lines = D.table(spark, sf_small, "lineitem")
    plan = P.scan_tables([("l", lines, ())])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in plan
