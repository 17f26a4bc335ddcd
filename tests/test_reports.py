"""Incident notes: drafts are cleaned, checked and completed; the template stands in for them."""

import pytest
from strataudit.plans import diagnosis as G
from strataudit.plans import reports as N
from workload import domain as D

CFG = D.config()
RUN = "dropped_join_key"


@pytest.fixture(scope="module")
def broken(spark, sf_mid):
    d = G.diagnose(D.stored_layers(spark, sf_mid, RUN), CFG, RUN)
    yield d
    d.close()


def note(spark, d, text=None):
    drafts = None
    if text is not None:
        drafts = spark.createDataFrame([(RUN, "writer", 0.1, text)], "run_id string, author string, seconds double, text string")
    return N.render_reports(d.profiles, d.findings, d.segments, drafts).first()


def test_template(spark, broken):
    n = note(spark, broken)
    assert (n.status, n.source, n.grounded, n.note) == ("FAILED", "template", True, "no draft - used template")
    for heading in N.REQUIRED_SECTIONS:
        assert f"## {heading}\n" in n.markdown
    assert "staging.loans.customer_id" in n.markdown and "Join Key Mismatch: " in n.markdown
    assert "It caused 2 downstream issue(s) in later layers." in n.markdown
    assert "- 2,900 rows lost during staging->final (-19.9%) (staging->final)" in n.markdown
    for i, step in enumerate(N.FIX_PLAYBOOK["JOIN_KEY_MISMATCH"], 1):
        assert f"{i}. {step}" in n.markdown
    lines = n.markdown.splitlines()
    i = lines.index("  by source_system:")
    assert lines[i + 1] == "    CARD_PLATFORM: changed_rows=2,900"
    assert "  match_if_zero_padded: 2,900" in lines and "  expected: 14,550 | actual: 11,650" in lines
    assert "  expected: 3,640,525,045.12 | actual: 2,926,589,225.34" in lines
    assert """  examples: ["'00000000' -> '0'", "'00000001' -> '1'", "'00000002' -> '2'"]""" in lines
    assert "    CARD_PLATFORM: expected=713,935,819.78, actual=0.00, delta=-713,935,819.78" in lines


def test_chatty_draft_is_completed(spark, broken):
    n = note(spark, broken, "Sure, here's the report!\n\n## Summary\nThe customer_id key in staging.loans lost its leading zeros.\n\n"
                            "## Where it broke\nraw->staging, loans.customer_id\n\n## Root cause\nKey cast to int.")
    assert n.source == "draft" and n.author == "writer" and "Sure" not in n.markdown
    assert n.note == "filled from template: Downstream impact, Recommended fix"
    for heading in N.REQUIRED_SECTIONS:
        assert n.markdown.count(f"## {heading}\n") == 1
    assert "### Evidence from automated checks" in n.markdown


def test_ungrounded_draft_is_dropped(spark, broken):
    n = note(spark, broken, "## Summary\nSomething went wrong with the database.")
    assert n.source == "template" and n.grounded is False and "did not name" in n.note


def test_fence_is_unwrapped(spark, broken):
    n = note(spark, broken, "```markdown\n## Summary\nstaging.loans customer_id lost its leading zeros.\n```")
    assert n.source == "draft" and n.markdown.count("```") == 2 and "```markdown" not in n.markdown


@pytest.mark.parametrize("text, want", [
    ("  plain \n", "plain"), ("```\nabc\n```  ", "abc"), ("```", ""), ("```x", ""), ("a ``` b", "a ``` b"),
    ("hello ## A\nb", "## A\nb"), ("## A ## B", "## A ## B"), ("```md\nhi\n## A\n```\n", "## A"), ("", ""),
])
def test_clean_draft(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.selectExpr(N.clean_draft("t")).first()[0] == want


def test_grounding_rule(spark):
    rows = [("LOANS and Customer_ID", "staging.loans", "customer_id", True), ("loans", "staging.loans", "customer_id", False),
            ("customer_id", "staging.loans", "customer_id", False), ("staging.loans", "staging.loans", None, True)]
    df = spark.createDataFrame(rows, "t string, tab string, c string, want boolean")
    assert df.filter(f"({N.is_grounded('t', 'tab', 'c')}) <> want").count() == 0


def test_facts(spark, broken):
    runs = broken.profiles.select("run_id").distinct()
    sheet = N.fact_sheets(runs, broken.findings, broken.profiles, broken.segments, G.verdicts(broken.findings, runs)).first().facts
    assert "staging.loans.customer_id" in sheet and "CARD_PLATFORM" in sheet and "leading zeros stripped" in sheet
    expected = sheet.split("EXPECTED CHANGES")[1].split("FINAL LAYER")[0]
    assert "450 WITHDRAWN" in expected
    assert "dropped_join_key" not in sheet.replace(f"Run: {RUN}", "")
    assert "Checks: schema=PASS, key_integrity=FAIL, uniqueness=PASS, nulls=PASS, row_counts=FAIL, measures=FAIL, distribution=PASS" in sheet
    assert "  loan rows: 11,650 (staging had 14,550)" in sheet
    for step in N.FIX_PLAYBOOK["JOIN_KEY_MISMATCH"]:
        assert f"  - {step}" in sheet


def test_healthy_note(spark, sf_small):
    d = G.diagnose(D.layers(spark, sf_small), CFG, "ok").close()
    n = N.render_reports(d.profiles, d.findings, d.segments).first()
    assert (n.status, n.source, n.note) == ("HEALTHY", "template", "healthy run - no draft needed")
    assert "All checks passed" in n.markdown and "WITHDRAWN" in n.markdown
    assert "Checks run: schema, key_integrity, uniqueness, nulls, row_counts, measures, distribution" in n.markdown
