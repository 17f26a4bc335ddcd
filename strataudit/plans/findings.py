"""The shape of a finding and of its evidence."""

from __future__ import annotations

# Evidence fields in the order reports print them; the ones after persists_in are kept but not printed.
EVIDENCE = {
    "affected_segment": "string",
    "pattern": "string",
    "note": "string",
    "examples": "array<string>",
    "sample_values": "array<string>",
    "sample_unmatched_keys": "array<string>",
    "non_numeric_rows": "bigint",
    "non_numeric_pct": "double",
    "null_rows": "bigint",
    "upstream_null_pct": "double",
    "upstream_dtype": "string",
    "changed_rows": "bigint",
    "duplicate_rows": "bigint",
    "exact_copies": "bigint",
    "origination_date_range": "array<string>",
    "unmatched_rows": "bigint",
    "match_if_zero_padded": "bigint",
    "loan_types_missing_from_final": "array<string>",
    "rows_now_unmatched_in_customers": "bigint",
    "cause": "string",
    "delta": "double",
    "delta_pct": "double",
    "unknown_rows": "bigint",
    "persists_in": "array<string>",
    "limit_pct": "double",
    "upstream_table": "string",
    "upstream_duplicate_rows": "bigint",
    "duplicated_keys": "bigint",
    "table_origination_start": "string",
    "raw_rows": "bigint",
    "withdrawn": "bigint",
    "raw_duplicates": "bigint",
    "customer_key_length": "bigint",
    "unknown_with_null_credit_score": "bigint",
}
PRINTED_EVIDENCE = list(EVIDENCE)[: list(EVIDENCE).index("persists_in") + 1]
EVIDENCE_DDL = "struct<" + ", ".join(f"{k}: {t}" for k, t in EVIDENCE.items()) + ">"

FINDING = {
    "run_id": "string", "check_idx": "int", "item_idx": "int", "verdict": "string", "check": "string",
    "category": "string", "severity": "string", "transition": "string", "transition_idx": "int", "table": "string",
    "column": "string", "message": "string", "expected": "string", "actual": "string", "evidence": EVIDENCE_DDL,
}
FINDING_DDL = ", ".join(f"{k} {t}" for k, t in FINDING.items())

# Per-segment figures of a finding; which columns are filled depends on the check. ``magnitude`` orders them.
SEGMENT = {
    "run_id": "string", "verdict": "string", "table": "string", "column": "string", "segment": "string",
    "magnitude": "double", "rows": "bigint", "affected": "bigint", "affected_pct": "double", "extra_rows": "bigint",
    "changed_rows": "bigint", "unmatched_rows": "bigint", "expected": "double", "actual": "double", "delta": "double",
}
SEGMENT_DDL = ", ".join(f"{k} {t}" for k, t in SEGMENT.items())
SEGMENT_FIGURES = list(SEGMENT)[6:]


def evidence_struct(**given: str) -> str:
    fields = ", ".join(f"'{k}', cast({given.get(k, 'null')} AS {t})" for k, t in EVIDENCE.items())
    return f"named_struct({fields})"


def finding_columns(evidence: str | None = None, **given: str) -> str:
    """Select list of a finding."""
    given["evidence"] = evidence or evidence_struct()
    return ", ".join(f"cast({given[k]} AS {t}) AS {k}" for k, t in FINDING.items())


def segment_columns(**given: str) -> list[str]:
    return [f"cast({given.get(k, 'null')} AS {t}) AS {k}" for k, t in SEGMENT.items()]
