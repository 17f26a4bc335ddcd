"""Edits that break a table on purpose, to see whether the audit finds them.

``rows`` is a SQL condition. Which rows are hit depends only on their values and the seed, so the outcome does
not change with partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from strataudit.functions import exprs, lit, name


def hashed_share(key: str, percent: int, seed: int = 42) -> str:
    """A condition true for about ``percent`` % of the keys, by the first 13 digits of an md5: any engine can repeat it."""
    digits = f"left(md5(cast(concat({lit(f'{seed}:')}, cast({name(key)} AS string)) AS binary)), 13)"
    return f"cast(conv({digits}, 16, 10) AS bigint) % 100 < {percent}"


def _replaced(df: DataFrame, column: str, e: str) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {name(c)}" if c == column else name(c) for c in df.columns])


def number_to_text(df: DataFrame, column: str, rows: str) -> DataFrame:
    """A numeric column arrives as text; the given rows carry currency symbols (``$12,345.67``)."""
    c = name(column)
    return _replaced(df, column, f"CASE WHEN {rows} THEN concat('$', format_number({c}, 2)) "
                                 f"ELSE format_string('%.2f', {c}) END")


def null_out(df: DataFrame, column: str, rows: str) -> DataFrame:
    """The given rows lose their value."""
    return _replaced(df, column, f"CASE WHEN coalesce({rows}, false) THEN NULL ELSE {name(column)} END")


def strip_leading_zeros(df: DataFrame, column: str, rows: str) -> DataFrame:
    """The given rows have their key cast to an integer and back; a key that is no number stays."""
    c = name(column)
    return _replaced(df, column, f"CASE WHEN {rows} THEN coalesce(cast(try_cast({c} AS bigint) AS string), {c}) "
                                 f"ELSE {c} END")


def recent(date_column: str, as_of: str, days: int = 365) -> str:
    """A condition true for the last ``days`` days."""
    return f"{name(date_column)} >= date_sub(DATE'{as_of}', {days})"


def repeat_recent(df: DataFrame, date_column: str, as_of: str, days: int = 365) -> DataFrame:
    """The last ``days`` days of rows are loaded a second time."""
    return df.union(df.filter(recent(date_column, as_of, days)))


def messy_case(df: DataFrame, column: str, lower_rows: str, pad_rows: str) -> DataFrame:
    """Some codes arrive in lower case, some with a trailing blank; see :func:`hashed_share` for the conditions."""
    c = name(column)
    lowered = f"CASE WHEN {lower_rows} THEN lower({c}) ELSE {c} END"
    return _replaced(df, column, f"CASE WHEN {pad_rows} THEN concat({lowered}, ' ') ELSE {lowered} END")


def truth(df: DataFrame, run_id: str, scenario: str, injected_at: str, column: str, rows: str,
          segment: str | None = None, description: str = "") -> DataFrame:
    """What an edit touched, as one row: the answer key a diagnosis is scored against."""
    return df.agg(*exprs(f"count_if({rows}) AS rows_affected")).selectExpr(
        f"{lit(run_id)} AS run_id", f"{lit(scenario)} AS scenario", f"{lit(injected_at)} AS injected_at",
        f"{lit(column)} AS column", f"{lit(segment)} AS affected_segment", "rows_affected",
        f"{lit(description)} AS description")
