"""Row counts and totals from layer to layer."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from strataudit.config import DistinctRule, DistributionRule, MeasureRule
from strataudit.functions import currency_to_double, exprs, lit, name, percent_of, strip, to_double
from strataudit.operators.layers import arrival_order, excluded


def expected_keys(df: DataFrame, rule: DistinctRule, unique: bool = False) -> DataFrame:
    """One row: rows, distinct keys that should remain, distinct keys excluded, surplus keys.

    ``unique`` tells that a profile found every key present once; counting rows is enough then.

    Each key is reduced to two flags before anything is counted, so that several distinct counts need neither
    a copy of the rows per count nor one task for a key that fills a third of the table.
    """
    key = strip(f"cast({name(rule.key)} AS string)") if rule.strip_key else name(rule.key)
    out = excluded(rule.exclusion) if rule.exclusion else "false"
    if unique and not rule.strip_key:
        return df.selectExpr(f"{out} AS out").agg(*exprs(
            "count(*) AS source_rows", "count_if(NOT out) AS expected_rows", "count_if(out) AS excluded_keys",
            "0L AS surplus_keys"))
    per_key = df.selectExpr(f"{key} AS k", f"{out} AS out").groupBy("k").agg(*exprs(
        "count(*) AS n", "max(out) AS any_out", "max(NOT out) AS any_in"))
    return per_key.agg(*exprs(
        "coalesce(sum(n), 0L) AS source_rows",
        "count_if(k IS NOT NULL AND any_in) AS expected_rows",
        "count_if(k IS NOT NULL AND any_out) AS excluded_keys",
        "coalesce(sum(n), 0L) - count_if(k IS NOT NULL) AS surplus_keys"))


def one_value_per_key(df: DataFrame, rule: MeasureRule, segment: str, unique: bool = False) -> DataFrame:
    """Segment and readable amount of the first row of each key that is not excluded, by the rule that staging goes by.
    With ``unique`` keys every row is the only one of its key."""
    kept = df.filter(f"NOT {excluded(rule.exclusion)}") if rule.exclusion else df
    amount = currency_to_double(name(rule.measure), df.schema[rule.measure].dataType)
    if unique:
        return kept.selectExpr(f"{name(segment)} AS segment", f"{amount} AS amount")
    first = f"min_by(struct({name(segment)} AS segment, {amount} AS amount), {arrival_order(df.columns, [rule.key])})"
    return kept.groupBy(name(rule.key)).agg(*exprs(f"{first} AS first")).selectExpr("first.segment", "first.amount")


def segment_totals(layers: Mapping[str, DataFrame], rule: MeasureRule, segment: str,
                   unique: Collection[str] = ()) -> DataFrame:
    """Totals per segment, one column ``t0, t1, ...`` per table of the rule.

    The tables meet in a grouping rather than in joins: a segment that exists on one side only, or has no name,
    is kept with 0 on the other side.
    """
    parts = []
    for i, table in enumerate(rule.tables):
        df = layers[table]
        if i == 0:
            amounts = one_value_per_key(df, rule, segment, table in unique)
        else:
            amount = to_double(name(rule.measure), df.schema[rule.measure].dataType)
            amounts = df.selectExpr(f"{name(segment)} AS segment", f"{amount} AS amount")
        parts.append(amounts.groupBy("segment").agg({"amount": "sum"}).selectExpr(
            "cast(segment AS string) AS segment", f"{i} AS layer", "`sum(amount)` AS total"))
    return reduce(DataFrame.unionByName, parts).groupBy("segment").agg(*exprs(*[
        f"coalesce(sum(CASE WHEN layer = {i} THEN total END), 0.0D) AS t{i}" for i in range(len(rule.tables))]))


def _steps(rule: MeasureRule, prefix: str) -> str:
    rows = [f"struct({i} AS step, {lit(t)} AS transition, {lit(rule.tables[i + 1])} AS table, "
            f"{prefix}{i} AS expected_total, {prefix}{i + 1} AS actual_total)"
            for i, t in enumerate(rule.transitions)]
    return f"inline(array({', '.join(rows)}))"


def measure_steps(totals: DataFrame, rule: MeasureRule) -> DataFrame:
    """Expected and actual total per segment and transition."""
    return totals.selectExpr("segment", _steps(rule, "t")).selectExpr(
        "transition", "table", "segment", "round(expected_total, 2) AS expected", "round(actual_total, 2) AS actual",
        "round(actual_total - expected_total, 2) AS delta")


def measure_drift(totals: DataFrame, rule: MeasureRule) -> DataFrame:
    """Grand totals and unrounded drift per transition; an expected total of 0 gives a drift of 0."""
    sums = totals.agg(*exprs(*[f"coalesce(sum(t{i}), 0.0D) AS s{i}" for i in range(len(rule.tables))]))
    return sums.selectExpr(_steps(rule, "s")).selectExpr(
        "*", "CASE WHEN expected_total <> 0 THEN 100.0D * (actual_total - expected_total) / expected_total "
             "ELSE 0.0D END AS drift_pct")


def category_share(df: DataFrame, rule: DistributionRule) -> DataFrame:
    """Rows, rows in the watched category, and those of them whose cause column is NULL, in one scan."""
    hit = f"{name(rule.column)} = {lit(rule.category)}"
    return df.agg(*exprs(
        "count(*) AS rows", f"count_if({hit}) AS category_rows",
        f"count_if({hit} AND {name(rule.cause_column)} IS NULL) AS with_null_cause",
    )).selectExpr("*", percent_of("category_rows", "rows", 1) + " AS share_pct")
