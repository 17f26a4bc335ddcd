"""Building the layers: clean the landed tables, join them into the portfolio, summarise it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataudit.config import EXCLUDED_STATUSES, INGEST_SEQ, Exclusion, Transform
from strataudit.functions import exprs, lit, name, normalise_code, strip, to_double, to_long, to_strict_timestamp
from strataudit.sources.local import local_frame

# Which cleaning each column gets; a column without a rule passes through as it is.
CUSTOMER_RULES = {
    "customer_id": "strip",
    "first_name": "strip",
    "last_name": "strip",
    "full_name": "strip",
    "email": "strip_lower",
    "state": "code",
    "credit_score": "whole",
    "annual_income": "number",
    "date_of_birth": "timestamp",
    "customer_since": "timestamp",
}
LOAN_RULES = {
    "customer_id": "strip",
    "status": "code",
    "principal": "number",
    "balance": "number",
    "interest_rate": "number",
    "term_months": "whole",
    "origination_date": "timestamp",
}

RISK_BAND = """CASE WHEN credit_score IS NULL THEN 'UNKNOWN' WHEN credit_score >= 740 THEN 'PRIME'
    WHEN credit_score >= 670 THEN 'NEAR_PRIME' ELSE 'SUBPRIME' END"""
IS_DELINQUENT = "status IN ('DELINQUENT_30', 'DELINQUENT_90', 'DEFAULT')"


def _cleaned(column: str, dtype: T.DataType, rule: str | None) -> str:
    c = name(column)
    text = f"cast({c} AS string)"
    match rule:
        case "strip":
            return strip(text)
        case "strip_lower":
            return f"lower({strip(text)})"
        case "code":
            return normalise_code(text)
        case "number" if not isinstance(dtype, T.DoubleType):
            return to_double(c, dtype)
        case "whole" if not isinstance(dtype, T.LongType):
            return to_long(c, dtype)
        case "timestamp" if not isinstance(dtype, T.TimestampNTZType):
            return to_strict_timestamp(c)
        case _:
            return c


def clean(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Apply one rule per column in a single projection; a column that is of the rule's type already stays as it is."""
    return df.selectExpr(*[f"{_cleaned(f.name, f.dataType, rules.get(f.name))} AS {name(f.name)}" for f in df.schema.fields])


def with_arrival(raw: DataFrame, keys: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """The landed rows with what their order of arrival needs after cleaning, where landing recorded none: the arrived values of
    the columns that cleaning changes."""
    if INGEST_SEQ in raw.columns:
        return raw
    changed = [f.name for f in raw.schema.fields if f.name not in keys and _cleaned(f.name, f.dataType, rules.get(f.name)) != name(f.name)]
    return raw.selectExpr("*", *[f"{name(c)} AS {name(ARRIVED + c)}" for c in changed])


def _value_list(rule: Exclusion) -> str:
    return ", ".join(lit(v) for v in rule.values)


def excluded(rule: Exclusion) -> str:
    """True for rows meant to drop out. Never NULL, so its negation keeps rows with a missing value."""
    value = normalise_code(f"cast({name(rule.column)} AS string)")
    return f"coalesce({value} IN ({_value_list(rule)}), false)"


def keep_unexcluded(df: DataFrame, rule: Exclusion) -> DataFrame:
    """Filter an already normalised column; this form is pushed into the scan."""
    c = name(rule.column)
    return df.filter(f"{c} IS NULL OR NOT {c} IN ({_value_list(rule)})")


ARRIVED = "_arrived_"


def arrival_order(columns: list[str], keys: Sequence[str]) -> str:
    """What decides which row of a key came first, for every side of a comparison: the sequence recorded at landing, or
    else all columns of the landed table in order, as they arrived, so that the result never depends on partitioning."""
    if INGEST_SEQ in columns:
        return name(INGEST_SEQ)
    own = [c for c in columns if not c.startswith(ARRIVED)]
    order = [ARRIVED + c if ARRIVED + c in columns else c for c in own if c not in keys]
    return f"struct({', '.join(map(name, order or keys))})"


def first_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the first to arrive (see ``arrival_order``).

    Spark keeps one candidate per key and task before the shuffle (window group limit), so a key holding a large part of
    the table reaches its task as a handful of rows.
    """
    over = f"PARTITION BY {', '.join(map(name, keys))} ORDER BY {arrival_order(df.columns, keys)}"
    ranked = df.selectExpr("*", f"row_number() OVER ({over}) AS _rank").filter("_rank = 1")
    return ranked.selectExpr(*[name(c) for c in df.columns if not c.startswith(ARRIVED)])


def clean_table(raw: DataFrame, rules: Mapping[str, str], keys: Sequence[str], exclusion: Exclusion | None = None) -> DataFrame:
    """A landed table cleaned column by column, without the excluded rows, one row per key: the first to arrive."""
    cleaned = clean(with_arrival(raw, keys, rules), rules)
    if exclusion:
        cleaned = keep_unexcluded(cleaned, exclusion)
    return first_per_key(cleaned, list(keys)).drop(INGEST_SEQ)


def clean_customers(raw: DataFrame) -> DataFrame:
    return clean_table(raw, CUSTOMER_RULES, ["customer_id"])


def clean_loans(raw: DataFrame, exclusion: Exclusion = Exclusion("status", EXCLUDED_STATUSES)) -> DataFrame:
    return clean_table(raw, LOAN_RULES, ["loan_id"], exclusion)


def loan_portfolio(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Loans with the customer attributes reports need. Columns the loans lack are left out.

    No join hint: the customer side grows with the data, so Spark decides from its measured size, and adaptive
    execution splits a customer that holds a large share of the loans.
    """
    joined = loans.join(customers.select("customer_id", "state", "credit_score"), "customer_id", "inner")
    wanted = {c: c for c in ("loan_id", "customer_id", "state", "credit_score", "risk_band", "loan_type",
                             "source_system", "principal", "balance", "interest_rate", "term_months", "status",
                             "is_delinquent", "origination_date")}
    wanted |= {"risk_band": RISK_BAND, "is_delinquent": IS_DELINQUENT,
               "origination_date": "cast(origination_date AS date)"}
    present = {*joined.columns, "risk_band", "is_delinquent"}
    return joined.selectExpr(*[f"{e} AS {c}" for c, e in wanted.items() if c in present])


def build_layers(raw: Mapping[str, DataFrame], transforms: Sequence[Transform] | None = None) -> dict[str, DataFrame]:
    """The tables of ``raw`` and all that the transforms make of them, as lazy frames by ``layer.table``; by default the lending
    tables. A transform may stand anywhere in the list, but not depend on itself."""
    todo = list(loan_transforms(Exclusion("status", EXCLUDED_STATUSES)) if transforms is None else transforms)
    made = dict(raw)
    while todo:
        ready = [t for t in todo if all(r in made for r in t.reads)]
        if not ready:
            raise ValueError(f"no tables to make {', '.join(t.table for t in todo)} from")
        made |= {t.table: t.build(made) for t in ready}
        todo = [t for t in todo if t not in ready]
    return made


def portfolio_summary(portfolio: DataFrame) -> DataFrame:
    """Key figures by loan type."""
    return portfolio.groupBy("loan_type").agg(*exprs(
        "count(*) AS loan_count",
        "round(sum(balance), 2) AS total_balance",
        "round(avg(interest_rate), 4) AS avg_interest_rate",
        "round(avg(cast(is_delinquent AS int)), 4) AS delinquency_rate",
        "round(avg(cast(risk_band = 'SUBPRIME' AS int)), 4) AS subprime_share"))


def ordered_summary(summary: DataFrame) -> DataFrame:
    """A summary as it is shown: the largest balance first, ties by name."""
    return summary.orderBy(F.desc("total_balance"), "loan_type")


def loan_transforms(exclusion: Exclusion) -> tuple[Transform, ...]:
    """How the lending tables are made."""
    return (
        Transform("staging.customers", ("raw.customers",), lambda t: clean_customers(t["raw.customers"])),
        Transform("staging.loans", ("raw.loans",), lambda t: clean_loans(t["raw.loans"], exclusion)),
        Transform("final.loan_portfolio", ("staging.loans", "staging.customers"),
                  lambda t: loan_portfolio(t["staging.loans"], t["staging.customers"])),
        Transform("final.portfolio_summary", ("final.loan_portfolio",), lambda t: portfolio_summary(t["final.loan_portfolio"])),
    )


def balance_by_source(layers: Mapping[str, DataFrame], tables: Mapping[str, str]) -> DataFrame:
    """Rows and readable balance per layer and source; text that is not a number counts as 0."""
    parts = []
    for layer, table in tables.items():
        df = layers[table]
        amount = to_double("balance", df.schema["balance"].dataType)
        totals = df.groupBy("source_system").agg(*exprs(
            "count(*) AS loans", f"round(coalesce(sum({amount}), 0.0D), 2) AS balance"))
        parts.append(totals.selectExpr(f"'{layer}' AS layer", "source_system", "loans", "balance"))
    return reduce(DataFrame.unionByName, parts)


def pivot_by_layer(by_source: DataFrame, value: str, layer_names: list[str], sources: list[str]) -> DataFrame:
    """One row per listed source, one column per layer, both in a fixed order; a missing cell stays NULL."""
    frame = local_frame(by_source.sparkSession, enumerate(sources), "position int, source_system string")
    cells = by_source.groupBy("source_system").pivot("layer", layer_names).agg({value: "first"})
    return frame.join(cells, "source_system", "left").orderBy("position").select("source_system", *layer_names)
