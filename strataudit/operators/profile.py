"""Column profiles: counts, nulls, distinct values, minimum, maximum and sum of every column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strataudit.config import TECHNICAL_COLUMNS, AuditConfig
from strataudit.functions import exprs, is_numeric, is_temporal, lit, name, percent_of, type_label
from strataudit.sources.local import local_frame


def surplus_keys(keys: Sequence[str]) -> str:
    """Aggregate: rows minus distinct keys. A missing single key counts as surplus; a key of several columns is
    compared as a whole, so one with a missing part still counts as a value."""
    key = name(keys[0]) if len(keys) == 1 else f"struct({', '.join(map(name, keys))})"
    return f"count(*) - count(DISTINCT {key})"


def _fields(df: DataFrame) -> list[tuple[int, T.StructField]]:
    return list(enumerate(f for f in df.schema.fields if f.name not in TECHNICAL_COLUMNS))


# ---------------------------------------------------------------- exact: each column read once, one shuffle

# Columns are profiled together with the others of their family, in the family's own type.
FAMILIES = {"text": "string", "decimal": "string", "number": "double", "whole": "bigint", "moment": "timestamp_ntz"}
AS_NUMBER = {"number": "v", "whole": "cast(v AS double)", "decimal": "cast(v AS double)"}


def _value(e: str, dtype: T.DataType) -> tuple[str, str]:
    """Family of a column and its value in the type of that family."""
    match dtype:
        case T.DoubleType() | T.FloatType():
            return "number", f"cast({e} AS double)"
        case T.ByteType() | T.ShortType() | T.IntegerType() | T.LongType() | T.BooleanType():
            return "whole", f"cast({e} AS bigint)"
        case T.DateType() | T.TimestampNTZType():
            return "moment", f"cast({e} AS timestamp_ntz)"
        case T.TimestampType():
            return "whole", f"unix_micros({e})"
        case T.DecimalType():
            return "decimal", f"cast({e} AS string)"
        case T.BinaryType():
            return "text", f"hex({e})"
        case T.ArrayType() | T.MapType() | T.StructType():
            return "text", f"CASE WHEN {e} IS NOT NULL THEN to_json(struct({e} AS v)) END"
        case _:
            return "text", f"cast({e} AS string)"


def _folded(values: DataFrame, family: str) -> DataFrame:
    """Count equal values, then fold the distinct ones: (item, row_count, null_count, distinct_count, ...).

    Tasks count before they shuffle, so a frequent value costs one row per task, and what is shuffled is one
    row of item and value per distinct value. A plain aggregate with several distincts would carry every column
    along in every copy of a row.
    """
    number = AS_NUMBER.get(family, "cast(null AS double)")
    whole = "v" if family == "whole" else "cast(null AS bigint)"
    moment = "v" if family == "moment" else "cast(null AS timestamp_ntz)"
    return values.groupBy("item", "v").count().groupBy("item").agg(*exprs(
        "sum(count) AS row_count", "sum(CASE WHEN v IS NULL THEN count ELSE 0L END) AS null_count",
        "count(v) AS distinct_count",
        f"min({number}) AS low", f"max({number}) AS high", f"sum({number} * count) AS total",
        f"min({whole}) AS low_whole", f"max({whole}) AS high_whole",
        f"min({moment}) AS low_moment", f"max({moment}) AS high_moment"))


def _whole_key(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """Rows and distinct values of a key of several columns."""
    counted = df.groupBy(*map(name, keys)).count().agg(*exprs(
        "sum(count) AS row_count", "count(*) AS distinct_count"))
    empty = [f"cast(null AS {t}) AS {p}{s}" for s, t in (("", "double"), ("_whole", "bigint"), ("_moment", "timestamp_ntz"))
             for p in ("low", "high")]
    return counted.selectExpr(f"{lit(item)} AS item", "row_count", "0L AS null_count", "distinct_count",
                              "cast(null AS double) AS total", *empty)


def _number(e: str) -> str:
    return f"CASE WHEN is_number AND NOT isnan({e}) THEN {e} END"


def _moment(moment: str, micros: str) -> str:
    return (f"CASE dtype WHEN 'DATE' THEN cast(cast({moment} AS date) AS string) WHEN 'TIMESTAMP' THEN "
            f"coalesce(cast({moment} AS string), cast(timestamp_micros({micros}) AS string)) END")


def profile_tables(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Exact profiles of several tables ``(name, frame, key columns)`` at (table, column) grain.

    Every column is read once, by the scan of its family; the families are shuffled and folded side by side in
    one job. An empty table has no values at all and still gets its columns.
    """
    labels, families, folded = [], {}, []
    for t, (table, df, keys) in enumerate(tables):
        items: dict[str, list[str]] = {}
        for i, f in _fields(df):
            family, value = _value(name(f.name), f.dataType)
            items.setdefault(family, []).append(f"{value} AS `{t}.{i}`")
            labels.append((f"{t}.{i}", table, i, f.name, type_label(f.dataType), is_numeric(f.dataType), (f.name,) == tuple(keys)))
        for family, values in items.items():
            # a plain projection of the family's columns, turned into rows
            families.setdefault(family, []).append(df.selectExpr(*values).unpivot(
                [], [name(v.rsplit("`", 2)[1]) for v in values], "item", "v"))
        if len(keys) > 1:
            labels.append((f"{t}.key", table, None, None, None, False, True))
            folded.append(_whole_key(df, keys, f"{t}.key"))
    folded += [_folded(reduce(DataFrame.unionByName, parts), family) for family, parts in families.items()]
    frame = local_frame(tables[0][1].sparkSession, labels,
                        "item string, table string, column_idx int, column string, dtype string, is_number boolean, "
                        "is_key boolean")
    rows, distinct = "coalesce(row_count, 0L)", "coalesce(distinct_count, 0L)"
    # the window spans one row per column of a table, never its data
    surplus = f"max(CASE WHEN is_key THEN {rows} - {distinct} END) OVER (PARTITION BY table)"
    surplus = f"coalesce({surplus}, 0L)"  # no key, no surplus
    measured = frame.join(reduce(DataFrame.unionByName, folded), "item", "left")
    return measured.selectExpr("*", f"{surplus} AS duplicate_keys").filter("column IS NOT NULL").selectExpr(
        "table", "column_idx", "column", "dtype", f"{rows} AS row_count", "coalesce(null_count, 0L) AS null_count",
        percent_of("coalesce(null_count, 0L)", rows, 2) + " AS null_pct", f"{distinct} AS distinct_count",
        _number("low") + " AS min_value", _number("high") + " AS max_value",
        f"round({_number('total')}, 2) AS sum_value",
        _moment("low_moment", "low_whole") + " AS min_text", _moment("high_moment", "high_whole") + " AS max_text",
        "duplicate_keys")


# ---------------------------------------------------------------- estimated distinct counts: one pass, no shuffle

def _estimate_table(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    aggregates, rows = ["count(*) AS row_count", f"{surplus_keys(keys) if keys else '0L'} AS duplicate_keys"], []
    for i, f in _fields(df):
        c = name(f.name)
        low = high = total = "cast(null AS double)"
        low_text = high_text = "cast(null AS string)"
        aggregates += [f"count({c}) AS filled_{i}", f"approx_count_distinct({c}) AS distinct_{i}"]
        if is_numeric(f.dataType) or is_temporal(f.dataType):
            aggregates += [f"min({c}) AS low_{i}", f"max({c}) AS high_{i}"]
        if is_numeric(f.dataType):
            aggregates.append(f"sum(cast({c} AS double)) AS total_{i}")
            low, high, total = (f"CASE WHEN NOT isnan({p}_{i}) THEN cast({p}_{i} AS double) END"
                                for p in ("low", "high", "total"))
        elif is_temporal(f.dataType):
            low_text, high_text = f"cast(low_{i} AS string)", f"cast(high_{i} AS string)"
        nulls = f"row_count - filled_{i}"
        rows.append(f"struct({i} AS column_idx, {lit(f.name)} AS column, {lit(type_label(f.dataType))} AS dtype, "
                    f"row_count, {nulls} AS null_count, {percent_of(nulls, 'row_count', 2)} AS null_pct, "
                    f"distinct_{i} AS distinct_count, {low} AS min_value, {high} AS max_value, "
                    f"round({total}, 2) AS sum_value, {low_text} AS min_text, {high_text} AS max_text, duplicate_keys)")
    return df.agg(*exprs(*aggregates)).selectExpr(f"{lit(table)} AS table", f"inline(array({', '.join(rows)}))")


def _scanned_table(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a scan without a shuffle tells: everything but distinct counts and surplus keys."""
    aggregates, rows = ["count(*) AS row_count"], []
    for i, f in _fields(df):
        c = name(f.name)
        low = high = total = "cast(null AS double)"
        low_text = high_text = "cast(null AS string)"
        aggregates.append(f"count({c}) AS filled_{i}")
        if is_numeric(f.dataType) or is_temporal(f.dataType):
            aggregates += [f"min({c}) AS low_{i}", f"max({c}) AS high_{i}"]
        if is_numeric(f.dataType):
            aggregates.append(f"sum(cast({c} AS double)) AS total_{i}")
            low, high, total = (f"CASE WHEN NOT isnan({p}_{i}) THEN cast({p}_{i} AS double) END" for p in ("low", "high", "total"))
        elif is_temporal(f.dataType):
            low_text, high_text = f"cast(low_{i} AS string)", f"cast(high_{i} AS string)"
        nulls = f"row_count - filled_{i}"
        rows.append(f"struct({i} AS column_idx, {lit(f.name)} AS column, {lit(type_label(f.dataType))} AS dtype, "
                    f"row_count, {nulls} AS null_count, {percent_of(nulls, 'row_count', 2)} AS null_pct, "
                    f"cast(null AS bigint) AS distinct_count, {low} AS min_value, {high} AS max_value, "
                    f"round({total}, 2) AS sum_value, {low_text} AS min_text, {high_text} AS max_text)")
    return df.agg(*exprs(*aggregates)).selectExpr(f"{lit(table)} AS table", f"inline(array({', '.join(rows)}))")


def _surplus_of(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Surplus keys of a table, from its key columns alone, counted before they are shuffled."""
    present = f"count({name(keys[0])})" if len(keys) == 1 else "count(*)"
    return df.groupBy(*map(name, keys)).count().agg(*exprs(f"coalesce(sum(count), 0L) - {present} AS duplicate_keys")).selectExpr(
        f"{lit(table)} AS table", "duplicate_keys")


def scan_tables(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Profiles without distinct counts: one scan of each table without a shuffle, and its key columns for the surplus keys."""
    scanned = reduce(DataFrame.unionByName, [_scanned_table(*t) for t in tables])
    keyed = [_surplus_of(*t) for t in tables if t[2]]
    if not keyed:
        return scanned.selectExpr("*", "0L AS duplicate_keys")
    return scanned.join(reduce(DataFrame.unionByName, keyed), "table", "left").selectExpr(
        *scanned.columns, "coalesce(duplicate_keys, 0L) AS duplicate_keys")


def profile_layers(layers: Mapping[str, DataFrame], cfg: AuditConfig, run_id: str = "adhoc",
                   distinct: str = "exact") -> DataFrame:
    """Profiles of every contract table, at (run, table, column) grain.

    ``distinct="approx"`` estimates the distinct counts of the columns, ``"none"`` leaves them out (NULL), which spares all shuffles
    but those of the keys; surplus keys are always exact.
    """
    has = {c.name: set(layers[c.name].columns) for c in cfg.contracts}
    tables = [(c.name, layers[c.name], c.keys if has[c.name].issuperset(c.keys) else ()) for c in cfg.contracts]
    if distinct == "none":
        profiled = scan_tables(tables)
    elif distinct == "approx":
        profiled = reduce(DataFrame.unionByName, [_estimate_table(*t) for t in tables])
    else:
        profiled = profile_tables(tables)
    return profiled.selectExpr(f"{lit(run_id)} AS run_id", "split_part(table, '.', 1) AS layer", "*")


def table_profiles(profiles: DataFrame) -> DataFrame:
    """Row count and surplus keys at (run, table) grain."""
    return profiles.groupBy("run_id", "layer", "table").agg(*exprs(
        "max(row_count) AS row_count", "max(duplicate_keys) AS duplicate_keys"))


def schema_scan(df: DataFrame) -> DataFrame:
    """Position, name and type of each column; reads no data."""
    rows = [(i, f.name, type_label(f.dataType)) for i, f in _fields(df)]
    return local_frame(df.sparkSession, rows, "position int, column string, dtype string")


def column_grid(profiles: DataFrame) -> DataFrame:
    """The readable columns of a profile, minimum and maximum as text."""
    return profiles.selectExpr(
        "run_id", "table", "column", "dtype", "null_pct", "distinct_count",
        "coalesce(format_number(min_value, 2), min_text, '') AS min",
        "coalesce(format_number(max_value, 2), max_text, '') AS max")
