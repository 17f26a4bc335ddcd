"""Normalisation, coercion and formatting as Spark SQL expressions.

The same helper is used on both sides of every comparison, so a value cannot be "clean" in one layer and
"dirty" in another merely because two engines trim or parse differently. Expressions are SQL text: wide tables
need hundreds of them, and one text per expression is far quicker to hand to Spark than a tree of column objects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as a number in text. Narrower than a plain cast, which would also take '1d' or 'infinity'.
NUMERAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def exprs(*texts: str) -> list[Column]:
    """SQL expressions as columns, for ``agg``."""
    return [F.expr(t) for t in texts]


def name(column: str) -> str:
    """A column by its exact name, dots and blanks included."""
    return "`" + column.replace("`", "``") + "`"


def lit(text: str | None) -> str:
    """A text constant."""
    if text is None:
        return "cast(null AS string)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The characters that count as whitespace, beyond ASCII too.
BLANKS = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
          0x205F, 0x3000]
_BLANKS = "'" + "".join(f"\\u{c:04x}" for c in BLANKS) + "'"


def strip(e: str) -> str:
    """Drop leading and trailing whitespace of every kind (``trim`` only drops spaces)."""
    return f"btrim({e}, {_BLANKS})"


def normalise_code(e: str) -> str:
    return f"upper({strip(e)})"


def to_double(e: str, dtype: T.DataType) -> str:
    """Number or NULL, never an error."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return f"cast({e} AS double)"
    if isinstance(dtype, T.StringType):
        return f"CASE WHEN {strip(e)} RLIKE r'{NUMERAL}' THEN try_cast({strip(e)} AS double) END"
    return "cast(null AS double)"


def to_long(e: str, dtype: T.DataType) -> str:
    """Whole number or NULL. ``'720.0'`` is whole, ``'720.5'`` is not."""
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return f"cast({e} AS bigint)"
    number = to_double(e, dtype)
    whole = f"CASE WHEN ({number}) = floor({number}) THEN try_cast({number} AS bigint) END"
    if isinstance(dtype, T.StringType):
        return f"coalesce(CASE WHEN {strip(e)} RLIKE r'{NUMERAL}' THEN try_cast({strip(e)} AS bigint) END, {whole})"
    return whole


def to_strict_timestamp(e: str) -> str:
    """The one strict coercion: a malformed date fails the job, under ANSI rules and without."""
    fails = f"cast(raise_error(concat('not a date: ', cast({e} AS string))) AS timestamp_ntz)"
    return f"coalesce(try_cast({e} AS timestamp_ntz), CASE WHEN {e} IS NOT NULL THEN {fails} END)"


def currency_to_double(e: str, dtype: T.DataType) -> str:
    """The amount a formatted text such as ``$12,345.67`` was meant to be."""
    if isinstance(dtype, T.StringType):
        return to_double(f"translate({e}, '$,', '')", dtype)
    return to_double(e, dtype)


def percent_of(part: str, whole: str, digits: int) -> str:
    """Rounded share in percent, 0 for an empty whole."""
    return f"CASE WHEN {whole} <> 0 THEN round(100.0D * ({part}) / ({whole}), {digits}) ELSE 0.0D END"


def comma_int(e: str) -> str:
    return f"format_number({e}, 0)"


def money2(e: str) -> str:
    return f"format_number({e}, 2)"


def json_list(e: str) -> str:
    """An array of strings in JSON notation, with a blank after each comma."""
    escaped = f"transform({e}, x -> replace(replace(x, '\\\\', '\\\\\\\\'), '\"', '\\\\\"'))"
    return f"concat('[\"', array_join({escaped}, '\", \"'), '\"]')"
