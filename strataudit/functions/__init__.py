"""Expressions shared by every operator; all of them stay inside the JVM."""

from strataudit.functions.sql import (
    comma_int,
    currency_to_double,
    exprs,
    json_list,
    lit,
    money2,
    name,
    normalise_code,
    percent_of,
    strip,
    to_double,
    to_long,
    to_strict_timestamp,
)
from strataudit.functions.types import is_numeric, is_temporal, type_label

__all__ = [
    "comma_int", "currency_to_double", "exprs", "is_numeric", "is_temporal", "json_list", "lit", "money2",
    "name", "normalise_code", "percent_of", "strip", "to_double", "to_long", "to_strict_timestamp", "type_label",
]
