"""Queries that explain a problem: which segment, which rows, which keys.

Everything that could grow with the data stays a DataFrame; only at most three sample values and single-row
totals are meant for a finding.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataudit.config import TECHNICAL_COLUMNS
from strataudit.functions import exprs, lit, name, percent_of, strip, to_double

SAMPLES = 3
PARTS, SALTS = 200, 16  # tasks that count keys (Spark writes to up to 200 without a sort in memory), and how many of them share a key's rows at first


def failed_cast(column: str, dtype) -> str:
    """Condition: a value is there, but it is not a number."""
    return f"(({to_double(name(column), dtype)}) IS NULL AND {name(column)} IS NOT NULL)"


def _segment(segment: str | None) -> str:
    return f"cast({name(segment)} AS string)" if segment else "cast(null AS string)"


def segment_counts(df: DataFrame, segment: str | None, flags: Mapping[str, str]) -> DataFrame:
    """Rows and affected rows per segment, for several conditions in one scan: (item, segment, rows, affected)."""
    wide = df.selectExpr(f"{_segment(segment)} AS segment", *[f"{c} AS f{i}" for i, c in enumerate(flags.values())])
    counted = wide.groupBy("segment").agg(*exprs(
        "count(*) AS rows", *[f"count_if(f{i}) AS a{i}" for i in range(len(flags))]))
    rows = ", ".join(f"struct({lit(item)} AS item, a{i} AS affected)" for i, item in enumerate(flags))
    return counted.selectExpr("segment", "rows", f"inline(array({rows}))").selectExpr(
        "item", "segment", "rows", "affected", percent_of("affected", "rows", 1) + " AS affected_pct")


def sole_segment(affected: str, column: str) -> str:
    """Aggregate over ``segment``: names it if exactly one is affected, otherwise NULL."""
    return (f"CASE WHEN count_if({affected} > 0) = 1 THEN concat({lit(column + ' = ')}, \"'\", "
            f"max(CASE WHEN {affected} > 0 THEN coalesce(segment, 'None') END), \"'\") END")


def smallest_values(df: DataFrame, column: str, n: int = SAMPLES) -> DataFrame:
    """The ``n`` smallest distinct values; each task keeps only ``n`` of them."""
    return df.selectExpr(f"cast({name(column)} AS string) AS value").distinct().orderBy("value").limit(n)


# ---------------------------------------------------------------- duplicates

def duplicate_keys(df: DataFrame, keys: Sequence[str], date_column: str | None = None) -> DataFrame:
    """Keys that occur more than once, with their row count and one date each."""
    date = [f"min({name(date_column)}) AS first_date"] if date_column else []
    return df.groupBy(*map(name, keys)).agg(*exprs("count(*) AS copies", *date)).filter("copies > 1")


def duplicate_span(duplicates: DataFrame) -> DataFrame:
    """Number of duplicated keys and the dates between which they lie."""
    return duplicates.agg(*exprs(
        "count(*) AS duplicated_keys", "cast(cast(min(first_date) AS date) AS string) AS date_from",
        "cast(cast(max(first_date) AS date) AS string) AS date_to"))


def row_fingerprint(columns: Sequence[str]) -> list[str]:
    """Two 64-bit hashes of a row, which make a 128-bit fingerprint. A hash skips NULL, so which values are NULL goes in as a value of its own."""
    missing = f"concat({', '.join(f'cast({name(c)} IS NULL AS int)' for c in columns)})"
    values = ", ".join(map(name, columns))
    return [f"xxhash64({missing}, {values}) AS _h0", f"xxhash64({values}, {missing}, 1) AS _h1"]


def counted_rows(df: DataFrame, keys: Sequence[str], segment: str | None = None, date_column: str | None = None) -> DataFrame:
    """How often each different row occurs: keys ``_k0``, ..., ``segment``, the row's fingerprint, ``rows`` and ``first_date``.

    All figures about repeated keys are read off this frame. The table is exchanged once, as narrow rows that are counted before they
    move: the copies of a row leave a task as one, and different rows of a key that holds a third of the table go to different tasks.
    """
    columns = [c for c in df.columns if c not in TECHNICAL_COLUMNS]
    narrow = df.selectExpr(*[f"{name(k)} AS _k{i}" for i, k in enumerate(keys)], f"{_segment(segment)} AS segment",
                           f"{name(date_column) if date_column else 'cast(null AS date)'} AS _date", *row_fingerprint(columns))
    return narrow.groupBy(*_keys(keys), "segment", "_h0", "_h1").agg(*exprs("count(*) AS rows", "min(_date) AS first_date"))


def key_rows(df: DataFrame, keys: Sequence[str], segment: str | None = None) -> DataFrame:
    """What ``surplus_among`` needs of a table: keys ``_k0``, ..., ``segment`` and ``rows``, which is 1. It reads no other column."""
    return df.selectExpr(*[f"{name(k)} AS _k{i}" for i, k in enumerate(keys)], f"{_segment(segment)} AS segment", "1L AS rows")


def _keys(keys: Sequence[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(keys))]


def copies_among(counted: DataFrame) -> DataFrame:
    """How many rows repeat another row in every column."""
    return counted.agg(*exprs("coalesce(sum(rows - 1), 0L) AS exact_copies"))


def repeated_among(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count and their first date."""
    return counted.groupBy(*_keys(keys)).agg(*exprs("sum(rows) AS copies", "min(first_date) AS first_date")).filter("copies > 1")


def surplus_among(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Surplus keys per segment, counted per (segment, key) first, so that a dominant segment stays spread out."""
    per_key = counted.groupBy("segment", *_keys(keys)).agg(*exprs("sum(rows) AS rows"))
    present = "_k0 IS NOT NULL" if len(keys) == 1 else "true"
    return per_key.groupBy("segment").agg(*exprs(f"sum(rows) - count_if({present}) AS extra_rows"))


def exact_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows repeat another row in every column. Rows go by their keys and a 128-bit fingerprint."""
    return copies_among(counted_rows(df, keys))


def surplus_by_segment(df: DataFrame, keys: Sequence[str], segment: str | None) -> DataFrame:
    """Surplus keys per segment, from the key columns alone.

    Nearly every key is a group of its own, so a task's memory goes by the keys it is dealt. They are dealt to a fixed, large number of tasks, which
    adaptive execution does not draw together; the rows of one key go to several tasks first, so that a key with a third of the table is no obstacle.
    """
    by = ["segment", *_keys(keys)]
    columns = df.selectExpr(f"{_segment(segment)} AS segment", *[f"{name(k)} AS _k{i}" for i, k in enumerate(keys)],
                            f"spark_partition_id() % {SALTS} AS _salt")
    salted = columns.repartition(PARTS, *by, "_salt").groupBy(*by, "_salt").agg(*exprs("count(*) AS rows"))
    return surplus_among(salted.repartition(PARTS, *by), keys)


# ---------------------------------------------------------------- orphans

def orphan_rows(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no match; a missing key has none."""
    return df.join(reference.select(name(key)), key, "left_anti")


def orphan_keys(df: DataFrame, reference: DataFrame, key: str, segment: str | None) -> DataFrame:
    """Unmatched keys per segment with their row counts: (key, segment, unmatched_rows).

    Rows are counted per key before the join, so a key held by a third of the rows joins as one row. Where the reference is small enough
    to be sent to all tasks, the optimizer may join first: that moves no row of ``df``, and what it counts then are the unmatched rows only.
    """
    counted = df.selectExpr(name(key), f"{_segment(segment)} AS segment").groupBy(name(key), "segment").agg(
        *exprs("count(*) AS unmatched_rows"))
    return counted.join(reference.select(name(key)), key, "left_anti")


def modal_length(reference: DataFrame, key: str) -> DataFrame:
    """The most frequent key length, the shortest of equals."""
    lengths = reference.filter(f"{name(key)} IS NOT NULL").selectExpr(f"length({name(key)}) AS key_length")
    return lengths.groupBy("key_length").count().orderBy(F.desc("count"), "key_length").limit(1).select("key_length")


def zero_padded_matches(orphans: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Orphan keys that would match if they were padded with zeros to the usual key length."""
    length = modal_length(reference, key).scalar()
    padded = orphans.withColumn("_padded", F.lpad(F.col(name(key)), length, F.lit("0")))
    return padded.join(reference.selectExpr(f"{name(key)} AS _padded"), "_padded", "left_semi").drop("_padded")


def lost_groups(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that no longer occur afterwards."""
    return before.select(name(column)).subtract(after.select(name(column)))


# ---------------------------------------------------------------- changed keys

PADDED = "lpad(low, length(raw_id), '0') = raw_id"


def changed_keys(before: DataFrame, after: DataFrame, row_key: str, column: str, segment: str | None,
                 unique_before: bool = False, unique_after: bool = False) -> DataFrame:
    """Keys that differ between two layers for the same row, counted without pairing rows up.

    One row per distinct (row key, key before, segment) whose row still exists afterwards: ``changed`` is the
    number of distinct later keys that differ from it, ``padded`` how many of those give the earlier key back
    when padded with zeros, ``staged_id`` the smallest differing one.

    A row key normally has one later key, and then a single join decides. Where a row key has several, the
    differing ones are counted as "all minus equal" and the padded ones are found by equality, so that no two sets of keys of one row are ever multiplied. Where a profile has shown that row keys
    are unique, say so: the side then goes into the join as it is, without a shuffle of its own.
    """
    r = before.selectExpr(f"{name(row_key)} AS row_key", f"{strip(f'cast({name(column)} AS string)')} AS raw_id",
                          f"{_segment(segment)} AS segment").filter("raw_id IS NOT NULL")
    s = after.selectExpr(f"{name(row_key)} AS row_key", f"cast({name(column)} AS string) AS stg_id").filter(
        "stg_id IS NOT NULL")
    r = r if unique_before else r.distinct()
    if unique_after:
        return _changed_singly(r.join(s.selectExpr("row_key", "stg_id AS low"), "row_key"))
    s = s.distinct()
    per_row = s.groupBy("row_key").agg(*exprs(
        "count(*) AS staged", "min(stg_id) AS low", "max(stg_id) AS high"))
    single = r.join(per_row.filter("staged = 1"), "row_key")
    several = per_row.filter("staged > 1")
    return _changed_singly(single).unionByName(_changed_among_several(r, s, several))


def _changed_singly(joined: DataFrame) -> DataFrame:
    return joined.filter("raw_id <> low").selectExpr(
        "row_key", "raw_id", "segment", "1L AS changed", f"cast({PADDED} AS bigint) AS padded", "low AS staged_id")


def _changed_among_several(r: DataFrame, s: DataFrame, per_row: DataFrame) -> DataFrame:
    joined = r.join(per_row, "row_key")
    several = s.join(per_row.select("row_key"), "row_key", "left_semi")
    equal = several.selectExpr("row_key", "stg_id AS raw_id", "1L AS same")
    ids = joined.select("row_key", "raw_id").distinct()
    # staged = raw without some of its leading zeros: the rest after all zeros is the same
    rest = "ltrim('0', {0}) AS rest"
    by_zeros = ids.selectExpr("row_key", "raw_id", rest.format("raw_id")).join(
        several.selectExpr("row_key", "stg_id", rest.format("stg_id")), ["row_key", "rest"]).filter(
        "length(stg_id) < length(raw_id) AND lpad(stg_id, length(raw_id), '0') = raw_id").selectExpr("row_key", "raw_id")
    # staged = raw with something appended: padding to a shorter length, of those that occur, cuts it off
    lengths = ids.selectExpr("row_key", "length(raw_id) AS n").distinct()
    longer = several.join(lengths, "row_key").filter("length(stg_id) > n").selectExpr("row_key", "substr(stg_id, 1, n) AS raw_id").join(
        ids, ["row_key", "raw_id"], "left_semi")
    padded = by_zeros.unionByName(longer).groupBy("row_key", "raw_id").agg(*exprs("count(*) AS padded"))
    return (joined.join(equal, ["row_key", "raw_id"], "left").join(padded, ["row_key", "raw_id"], "left")
            .selectExpr("row_key", "raw_id", "segment", "staged - coalesce(same, 0L) AS changed",
                        "coalesce(padded, 0L) AS padded", "CASE WHEN low <> raw_id THEN low ELSE high END AS staged_id"))


def changed_key_examples(changed: DataFrame, n: int = SAMPLES) -> DataFrame:
    """The ``n`` smallest distinct changes, written ``'before' -> 'after'``."""
    pairs = changed.select("raw_id", "staged_id").distinct().orderBy("raw_id", "staged_id").limit(n)
    return pairs.selectExpr("""concat("'", raw_id, "' -> '", staged_id, "'") AS value""")
