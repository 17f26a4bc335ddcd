"""What depends on what: the closure of lineage edges as a recursive query."""

from __future__ import annotations

from pyspark.sql import DataFrame

DEEPEST = 10_000  # levels


def closure(edges: DataFrame) -> DataFrame:
    """``src_table``, ``dst_table`` and ``depth``, the length of the shortest way, for every table that is made from another, directly
    or not. ``edges`` has ``src_table`` and ``dst_table``; edges of several columns count once.

    A table that is made from itself, over any number of steps, fails the query with ``lineage cycle``.
    """
    pairs = edges.select("src_table", "dst_table").distinct()
    return edges.sparkSession.sql(f"""
        WITH RECURSIVE reach(src_table, dst_table, depth) MAX RECURSION LEVEL {DEEPEST} AS (
            SELECT src_table, dst_table,
              CASE WHEN src_table = dst_table THEN raise_error(concat('lineage cycle through ', src_table)) ELSE 1 END
            FROM {{pairs}}
            UNION ALL
            SELECT r.src_table, e.dst_table,
              CASE WHEN e.dst_table = r.src_table THEN raise_error(concat('lineage cycle through ', r.src_table)) ELSE r.depth + 1 END
            FROM reach r JOIN {{pairs}} e ON e.src_table = r.dst_table)
        SELECT src_table, dst_table, min(depth) AS depth
        FROM reach GROUP BY src_table, dst_table""", pairs=pairs)
