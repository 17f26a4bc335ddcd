"""A fixed-size set of 64-bit hashes for workers: it may hold hashes that were not put in, never the reverse."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataudit.llm.common import column_type, kept

BITS = 1 << 25  # 4 MB
SHIFTS = (0, 19, 38)  # a hash marks the bits that its 25 bits from each of these on name
_PAGE = 8 * 4096  # bits in a row of Spark's bitmap functions


def marked(hashes: DataFrame, column: str, size: int = BITS) -> np.ndarray:
    """Bytes of the set of all hashes in a bigint column. Bits are gathered by partial aggregates; what reaches the
    driver is a page per 32,768 bits, 4 MB in all, however many hashes there are."""
    bits = F.array(*[F.shiftrightunsigned(column, s).bitwiseAND(size - 1) for s in SHIFTS])
    at = hashes.where(F.col(column).isNotNull()).select(F.explode(bits).alias("bit"))
    page, bit = F.floor(F.col("bit") / _PAGE).cast("int"), F.pmod("bit", F.lit(_PAGE))
    out = np.zeros(size // 8, np.uint8)
    for row in at.groupBy(page.alias("page")).agg(F.bitmap_construct_agg(bit).alias("bits")).collect():
        out[row["page"] * 4096:(row["page"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def among(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the set."""
    hashes, some = hashes.view(np.uint64), None
    for shift in SHIFTS:  # most hashes fail the first probe
        bit = (((hashes if some is None else hashes[some]) >> np.uint64(shift)) & np.uint64(8 * len(marks) - 1)).view(np.int64)
        hit = np.flatnonzero((marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
        some = hit if some is None else some[hit]
    there = np.zeros(len(hashes), bool)
    there[some] = True
    return there


def level_hash(column: str, level: int) -> Column:
    """The hash of an id that level ``level`` of ``told_apart`` goes by."""
    return F.xxhash64(column, F.lit(level))


def told_apart(members: DataFrame, others: DataFrame, column: str, size: int = BITS) -> list[np.ndarray]:
    """Sets that tell ``members`` from ``others``, two frames of different ids, without an error: the first set holds the members, the second those of
    the others that the first would let pass, the third the members that the second would, and so on until nobody passes wrongly."""
    within, without, out = members, others, []
    while True:
        level = len(out)
        out.append(marked(within.select(level_hash(column, level).alias("h")), "h", size))
        shared = members.sparkSession.sparkContext.broadcast(out[-1])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(among(shared.value, batch.column("h").to_numpy(zero_copy_only=False)))).select([column])

        wrong = kept(without.select(column, level_hash(column, level).alias("h")).mapInArrow(run, f"`{column}` {column_type(members, column)}"))
        if wrong.isEmpty():
            return out
        within, without = wrong, within


def is_member(sets: list[np.ndarray], hashes: list[np.ndarray]) -> np.ndarray:
    """Whether each id is a member, by its hashes of all levels: those are that pass an odd number of sets before one stops them."""
    inside, odd = np.ones(len(hashes[0]), bool), np.zeros(len(hashes[0]), bool)
    for marks, h in zip(sets, hashes, strict=True):
        inside = inside & among(marks, h)
        odd ^= inside
    return odd
