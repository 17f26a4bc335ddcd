"""Near-duplicate documents: SimHash fingerprints linked through the anchors of a covering code."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataudit.llm.common import column_type, kept, utf8, written
from strataudit.llm.graph import components

SEED = 42
STEP = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a text: bit i is 1 if it is set in over half the hashes of its shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    ends, starts = ends[shingle - 1:], starts[: len(words) - shingle + 1]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(ends), STEP):
        pairs = zip(starts[at:at + STEP].tolist(), ends[at:at + STEP].tolist(), strict=True)
        hashes = np.array([digest(line[s:e], SEED) for s, e in pairs], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``id_col`` and ``fp``, the 64 bits as a bigint, for every row.

    Words are runs of non-blank characters with A-Z lower-cased; a text with fewer words than a shingle is one
    shingle, a null text or one without words has fingerprint 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, shingle) for x in utf8(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {column_type(docs, id_col)}, fp bigint")


class Anchors:
    """A covering code for 64-bit fingerprints, made of one code for each block of bits.

    A block's code is a Hamming code, whose balls of radius 1 fill its space, and whatever bits are left over. So each
    block lies within 1 of exactly one anchor, its home. Two fingerprints that differ in at most ``distance`` bits
    differ in at most ``distance // blocks`` of some block: there, one is within 1 + that many bits of the other's home.
    """

    def __init__(self, distance: int, blocks: int) -> None:
        self.distance, self.within = distance, distance // blocks
        base, extra = divmod(64, blocks)
        self.blocks = [(i * base + min(i, extra), base + (i < extra)) for i in range(blocks)]

    def _code(self, width: int) -> tuple[int, int]:
        checks = (width + 1).bit_length() - 1
        return checks, (1 << checks) - 1

    def _syndrome(self, block: str, width: int) -> str:
        checks, length = self._code(width)
        rows = [sum(1 << j for j in range(length) if (j + 1) >> b & 1) for b in range(checks)]
        return " + ".join(f"shiftleft(bit_count({block} & {row}L) % 2, {b})" for b, row in enumerate(rows))

    def _errors(self, width: int, weight: int) -> list[list[int]]:
        """By syndrome: the patterns of up to ``weight`` bits that lead from a word with it to an anchor."""
        checks, length = self._code(width)
        found: list[list[int]] = [[] for _ in range(1 << checks)]
        for n in range(weight + 1):
            for bits in combinations(range(width), n):
                syndrome = 0
                for j in bits:
                    syndrome ^= j + 1 if j < length else 0
                found[syndrome].append(sum(1 << j for j in bits))
        return found

    def keys(self, fp: str, weight: int | None = None) -> str:
        """SQL array of the keys of all anchors within ``weight`` bits of a block of ``fp``, or of each block's home
        alone; the key names the block."""
        arrays = []
        for i, (at, width) in enumerate(self.blocks):
            block = f"(shiftrightunsigned({fp}, {at}) & {(1 << width) - 1}L)"
            rows = [row[:1] for row in self._errors(width, 1)] if weight is None else self._errors(width, weight)
            masks = ", ".join("array(" + ", ".join(f"{m}L" for m in row) + ")" for row in rows)
            arrays.append(f"transform(get(array({masks}), cast({self._syndrome(block, width)} as int)), "
                          f"m -> ({block} ^ m) | {i << 40}L)")
        return f"concat({', '.join(arrays)})"

    def first_meeting(self, x: str, y: str, key: str) -> str:
        """True in the first block in which the two differ by no more than some block must, so that each pair counts once."""
        apart = [f"bit_count(({x} ^ {y}) & {self._signed(((1 << w) - 1) << at)}L)" for at, w in self.blocks]
        cases = [" AND ".join([f"{apart[i]} <= {self.within}", *(f"{d} > {self.within}" for d in apart[:i])]) for i in range(len(apart))]
        return f"CASE shiftright({key}, 40) {' '.join(f'WHEN {i} THEN {c}' for i, c in enumerate(cases))} END"

    @staticmethod
    def _signed(mask: int) -> int:
        return mask - (1 << 64) if mask >> 63 else mask


def links(fps: DataFrame, distance: int = 4, blocks: int = 3) -> DataFrame:
    """Pairs ``a < b`` of different fingerprints (column ``fp``, repeats allowed) at most ``distance`` bits apart.

    Each fingerprint is copied to every anchor within the covering radius plus the bits it may differ by, and compared
    at an anchor with those whose home it is. ``blocks`` trades copies for comparisons: 3 makes about 44 copies, 2
    about 340 copies and a hundredth of the comparisons, for billions of different fingerprints. No pair is missed.
    """
    code = Anchors(distance, blocks)
    fps = fps.select("fp").where("fp is not null").distinct()
    home = fps.select(F.explode(F.expr(code.keys("fp"))).alias("key"), F.col("fp").alias("a"))
    near = fps.select(F.explode(F.expr(code.keys("fp", 1 + code.within))).alias("key"), F.col("fp").alias("b"))
    close = f"a < b AND bit_count(a ^ b) <= {distance} AND {code.first_meeting('a', 'b', 'h.key')}"
    # Spark sizes an exploded frame as if each row gave one, and would broadcast copies many times as large as the fingerprints
    return home.hint("merge").alias("h").join(near.hint("merge").alias("n"), (F.col("h.key") == F.col("n.key")) & F.expr(close)).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    distance: int = 4, blocks: int = 3) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id``, the smallest id reachable over linked fingerprints, for every row.

    Equal fingerprints are one node of the graph, so copies cost nothing beyond their rows. Texts without words have
    fingerprint 0 and link like any other; rows without id keep a null id and join a component by their fingerprint;
    rows that repeat an id each have their own fingerprint; an empty table gives an empty result. Other columns of
    ``docs`` are not read.
    """
    fps = kept(fingerprints(docs, id_col, text_col, shingle))
    return grouped(fps, links(fps, distance, blocks), id_col)


def grouped(fps: DataFrame, links: DataFrame, id_col: str) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id`` for rows with a node ``fp`` each and links ``a``, ``b`` between nodes."""
    least = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = components(links, "a", "b").withColumnRenamed("node", "fp")
    member = kept(least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(smallest, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(id_col, "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                find: Callable[..., DataFrame] = near_duplicates, **options) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, by id (null first) and text hash.

    Of rows that agree in id and text, one stays. ``find`` names the components, see ``near_duplicates``.
    """
    row = F.struct(id_col, F.xxhash64(id_col, text_col).alias("k"))
    found = find(docs.select(row.alias("row"), text_col), "row", text_col, **options)
    each = found.groupBy(F.col("row.k").alias("k_")).agg(F.bool_or(F.col("row") != F.col("component_id")).alias("goes"), F.count("*").alias("rows"))
    marked = docs.withColumn("k_", F.xxhash64(id_col, text_col)).join(
        written(each.where("goes OR rows > 1"), "goes"), "k_", "left").where("NOT coalesce(goes, false)")
    single = F.col("rows").isNull()
    return marked.where(single).unionByName(marked.where(~single).dropDuplicates(["k_"])).drop("k_", "goes", "rows")
