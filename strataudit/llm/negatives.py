"""Hard negatives for retrieval training: exact integer scores by matrix products in a residue number system."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_BLOCK, ANCHORS_PER_BLOCK = 1 << 15, 1 << 12
TILE = 1 << 7  # anchors whose scores are held at once
DEPTH = 64  # components that are multiplied before the residues are reduced
LONG = float(1 << 62)


def primes(bound: float) -> list[int]:
    """Primes whose product exceeds 2 * ``bound`` + 1, two at least, the largest for which float32 is exact.

    A product of ``DEPTH`` residues around zero stays below 2 ** 24, where float32 holds every whole number.
    """
    most = 2 * int((2 ** 24 // DEPTH) ** 0.5) + 1
    chosen, product = [], 1
    for p in range(most - 1 + most % 2, 2, -2):
        if len(chosen) >= 2 and product > 2 * bound + 1:
            break
        if all(p % q for q in range(3, int(p ** 0.5) + 1, 2)):
            chosen.append(p)
            product *= p
    return chosen


def residues(vectors: np.ndarray, moduli: list[int]) -> list[np.ndarray]:
    """The vectors' residues nearest to zero, float32, one matrix for each modulus."""
    out = []
    for p in moduli:
        r = np.mod(vectors, p)
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def products(a: list[np.ndarray], b: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``, given by their residues: one float32 product for each modulus,
    joined digit by digit (Chinese remainders in mixed radix); what lies over half the range is negative."""
    value, radix = None, 1
    for x, y, p in zip(a, b, moduli, strict=True):
        total = np.zeros((len(x), len(y)), np.int64)
        for at in range(0, x.shape[1], DEPTH):
            total += (x[:, at:at + DEPTH] @ y[:, at:at + DEPTH].T).astype(np.int64)
        if value is None:
            value = total % p
        else:
            if (radix * p).bit_length() > 62:
                value = value.astype(object)
            digit = (total - value) % p * pow(radix, -1, p) % p
            value = value + digit * radix
        radix *= p
    return np.where(value > radix // 2, value - radix, value).astype(np.int64)


def first(scores: np.ndarray, where: np.ndarray, n: int) -> np.ndarray:
    """Of the positions ``where`` (ascending) the ``n`` with the highest scores; equal scores go by position."""
    some = scores[where]
    if len(some) > n:
        worst = np.partition(some, len(some) - n)[len(some) - n]
        where = where[some >= worst]
        some = scores[where]
    return where[np.argsort(-some, kind="stable")[:n]]


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``id``, ``label``, ``vec`` of the rows that take part."""
    x = lambda c: c.cast("double")
    usable = F.forall("vec", lambda c: F.coalesce(F.abs(x(c)) < float("inf"), F.lit(False)) & ~F.isnan(x(c)))
    size = F.aggregate("vec", F.lit(0.0), lambda a, c: a + (F.abs(x(c)) * float(scale) + 1.0) * (F.abs(x(c)) * float(scale) + 1.0))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).alias("vec"))
    return rows.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").where(usable).withColumn("size", size).where(F.col("size") < LONG)


def _matrix(table: pa.Table, width: int, scale: int) -> tuple[pa.Table, np.ndarray]:
    """The rows of a block in order of id, one for each id, and their scaled components, zeros beyond a vector's end."""
    table = table.combine_chunks()
    if not table.num_rows:
        return table, np.zeros((0, width))
    vec = table.column("vec").chunk(0)
    lengths = vec.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    out = np.zeros((len(vec), width))
    out[np.repeat(np.arange(len(vec)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    # of rows that share an id, the one with the smallest label, then vector
    order = np.lexsort((*out.T[::-1], table.column("label").to_numpy(), table.column("id").to_numpy()))
    ids = table.column("id").to_numpy()[order]
    order = order[np.concatenate(([True], ids[1:] != ids[:-1]))]
    return table.select([c for c in table.column_names if c != "vec"]).take(pa.array(order)), out[order]


def mine(vectors: DataFrame, anchors: str = "id % 100 = 0", id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         label: str = "label", scale: int = 256, positives: int = 5, negatives: int = 5, least_pct: int = 80,
         rows_per_block: int = ROWS_PER_BLOCK, anchors_per_block: int = ANCHORS_PER_BLOCK) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``: for each anchor and each of
    its ``positives`` best rows of the same label, the first ``negatives`` rows of other labels whose score is at least ``least_pct``
    per cent of the positive's and not above it.

    A score is the exact inner product of two vectors whose components are ``floor(scale * x)``; higher ones come first,
    ties go by the smaller id. ``anchors`` selects the anchors and ``label`` gives the label, both expressions over ``id`` and ``label``.

    Anchors and rows are dealt into blocks by hashes of their ids and every block of anchors meets every block of
    rows once, as a group of bounded size; a group returns only the first few rows of each anchor, or anchor and positive.
    So nothing grows but the number of groups, which a search of every anchor among all rows needs. Labels play no part in the
    dealing, so a label with a third of the rows is no obstacle.

    Rows without id, label or vector, or with a component that is null or not finite, take no part. Nor do vectors whose scaled
    squared length reaches 2 ** 62, since a long does not hold their scores. Vectors of unlike length are compared as if the shorter
    went on with zeros. Rows with the same id are one row: the one with the smallest label, then vector. An anchor without positives
    or negatives has no rows; an empty table gives none. Other columns are not read.
    """
    rows = prepared(vectors, id_col, vector_col, label_col, scale)
    known = rows.agg(F.count("*").alias("n"), F.count_if(F.expr(anchors)).alias("anchors"), F.max("size").alias("size"),
                     F.max(F.size("vec")).alias("width")).first()
    width, moduli = known["width"] or 1, primes(known["size"] or 1.0)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    row_blocks = max(-(-known["n"] // rows_per_block), min(2 * cores, known["n"] // 1024), 1)
    anchor_blocks = max(-(-known["anchors"] // anchors_per_block), 1)
    rows = rows.select("id", F.expr(label).cast("bigint").alias("label"), "vec")
    grid = lambda df, mine, mine_n, other, other_n: df.withColumn(mine, F.pmod(F.xxhash64("id"), F.lit(mine_n))).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))).withColumn(other, F.col(other).cast("bigint"))
    block = grid(rows, "r", row_blocks, "a", anchor_blocks)
    # columns of their own, so that a group of anchors can meet rows of the same table
    asked = grid(rows.where(anchors).select(*[F.col(c).alias(c) for c in rows.columns]), "a", anchor_blocks, "r", row_blocks)

    def meet(left: pa.Table, right: pa.Table) -> Iterator[tuple[pa.Table, slice, np.ndarray, pa.Table]]:
        """Tiles of anchors with their scores against the whole block."""
        table, matrix = _matrix(right, width, scale)
        heads, own = _matrix(left, width, scale)
        if table.num_rows and heads.num_rows:
            there = residues(matrix, moduli)
            for at in range(0, heads.num_rows, TILE):
                some = slice(at, at + TILE)
                yield heads, some, products(residues(own[some], moduli), there, moduli), table

    def alike(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros((0, 3), np.int64)]
        for heads, some, scores, table in meet(left, right):
            ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
            for i, kind, row in zip(heads.column("id").to_numpy()[some], heads.column("label").to_numpy()[some], scores, strict=True):
                best = first(row, np.flatnonzero((labels == kind) & (ids != i)), positives)
                out.append(np.column_stack((np.full(len(best), i), ids[best], row[best])))
        return pa.table(list(np.concatenate(out).T), names=["id", "positive_id", "positive_score"])

    found = asked.groupBy("a", "r").cogroup(block.groupBy("a", "r")).applyInArrow(alike, "id bigint, positive_id bigint, positive_score bigint")
    ranked = found.selectExpr("*", "row_number() OVER (PARTITION BY id ORDER BY positive_score DESC, positive_id) AS n").where(F.col("n") <= positives)
    wanted = ranked.groupBy("id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))

    def unlike(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros((0, 5), np.int64)]
        for heads, some, scores, table in meet(left, right):
            ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
            part = heads.slice(some.start, TILE)
            for i, kind, asks, row in zip(*(part.column(c).to_pylist() for c in ("id", "label", "positives")), scores, strict=True):
                least = min(_least(x["positive_score"], least_pct) for x in asks)
                top = max(x["positive_score"] for x in asks)
                near = np.flatnonzero((row >= least) & (row <= top) & (labels != kind))
                for x in asks:
                    score = x["positive_score"]
                    best = first(row, near[(row[near] <= score) & (row[near] >= _least(score, least_pct))], negatives)
                    out.append(np.column_stack((np.full(len(best), i), np.full(len(best), x["positive_id"]), np.full(len(best), score),
                                                ids[best], row[best])))
        return pa.table(list(np.concatenate(out).T), names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    asks = asked.join(wanted, "id")
    hard = asks.select(*[F.col(c).alias(c) for c in asks.columns]).groupBy("a", "r").cogroup(block.groupBy("a", "r")).applyInArrow(
        unlike, "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    order = "PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id"
    return hard.selectExpr("anchor_id", "positive_id", f"row_number() OVER ({order}) AS rank", "negative_id", "positive_score",
                           "negative_score").where(F.col("rank") <= negatives)


def _least(score: int, pct: int) -> int:
    """The smallest whole number that is ``pct`` per cent of the score."""
    return -(-pct * int(score) // 100)
