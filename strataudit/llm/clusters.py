"""Centroid clustering of vectors through a VA-file: cells of a few bits per dimension decide, full vectors only where they cannot."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataudit.llm.common import kept, written

BITS = 6  # per dimension
SAMPLE = 4096  # vectors from which the borders of the cells are taken; they bear on speed, never on results
STEP = 1 << 12  # vectors whose intervals are held at once


class Intervals:
    """What cells tell of the distances to centroids, by lookup tables.

    ``edges`` has for each dimension the first value of each cell and, at its end, the last value of all plus one.
    """

    def __init__(self, edges: np.ndarray, centroids: np.ndarray):
        self.start, self.end, self.centroids = edges[:, :-1, None], edges[:, 1:, None] - 1, centroids.T[:, None, :]
        below, above = self.start - self.centroids, self.centroids - self.end  # how far the centroid lies outside
        low = np.maximum(np.maximum(below, above), 0) ** 2
        high = np.maximum(np.abs(below), np.abs(above)) ** 2
        self.middle = low + high  # twice the middle of the interval, by dimension, cell and centroid
        self.tables: dict[int, np.ndarray] = {}

    def worst(self, b: int) -> np.ndarray:
        """Upper end of the interval of distance to ``b`` less distance to each other centroid, by dimension, cell and centroid.
        The square of a component is in both distances, so the interval is far narrower than those of the two."""
        if b not in self.tables:
            apart, sum_ = self.centroids - self.centroids[:, :, b:b + 1], self.centroids + self.centroids[:, :, b:b + 1]
            self.tables[b] = np.maximum(apart * (2 * self.start - sum_), apart * (2 * self.end - sum_))
        return self.tables[b]

    def nearest(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of cell numbers: a near centroid, and whether no vector in these cells can be nearer to another."""
        best = sum(self.middle[j, cells[:, j]] for j in range(cells.shape[1])).argmin(axis=1)
        sure = np.zeros(len(cells), bool)
        for b in np.unique(best):
            rows, table = np.flatnonzero(best == b), self.worst(int(b))
            gain = sum(table[j, cells[rows, j]] for j in range(cells.shape[1]))
            gain[:, b] = -1
            gain[:, :b] += 1  # of equals the smaller number is nearest
            sure[rows] = (gain <= 0).all(axis=1)
        return best, sure


def packed(cells: np.ndarray) -> list[bytes]:
    """Cell numbers of each row, ``BITS`` bits each."""
    bits = np.unpackbits(cells.astype(np.uint8)[:, :, None], axis=2)[:, :, 8 - BITS:]
    return [x.tobytes() for x in np.packbits(bits.reshape(len(cells), -1), axis=1)]


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1), axis=1)
    return np.packbits(bits[:, :dims * BITS].reshape(len(column), dims, BITS), axis=2)[:, :, 0] >> (8 - BITS)


def borders(sample: np.ndarray) -> np.ndarray:
    """For each dimension the first values of all cells but the first. Cells are as dense as the root of the sample's density,
    which makes the mean width of a vector's cells smallest."""
    out = []
    for x in sample.T:
        ends = np.linspace(x.min(), x.max() + 1, min(int(x.max() - x.min()) + 1, 1 << 10) + 1)
        share = np.cumsum(np.sqrt(np.histogram(x, ends)[0] + 0.01))
        out.append(np.ceil(ends[1 + np.searchsorted(share / share[-1], np.arange(1, 1 << BITS) / (1 << BITS))]))
    return np.array(out).astype(np.int64)


def full(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), dims).astype(np.int64)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of each vector from each centroid; the first of equals is the smaller number."""
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


class VAFile:
    """Vectors with their cells, written once. ``vec`` is the full vector; scans that need only ``cells`` do not read it."""

    def __init__(self, vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int):
        self.dims = dims
        c, largest = F.col(vector_col), int(2 ** 29 / dims ** 0.5)  # below it a long holds all sums of squares
        self.largest = largest
        small = F.forall(c, lambda x: F.coalesce(F.abs(x.cast("double")) * scale < largest, F.lit(False)) & ~F.isnan(x))
        whole = F.transform(c, lambda x: F.floor(x.cast("double") * scale).cast("int"))
        kept_rows = vectors.select(F.col(id_col).alias("id"), F.when((F.size(c) == dims) & small, whole).alias("v")).where("v IS NOT NULL")
        self.vectors = kept_rows
        self.edges = self._edges()
        self.table = written(self._coded(), "va")

    def _edges(self) -> np.ndarray:
        """Borders between cells from a bounded sample, and the true ends of each dimension."""
        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, low, high = 0, np.full(dims, largest), np.full(dims, -largest)
            for batch in batches:
                v = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                if len(v):
                    n, low, high = n + len(v), np.minimum(low, v.min(axis=0)), np.maximum(high, v.max(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(np.full(dims, n)), pa.array(low), pa.array(high)],
                                             names=["dim", "n", "low", "high"])

        dims, largest = self.dims, self.largest
        rows = self.vectors.select("v").mapInArrow(ends, "dim bigint, n bigint, low bigint, high bigint").groupBy("dim").agg(
            F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()
        low, high = np.array([r["low"] for r in rows], np.int64), np.array([r["high"] for r in rows], np.int64)
        share = SAMPLE / max(rows[0]["n"] if rows else 0, 1)
        drawn = self.vectors.where(F.pmod(F.xxhash64("id", "v"), F.lit(1 << 40)) < int(min(2 * share, 1) * (1 << 40))).select("v").limit(SAMPLE).collect()
        if not drawn:
            return np.tile(np.arange((1 << BITS) + 1), (dims, 1)).astype(np.int64)
        inner = borders(np.array([r["v"] for r in drawn], np.int64))
        return np.concatenate((low[:, None], np.clip(inner, low[:, None], high[:, None]), high[:, None] + 1), axis=1)

    def _coded(self) -> DataFrame:
        edges, dims = self.edges, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                cells = np.zeros((len(v), dims), np.uint8)
                for j in range(dims):
                    # of cells that share a first value only the last has values
                    cells[:, j] = np.searchsorted(edges[j, 1:-1], v[:, j], side="right")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("id"), pa.array(packed(cells), pa.binary()),
                     pa.array([x.tobytes() for x in v.astype("<i4")], pa.binary())], names=["row", "id", "cells", "vec"])

        kind = self.vectors.schema["id"].dataType.simpleString()
        # the number of a row holds from here on, since it is written
        numbered = self.vectors.withColumn("row", F.monotonically_increasing_id())
        return numbered.mapInArrow(run, f"row bigint, id {kind}, cells binary, vec binary")

    def first_centroids(self, k: int, seed: int) -> np.ndarray:
        """The ``k`` vectors with the smallest sha256 of ``seed:id``, in order of it; each task keeps ``k`` rows."""
        named = self.table.where("id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
        rows = named.select("h", "vec").orderBy("h", "vec").limit(k).collect()
        return np.stack([np.frombuffer(bytes(r["vec"]), "<i4").astype(np.int64) for r in rows]) if rows else np.zeros((0, self.dims), np.int64)

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """``row``, ``id``, ``cluster``, ``distance`` of every vector. Where its intervals leave one centroid, only that distance is taken."""
        table, dims = Intervals(self.edges, centroids), self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(at, STEP) for at in range(0, batch.num_rows, STEP)):
                    cluster, sure = table.nearest(unpacked(part.column("cells"), dims))
                    v = full(part.column("vec"), dims)
                    cluster[~sure] = squared(v[~sure], centroids).argmin(axis=1)
                    distance = ((v - centroids[cluster]) ** 2).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), pa.array(cluster, pa.int32()), pa.array(distance)],
                                                     names=["row", "id", "cluster", "distance"])

        kind = self.table.schema["id"].dataType.simpleString()
        return self.table.mapInArrow(run, f"row bigint, id {kind}, cluster int, distance bigint")

    def changes(self, new: np.ndarray, old: np.ndarray | None) -> DataFrame:
        """What the move from the ``old`` centroids to the ``new`` ones adds to the count and the component sums of each cluster:
        ``cluster``, ``n``, ``sums``, a row for each task and cluster.

        The cells alone tell of most vectors that they stay where they were; the others are fetched. Without old centroids
        all are.
        """
        after, dims = Intervals(self.edges, new), self.dims
        before = None if old is None else Intervals(self.edges, old)

        def unsure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(at, STEP) for at in range(0, batch.num_rows, STEP)):
                    cells = unpacked(part.column("cells"), dims)
                    (x, one), (y, other) = after.nearest(cells), before.nearest(cells)
                    stays = one & other & (x == y)
                    yield part.select(["row"]).filter(pa.array(~stays))

        def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = np.zeros(len(new), np.int64), np.zeros((len(new), dims), np.int64)
            for batch in batches:
                v = full(batch.column("vec"), dims)
                to = squared(v, new).argmin(axis=1)
                np.add.at(n, to, 1)
                np.add.at(sums, to, v)
                if old is not None:
                    of = squared(v, old).argmin(axis=1)
                    np.add.at(n, of, -1)
                    np.add.at(sums, of, -v)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(new), dtype=np.int32)), pa.array(n), pa.array(sums.tolist(), pa.list_(pa.int64()))],
                                             names=["cluster", "n", "sums"])

        fetched = self.table.select("vec")
        if old is not None:
            rows = self.table.select("row", "cells").mapInArrow(unsure, "row bigint")
            fetched = self.table.select("row", "vec").join(rows, "row", "left_semi").select("vec")
        return fetched.mapInArrow(moves, "cluster int, n bigint, sums array<bigint>")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64,
            scale: int = 64, seed: int = 1) -> DataFrame:
    """``id_col``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every vector that takes part.

    Components become ``floor(scale * x)``. The ``k`` vectors with the smallest sha256 of ``seed:id`` are the first centroids. Each
    round assigns all vectors to the nearest centroid (squared distance; the smaller number of equals) and moves the centroids
    that have vectors to the exact floor of their mean; then all vectors are assigned once more. All sums are whole numbers, so
    results do not depend on partitioning.

    A vector is kept as ``dims`` cells of six bits and in full. Tables give the interval of distances between each cell and
    each centroid. After the first round, sums change only by vectors that move: cells are read for all, full vectors are fetched
    only where intervals overlap or point elsewhere. The borders of the cells come from a sample of ``SAMPLE`` vectors; every vector is indexed.
    Only centroids, cell borders and sums of ``k`` clusters reach the driver or are sent to tasks.

    Vectors that are null, of another length, or with a component that is null or not finite take no part; nor do those with a scaled component
    of 2 ** 29 / sqrt(dims) or more (2 ** 26 here), whose distances a long need not hold. Rows without id are clustered but are no first centroid; repeated rows count each; with fewer vectors than
    ``k`` there are as many centroids; no vectors give no rows. Other columns are not read.
    """
    file = VAFile(vectors, id_col, vector_col, dims, scale)
    centroids, old = file.first_centroids(k, seed), None
    if not len(centroids):
        # nothing to cluster, or nothing but rows without id: no centroid, no rows
        return file.table.where("false").selectExpr(f"id AS `{id_col}`", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia",
                                                    "'' AS centroid_sha256")
    count, total = [0] * len(centroids), [[0] * dims for _ in centroids]
    for _ in range(rounds):
        parts = file.changes(centroids, old).select("cluster", "n", F.posexplode("sums").alias("dim", "x")).groupBy("cluster", "dim").agg(
            F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
        for r in parts:
            total[r["cluster"]][r["dim"]] += int(r["x"])
            if r["dim"] == 0:
                count[r["cluster"]] += r["n"]
        old, centroids = centroids, np.array([[s // n for s in sums] if n else list(c) for c, n, sums in zip(centroids, count, total, strict=True)], np.int64)
    found = kept(file.assigned(centroids))
    inertia = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    rows = [(i, inertia[i], sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for i, c in enumerate(centroids.tolist()) if i in inertia]
    # at most k rows
    each = vectors.sparkSession.createDataFrame([(i, str(a), str(b), h) for i, a, b, h in rows], "cluster int, a string, b string, centroid_sha256 string")
    return found.join(F.broadcast(each), "cluster").selectExpr(
        f"id AS `{id_col}`", "cluster", "distance", "try_cast(a AS bigint) AS cluster_inertia", "try_cast(b AS bigint) AS inertia", "centroid_sha256")
