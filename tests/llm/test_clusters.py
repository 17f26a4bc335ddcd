import hashlib
import math
import random

import numpy as np
import pyarrow as pa
from compare import differences, oracle
from strataudit.llm import clusters, queries

DDL = "vec_id long, embedding array<float>, id int, v int, row int, cells int, cluster int, distance int"


def brute(rows, k, rounds, dims, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    c = [v for _, v in named[:k]]
    if not c:
        return []
    far = lambda v, w: sum((x - y) ** 2 for x, y in zip(v, w, strict=True))
    nearest = lambda v: min(range(len(c)), key=lambda j: (far(v, c[j]), j))
    for _ in range(rounds):
        of = [nearest(v) for _, v in kept]
        c = [[sum(col) // of.count(j) for col in zip(*[v for (_, v), o in zip(kept, of, strict=True) if o == j], strict=True)] if j in of else c[j]
             for j in range(len(c))]
    out = [(i, nearest(v), far(v, c[nearest(v)])) for i, v in kept]
    each = {j: sum(d for _, o, d in out if o == j) for j in range(len(c))}
    key = lambda r: (r[0] is not None, r)
    return sorted(((i, o, d, each[o], sum(each.values()), hashlib.sha256(",".join(map(str, c[o])).encode()).hexdigest()) for i, o, d in out), key=lambda r: str(r))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 5, 6) for i, v in rows], DDL)


def run(spark, rows, k=5, rounds=3, dims=3):
    got = clusters.cluster(frame(spark, rows).repartition(5), k=k, rounds=rounds, dims=dims)
    return sorted(map(tuple, got.collect()), key=lambda r: str(r))


def test_same_as_brute_force(spark):
    """Ties, copies that hold a third of the rows, repeated ids, nulls, other lengths, an outlier."""
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(3)]) for i in range(300)]
    rows += [(1000 + i, [0.25, -0.25, 0.5]) for i in range(150)] + rows[:20]
    rows += [(None, [0.1, 0.2, 0.3]), (5, None), (6, []), (7, [1.0, 2.0]), (8, [None, 1.0, 1.0]), (9, [float("nan")] * 3), (10, [float("inf"), 0.0, 0.0]),
             (11, [9000.0, -9000.0, 1.0])]
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows) == brute(rows, 5, 3, 3, 64)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5, 0.5, 0.5]), (2, [0.5, 0.5, 0.5]), (3, [-0.5, 0.0, 0.25])]
    assert run(spark, rows) == brute(rows, 5, 3, 3, 64)
    assert run(spark, []) == run(spark, [(None, [0.5, 0.5, 0.5])]) == []


def test_cells_decide_only_what_is_certain():
    rng = np.random.default_rng(2)
    v = rng.normal(0, 8, (4000, 64)).astype(np.int64)
    v[0] = 5000
    inner = clusters.borders(v[1:1000])
    edges = np.concatenate((v.min(0)[:, None], np.clip(inner, v.min(0)[:, None], v.max(0)[:, None]), v.max(0)[:, None] + 1), axis=1)
    cells = np.stack([np.searchsorted(edges[j, 1:-1], v[:, j], side="right") for j in range(64)], axis=1).astype(np.uint8)
    assert (clusters.unpacked(pa.array(clusters.packed(cells), pa.binary()), 64) == cells).all()
    c = np.concatenate((v[1:16], v[1:2]))  # two are equal: the smaller number is nearest
    best, sure = clusters.Intervals(edges, c).nearest(cells)
    assert (best[sure] == clusters.squared(v, c).argmin(axis=1)[sure]).all() and sure.mean() > 0.5


def test_query_on_the_table(spark, sf_mid):
    con = oracle(sf_mid)
    assert differences(queries.op12_centroid_clusters(spark, sf_mid), con, queries.ORACLES["op12_centroid_clusters"]) == []


def test_later_rounds_fetch_few_vectors(spark, sf_mid):
    file = clusters.VAFile(spark.read.parquet(f"{sf_mid}/embeddings.parquet"), "vec_id", "embedding", 64, 64)
    c = file.first_centroids(16, 1)
    plan = file.changes(c, c)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<row:bigint,cells:binary>" in plan
    assert file.changes(c, c).selectExpr("sum(abs(n))").first()[0] == 0
