import math
import random

import numpy as np
import pytest
from compare import differences, oracle
from strataudit.llm import negatives, queries

DDL = "vec_id long, embedding array<float>, label int, id int, vec string, a int, r int, size int, score int"


def brute(rows, anchors, scale=256, pct=80):
    """All scores in whole numbers of any size, by loops."""
    one = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        c = [math.floor(scale * x) for x in v]
        if i not in one or (label, c) < one[i]:
            one[i] = (label, c)
    out = []
    score = lambda x, y: sum(p * q for p, q in zip(one[x][1], one[y][1], strict=False))
    for a in filter(anchors, one):
        best = sorted((j for j in one if j != a and one[j][0] == one[a][0]), key=lambda j: (-score(a, j), j))[:5]
        for p in best:
            s = score(a, p)
            hard = [k for k in one if one[k][0] != one[a][0] and pct * s <= 100 * score(a, k) <= 100 * s]
            hard.sort(key=lambda k: (-score(a, k), k))
            out += [(a, p, n, k, s, score(a, k)) for n, k in enumerate(hard[:5], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, 5) for r in rows], DDL)


def test_residue_products_are_exact():
    rng = np.random.default_rng(1)
    for width, most in ((1, 3), (64, 256), (200, 1000), (130, 1 << 27)):
        a, b = rng.integers(-most, most, (7, width)), rng.integers(-most, most, (9, width))
        moduli = negatives.primes(float(max((a.astype(float) ** 2).sum(1).max(), (b.astype(float) ** 2).sum(1).max())))
        found = negatives.products(negatives.residues(a.astype(float), moduli), negatives.residues(b.astype(float), moduli), moduli)
        assert (found == np.array([[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a])).all()


@pytest.mark.parametrize("blocks", [(1 << 15, 1 << 12), (16, 2)])
def test_same_as_brute_force(spark, blocks):
    """Ties, repeated rows and ids, nulls, vectors that are empty, shorter or not finite, and a label with a third of the rows."""
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-0.5, 0.25, 0.5, 0.501]) for _ in range(6)], 0 if i % 3 else rnd.randrange(4)) for i in range(150)]
    rows += rows[:9] + [(3, [0.5] * 6, 2), (10, [0.25] * 6, 1), (None, [0.5] * 6, 1), (200, None, 1), (201, [0.5] * 6, None), (202, [None] * 6, 1),
                        (203, [float("nan")] * 6, 1), (204, [float("inf")] * 6, 1), (210, [], 1), (220, [0.5, 0.5], 0), (230, [0.5] * 9, 1), (-10, [0.4] * 6, 0)]
    got = negatives.mine(frame(spark, rows), anchors="id % 10 = 0", rows_per_block=blocks[0], anchors_per_block=blocks[1])
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 10 == 0)


def test_vectors_too_large_for_a_long_take_no_part(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.4], 2), (3, [3e38, 0.0], 2)]
    assert [tuple(r) for r in negatives.mine(frame(spark, rows)).collect()] == brute(rows[:3], lambda i: i == 0)


def test_nothing(spark):
    assert negatives.mine(frame(spark, [])).count() == 0
    assert negatives.mine(frame(spark, [(0, [1.0], 1)])).count() == 0


def test_query_on_the_table(spark, sf_mid):
    con = oracle(sf_mid)
    assert differences(queries.op11_hard_negatives(spark, sf_mid), con, queries.ORACLES["op11_hard_negatives"]) == []
