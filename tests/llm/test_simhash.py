import random

import xxhash
from strataudit.llm import simhash


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(spark, edges):
    got = sorted(((r.doc_id or 0), r.fp) for r in simhash.fingerprints(edges).collect())
    assert got == sorted(((r.doc_id or 0), signed(plain(r.text))) for r in edges.collect())


def test_links_are_complete(spark):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(150)]
    for v in list(values):
        for n in (1, 3, 4, 5):
            flipped = v
            for b in rng.sample(range(64), n):
                flipped ^= 1 << b
            values.append(flipped)
    want = {(min(a, b), max(a, b)) for i, a in enumerate(map(signed, values)) for b in map(signed, values[:i])
            if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    df = spark.createDataFrame([(signed(v),) for v in values] + [(None,)], "fp long")
    for blocks in (2, 3, 4):
        pairs = [tuple(r) for r in simhash.links(df, 4, blocks).collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_copies_are_not_broadcast(spark):
    """A fingerprint has some 44 copies, which Spark's estimate leaves out: a few MB of fingerprints would be broadcast as hundreds."""
    pairs = simhash.links(spark.range(20_000).selectExpr("xxhash64(id) AS fp"))
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components(spark, edges, nothing):
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(edges).collect()}
    assert {(1, 1), (None, 1), (6, 1), (2, 2), (3, 2), (4, 2), (7, 7)} <= got  # no words: all alike
    assert simhash.near_duplicates(edges).count() == edges.count()
    assert simhash.near_duplicates(nothing).count() == 0
    left = sorted((r.doc_id or 0, (r.text or "")[:7]) for r in simhash.one_of_each(edges).collect())
    # the row without an id comes first of its group; of two equal rows one stays, the other text of id 6 stays
    assert [x[0] for x in left] == [0, 2, 5, 6, 7, 8] and ("another") in [x[1] for x in left]
