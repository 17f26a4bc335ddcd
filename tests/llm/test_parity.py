import random
import re

import numpy as np
import pytest
from strataudit.llm import parity, queries


def shingles(text, n):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return frozenset(" ".join(words[i:i + n]) for i in range(max(len(words) - n + 1, 1))) if words else frozenset()


def brute(rows, n, num, den):
    """Every row against every other."""
    found, root = [shingles(t, n) for _, t in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(found):
        for j in range(i):
            b = found[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[top(i)] = min(least.get(top(i), k), k)
    key = lambda r: str(r)
    return sorted(((k, len(s), least.get(top(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, found, strict=True))), key=key)


def run(df, n, num, den):
    got = parity.near_duplicates(df, shingle=n, num=num, den=den).select("doc_id", "size", "component_id")
    return sorted(map(tuple, got.collect()), key=lambda r: str(r))


def variants(rnd, words, share):
    return " ".join(rnd.choice("abcdefgh") * 3 + str(rnd.randrange(999)) if rnd.random() < share else w for w in words)


@pytest.mark.parametrize(("n", "num", "den"), [(4, 85, 100), (5, 4, 5), (1, 1, 2)])
def test_same_as_brute_force(spark, n, num, den):
    """Families of variants from nearly equal to unlike, so that many pairs lie close to the limit and chains arise."""
    rnd = random.Random(n)
    rows = []
    for _ in range(12):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([3, 8, 20, 60, 300]))]
        for _ in range(14):
            words = variants(rnd, words, rnd.choice([0, 0.005, 0.01, 0.03, 0.1])).split()
            words = words[:len(words) - rnd.randrange(1 + len(words) // 20)] or words
            rows.append((rnd.randrange(10_000), " ".join(words)))
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), n, num, den) == brute(rows, n, num, den)


def test_edges(edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert run(edges, 4, 85, 100) == brute(rows, 4, 85, 100)
    assert run(nothing, 4, 85, 100) == []


def test_sketch_never_exceeds_the_symmetric_difference():
    rng = np.random.default_rng(4)
    for size in (1, 30, 5000):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        b = np.unique(np.concatenate((a[size // 10:], rng.integers(0, 1 << 63, size // 7).astype(np.uint64))))
        for blocks in (1, 8, 200):
            apart = np.bitwise_count(parity.sketch(a, blocks) ^ parity.sketch(b, blocks)).sum()
            assert apart <= len(np.setxor1d(a, b))


def test_sets_that_are_similar_enough_share_a_key():
    """The worst case: members differ by as many as are allowed, dealt over as many blocks as possible."""
    rng, bands = np.random.default_rng(6), parity.Bands(85, 100)
    every = lambda x: {key for _, found, _ in parity.keys(np.unique(x), bands) for key in found.tolist()}
    for size in [*range(5, 40), 100, 333, 2000]:
        a = rng.integers(0, 1 << 63, size).astype(np.uint64)
        for extra in range(0, size // 3):
            for gone in range(0, size // 3):
                if extra + gone and 100 * (size - gone) >= 85 * (size + extra) and (size < 40 or rng.random() < 0.02):
                    b = np.concatenate((a[gone:], rng.integers(0, 1 << 63, extra).astype(np.uint64)))
                    assert every(a) & every(b)


def test_unlike_sets_share_few_keys_and_pass_few_sketches():
    """Sets without a member in common: what they share grows with the square of their number."""
    rng, bands = np.random.default_rng(7), parity.Bands(85, 100)
    for size in (20, 100, 1000):
        found = [{x for _, ks, _ in parity.keys(np.unique(rng.integers(0, 1 << 64, size, np.uint64)), bands) for x in ks.tolist()} for _ in range(300)]
        shared = sum(bool(a & b) for i, a in enumerate(found) for b in found[:i])
        assert shared <= 5  # of 44,850 pairs
    for size in (60, 400):  # three times as many different members as a link allows
        band = bands.of(size)[0]
        a = rng.integers(0, 1 << 64, size, np.uint64)
        b = np.concatenate((a[bands.most[band]:], rng.integers(0, 1 << 64, 2 * bands.most[band], np.uint64)))
        one, two = (next(x.view(np.uint64) for k, _, x in parity.keys(np.unique(s), bands) if k == band) for s in (a, b[:bands.high[band]]))
        assert np.bitwise_count(one ^ two).sum() > bands.allowed(len(a) + len(b))


def test_query_on_the_table(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = queries.op13_parity_join(spark, sf_small)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=lambda r: str(r)) == brute(rows, 4, 85, 100)
