import collections
import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from strataudit.llm import ctw


def plain_scores(rows, depth=ctw.DEPTH):
    """The weighted trees written out node by node."""
    counts = collections.defaultdict(lambda: [0, 0])

    def steps(text):
        data = bytes([2]) * depth + ctw.encoded((text or "").encode())[1]
        for i in range(depth, len(data)):
            for k in range(8):
                yield data[i - depth:i], (1 << k) | (data[i] >> (8 - k)), (data[i] >> (7 - k)) & 1

    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for context, node, bit in steps(text):
                for d in range(depth + 1):
                    counts[(context[depth - d:], node)][bit] += 1
    children = collections.defaultdict(set)
    for context, node in counts:
        if context:
            children[(context[1:], node)].add((context, node))
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
    memo: dict = {}

    def weighted(key):
        if key not in memo:
            own = kt(*counts[key])
            below = sum(weighted(c) for c in children[key])
            memo[key] = own if len(key[0]) == depth else math.log(.5) + max(own, below) + math.log1p(math.exp(-abs(own - below)))
        return memo[key]

    def zero(context, node, d=0):
        key = (context[depth - d:], node)
        if key not in counts:
            return .5
        a, b = counts[key]
        if d == depth:
            return (a + .5) / (a + b + 1)
        share = 1 / (1 + math.exp(sum(weighted(c) for c in children[key]) - kt(a, b)))
        return share * (a + .5) / (a + b + 1) + (1 - share) * zero(context, node, d + 1)

    return {i: sum(math.log10(zero(c, n) if b == 0 else 1 - zero(c, n)) for c, n, b in steps(t)) for i, t in rows}


def test_against_trees_written_out(spark):
    rows = [(1, "ab abc ab"), (2, "abc abd"), (3, "b"), (5, None), (4, "xyz AB"), (12, "quite new words"), (16, "abc")]
    assert any(zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows)
    got = {r.doc_id: r for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_scores(rows)
    assert all(abs(got[i].score - want[i]) < 1e-6 for i in want)
    counts, ends = collections.Counter(), 0
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update((t or "").lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    for i, t in rows:
        words = (t or "").lower().split()
        assert abs(got[i].base_score - sum(math.log10((c + 1) / (n + v + 1)) for c in [*(counts[w] for w in words), ends])) < 1e-9
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(words) + 1, sum(w in counts for w in words) + 1, n)


def test_rare_answers_come_by_join(spark, sf_small, monkeypatch):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").where("doc_id % 4 = 0")
    want = {r.doc_id: r for r in ctw.score(docs).collect()}
    monkeypatch.setattr(ctw, "COMMON", 5)
    for r in ctw.score(docs).collect():
        assert abs(r.score - want[r.doc_id].score) < 1e-6 and abs(r.base_score - want[r.doc_id].base_score) < 1e-6 and r.n_known == want[r.doc_id].n_known


def test_edges(edges, nothing):
    rows = ctw.score(edges).collect()
    assert len(rows) == edges.count() and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert ctw.score(nothing).count() == 0


def test_memory_of_a_task_does_not_follow_its_words():
    """Words as objects take many times the bytes of their text; a task holds those of one text, and what differs."""
    text = " ".join(f"w{i % 997}" for i in range(4000))
    batch = pa.RecordBatch.from_pydict({"chunk": [0] * 200, "held_out": [False] * 200, "text": [text] * 200})

    class Known:
        value = {kind: (np.zeros(0, np.int64), np.zeros(0)) for kind in (ctw.WORD, ctw.GRAM)}

    for run in (ctw._counted, ctw._asking(Known)):
        tracemalloc.start()
        for _ in run(iter([batch])):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 19 * batch.nbytes
