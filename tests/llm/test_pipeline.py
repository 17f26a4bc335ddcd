import corpus_pipeline as cp
import numpy as np
import pytest
from compare import differences, oracle
from strataudit.llm import jaccard, simhash
from strataudit.llm.queries import ORACLES, QUERIES


def test_stages_in_order(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in cp.STAGES:
        docs = cp.written(stage(spark, docs, sf_small), name)
        counts.append(docs.count())
        if name != "source_mix":
            assert docs.columns == columns
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0.5 * counts[0]
    assert {tuple(r) for r in docs.collect()} == {tuple(r) for r in cp.run(spark, sf_small).collect()}


def test_stages_on_edges(spark, edges, nothing, sf_small):
    for docs in (edges, nothing):
        n = docs.count()
        for name, stage in cp.STAGES:
            docs = cp.written(stage(spark, docs, sf_small), name)
        assert docs.count() <= n


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, sf_small, name):
    assert differences(QUERIES[name](spark, sf_small), oracle(sf_small), ORACLES[name]) == []


def test_near_dedup_compares_what_simhash_links(spark, monkeypatch):
    """Without the bands, the fingerprints' groups alone propose: near copies are found, texts that only their repeated passage makes alike are not."""
    passage, one, two = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("p", 11), ("a", 30), ("b", 30)))
    long = [f"w{i}" for i in range(400)]
    texts = [(1, f"{passage} " * 60 + one), (2, f"{passage} " * 60 + two), (3, " ".join(long)), (4, " ".join([*long, "end"])), (5, one)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {1, 3, 5}
    monkeypatch.setattr(jaccard.minhash, "keys", lambda hashes, sizes, rows, bands: np.random.default_rng().integers(0, 1 << 63, (len(sizes), bands), np.uint64))
    assert {r.doc_id for r in cp.simhash_near_dedup(spark, docs, "").collect()} == {1, 2, 3, 5}
