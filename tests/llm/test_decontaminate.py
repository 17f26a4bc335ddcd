import random

from strataudit.llm import decontaminate as dc

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango".split()


def test_changed_words_are_tolerated(spark, edges, nothing):
    rng = random.Random(6)
    item = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(30)]
    filler = lambda n: [rng.choice(WORDS) + str(rng.randrange(50, 99)) for _ in range(n)]
    every_fifth = [w if i % 5 else "other" for i, w in enumerate(item)]
    docs = [(1, " ".join(filler(40) + item + filler(40))), (2, " ".join(filler(20) + every_fifth + filler(9))), (3, " ".join(filler(90))),
            (4, " ".join(item[:4] + filler(30))), (5, "What, is: this?"), (6, None), (7, " ".join(item).upper().replace(" ", "  , ")),
            (8, " ".join(filler(3) + item[:16]))]
    bench = spark.createDataFrame([(0, " ".join(item)), (1, "what is this"), (2, None), (3, "")], "item_id long, text string").selectExpr("*", "1 AS k", "2 AS at")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.id, r.item): (r.at, r.words, r.equal) for r in dc.overlaps(docs, bench).collect()}
    assert found == {(1, 0): (40, 30, 30), (2, 0): (21, 29, 24), (5, 1): (0, 3, 3), (7, 0): (0, 30, 30), (8, 0): (3, 16, 16)}
    assert {r.doc_id for r in dc.clean(docs, bench).collect()} == {3, 4, 6}
    assert dc.clean(edges, bench).count() == edges.count() and dc.overlaps(nothing, bench).count() == 0
    assert dc.overlaps(docs, bench.limit(0)).count() == 0


def test_every_passage_of_the_benchmark_is_found(spark, sf_small):
    docs, bench = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [r.text for r in bench.collect()]
    want = {r.doc_id for r in docs.collect() if any(t in r.text for t in items)}
    assert {r.id for r in dc.overlaps(docs, bench).collect()} == want
