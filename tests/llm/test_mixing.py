import numpy as np
from strataudit.llm import mixing


def test_permutation():
    for n in (1, 2, 3, 17, 64, 1000):
        for key in (0, 7):
            got = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(got) == list(range(n))


def test_targets_and_takes(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    made = mixing.mix(docs)
    rows = made.taken.toPandas()
    per_source = rows.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"))
    assert (abs(per_source.taken - per_source.target) <= 0.03 * per_source.target + 64).all()
    assert (rows.taken <= 2 * rows["size"]).all() and abs(per_source.target.sum() - 1.5 * rows["size"].sum()) < 1
    again = mixing.mix(docs).taken.toPandas()
    assert sorted(map(tuple, rows[["doc_id", "taken"]].values)) == sorted(map(tuple, again[["doc_id", "taken"]].values))
    texts = mixing.texts(docs, made).toPandas()
    assert texts.text.str.split(r"[\x20\x09-\x0D]+", regex=True).str.len().sum() == rows.taken.sum()


def test_taken_against_the_expanded_mix(spark, sf_small, edges):
    """Every slot laid out over its source's stream of words, word by word."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "source")
    repeated = docs.where("doc_id % 9 = 0").selectExpr("cast(null AS bigint) AS doc_id", "text", "source")
    for table in (docs, edges.select("doc_id", "text", "source"), docs.union(repeated).union(docs.where("doc_id % 5 = 0"))):
        made = mixing.mix(table, slots_per_shard=50, rows_per_group=64)
        rows, shown = made.docs.collect(), {}
        for r in made.sources.collect():
            shown[r.src] = np.zeros(r.blocks * 64, int)
        for slot in made.slots.collect():
            shown[slot.src][slot.block * 64:(slot.block + 1) * 64] += 1
        wanted = sorted(str((r.doc_id, r.source, r["size"], int(shown[r.src][r.start:r.start + r["size"]].sum()))) for r in rows)
        got = sorted(str((r.doc_id, r.source, r["size"], r.taken)) for r in made.taken.collect())
        assert got == wanted and len(rows) == table.count()
        for src in shown:  # the rows of a source lie end to end
            ends = sorted((r.start, r.start + r["size"]) for r in rows if r.src == src and r["size"])
            assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_slots_are_spread(spark):
    sources = spark.createDataFrame([(i, 1000 + i, 30_000) for i in range(3)], "src long, blocks long, n_slots long")
    counts = mixing.draw(sources, 40, 7, at_once=8)
    assert counts.rdd.getNumPartitions() == 5
    made = counts.toPandas()
    assert (made.groupby("src").n.sum() == 30_000).all() and made.n.between(600, 900).all() and len(made) == 120
    for _, rows in made.sort_values(["src", "shard"]).groupby("src"):
        assert (rows["first"].to_numpy() == rows.n.cumsum().to_numpy() - rows.n.to_numpy()).all()
    slots = mixing.drawn_blocks(counts, 40, 7).selectExpr("spark_partition_id() AS p", "src", "slot", "block").toPandas()
    assert slots.p.nunique() > 20 and len(slots) == 90_000 and slots.groupby("p").size().max() < 90_000 / 8
    assert slots.groupby(["src", "block"]).size().between(27, 30).all()


def test_levels_against_a_plain_fill(spark):
    rng = np.random.default_rng(3)
    for sizes in ([10, 10, 10], [1000, 1, 1], [5, 500, 50, 7, 0, 900], list(map(int, rng.integers(0, 10_000, 40))), [0, 0]):
        df = spark.createDataFrame([(f"s{i:03d}", n) for i, n in enumerate(sizes)], "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df, 1.5, (3, 1, 2), 2.0, 64, per_range=8).collect()}
        weight, cap = np.array([(3, 1, 2)[i % 3] for i in range(len(sizes))], float), 2.0 * np.array(sizes)
        low, high = 0.0, float(sum(sizes)) * 3 + 1
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if np.minimum(cap, mid * weight).sum() < 1.5 * sum(sizes) else (low, mid)
        assert np.allclose([got[f"s{i:03d}"] for i in range(len(sizes))], np.minimum(cap, high * weight), rtol=1e-9, atol=1e-6)


def test_edges(edges, nothing):
    rows = mixing.mix(edges).taken.collect()
    assert len(rows) == edges.count()
    assert all(r.taken <= 2 * r.size for r in rows) and {r.source for r in rows} == {"a", "b", "c", None}
    assert mixing.mix(nothing).taken.count() == 0 and mixing.mix(edges.where("text is null")).taken.first().taken == 0
