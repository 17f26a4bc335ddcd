import itertools

import numpy as np
from strataudit.llm import language


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    model = language.Crf(["a", "b", "c"], np.zeros(0, np.uint64), np.zeros((language.SIZE, 3), np.float32), rng.normal(size=(3, 3)), rng.normal(size=3))
    lengths = np.array([3, 0, 5, 1])
    each = rng.normal(size=(int(lengths.sum()), 3))
    got, at = model.marginals(each, lengths), 0
    for n in lengths:
        part = each[at:at + n]
        sums = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)) if n else []:
            weight = np.exp(model.start[path[0]] + sum(part[i, k] for i, k in enumerate(path)) + sum(model.move[a, b] for a, b in itertools.pairwise(path)))
            for i, k in enumerate(path):
                sums[i, k] += weight
        if n:
            assert np.allclose(got[at:at + n], sums / sums.sum(1, keepdims=True))
        at += n


def test_held_out_accuracy(spark, sf_mid):
    docs = spark.read.parquet(f"{sf_mid}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.95 and got.score.between(0, 1).all()


def test_words_of_switched_text(spark, sf_mid):
    docs = spark.read.parquet(f"{sf_mid}/documents.parquet")
    model = language.fit(language.sample(docs.selectExpr("doc_id AS id", "text", "lang"), 100, 4000, 10))
    text = "the and of this that with from und der die das nicht eine auch"
    p = model.marginals(model.emissions(language.tokens(text)), np.array([14]))
    best = [model.langs[i] for i in p.argmax(1)]
    assert best[:5] == ["en"] * 5 and best[-5:] == ["de"] * 5


def test_edges(spark, edges, nothing):
    rows = {(r.doc_id, r.lang_pred): r.score for r in language.identify(edges).collect()}
    assert all(k[1] == "und" and s == 0 for k, s in rows.items() if k[0] in (2, 3, 4)) and all(0 <= s <= 1 for s in rows.values())
    assert language.identify(nothing).count() == 0
    unlabelled = edges.selectExpr("doc_id", "text", "cast(null as string) AS lang")
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    digits = spark.createDataFrame([(1, "12 34 !!")], "doc_id long, text string")
    assert language.predict(digits, language.fit([("a b c d e f g h " * 20, "x"), ("q r s t " * 40, "y")])).first().lang_pred == "und"


def test_middle_of_unspaced_text_decides(spark):
    rng = np.random.default_rng(3)
    some = lambda chars, n: "".join(rng.choice(list(chars), n))
    one, other = "的一是不了人我在有他这中大来上国", "のはをがにでとしたるすいまよあれ"
    model = language.fit([(some(one, 60), "zh") for _ in range(80)] + [(some(other, 60), "ja") for _ in range(80)])
    texts = [(1, some(one, 10) + some(other, 200) + some(one, 10)), (2, some(other, 10) + some(one, 200) + some(other, 10)),
             (3, some(one, 100)), (4, "x" * 100)]
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert (got[1].lang_pred, got[2].lang_pred, got[3].lang_pred) == ("ja", "zh", "zh")
    for _, text in [*texts, (0, "a é日本" * 30 + " b"), (0, "\U0001f600" * 40)]:  # no byte is left out, no character is cut
        parts = language.tokens(text)
        assert b"".join(parts) == text.replace(" ", "").encode() and max(map(len, parts)) <= language.WIDTH - 2
        assert all(p.decode() for p in parts)
