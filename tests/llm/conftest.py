import sys

import pytest

LONG = " ".join(f"word{i % 977}x" for i in range(40_000))
# id, text, language, source: nulls in every column, empty and blank texts, a very long one, repeated ids, repeated rows
EDGES = [(1, "one two three four five six seven", "en", "a"), (2, None, "en", None), (3, "", None, "b"), (4, " \t\n ", "de", "b"),
         (5, LONG, "en", "a"), (None, "one two three four five six seven", None, None), (6, "ONE two  three four\nfive six seven", "en", "a"),
         (6, "another text under the same id as before", "en", "c"), (7, "same row twice here in this table", "fr", "a"),
         (7, "same row twice here in this table", "fr", "a"), (8, "émile ate a naïve crêpe ünder the ß", "fr", "b")]
# names that operators use inside
CLASHES = ("fp", "k", "id", "row", "keep", "limit", "k_", "group", "size", "known", "random", "n_lines", "chunk", "held_out", "nats", "score")


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def edges(spark):
    rows = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in EDGES]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 1, None), (8, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")


sys.setrecursionlimit(10_000)
