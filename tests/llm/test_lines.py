import random

from pyspark.sql import functions as F
from strataudit.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(500):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 25)))
        b = list(a)
        for _ in range(rng.randint(0, 7)):
            b.insert(rng.randint(0, len(b)), rng.choice("abcd"))
            b.pop(rng.randrange(len(b)))
        assert lines.edits(a, "".join(b)) == distance(a, "".join(b))


def test_repeated_lines(spark, edges, nothing):
    base = "the quick brown fox jumps over the lazy dog near the river bank on a sunny day in the month of june with friends"
    docs = [(3, f"first own line of three here\n{base}"), (1, f"{base}\n\nshort line\nown line of one only here"), (2, f"  {base.upper()}!!\nshort line\nown words of number two here"),
            (4, base.replace("sunny", "rainy") + "\nlast own line of four here"), (5, base), (6, None), (7, "")]
    rows = {r.doc_id: r for r in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[1].text == docs[1][1] and rows[1].n_dropped == 0  # the first by id keeps its line, short lines stay
    assert rows[2].text == "short line\nown words of number two here" and rows[3].text == "first own line of three here"
    assert rows[5].text == "" and (rows[6].text, rows[6].n_lines) == (None, 0) and (rows[7].text, rows[7].n_dropped) == ("", 0)
    assert lines.dedup(nothing).count() == 0
    kept = lines.dedup(edges).collect()
    assert len(kept) == edges.count() and {r.group for r in kept} == {"x"}


def test_crowds_find_what_pairs_find(spark):
    """Many variants of a few lines: comparing with drawn members first gives the groups that all pairs give."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for b in range(3):
        base = [rng.choice(words) for _ in range(60)]
        for i in range(60):
            new = [w if rng.random() > 0.03 else rng.choice(words) for w in base]
            docs.append((len(docs), " ".join(new)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    few = lines.repeats(df, crowd=2).select("id", "of_id").collect()
    all_pairs = lines.repeats(df, crowd=10**9).select("id", "of_id").collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, all_pairs)) and len(few) >= 150


def test_exact_repeats_on_the_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    seen, want = set(), set()
    for r in docs.orderBy("doc_id").collect():
        for no, line in enumerate(r.text.encode().split(b"\n")):
            form = lines.normal(line)
            if form.count(b" ") >= 4:
                want |= {(r.doc_id, no)} if form in seen else set()
                seen.add(form)
    got = {(r.id, r.line) for r in lines.repeats(docs).select("id", F.col("line")).collect()}
    assert want <= got


def test_near_lines_against_edit_similarity(spark):
    """Lines of 5 to 60 words with one or more words changed: nearly all pairs with the similarity end in one group."""
    rng, docs, pairs = random.Random(5), [], []
    letters = "etaoinshrdlu"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 8)))
    for n in (5, 8, 10, 15, 20, 30, 60):
        for _ in range(40):
            base = [word() for _ in range(n)]
            new = list(base)
            for at in rng.sample(range(n), 1 + rng.randrange(max(1, n // 10))):
                new[at] = word()
            a, b = " ".join(base), " ".join(new)
            if a != b and lines.alike(a, b) >= 0.8:
                pairs.append((n, len(docs) + 1))
            docs += [(len(docs), a), (len(docs) + 1, b)]
    got = {r.id for r in lines.repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got <= {b for _, b in pairs}
    for n in {n for n, _ in pairs}:
        of = [b in got for m, b in pairs if m == n]
        print(n, sum(of), len(of))
        assert sum(of) >= 0.9 * len(of)


def test_lines_without_spaces(spark):
    line, near = "今天天气很好我们一起去公园散步然后回家吃晚饭看电视最后早点睡觉", "今天天气很好他们一起去公园散步然后回家吃晚饭看电视最后早点睡觉"
    docs = [(1, f"{line}\n短行"), (2, f"短行\n{line}"), (3, near), (4, "https://example.org/a/very/long/link/to/a/page"), (5, "https://example.org/a/very/long/link/to/a/page\nx")]
    rows = {r.doc_id: r.text for r in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows == {1: docs[0][1], 2: "短行", 3: "", 4: docs[3][1], 5: "x"}


def test_meeting_in_parts():
    """Parts of a bucket give the pairs of the whole for keys with few sketches; each sketch of a crowd gets its draws."""
    import numpy as np

    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    members = np.zeros(400, lines.MEMBER)
    members["key"] = rng.integers(0, 150, 400)
    members["s"] = base[members["key"] % 40] ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    want = {(int(x["s"]), int(y["s"])) for x in members for y in members
            if x["key"] == y["key"] and x["s"] < y["s"] and (int(x["s"]) ^ int(y["s"])).bit_count() <= lines.APART[0]}
    whole, _ = lines._meet(members, 50, 3, 0)
    first, seen = lines._meet(members[:200], 50, 3, 0)
    second, _ = lines._meet(np.concatenate([seen, members[200:]]), 50, 3, 0)
    assert set(map(tuple, whole.tolist())) == want == set(map(tuple, np.concatenate([first, second]).tolist()))
    sized = members.copy()
    sized["n"] = members["s"] % np.uint64(7)
    got, _ = lines._meet(sized, 50, 3, 2)
    assert set(map(tuple, got.tolist())) == {(x, y) for x, y in want if abs(x % 7 - y % 7) <= 2 and (x ^ y).bit_count() <= lines.APART[min(x % 7, y % 7)]}
    crowd = members[:100].copy()
    crowd["key"], crowd["s"] = 1, np.uint64(77) ^ np.arange(100).astype(np.uint64)
    pairs, seen = lines._meet(crowd, 8, 3, 0)
    times = np.unique(pairs, return_counts=True)[1]
    assert len(times) == 100 and times.min() >= 3 and len(pairs) < 310 and len(seen) == 8
    assert [len(x) for x in lines._meet(members[:0], 8, 3, 0)] == [0, 0]


def test_crowds_lose_no_link(spark):
    """Families of lines whose sketches are near although their texts are not all similar: stars alone leave links out."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for _ in range(6):
        base = [rng.choice(words) for _ in range(24)]
        for _ in range(12):
            family = [w if rng.random() > 0.12 else rng.choice(words) for w in base]
            for _ in range(4):
                docs.append((len(docs), " ".join(w if rng.random() > 0.06 else rng.choice(words) for w in family)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    few = lines.repeats(df, crowd=1, draws=1).select("id", "of_id").collect()
    all_pairs = lines.repeats(df, crowd=10**9).select("id", "of_id").collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, all_pairs)) and len(few) >= 100


def test_similarity_is_decided_as_the_distance_does():
    """Gaps between common words say yes only where the distance does, and say it for most pairs that differ by words."""
    rng = random.Random(3)
    words = [f"w{i}x" for i in range(40)] + ["\u00e9t\u00e9", "\u65e5\u672c"]
    close = 0
    for n in range(400):
        a = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        b = [rng.choice(words) if rng.random() < (n % 10) / 20 else w for w in a if rng.random() > 0.03]
        a, b = " ".join(a), " ".join(b).replace("w1x", "w1 x" if n % 3 else "w1y")
        assert lines.reaches(a, b, 0.8) == (lines.alike(a, b) >= 0.8)
        between = lines.gaps(a, b)
        assert sum(lines.edits(x, y) for x, y in between) >= lines.edits(a, b)
        close += sum(max(len(x), len(y)) for x, y in between) <= 0.2 * max(len(a), len(b))
    assert close >= 100
    assert lines.gaps("one two", "one two") == [] and lines.gaps("", "one") == [(" ", "one ")]


def test_distances_side_by_side():
    """Many pairs at once have the distances that they have one by one, up to the number asked for, and more than it where they are farther apart."""
    rng, pairs = random.Random(6), [("", ""), ("", "abc")]
    for n in range(1200):
        a = "".join(rng.choice("abc\u00e9\u65e5\U0001f600 ") for _ in range(rng.choice((0, 1, 3, 62, 63, 64, 65, 66, 127, 128, 129, 200))))
        b = list(a)
        for _ in range(rng.randint(0, 1 + len(a) // 3)):
            b.insert(rng.randint(0, len(b)), rng.choice("abcd"))
            if rng.random() < 0.7:
                b.pop(rng.randrange(len(b)))
        moved = rng.randint(0, len(b)) if n % 7 == 0 else 0
        pairs.append((a, "".join(b[moved:] + b[:moved])))
    want = [lines.edits(*p) for p in pairs]
    for most in (0, 1, 12, 63, 64, 65, 250):
        for got, edited in zip(lines.edits_of(pairs, [most] * len(pairs)), want, strict=True):
            assert got == edited if edited <= most else got > most
    close = [lines.alike(*p) >= 0.8 for p in pairs]
    assert lines.all_reach(pairs, 0.8) == lines.all_reach(pairs, 0.8, likely=False) == close and 100 < sum(close) < len(close) - 100


def test_lines_that_only_share_a_crowded_key_are_not_compared():
    """In a whole bucket, a sketch that is near no other of its key, but for those it is paired with, need not meet them again; no near pair is lost."""
    import numpy as np

    rng = np.random.default_rng(4)
    members = np.zeros(600, lines.MEMBER)
    members["key"] = rng.integers(0, 10, 600)
    members["s"] = rng.integers(0, 1 << 63, 600, np.uint64)
    near = rng.integers(0, 600, 300)
    members["s"][near] = members["s"][0] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    members["n"] = rng.integers(200, 204, 600)
    every, some = [], []
    pairs, _ = lines._meet(members, 8, 1, 8, False, every)
    again, _ = lines._meet(members, 8, 1, 8, False, some, True)
    assert set(map(tuple, pairs.tolist())) == set(map(tuple, again.tolist()))
    some, pairs = set(map(tuple, some[0].tolist())), set(map(tuple, pairs.tolist()))
    assert len(some) <= 0.6 * len(every[0])
    for x in members:
        for y in members:
            apart = (int(x["s"]) ^ int(y["s"])).bit_count()
            if x["key"] == y["key"] and x["s"] < y["s"] and apart <= lines.APART[min(x["n"], y["n"])] and abs(int(x["n"]) - int(y["n"])) <= 8:
                assert (x["s"], y["s"]) in pairs or {(x["s"], x["key"]), (y["s"], y["key"])} <= some


def test_distances_take_a_few_operations_a_column(monkeypatch):
    """All words of a column near the diagonal are worked on at once, so a batch of pairs takes as many operations as its texts are long."""
    import numpy as np

    class Counted:
        calls = 0

        def __getattr__(self, name):
            self.calls += name == "invert"
            return getattr(np, name)

    rng = random.Random(8)
    pairs = [("".join(rng.choices("abcdefgh ", k=640)), "".join(rng.choices("abcdefgh ", k=600))) for _ in range(80)]
    want = [lines.edits(*p) for p in pairs]
    counted = Counted()
    monkeypatch.setattr(lines, "np", counted)
    got = lines._edits_at_once(pairs, 639).tolist()
    assert got == want and counted.calls <= 2 * (640 + 11)


def test_lines_are_normal_in_whole_texts():
    """Lines of a text that is normalised at once are the normal forms of each line."""
    import pyarrow as pa

    rng = random.Random(9)
    kinds = ["a", "B", " ", "  ", "\t", "\n", "\r", "\v", "\f", ".", "é", "日", "\x1c", "\x85", "　", " Two, words", "\0"]
    texts = ["".join(rng.choices(kinds, k=rng.randint(0, 90))) for _ in range(2000)] + [None, ""]
    for least in (0, 1, 2, 5):
        want = [(row, no, form) for row, text in enumerate(texts) for no, line in enumerate((text or "").encode().split(b"\n"))
                if (form := lines.normal(line)) and (form.count(b" ") >= least - 1 or len(form.decode()) >= lines.LEAST_CHARS)]
        assert list(lines._texts_of(pa.record_batch([pa.array(texts)], names=["text"]), "text", least)) == want
