"""Secrets in text: patterns for known kinds, and two character Markov models for the unknown ones. SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataudit.llm.common import kept

# The known kinds in their order, their patterns, the group that is measured and its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the runs of AKIA[A-Z0-9]+ with 20 characters or more
HEX = r"[0-9a-f]{24,}"
KINDS = [("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24)]

FIRST, CODES = 43, 80  # token characters lie between "+" and "z"; a pair has the number first * CODES + second
CHARS = "A-Za-z0-9+/_=-"
TOKEN = f"[{CHARS}]"
SYMBOLS = 67  # what may follow a character: the token characters and the dot of assigned values
#: Words, and identifiers of words joined by case or by one of _ / -
ORDINARY = rf"(?<!{TOKEN})(?={TOKEN}{{%d}})[A-Za-z][a-z]++(?:[_/-][A-Za-z]?[a-z]++|[A-Z][a-z]++)*+(?!{TOKEN})"
NAMES = r"(?i)(password|passwd|secret|token|api_?key)$"
PARTS, LEAST_RATIO = 5, 12.0


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _sums(sizes: Column) -> Column:
    """For each number of an array, the sum of those before it. An array of n is summed in runs of about the root of n, since what is
    appended to is copied: n ** 1.5 copies, where one run would make n ** 2 / 2."""
    def run(numbers: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(numbers, begin, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.array_append(acc["before"], acc["at"]).alias("before")))

    def runs(x: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(x))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(x), width), lambda at: run(F.slice(x, at, width)))

    def joined(parts: Column) -> Column:
        return F.flatten(F.zip_with(parts, run(F.transform(parts, lambda r: r["at"]))["before"],
                                    lambda r, before: F.transform(r["before"], lambda n: n + before)))

    return _let(sizes, lambda x: _let(runs(x), joined))


def _spans(text: Column, kind: str, rank: int, pattern: str, group: int, least: int) -> Column:
    """Array of (start, rank, end, kind, value): leftmost non-overlapping matches whose group has ``least`` characters, in code points,
    end exclusive.

    The pieces between the matches and the matches themselves alternate, so their lengths add up to the positions.
    """
    def placed(part: Column) -> Column:
        start = part["before"] + F.length(part["gap"])
        return F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(part["whole"])).alias("end"),
                        F.lit(kind).alias("kind"), part["value"].alias("value"))

    def found(parts: Column) -> Column:
        before = _sums(F.transform(parts, lambda p: F.length(p["gap"]) + F.length(p["whole"])))
        sized = F.zip_with(parts, before, lambda p, b: F.struct(p["gap"].alias("gap"), p["whole"].alias("whole"), b.alias("before"), (
            F.regexp_extract(p["whole"], pattern, group) if group else p["whole"]).alias("value")))
        return F.transform(F.filter(sized, lambda p: F.length(p["value"]) >= least), placed)

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(F.split(text, pattern, -1), whole, lambda gap, one: F.struct(gap.alias("gap"), one.alias("whole")))
    return F.when(text.rlike(pattern), _let(F.filter(parts, lambda p: p["whole"].isNotNull()), found)) \
        .otherwise(F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>"))


def _known(text: Column) -> Column:
    return F.concat(*[_spans(text, k, i, p, g, n) for i, (k, p, g, n) in enumerate(KINDS)])


def _pairs(token: Column) -> Column:
    """The numbers of the pairs of neighbouring characters."""
    code = lambda i: F.ascii(F.substr(token, i, F.lit(1))) - FIRST
    return F.when(F.length(token) > 1, F.transform(F.sequence(F.lit(1), F.length(token) - 1),
                                                  lambda i: code(i) * CODES + code(i + 1)))


def _score(token: Column, ratios: list[float]) -> Column:
    """Log-likelihood ratio of a string, in nats."""
    table = F.lit(np.array(ratios))
    return F.aggregate(F.coalesce(_pairs(token), F.array().cast("array<int>")), F.lit(0.0), lambda acc, p: acc + F.get(table, p))


def samples(docs: DataFrame, text_col: str = "text", least: int = 12) -> DataFrame:
    """Labelled strings with their count ``n``: ``label`` 1 for values that a known kind captures, 0 for words and identifiers made of words, of
    ``least`` characters or more. Strings of other forms, such as runs of digits, have no label. A fixed fifth of the strings is ``held_out``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    random = F.transform(_known(text), lambda s: F.struct(F.lit(1).alias("label"), s["value"].alias("t")))
    ordinary = F.transform(F.regexp_extract_all(text, F.lit(ORDINARY % least), F.lit(0)), lambda t: F.struct(F.lit(0).alias("label"), t.alias("t")))
    every = docs.select(F.explode(F.concat(random, ordinary)).alias("s")).groupBy("s.label", "s.t").agg(F.count("*").alias("n"))
    return every.withColumn("held_out", F.pmod(F.xxhash64("t"), F.lit(PARTS)) == 0)


def ratios_of(labelled: DataFrame, prior: float = 0.5, lean: float = 5.0) -> list[float]:
    """For each pair of characters, log P(second | first) among random strings less that among ordinary ones, from ``samples``.

    A pair's probability leans on that of its second character, as by ``lean`` more pairs, and that on even odds, as by ``prior`` more of
    each: characters that identifiers lack tell, even in pairs never seen. Without samples of both labels all ratios are 0 and decide nothing.
    """
    one = F.when(F.col("label") == 1, F.col("n")).otherwise(0)
    counts = (labelled.select(one.alias("n1"), (F.col("n") - one).alias("n0"), F.explode(_pairs(F.col("t"))).alias("pair"))
              .groupBy("pair").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")))
    first, second = (F.col("pair") / CODES).cast("int"), F.col("pair") % CODES
    after = counts.groupBy(first.alias("first")).agg(F.sum("n1").alias("m1"), F.sum("n0").alias("m0"))
    alone = counts.groupBy(second.alias("second")).agg(F.sum("n1").alias("u1"), F.sum("n0").alias("u0"))
    every = labelled.sparkSession.range(CODES * CODES).select(F.col("id").cast("int").alias("pair"))
    whole = Window.partitionBy()  # a row per pair of characters
    rows = (every.join(counts, "pair", "left").join(after, first == F.col("first"), "left").join(alone, second == F.col("second"), "left")
            .fillna(0, ["n1", "n0", "m1", "m0", "u1", "u0"]).withColumn("t1", F.sum("n1").over(whole)).withColumn("t0", F.sum("n0").over(whole)))

    def log_p(label: int) -> Column:
        n, m, u, t = (F.col(f"{c}{label}") for c in "nmut")
        return F.ln((n + lean * (u + prior) / (t + prior * SYMBOLS)) / (m + lean))

    ratio = F.when((F.col("t1") > 0) & (F.col("t0") > 0), log_p(1) - log_p(0)).otherwise(0.0)
    return [row["ratio"] for row in rows.select("pair", ratio.alias("ratio")).sort("pair").collect()]  # CODES * CODES rows, whatever the corpus


def train(docs: DataFrame, text_col: str = "text", least: int = 12) -> list[float]:
    """The ratios of pairs of characters, from the samples of ``docs`` that are not held out."""
    return ratios_of(samples(docs, text_col, least).where("NOT held_out"))


def held_out(labelled: DataFrame, ratios: list[float], alarms: float = 1e-3) -> dict[str, float]:
    """What the samples that are held out say of a model: ``threshold``, the ratio that a share of ``alarms`` of the ordinary strings reach, but
    ``LEAST_RATIO`` at least, and the ``recall`` of random strings with a larger ratio (0 without any)."""
    scored = labelled.where("held_out").select("label", "n", _score(F.col("t"), ratios).alias("ratio"))
    limit = scored.where("label = 0").agg(F.percentile_approx("ratio", 1 - alarms, 10_000).alias("limit")).first()["limit"]
    threshold = max(LEAST_RATIO, limit or 0.0)
    of = scored.where("label = 1").agg((F.sum(F.when(F.col("ratio") > threshold, F.col("n")).otherwise(0)) / F.sum("n")).alias("recall")).first()
    return {"threshold": threshold, "recall": of["recall"] or 0.0}


def scan(docs: DataFrame, text_col: str = "text", model: list[float] | None = None, least: int = 16,
         threshold: float | None = None) -> DataFrame:
    """``docs`` with the arrays ``known`` and ``random`` of (start, rank, end, kind, value), by start and kind.

    ``known`` are the matches of the fixed kinds. ``random`` are runs of ``least`` or more token characters outside assignments,
    without an access key or hex string in them and not ending in the name of an assignment, whose log-likelihood ratio under ``model`` is above
    ``threshold`` nats. By default the model is trained on ``docs``, and the threshold chosen on samples held out from it
    (``LEAST_RATIO`` for a given model). Letters, digits, and ``+/_=-`` are token characters, so card numbers are random strings too. A row's
    spans depend on its own text and the model only: rows and ids may repeat or be null, a null text is empty, and columns of
    ``docs`` with these two names are replaced. Work grows with the length of a text, and with the power 1.5 of the number of its matches.
    """
    if model is None:
        labelled = kept(samples(docs, text_col))
        model = ratios_of(labelled.where("NOT held_out"))
        threshold = held_out(labelled, model)["threshold"] if threshold is None else threshold
    threshold = LEAST_RATIO if threshold is None else threshold
    text = F.coalesce(F.col(text_col), F.lit(""))
    run = f"(?<!{TOKEN}){TOKEN}{{{least},}}"
    plain = _spans(text, "random", len(KINDS), run, 0, least)
    beside = _spans(text, "random", len(KINDS), f"{ASSIGN}|({TOKEN}{{{least},}})", 3, least)
    suspect = lambda s: ~s["value"].rlike(f"{ACCESS}|{HEX}|{NAMES}") & (_score(s["value"], model) > threshold)
    runs = F.when(text.rlike(ASSIGN), beside).otherwise(plain)
    return docs.withColumn("known", F.array_sort(_known(text))).withColumn("random", F.filter(runs, suspect))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, by start and kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
                        ",")
