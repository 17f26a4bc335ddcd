"""Jaccard join of shingle sets by parity sketches: what XOR leaves of two sets is what they do not share."""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataudit.llm import marks
from strataudit.llm.common import column_type, kept, pieces, utf8, written
from strataudit.llm.graph import components

SEED = 42
PIECE = 1 << 22  # bytes of text, or of sets, handled at once
STARS = 3
RUN = 1 << 19  # hashes that are compared with one set at once
WORDS_KNOWN = 1 << 20  # words whose hashes a task remembers
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KNOWN:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, n: int, known: dict) -> np.ndarray:
    """The different hashes of a text's runs of ``n`` words, in order. Fewer words are one shingle; no words, none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):  # each place has an odd factor of its own
        out += h[j:len(h) - width + 1 + j] * np.uint64(int(_MIX) * (2 * j + 3) & 0xFFFFFFFFFFFFFFFF)
    out = np.sort(mixed(out))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


class Bands:
    """Overlapping ranges of set sizes, so that any two sets of similarity ``num / den`` or more share one.

    Band k holds pairs whose smaller set has between ``low[k]`` and ``low[k + 1]`` members and whose larger has at most
    ``high[k]``. Of those, two that are similar enough differ in at most ``most[k]`` members.
    """

    def __init__(self, num: int, den: int):
        g = gcd(num, den)
        self.num, self.den = num // g, den // g
        self.low = [1]
        while self.low[-1] < 1 << 40:
            self.low.append(max(self.low[-1] + 1, self.low[-1] * self.den // self.num))
        self.high = [(b - 1) * self.den // self.num for b in self.low[1:]]
        self.most = [self.allowed(b - 1 + h) for b, h in zip(self.low[1:], self.high, strict=True)]

    def allowed(self, both: int) -> int:
        """Members that may be in one of two sets alone, which have ``both`` members together."""
        return both * (self.den - self.num) // (self.den + self.num)

    def of(self, size: int) -> list[int]:
        """Bands of a set of ``size`` members in which different sets may be linked."""
        return [k for k in range(len(self.high)) if self.low[k] <= size <= self.high[k] and self.most[k]] if size else []


def _blocks(members: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Which blocks have members, and where those of each begin: members are in order, and so are their blocks."""
    starts = np.searchsorted(((members >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), np.arange(blocks, dtype=np.uint64))
    filled = starts < np.append(starts[1:], len(members))
    return filled, starts[filled]


def sketch(members: np.ndarray, blocks: int) -> np.ndarray:
    """The parity sketch: 64 bits for each block, each bit telling whether an odd number of members fell on it. The sketches of
    two sets differ in at most as many bits as the sets differ in members."""
    out = np.zeros(blocks, np.uint64)
    if len(members):
        filled, starts = _blocks(members, blocks)
        out[filled] = np.bitwise_xor.reduceat(np.uint64(1) << (members & np.uint64(63)), starts)
    return out


def keys(members: np.ndarray, bands: Bands) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Band, keys and a coarse sketch for each of the set's bands. A key is the parity of all bits of a block's members, so blocks with other members
    have other keys. A band has ``spare`` blocks and one more than members may differ: two sets that are similar enough have one block more
    than ``spare`` without a difference, and its key in common. Blocks without members, which many sets share, have a key only where a
    set has more than ``spare`` of them: with no more, one of the blocks in common has members. The coarse sketch has about sixteen bits for
    each member that may differ, enough to tell most other sets that share a key apart."""
    out = []
    for k in bands.of(len(members)):
        blocks = bands.most[k] + 1 + spare(bands.most[k])
        filled, starts = _blocks(members, blocks)
        bits = np.zeros(blocks, np.uint64)
        bits[filled] = np.bitwise_xor.reduceat(members, starts)
        place = (np.uint64(k) << np.uint64(48)) + np.arange(blocks, dtype=np.uint64)
        found = mixed(mixed(bits) + mixed(place)).view(np.int64)
        if blocks - len(starts) <= spare(bands.most[k]):
            found = found[filled]
        out.append((k, found, sketch(members, 1 + bands.most[k] // 4).view(np.int64)))
    return out


def spare(most: int) -> int:
    return 1 + most // 32


KEYS = pa.struct([("band", pa.int32()), ("key", pa.int64())])
SKETCHES = pa.struct([("band", pa.int32()), ("bits", pa.list_(pa.int64()))])


def _lists(values: pa.Array, sizes: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), values)


def sets(docs: DataFrame, shingle: int, bands: Bands) -> DataFrame:
    """``id`` and ``at`` of each row with ``fp``, a hash of its set (null of none), and ``size``, the number of members. The first row
    of its kind in a batch also has the ``keys`` and ``sketches`` of its bands; they say the same for its copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in pieces(batches, "text", PIECE):
            fps, sizes, found, seen = [], [], [], set()
            for text in utf8(batch.column("text")):
                members = shingle_set(text, shingle, known)
                fps.append(name(members))
                sizes.append(len(members))
                found.append([] if fps[-1] in seen else keys(members, bands))
                seen.add(fps[-1])
            every = [x for row in found for x in row]
            band = np.array([k for k, _, _ in every], np.int32)
            key = np.concatenate([np.zeros(0, np.int64), *(x for _, x, _ in every)])
            bits = np.concatenate([np.zeros(0, np.int64), *(x for _, _, x in every)])
            of_key = pa.array(np.repeat(band, [len(x) for _, x, _ in every]) if every else band)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("at"), pa.array(fps, pa.int64()), pa.array(sizes, pa.int64()),
                 _lists(pa.StructArray.from_arrays([of_key, pa.array(key)], fields=list(KEYS)), [sum(len(x) for _, x, _ in row) for row in found]),
                 _lists(pa.StructArray.from_arrays([pa.array(band), _lists(pa.array(bits), [len(x) for _, _, x in every])], fields=list(SKETCHES)),
                        list(map(len, found)))], names=["id", "at", "fp", "size", "keys", "sketches"])

    return docs.mapInArrow(run, f"id {column_type(docs, 'id')}, at bigint, fp bigint, size bigint, keys array<struct<band: int, key: bigint>>, "
                                "sketches array<struct<band: int, bits: array<bigint>>>")


def name(members: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(members.tobytes()) - (1 << 63) if len(members) else None


def shared_keys(every: DataFrame) -> DataFrame:
    """``key``, ``band``, ``fp`` and ``low`` of each set of a key that has several, but for the smallest of the key, ``low``. Keys of one
    set, nearly all, are left out before anything is joined."""
    keyed = every.select(F.explode("keys.key").alias("key"), "fp")
    shared = kept(keyed.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high").select("key", "low"))
    wanted = every.sparkSession.sparkContext.broadcast(marks.marked(shared, "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("keys")
            band, key = (x.to_numpy(zero_copy_only=False) for x in column.flatten().flatten())
            some = np.flatnonzero(marks.among(wanted.value, key))
            row = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy(zero_copy_only=False))[some]
            yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(band[some]), batch.column("fp").take(pa.array(row))], names=["key", "band", "fp"])

    some = every.where("size(keys) > 0").select("fp", "keys").mapInArrow(run, "key bigint, band int, fp bigint")
    return written(some.join(shared, "key").where("fp > low").select("key", "band", "fp", "low").distinct(), "members")


def members_of(docs: DataFrame, chosen: DataFrame, shingle: int) -> DataFrame:
    """``fp`` and ``set`` (the hashes in order) of the chosen rows; no other set leaves the documents."""
    chosen = kept(chosen)
    wanted = docs.sparkSession.sparkContext.broadcast(marks.marked(chosen, "at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in pieces(batches, "text", PIECE):
            batch = batch.filter(pa.array(marks.among(wanted.value, batch.column("at").to_numpy(zero_copy_only=False))))
            found = [shingle_set(x, shingle, known).tobytes() for x in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(found, pa.binary())], names=["at", "set"])

    found = docs.select("at", "text").mapInArrow(run, "at bigint, set binary")
    return kept(found.join(chosen, "at").dropDuplicates(["fp"]).select("fp", "set"))


def plausible(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a``, ``b`` of a ``band`` that sizes and coarse sketches do not rule out, each once, with the size of ``b``."""
    pairs = pairs.groupBy("a", "b").agg(F.min("band").alias("band"))
    for side, n, bits in (("a", "m", "p"), ("b", "n", "q")):
        pairs = pairs.join(sketches.select(F.col("fp").alias(side), "band", F.col("size").alias(n), F.col("bits").alias(bits)), [side, "band"])
    return pairs.where(near(num, den)).select("a", "b", F.col("n").alias("b_size"))


def near(num: int, den: int) -> str:
    """Sets of ``m`` and ``n`` members with sketches ``p`` and ``q`` may be similar enough."""
    apart = "aggregate(zip_with(p, q, (u, v) -> bit_count(u ^ v)), 0, (s, d) -> s + d)"
    return f"least(m, n) * {den}L >= greatest(m, n) * {num}L AND {apart} <= (m + n) * {den - num}L div {den + num}L"


def verified(pairs: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets have a similarity of ``num / den`` or more.

    The partners of ``a`` are cut into runs of about ``RUN`` hashes; a run travels with ``a`` once, and runs are dealt into groups
    of that size. So a set with very many partners fills many groups, none of them large.
    """
    load = pairs.groupBy("a").agg(F.ceil(F.sum("b_size") / RUN).alias("runs"))
    groups = max(pairs.agg(F.ceil(F.sum("b_size") / RUN).alias("n")).first()["n"] or 1, 1)
    run = F.pmod(F.xxhash64("b"), F.col("runs"))
    dealt = kept(pairs.join(load, "a").select("a", "b", F.pmod(F.xxhash64(F.col("a"), run), F.lit(groups)).alias("g")))
    of = members.select(F.col("fp"), F.col("set"))
    left = dealt.join(of.withColumnRenamed("fp", "b"), "b").select("g", "a", "b", "set")
    right = dealt.select(F.col("g").alias("g"), F.col("a").alias("a")).distinct().join(of.select(F.col("fp").alias("a"), F.col("set").alias("set")), "a")

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        whole = {a: np.frombuffer(x, np.uint64) for a, x in zip(right.column("a").to_pylist(), right.column("set").to_pylist(), strict=True)}
        good = []
        for a, x in zip(left.column("a").to_pylist(), left.column("set").to_pylist(), strict=True):
            one, two = whole[a], np.frombuffer(x, np.uint64)
            both = len(np.intersect1d(one, two, assume_unique=True))
            good.append(den * both >= num * (len(one) + len(two) - both))
        return left.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return kept(left.groupBy("g").cogroup(right.select(F.col("g").alias("g"), "a", "set").groupBy("g")).applyInArrow(compared, "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``id_col``, ``fp``, ``size`` and ``component_id`` of every row: the hash and number of its different ``shingle``-word runs, and
    the smallest id reachable over links, itself included.

    Two rows are linked if their sets of word runs have a Jaccard similarity of at least ``num / den``, compared exactly, in whole numbers. A-Z
    is lower-cased; a text with fewer words is one run. No linked pair is missed: see ``keys``. Equal sets are one node. Of the sets that
    share a key, each is first compared with the smallest of them, which is then done with; so are ``STARS`` more, all at once. Of the others,
    those in different groups are compared with each other. Sizes and sketches rule out most pairs, the sets themselves decide.

    Sets are known by 64-bit hashes, as are their members. Null texts and texts without words have an empty set: ``fp`` is null, ``size`` 0, and
    they are linked with nothing. Rows without id join a group but keep a null id; rows that repeat an id each have their own
    set; repeated rows are equal sets; an empty table gives an empty result. Other columns are not read.
    """
    bands = Bands(num, den)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("at"))
    every = written(sets(rows, shingle, bands), "fps")
    members = shared_keys(every)
    first = every.where("fp IS NOT NULL").groupBy("fp").agg(F.min("at").alias("at"))
    in_band = members.select("fp", "band").union(members.select("low", "band")).distinct()
    sketches = kept(every.select("fp", "size", F.explode("sketches").alias("s")).select("fp", "s.band", "size", "s.bits").join(
        in_band, ["fp", "band"], "left_semi").dropDuplicates(["fp", "band"]))

    def compared(pairs: DataFrame) -> DataFrame:
        pairs = kept(plausible(pairs, sketches, num, den))
        wanted = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct()
        return verified(pairs, members_of(rows, first.join(wanted, "fp", "left_semi"), shingle), num, den)

    def grouped(links: DataFrame) -> DataFrame:
        return kept(components(links, "a", "b").select(F.col("node").alias("fp"), F.col("root").alias("group")))

    def named(rest: DataFrame, groups: DataFrame) -> DataFrame:
        return rest.select("key", "band", "fp").join(groups, "fp", "left").withColumn("group", F.coalesce("group", "fp"))

    least, most = F.min("group").alias("least"), F.max("group").alias("most")
    links = compared(members.selectExpr("low AS a", "fp AS b", "band"))
    groups = grouped(links)
    open_ = named(members, groups)
    stars = F.array_distinct(F.array(*[F.min_by(F.struct("fp", "group"), F.xxhash64(F.lit(r), "fp")) for r in range(STARS)])).alias("stars")
    met = kept(open_.join(open_.groupBy("key").agg(stars, least, most).where("least < most").select("key", "stars"), "key"))
    pairs = met.withColumn("star", F.explode("stars")).where("fp != star.fp AND group != star.group")
    links = kept(links.union(compared(pairs.selectExpr("least(fp, star.fp) AS a", "greatest(fp, star.fp) AS b", "band"))))
    groups = grouped(links)
    rest = met.where("NOT exists(stars, s -> s.fp = fp)")
    open_ = named(rest, groups)
    several = open_.groupBy("key").agg(least, most).where("least < most").select("key")
    full = open_.join(several, "key", "left_semi").join(sketches, ["fp", "band"])
    x = full.selectExpr("key", "band", "fp AS a", "group AS g", "size AS m", "bits AS p")
    y = full.selectExpr("key", "fp AS b", "group AS h", "size AS n", "bits AS q")
    pairs = x.join(y, "key").where("a < b AND g != h").where(near(num, den)).select("a", "b", "band")
    groups = grouped(links.union(compared(pairs)))
    first_id = every.where("fp IS NOT NULL").groupBy("fp").agg(F.min("id").alias("least"))
    node = kept(first_id.join(groups, "fp", "left").withColumn("group", F.coalesce("group", "fp")))
    smallest = kept(node.groupBy("group").agg(F.min("least").alias("component_id")))
    of = kept(node.join(smallest, "group").select("fp", "component_id"))
    return every.join(of, "fp", "left").select(F.col("id").alias(id_col), "fp", "size", F.when(F.col("fp").isNull(), F.col("id")).otherwise(
        F.col("component_id")).alias("component_id"))
