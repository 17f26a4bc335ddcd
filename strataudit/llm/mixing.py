"""Mix sources to target weights: fixed blocks of words, drawn per shard, taken through index permutations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataudit.llm.common import WORD, kept

WEIGHTS = (3, 1, 2)
ROUNDS = [np.uint64(r * 0x9E3779B97F4A7C15 % 2**64) for r in range(4)]


@dataclass
class Mix:
    """``sources``: one row per source. ``docs``: each row's place in its source's stream of words. ``slots``: the
    blocks of the mix, in shards. ``taken``: ``docs`` with the words that the mix takes of each, repeats counted."""

    sources: DataFrame
    docs: DataFrame
    slots: DataFrame
    taken: DataFrame


def numbered(sizes: DataFrame, per_range: int) -> DataFrame:
    """``sizes`` with ``src``, the number of the source by code point, null last: ranges of sources, each numbered from where it starts."""
    ranges = max(1, -(-sizes.count() // per_range))
    order = F.col("source").asc_nulls_last()
    cut = kept(sizes.repartitionByRange(ranges, order).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(order))
    return cut.withColumn("within", within).join(starts, "range").select("source", "source_size", (F.col("base") + F.col("within") - 1).alias("src"))


def filled(caps: DataFrame, total: float) -> float | None:
    """The level at which the sources' ``least(cap, level * weight)`` sum up to ``total``; None if all caps together are less.

    It rises from the level without caps: what full sources leave over is shared out among the others until no other is full. A
    step brings one row to the driver.
    """
    level = 0.0
    while True:
        full = F.col("cap") <= F.col("weight") * level
        row = caps.agg(F.sum(F.when(full, F.col("cap"))).alias("taken"), F.sum(F.when(~full, F.col("weight"))).alias("left")).first()
        if row.left is None:
            return None
        raised = (total - (row.taken or 0.0)) / row.left
        if raised <= level:
            return level
        level = raised


def targets(sizes: DataFrame, share: float, weights: tuple[int, ...], most: float, block: int, per_range: int = 1 << 16) -> DataFrame:
    """``src`` (number of the source by code point, null last), its target in words, its blocks and its slots.

    Targets are the level times the weight, or ``most`` times the size where that is less, and sum up to ``share`` of
    all sizes: what sources cannot take is shared out by weight among the others.
    """
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") % len(weights)).cast("int"))
    step = kept(numbered(sizes, per_range).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))))
    level = filled(step, share * float(step.agg(F.sum("source_size")).first()[0] or 0))
    step = step.withColumn("target", F.col("cap") if level is None else F.least("cap", F.lit(level) * F.col("weight")))
    blocks = F.ceil(F.col("source_size") / block)
    return (step.withColumn("blocks", blocks.cast("bigint"))
            .withColumn("n_slots", F.when(F.col("source_size") > 0,
                                          F.round(F.col("target") * blocks / F.col("source_size"))).otherwise(0).cast("bigint"))
            .select("src", "source", "source_size", "target", "blocks", "n_slots"))


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input flips about half of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of 0 .. size-1, one for each key: a Feistel network over the next power of four,
    walked along until it falls inside."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2).astype(np.float64)) / 2)).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], low[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in ROUNDS:
            left, right = right, left ^ (mixed_bits(right + k + r) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _key(seed: int, *parts: np.ndarray) -> np.ndarray:
    key = np.full(len(parts[0]), seed, np.uint64)
    for part in parts:
        key = mixed_bits(key * np.uint64(31) + part.astype(np.uint64) + np.uint64(1))
    return key


SHARDS_AT_ONCE = 1 << 10
MOST_TASKS = 1 << 14


def draw(sources: DataFrame, shards: int, seed: int, at_once: int = SHARDS_AT_ONCE) -> DataFrame:
    """For each source and shard: how many slots of the shard the source gets, and its slots before these.

    Each slot of a source falls into any shard alike: multinomial counts per shard, of which each source's sum is known. They are drawn
    for groups of ``at_once`` shards first and then, in tasks of their own, within each group, which is the same distribution.
    """
    groups = -(-shards // at_once)
    sizes = np.full(groups, at_once)
    sizes[-1] = shards - at_once * (groups - 1)

    def over_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for src, blocks, n in zip(pdf["src"], pdf["blocks"], pdf["n_slots"], strict=True):
                counts = np.random.default_rng([seed, int(src)]).multinomial(int(n), sizes / shards)
                yield pd.DataFrame({"src": src, "blocks": blocks, "group": np.arange(groups), "first": np.cumsum(counts) - counts,
                                    "n": counts})[counts > 0]

    def over_shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for src, blocks, group, first, n in pdf.itertuples(index=False):
                many = int(sizes[group])
                counts = np.random.default_rng([seed, int(src), int(group), 1]).multinomial(int(n), np.full(many, 1 / many))
                yield pd.DataFrame({"src": src, "blocks": blocks, "shard": group * at_once + np.arange(many),
                                    "first": first + np.cumsum(counts) - counts, "n": counts})[counts > 0]

    grouped = sources.select("src", "blocks", "n_slots").where("n_slots > 0").mapInPandas(
        over_groups, "src bigint, blocks bigint, group bigint, first bigint, n bigint")
    return grouped.repartition(min(groups, MOST_TASKS), "src", "group").mapInPandas(
        over_shards, "src bigint, blocks bigint, shard bigint, first bigint, n bigint")


def drawn_blocks(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """One row per slot: shard, source, the source's running slot number and the block it shows. A source's slots pass
    through all its blocks in one pseudorandom order, then through all again in another. Slots are made where their shard's counts
    lie, spread over a task per shard (16,384 at most)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            slot, size, src = (pdf[c].to_numpy(np.int64) for c in ("slot", "blocks", "src"))
            yield pd.DataFrame({"shard": pdf["shard"], "src": src, "slot": slot,
                                "block": permuted(slot % size, size, _key(seed, src, slot // size))})

    spread = counts.repartition(min(shards, MOST_TASKS), "src", "shard")
    slots = spread.select("shard", "src", "blocks", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("slot"))
    return slots.mapInPandas(run, "shard bigint, src bigint, slot bigint, block bigint")


def placed(sized: DataFrame, sources: DataFrame, rows_per_group: int, seed: int) -> DataFrame:
    """``sized`` with ``src`` and ``start``, where the row begins in its source's stream of words.

    A running sum in two steps, over groups of about ``rows_per_group`` rows of a source and then within each, so a
    source with a third of all rows is spread over many tasks. Rows lie by a hash of id and text: those without an id, or with one
    id, are spread as well. Rows that agree in both lie side by side and go through the sums as one.
    """
    groups = max(1, -(-sized.count() // rows_per_group))
    alike = sized.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("copies"))
    named = (alike.join(sources.select("src", F.col("source").alias("name")), F.col("source").eqNullSafe(F.col("name")))
             .drop("name").withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "text_hash"))
             .withColumn("group", F.pmod("place", F.lit(groups))).withColumn("all", F.col("size") * F.col("copies")))
    before = Window.partitionBy("src").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = named.groupBy("src", "group").agg(F.sum("all").alias("n")).select(
        "src", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("src", "group").orderBy("place", "doc_id", "text_hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (named.withColumn("within", F.coalesce(F.sum("all").over(within), F.lit(0))).join(starts, ["src", "group"])
            .select("doc_id", "src", "source", "size", (F.col("base") + F.col("within")).alias("begin"),
                    F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"))
            .select("doc_id", "src", "source", "size", (F.col("begin") + F.col("copy") * F.col("size")).alias("start")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5,
        weights: tuple[int, ...] = WEIGHTS, most: float = 2.0, block: int = 64, slots_per_shard: int = 1 << 16,
        rows_per_group: int = 4096, seed: int = 20240607) -> Mix:
    """Mix ``share`` times the words of all rows, from sources in proportion to ``weights``, each at most ``most``
    times over.

    Words are runs of non-blank characters; a null text has none. A source's rows, in an order drawn by id, form one
    stream of words, cut into blocks. A null source is a source of its own; null or repeated ids, empty texts and empty
    tables are rows like any other (an empty table gives empty frames). All draws follow from ``seed``, so reruns agree.
    Other columns are not read.
    """
    sized = kept(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                             F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), F.xxhash64(text_col).alias("text_hash")))
    sizes = kept(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = kept(targets(sizes, share, weights, most, block))
    shards = max(1, -(-(sources.agg(F.sum("n_slots")).first()[0] or 0) // slots_per_shard))
    slots = drawn_blocks(draw(sources, shards, seed), shards, seed)
    where = kept(placed(sized, sources, rows_per_group, seed))
    pieces = words_in_blocks(where, block)
    times = slots.groupBy("src", "block").agg(F.count("*").alias("times"))
    some = (pieces.join(times, ["src", "block"], "left").groupBy("doc_id", "src", "size", "start")
            .agg(F.coalesce(F.sum(F.col("words") * F.col("times")), F.lit(0)).alias("taken")))
    none = where.where("size = 0").select("doc_id", "src", "size", "start", F.lit(0).cast("bigint").alias("taken"))
    taken = some.union(none).join(sources.select("src", "source", "source_size", "target"), "src")
    return Mix(sources, where, slots, taken)


def words_in_blocks(where: DataFrame, block: int) -> DataFrame:
    """A row for each block that a document reaches into: from which of its words, and how many."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    begin, end = F.col("block") * block, (F.col("block") + 1) * block
    return (where.where("size > 0").select("doc_id", "src", "size", "start", F.explode(F.sequence(first, last)).alias("block"))
            .withColumn("skip", F.greatest(begin - F.col("start"), F.lit(0)))
            .withColumn("words", F.least(end, F.col("start") + F.col("size")) - F.greatest(begin, F.col("start"))))


def texts(docs: DataFrame, made: Mix, id_col: str = "doc_id", text_col: str = "text", block: int = 64) -> DataFrame:
    """The mix itself: shard, source, slot and the block's words, joined by index. Ids must be unique here."""
    words = docs.select(F.col(id_col).alias("doc_id"), F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)).alias("all"))
    pieces = words_in_blocks(made.docs, block).join(words, "doc_id").select(
        "src", "block", F.struct("start", F.slice("all", F.col("skip").cast("int") + 1, F.col("words").cast("int"))
                                 .alias("words")).alias("piece"))
    blocks = pieces.groupBy("src", "block").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    return made.slots.join(blocks, ["src", "block"]).join(made.sources.select("src", "source"), "src").select(
        "shard", "source", "slot", F.array_join(F.flatten("pieces.words"), " ").alias("text"))
