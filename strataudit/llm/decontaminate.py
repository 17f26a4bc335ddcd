"""Passages of a benchmark in training text, found by spaced seeds that tolerate changed words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataudit.llm import marks
from strataudit.llm.common import column_type, kept, pieces, utf8, written
from strataudit.llm.lines import keyed, normal

#: Which of the words in a window count; at any dash the words may differ.
MASKS = ("######", "##-#--##-##", "#-##--#-#-##-#", "###---#--#---##")
PIECE = 1 << 20  # bytes of text whose words are known at once
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


class WordHashes(dict):
    """A 64-bit hash per word, computed when it is first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = xxhash.xxh3_64_intdigest(word)
        return self[word]

    def of(self, text: bytes) -> np.ndarray:
        """The hashes of the words of a text in normal form."""
        words = normal(text).split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def seeds(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The hash at each place where the mask fits: of the words it does not ignore, in order."""
    fit = len(words) - len(mask) + 1
    if fit <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(fit, number + 1, np.uint64)
    for at, mark in enumerate(mask):
        if mark == "#":
            out = (out ^ words[at:at + fit]) * _MULTIPLIERS[at % 4]
            out ^= out >> np.uint64(29)
    return out


def _hits(texts: list[bytes], masks: tuple[str, ...], wanted: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row, places and hashes of its seeds, of all masks; only those that may be wanted."""
    seen = WordHashes()
    for row, text in enumerate(texts):
        words = seen.of(text)
        if len(seen) > 1 << 18:
            seen = WordHashes()
        for number, mask in enumerate(masks):
            h = seeds(words, mask, number)
            at = np.flatnonzero(marks.among(wanted, h)) if wanted is not None else np.arange(len(h))
            if len(at):
                yield row, at, h[at]


def seed_rows(docs: DataFrame, masks: tuple[str, ...], wanted: np.ndarray | None = None) -> DataFrame:
    """``k``, ``id`` of the text, ``at`` (number of the word where the mask begins), ``h``; for bounded ``wanted`` see ``marks``."""
    shared = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            for row, at, h in _hits(utf8(batch.column("text")), masks, None if shared is None else shared.value):
                ids = batch.select(["k", "id"]).take(pa.array(np.full(len(at), row)))
                yield pa.RecordBatch.from_arrays([*ids.columns, pa.array(at.astype(np.int32)), pa.array(h.view(np.int64))], names=["k", "id", "at", "h"])

    return docs.mapInArrow(run, f"k bigint, id {column_type(docs, 'id')}, at int, h bigint")


def _matched(item: np.ndarray, text: np.ndarray, offset: int) -> tuple[int, int, int]:
    """Along one diagonal: the run of words with the best balance of equal (+1) and changed (-2) words; the equal ones
    in it, and where it begins and ends in the item."""
    begin, end = max(0, -offset), min(len(item), len(text) - offset)
    gain = np.where(item[begin:end] == text[begin + offset:end + offset], 1, -2)
    total = np.concatenate(([0], np.cumsum(gain)))
    low = np.minimum.accumulate(total)
    stop = int(np.argmax(total - low))
    start = int(np.argmin(total[:stop + 1]))
    return int((gain[start:stop] > 0).sum()), begin + start, begin + stop


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", masks: tuple[str, ...] = MASKS, least_words: int = 8, share: float = 0.5) -> DataFrame:
    """``k`` and ``id`` of the document, ``item``, ``at`` (the word of the document where the overlap begins), ``words`` (its
    length) and ``equal`` (words that agree), for each overlap that is ``least_words`` long, or the whole item if that is shorter, and in
    which the equal words are at least ``share`` of the item's, or 13 and more.

    Both sides are hashed under each mask. A document's seeds leave it only if a fixed-size set of the benchmark's
    says that they may match; those are joined by hash, and what shares a seed is compared word by word along the seed's
    diagonal, so that changed words on either side of it are tolerated. Items with fewer words than the shortest mask
    are compared as a whole, through a hash of all their words. Null and empty texts overlap with nothing.
    """
    items = benchmark.select(F.xxhash64(item_col, item_text_col).alias("k"), F.col(item_col).alias("id"), F.col(item_text_col).alias("text"))
    rows = keyed(docs, id_col, text_col)
    short = _short_masks(items, masks)
    masks = masks + short
    theirs = kept(seed_rows(items.dropDuplicates(["k"]), masks))
    wanted = marks.marked(theirs, "h")
    ours = seed_rows(rows, masks, wanted)
    pairs = ours.join(theirs.select("h", F.col("k").alias("item_k"), F.col("at").alias("item_at")), "h") \
        .select("k", "item_k", (F.col("at") - F.col("item_at")).alias("offset")).distinct()
    found = written(pairs.groupBy("k", "item_k").agg(F.collect_set("offset").alias("offsets")), "overlaps")
    near = rows.join(found, "k").dropDuplicates(["k", "item_k"]).withColumnRenamed("text", "doc_text").join(
        items.dropDuplicates(["k"]).select(F.col("k").alias("item_k"), F.col("id").alias("item"), F.col("text").alias("item_text")), "item_k")
    item_type = column_type(items, "id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "doc_text", PIECE):
            seen = WordHashes()
            keep, out = [], []
            columns = (utf8(batch.column("doc_text")), utf8(batch.column("item_text")), batch.column("offsets").to_pylist())
            for row, (text, item, offsets) in enumerate(zip(*columns, strict=True)):
                a, b = seen.of(item), seen.of(text)
                for offset in sorted(offsets):
                    equal, begin, end = _matched(a, b, offset)
                    if end - begin >= min(least_words, len(a)) and (equal >= share * len(a) or equal >= 13):
                        keep.append(row)
                        out.append((begin + offset, end - begin, equal))
            ids = batch.select(["k", "id", "item"]).take(pa.array(keep, pa.int64()))
            numbers = [pa.array([x[i] for x in out], pa.int32()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*ids.columns, *numbers], names=["k", "id", "item", "at", "words", "equal"])

    return near.select("k", "id", "item", "doc_text", "item_text", "offsets").mapInArrow(
        verify, f"k bigint, id {column_type(rows, 'id')}, item {item_type}, at int, words int, equal int")


def _short_masks(items: DataFrame, masks: tuple[str, ...]) -> tuple[str, ...]:
    """Masks without gaps for the lengths, below the shortest mask, that items have."""
    least = min(map(len, masks))
    n = F.size(F.filter(F.split(F.regexp_replace("text", "[!-/:-@\\[-`{-~]", ""), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    lengths = items.select(n.alias("n")).where((F.col("n") > 0) & (F.col("n") < least)).distinct().collect()  # fewer than the mask has words
    return tuple("#" * r["n"] for r in sorted(lengths, key=lambda r: r["n"]))


def contaminated(found: DataFrame) -> DataFrame:
    """One row per document with an overlap: ``k``, ``id``, its ``items`` in order, and the most words that agree."""
    return found.groupBy("k", "id").agg(F.array_sort(F.collect_set("item")).alias("items"), F.max("equal").alias("equal"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without an overlap with the benchmark (see ``overlaps``)."""
    found = written(overlaps(docs, benchmark, id_col, text_col, **options).select(F.col("k").alias("k_")).distinct(), "found")
    return docs.withColumn("k_", F.xxhash64(id_col, text_col)).join(found, "k_", "left_anti").drop("k_")
