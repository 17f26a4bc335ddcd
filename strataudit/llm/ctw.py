"""Code lengths of texts under context-tree weighting over bytes, with a word unigram model beside it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataudit.llm import grams
from strataudit.llm.common import column_type, kept, pieces, utf8, written

DEPTH = 4  # bytes of context; with the byte itself they fill the 40 bits of a packed gram
PIECE = 1 << 20  # bytes of text whose grams are sorted at once
CHUNK = 1 << 23  # bytes of text in a chunk, on average
NEIGHBOURS = 2048  # whole ids that share a chunk
HELD = 1 << 19  # words, and grams, that a task holds before it passes their counts on
WORD, GRAM = 0, 1
COMMON = 1 << 17  # words, and grams, whose answers every worker gets; no more, whatever the corpus
END = b"\n"


def encoded(text: bytes) -> tuple[list[bytes], bytes]:
    """Its words, A-Z lower-cased, and the bytes that are coded: the words, single spaces between them, an end."""
    words = text.lower().split()
    return words, b" ".join(words) + END


def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)  # within a bigint


def chunk_of(rows: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """``rows`` (with ``id`` and ``text``) and ``chunk``, a number that depends on the id alone and covers about
    ``chunk_bytes`` of text.

    Neighbouring whole ids share a chunk, so a task that reads them in order names each word and gram once per chunk.
    """
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // chunk_bytes))
    near = F.floor(F.col("id") / NEIGHBOURS) if column_type(rows, "id") in ("bigint", "int", "smallint", "tinyint") else F.col("id")
    return rows.withColumn("chunk", F.pmod(F.xxhash64(near), F.lit(n)))


def _grams_of(texts: list[bytes], train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of the texts, and how often they occur in those that are trained on."""
    keys, counts, at = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= PIECE):
            size += len(texts[end])
            end += 1
        packed, n = grams.packed(texts[at:end], DEPTH + 1)
        gram, row = grams.split(packed)
        keys, counts = grams.runs(np.concatenate((keys, gram)), np.concatenate((counts, n * train[at:end][row])))
        at = end
    return keys, counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(held_out, text) rows to (kind, key, n): how often training texts have each word and gram that occurs at all,
    held-out texts included. A task names most of them once."""
    words: dict[bytes, int] = {}
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys), pa.array(n)], names=["kind", "key", "n"])

    def of_words() -> pa.RecordBatch:
        return rows(WORD, np.fromiter(map(_word_hash, words), np.int64, len(words)), np.fromiter(words.values(), np.int64, len(words)))

    for part in pieces(batches, "text", 4 * PIECE):
        train, coded = ~part.column("held_out").to_numpy(zero_copy_only=False), []
        for one, text in zip(train.astype(int).tolist(), utf8(part.column("text")), strict=True):
            found, line = encoded(text)  # the words of one text at a time: as objects they take many times its bytes
            for w in found:
                words[w] = words.get(w, 0) + one
            coded.append(line)
        more, n = _grams_of(coded, train)
        keys, counts = grams.runs(np.concatenate((keys, more)), np.concatenate((counts, n)))
        if len(words) > HELD:
            yield of_words()
            words = {}
        if len(keys) > HELD:
            yield rows(GRAM, keys.astype(np.int64), counts)
            keys, counts = keys[:0], counts[:0]
    yield of_words()
    yield rows(GRAM, keys.astype(np.int64), counts)


def _asking(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(chunk, text) rows to (chunk, kind, key): the words and grams of each chunk whose answers are not at hand."""
        known = {kind: np.sort(keys) for kind, (keys, _) in common.value.items()}
        for part in pieces(batches, "text", 8 * PIECE):
            chunks = part.column("chunk").to_numpy()
            texts = utf8(part.column("text"))
            for chunk in np.unique(chunks):
                words, coded = set(), []
                for i in np.flatnonzero(chunks == chunk):
                    found, line = encoded(texts[i])
                    words.update(found)
                    coded.append(line)
                asked = {WORD: np.fromiter(map(_word_hash, words), np.int64, len(words)),
                         GRAM: _grams_of(coded, np.ones(len(coded), bool))[0].astype(np.int64)}
                for kind, keys in asked.items():
                    keys = keys[~grams.found(known[kind], keys)[1]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), chunk, np.int64)), pa.array(np.full(len(keys), kind, np.int8)),
                                                      pa.array(keys)], names=["chunk", "kind", "key"])

    return run


def log_kt(a: Column, b: Column) -> Column:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence of ``a`` zeros and ``b`` ones."""
    def log_gamma(x: Column) -> Column:  # Stirling's series eight further on, where it is exact to a double
        y, product = x + 8, x
        for i in range(1, 8):
            product = product * (x + i)
        return (y - 0.5) * F.ln(y) - y + F.lit(float(0.5 * np.log(2 * np.pi))) + 1 / (12 * y) - 1 / (360 * y * y * y) \
            + 1 / (1260 * y * y * y * y * y) - F.ln(product)

    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - F.lit(float(np.log(np.pi)))


def bits(rows: DataFrame) -> DataFrame:
    """Each gram's last byte as eight decisions: ``context`` (the bytes before), ``node`` (1 and the bits so far), ``bit``."""
    byte = F.col("gram").bitwiseAND(255)
    decisions = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.struct(
        F.call_function("shiftright", byte + 256, 8 - i).alias("node"), F.call_function("shiftright", byte, 7 - i).bitwiseAND(1).alias("bit")))
    return rows.select("*", F.shiftright("gram", 8).alias("context"), F.explode(decisions).alias("d")).select("*", "d.node", "d.bit").drop("d")


def tree(counts: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """For each depth, ``context``, ``node`` and ``p``: the weighted probability of a zero where no deeper context is known.

    From the leaves up, a node's probability is half its own estimate and half the product of those below it. From the root
    down, each node takes its share of the weight and leaves the rest to the node below on the path; where the path leaves
    the tree, the rest goes to a half.
    """
    decided = bits(counts.where("n > 0"))
    level = decided.groupBy("context", "node").agg(F.sum(F.col("n") * (1 - F.col("bit"))).alias("a"), F.sum(F.col("n") * F.col("bit")).alias("b"))
    level = written(level.withColumn("own", log_kt(F.col("a"), F.col("b"))).withColumn("weighted", F.col("own")).withColumn("below", F.lit(None).cast("double")), "leaves")
    levels = [level]
    for d in range(depth - 1, -1, -1):
        up = level.groupBy(F.col("context").bitwiseAND((1 << 8 * d) - 1).alias("context"), "node").agg(
            F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("weighted").alias("below")).withColumn("own", log_kt(F.col("a"), F.col("b")))
        high, low = F.greatest("own", "below"), F.least("own", "below")
        level = kept(up.withColumn("weighted", F.lit(float(np.log(0.5))) + high + F.log1p(F.exp(low - high))))
        levels.append(level)
    out, above = [], None
    for d, level in enumerate(reversed(levels)):
        share = F.lit(1.0) if d == depth else 1 / (1 + F.exp(F.least(F.col("below") - F.col("own"), F.lit(700.0))))
        own = level.select("context", "node", ((F.col("a") + 0.5) / (F.col("a") + F.col("b") + 1)).alias("zero"), share.alias("share"))
        if above is None:
            own = own.withColumn("so_far", F.lit(0.0)).withColumn("rest", F.lit(1.0))
        else:
            own = own.withColumn("shorter", F.col("context").bitwiseAND((1 << 8 * (d - 1)) - 1)).join(
                above.select(F.col("context").alias("shorter"), "node", F.col("given").alias("so_far"), F.col("left").alias("rest")), ["shorter", "node"])
        above = kept(own.select("context", "node", (F.col("so_far") + F.col("rest") * F.col("share") * F.col("zero")).alias("given"),
                                (F.col("rest") * (1 - F.col("share"))).alias("left")))
        out.append(above.select("context", "node", (F.col("given") + F.col("left") / 2).alias("p")))
    return out


def gram_scores(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``gram`` and ``score``, the log10 probability of its last byte after the others, for all grams, also unseen ones."""
    levels = tree(counts, depth)
    rows, parts = bits(counts.select("gram")), []
    for d in range(depth, -1, -1):
        short = F.col("context").bitwiseAND((1 << 8 * d) - 1)
        joined = written(rows.withColumn("short", short).join(levels[d].withColumnRenamed("context", "short"), ["short", "node"], "left")
                         .select("gram", "context", "node", "bit", "p"), f"depth{d}")
        parts.append(joined.where("p IS NOT NULL"))
        rows = joined.where("p IS NULL").drop("p")
        if joined.where("p IS NULL").isEmpty():
            break
    else:
        parts.append(rows.withColumn("p", F.lit(0.5)))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("gram").agg(F.sum(F.log10(F.when(F.col("bit") == 0, F.col("p")).otherwise(1 - F.col("p")))).alias("score"))


def _scorer(id_type: pa.DataType, common):
    schema = pa.schema([("id", id_type), ("held_out", pa.bool_()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("logs", pa.float64()), ("score", pa.float64())])

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        def table(kind: int) -> tuple[np.ndarray, np.ndarray]:
            some = replies.filter(pa.array(np.asarray(replies.column("kind")) == kind))
            keys, values = (np.concatenate((some.column(c).to_numpy(), x)) for c, x in zip(("key", "value"), common.value[kind], strict=True))
            order = np.argsort(keys)
            return keys[order], values[order]

        (words, counts), (known, scores) = table(WORD), table(GRAM)
        logs, out = np.log10(counts + 1), []
        for part in pieces(iter(docs.to_batches()), "text", PIECE):
            texts = [encoded(x) for x in utf8(part.column("text"))]
            packed, n = grams.packed([x[1] for x in texts], DEPTH + 1)
            gram, row = grams.split(packed)
            at, there = grams.found(known, gram.astype(np.int64))
            assert there.all()
            score = np.bincount(row, scores[at] * n, len(texts)).astype(np.float64)
            seen: dict[bytes, int] = {}
            tokens = np.fromiter((len(w) for w, _ in texts), np.int64, len(texts))
            number = np.fromiter((seen.setdefault(w, len(seen)) for ws, _ in texts for w in ws), np.int64, int(tokens.sum()))
            at, _ = grams.found(words, np.fromiter(map(_word_hash, seen), np.int64, len(seen)))
            of, row = at[number], np.repeat(np.arange(len(texts)), tokens)
            some = len(words) > 0
            out.append(pa.Table.from_arrays([
                part.column("id"), part.column("held_out"), pa.array([len(x[1]) for x in texts], pa.int64()), pa.array(tokens),
                pa.array(np.bincount(row, counts[of] > 0 if some else None, len(texts)).astype(np.int64)),
                pa.array(np.bincount(row, logs[of] if some else None, len(texts)).astype(np.float64)), pa.array(score)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None) -> DataFrame:
    """Per row: ``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``bits_per_byte``.

    Tokens are the words, A-Z lower-cased, and an end. The model codes their bytes, spaces between them, and learns, as the
    base does, from all rows that are not ``held_out`` (by default every seventh or so, by a hash of the id). Each chunk
    of documents asks for the rare words and grams in it; the answers are joined by key and meet the chunk's texts again. So what
    a task holds follows from the size of a chunk. The ``COMMON`` most frequent words and grams go to every worker instead.

    Words go by a 64-bit hash. A null text is empty and has its end only; a null id is not held out; rows may repeat and
    each counts. An empty table gives an empty result; without training rows all probabilities are even. Other columns are not read.
    """
    if held_out is None:
        held_out = F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2
    rows = chunk_of(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")))
    counted = rows.select("held_out", "text").mapInArrow(_counted, "kind tinyint, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counted = written(counted, "counts")
    totals = counted.where(F.col("kind") == WORD).select("key", F.col("n").cast("double").alias("value"))
    gram_counts = counted.where(F.col("kind") == GRAM).select(F.col("key").alias("gram"), "n")
    scores = written(gram_scores(gram_counts).select(F.col("gram").alias("key"), F.col("score").alias("value")), "scores")
    often = {WORD: totals.orderBy(F.desc("value"), "key").limit(COMMON),
             GRAM: scores.join(F.broadcast(gram_counts.orderBy(F.desc("n"), "gram").limit(COMMON).select(F.col("gram").alias("key"))), "key")}
    common = {}
    for kind, rows_of in often.items():
        pdf = rows_of.toPandas()  # COMMON rows at most
        common[kind] = (pdf["key"].to_numpy(np.int64), pdf["value"].to_numpy(np.float64))
    shared = docs.sparkSession.sparkContext.broadcast(common)
    # What is common would be asked for in nearly every chunk, so nearly all that is joined and sent back is what is rare.
    found = totals.select(F.lit(WORD).cast("tinyint").alias("kind"), "key", "value").union(scores.select(F.lit(GRAM).cast("tinyint"), "key", "value"))
    answers = (rows.select("chunk", "text").mapInArrow(_asking(shared), "chunk bigint, kind tinyint, key bigint")
               .join(found, ["kind", "key"]).select("chunk", "kind", "key", "value"))
    made = kept(rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _scorer(_arrow_type(rows), shared),
        f"id {column_type(rows, 'id')}, held_out boolean, n_bytes bigint, n_tokens bigint, n_known bigint, logs double, score double"))
    n_words, n_different = totals.agg(F.sum("value"), F.count(F.when(F.col("value") > 0, 1))).first()
    ends = made.where("NOT held_out").count()
    n, v = int(n_words or 0) + ends, n_different + (ends > 0)
    return made.select(
        F.col("id").alias(id_col), "held_out", (F.col("n_tokens") + 1).alias("n_tokens"), (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("logs") + float(np.log10(ends + 1)) - (F.col("n_tokens") + 1) * float(np.log10(n + v + 1))).alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["id"].dataType)
