"""Languages of words in code-switched text, by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataudit.llm.common import column_type, pieces

WIDTH = 24  # bytes of a word that features see, with a mark at either end: longer ones are several words, see ``split``
SIZE = 1 << 16  # weights per language
PIECE = 1 << 22  # bytes of text that are labelled at once
STEP = 1 << 14  # words whose features are looked up at once
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(WIDTH)], np.uint64)


def _slots(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h + np.uint64(kind * 0x51ED27)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    return ((h * np.uint64(0x94D049BB133111EB)) >> np.uint64(40)).astype(np.int64) % (SIZE - 1) + 1


def _bytes_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A row of bytes for each word (see ``split``), between its marks, and how many they are."""
    cut = [b"^" + w + b"$" for w in words]
    size = np.fromiter(map(len, cut), np.int64, len(cut))
    out = np.zeros((len(cut), WIDTH), np.uint8)
    out[np.arange(WIDTH) < size[:, None]] = np.frombuffer(b"".join(cut), np.uint8)
    return out.astype(np.uint64), size


def features(words: list[bytes], lexicon: np.ndarray) -> np.ndarray:
    """The slots of each word's features, 0 for none: byte pairs and triples (with the marks, they hold short affixes),
    affixes of four and five bytes, and the word itself if it is in the lexicon."""
    wide, size = _bytes_of(words)
    at = np.arange(WIDTH)
    out = []
    for n in (2, 3):
        joined = sum(wide[:, j:WIDTH - n + 1 + j] << np.uint64(8 * j) for j in range(n))
        out.append(np.where(at[:WIDTH - n + 1] + n <= size[:, None], _slots(joined, n), 0))
    rows = np.arange(len(words))
    for n in (4, 5):
        long = size > n
        head = sum(wide[:, j] << np.uint64(8 * j) for j in range(n))
        tail = sum(wide[rows, np.maximum(size - n + j, 0)] << np.uint64(8 * j) for j in range(n))
        out.append(np.where(long, _slots(head, 10 + n), 0)[:, None])
        out.append(np.where(long, _slots(tail, 20 + n), 0)[:, None])
    whole = wide @ _POWERS
    known = np.isin(whole, lexicon)
    out.append(np.where(known, _slots(whole, 30), 0)[:, None])
    return np.concatenate(out, axis=1)


def word_numbers(words: list[bytes]) -> np.ndarray:
    return _bytes_of(words)[0] @ _POWERS


@dataclass
class Crf:
    """``weights``: per feature slot and language; ``move``: from language to language; ``start``: of the first word."""

    langs: list[str]
    lexicon: np.ndarray
    weights: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def emissions(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), len(self.langs)), np.float32)
        for i in range(0, len(words), STEP):
            out[i:i + STEP] = self.weights[features(words[i:i + STEP], self.lexicon)].sum(1)
        return out

    def marginals(self, each: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities of the languages at each word, for sequences laid end to end, by forward-backward.

        All sequences take a step together, the longest first, so what is left of them is always a front part.
        """
        each = np.exp(each - each.max(1, keepdims=True)).astype(np.float64)
        order = np.argsort(-lengths, kind="stable")
        sizes, begins = lengths[order], (np.cumsum(lengths) - lengths)[order]
        longest = int(sizes[0]) if len(sizes) else 0
        alive = np.searchsorted(-sizes, -np.arange(longest), side="left")  # sequences with a word at this step
        first = np.concatenate(([0], np.cumsum(alive)))
        where = np.concatenate([begins[:n] + t for t, n in enumerate(alive)]) if longest else np.zeros(0, np.int64)
        e, move = each[where], np.exp(self.move)
        ahead, back = np.empty_like(e), np.ones_like(e)
        for t in range(longest):
            a, b = first[t], first[t + 1]
            now = e[a:b] * (np.exp(self.start) if t == 0 else ahead[first[t - 1]:first[t - 1] + alive[t]] @ move)
            ahead[a:b] = now / now.sum(1, keepdims=True)
        for t in range(longest - 2, -1, -1):
            a, n = first[t], alive[t + 1]
            now = (e[first[t + 1]:first[t + 2]] * back[first[t + 1]:first[t + 2]]) @ move.T
            back[a:a + n] = now / now.sum(1, keepdims=True)
        both = ahead * back
        out = np.empty_like(e)
        out[where] = both / both.sum(1, keepdims=True)
        return out


def split(word: bytes) -> list[bytes]:
    """The word, or if it is too wide for its features, pieces of it that are cut between characters."""
    out, at = [], 0
    while len(word) - at > WIDTH - 2:
        end = at + WIDTH - 2
        while word[end] & 0xC0 == 0x80:  # inside a character
            end -= 1
        out.append(word[at:end])
        at = end
    out.append(word[at:])
    return out


def tokens(text: str | None) -> list[bytes]:
    """The runs of non-blank characters, lower-cased; long ones, as in scripts without spaces, in pieces: every byte is in a feature."""
    words = (text or "").lower().encode("utf-8", "replace").split()
    return [x for w in words for x in (split(w) if len(w) > WIDTH - 2 else (w,))]


def fit(texts: list[tuple[str, str]], lexicon_size: int = 2000, length: int = 48, epochs: int = 6, batch: int = 128, rate: float = 0.2,
        decay: float = 1e-5, seed: int = 9) -> Crf:
    """Learn from (text, language) pairs. Training sequences switch languages: they are pieces of 4 to 24 words, of texts in
    random order, laid end to end and cut every ``length`` words; each word has its text's language."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for _, lang in texts})
    counts: list[dict[bytes, int]] = [{} for _ in langs]
    parts: list[tuple[list[bytes], int]] = []
    for text, lang in texts:
        of, words, at = langs.index(lang), [w for w in tokens(text) if LETTER.search(w.decode("utf-8", "replace"))], 0
        for w in words:
            counts[of][w] = counts[of].get(w, 0) + 1
        while at < len(words):
            n = int(rng.integers(4, 25))
            parts.append((words[at:at + n], of))
            at += n
    common = [w for c in counts for w in sorted(c, key=lambda x: (-c[x], x))[:lexicon_size]]
    lexicon = np.unique(word_numbers(common)) if common else np.zeros(0, np.uint64)
    n_langs = len(langs)
    model = Crf(langs, lexicon, np.zeros((SIZE, n_langs), np.float32), np.zeros((n_langs, n_langs)), np.zeros(n_langs))
    parts = [parts[i] for i in rng.permutation(len(parts))]
    words = [w for p, _ in parts for w in p]
    truth = np.array([of for p, of in parts for _ in p], np.int64)
    n = len(words) // length * length
    if not n or n_langs < 2:
        return model
    number: dict[bytes, int] = {}
    which = np.fromiter((number.setdefault(w, len(number)) for w in words[:n]), np.int64, n).reshape(-1, length)
    slots = features(list(number), lexicon)
    truth = truth[:n].reshape(-1, length)
    grads = [np.full(x.shape, 1e-6) for x in (model.weights, model.move, model.start)]
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(len(which)), max(1, len(which) // batch)):
            used, right = slots[which[some].ravel()], truth[some]
            emit = model.weights[used].sum(1).reshape(len(some), length, n_langs).astype(np.float64)
            p, pairs = _expected(emit, model.move, model.start)
            delta = p.copy()
            np.put_along_axis(delta, right[:, :, None], np.take_along_axis(delta, right[:, :, None], 2) - 1, 2)
            flat = delta.reshape(-1, n_langs)
            g = np.stack([np.bincount(used.ravel(), np.repeat(flat[:, k], used.shape[1]), SIZE) for k in range(n_langs)], axis=1) / len(some)
            g[0] = 0
            moved = np.bincount((right[:, :-1] * n_langs + right[:, 1:]).ravel(), minlength=n_langs * n_langs).reshape(n_langs, n_langs)
            for x, grad, step in zip((model.weights, model.move, model.start), grads,
                                     (g + decay * model.weights, (pairs - moved) / len(some), delta[:, 0].sum(0) / len(some)), strict=True):
                grad += step * step
                x -= (rate * step / np.sqrt(grad)).astype(x.dtype)
    return model


def _expected(emit: np.ndarray, move: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the languages at each word, and expected numbers of moves, of sequences of one length."""
    e, a = np.exp(emit - emit.max(2, keepdims=True)), np.exp(move)
    ahead, back = np.empty_like(e), np.ones_like(e)
    for t in range(e.shape[1]):
        now = e[:, t] * (np.exp(start) if t == 0 else ahead[:, t - 1] @ a)
        ahead[:, t] = now / now.sum(1, keepdims=True)
    pairs = np.zeros_like(move)
    for t in range(e.shape[1] - 2, -1, -1):
        right = e[:, t + 1] * back[:, t + 1]
        joint = ahead[:, t][:, :, None] * a * right[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        now = right @ a.T
        back[:, t] = now / now.sum(1, keepdims=True)
    both = ahead * back
    return both / both.sum(2, keepdims=True), pairs


def sample(docs: DataFrame, per_language: int, most_bytes: int, most_languages: int) -> list[tuple[str, str]]:
    """``text`` and ``lang`` of at most ``per_language`` rows of each of the ``most_languages`` commonest languages, none over
    ``most_bytes``; in an order drawn by id."""
    rows = docs.where(F.col("lang").isNotNull() & F.octet_length("text").between(1, most_bytes))
    langs = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()]
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("place", "size"))
    ids = (rows.where(F.col("lang").isin(langs)).select("lang", F.xxhash64(F.lit(11), "id").alias("place"), F.octet_length("text").alias("size"))
           .withColumn("turn", turn).where(F.col("turn") <= per_language))
    chosen = F.broadcast(ids.select("lang", "place").distinct())  # at most per_language * most_languages rows
    found = rows.withColumn("place", F.xxhash64(F.lit(11), "id")).join(chosen, ["lang", "place"], "left_semi").select("text", "lang", "place")
    return [(r["text"], r["lang"]) for r in found.orderBy("lang", "place", "text").limit(per_language * most_languages).collect()]


def predict(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred``, ``score`` and ``lang_words``, how many words (of long ones: pieces) each language has by their most probable one.

    A document's language is the one with the largest sum of probabilities over its words with a letter; ``score`` is its
    share. Without a letter, or with a null text, it is ``und`` with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        n_langs = len(crf.langs)
        for part in pieces(batches, "text", PIECE):
            texts = [tokens(x) for x in part.column("text").to_pylist()]
            number: dict[bytes, int] = {}
            which = np.fromiter((number.setdefault(w, len(number)) for ws in texts for w in ws), np.int64)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            letters = np.fromiter((LETTER.search(w.decode("utf-8", "replace")) is not None for w in number), bool, len(number))
            doc = np.repeat(np.arange(len(texts)), lengths)
            counted = letters[which] if len(which) else np.zeros(0, bool)
            sums = np.zeros((len(texts), max(n_langs, 1)))
            words = np.zeros_like(sums)
            if n_langs and len(which):
                p = crf.marginals(crf.emissions(list(number))[which], lengths)
                best = p.argmax(1)
                for k in range(n_langs):
                    sums[:, k] = np.bincount(doc, p[:, k] * counted, len(texts))
                    words[:, k] = np.bincount(doc, (best == k) & counted, len(texts))
            total, best = sums.sum(1), sums.argmax(1)
            known = total > 0
            yield pa.RecordBatch.from_arrays([
                part.column("id"), pa.array([crf.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string()),
                pa.array(np.where(known, sums.max(1) / np.where(known, total, 1), 0.0)),
                pa.array([",".join(f"{lang}:{int(n)}" for lang, n in zip(crf.langs, row) if n) for row in words], pa.string())],
                names=["id", "lang_pred", "score", "lang_words"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = column_type(rows, "id")
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, lang_words string").withColumnRenamed("id", id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: Column | None = None,
             per_language: int = 400, most_bytes: int = 4000, most_languages: int = 50) -> DataFrame:
    """``predict`` for every row, with ``held_out``, by a model learnt from the rows that are not (by default every fifth or so
    is, by a hash of the id) and whose language is not null.

    It learns from a bounded sample of them (see ``sample``); predictions read the text alone. Repeated rows get the same
    answer; a null id is not held out; without a row to learn from, all is ``und``. Other columns are not read.
    """
    if held_out is None:
        held_out = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
    out = F.coalesce(held_out, F.lit(False))
    known = docs.where(~out).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = fit(sample(known, per_language, most_bytes, most_languages))
    return predict(docs, model, id_col, text_col).withColumn("held_out", out)
