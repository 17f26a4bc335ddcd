"""Lines that repeat across documents, exactly or nearly: one occurrence of each stays."""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataudit.llm import marks, minhash
from strataudit.llm.common import column_type, kept, pieces, release, utf8, written
from strataudit.llm.graph import components

GRAM = 6  # bytes
LEAST_CHARS = 30  # of a line with few words, as in scripts without spaces
ROWS, BANDS = 3, 28
STEPS = 1.03
# By the length of a line, in steps of 3 %: bits in which sketches may differ. With an edit similarity of 0.8 they differ in 14.7 on average, and the limit lies
# 2.2 standard deviations above; minima of lines with few runs repeat and so deviate more.
APART = np.int16(14.7 + 2.2 * np.sqrt(12 + 450 / np.maximum(STEPS ** np.arange(256) - GRAM + 1, 1)))
#: The limit for all three sketches, of lines x and y: 44.2 bits on average and 2.5 standard deviations.
FAR = f"44.2 + 2.5 * sqrt(35 + 4000 / greatest(least(x.n, y.n) - {GRAM - 1}, 1))"
#: ``APART`` for lines x and y, from their lengths.
APART_SQL = f"get(array({', '.join(map(str, APART.tolist()))}), cast(least(ln(least(x.n, y.n)) / ln({STEPS}), 255) AS int))"
PAIR, OWN_LINE, CROWD = range(3)  # kinds of rows of ``candidates``
NONE = np.uint32(0xFFFFFFFF)
OWN = np.dtype([("s", "<u8"), ("h", "<i8"), ("v", "<u8"), ("w", "<u8"), ("n", "<i4")])  # v, w: two more bits of the same minima
MEMBER = np.dtype([("key", "<u4"), ("s", "<u8"), ("n", "u1")])  # n: steps of 3 % of the length
BUCKET, PART, LINE = 1 << 24, 1 << 25, 128  # bytes of keys in a bucket and worked on at once; of a short average line
ROWS_OUT = 1 << 17
PIECE = 1 << 22  # bytes of text whose lines are hashed at once
LINES_AT_ONCE = 1 << 12
MATCHED = 1 << 12  # sketches of a key that are all matched with each other
PAIRS_AT_ONCE = 1 << 13
CELLS, LONG, FEW = 1 << 21, 1 << 12, 64  # characters of pairs whose edits are counted at once, of the longest of them, and the fewest such pairs
MANY, MASKS = 1 << 10, 1 << 22  # pairs from which on lengths must be nearly equal, and words that hold their characters' places
WORDY = 1 << 10  # characters of pairs whose common words are looked at first
_PUNCTUATION = string.punctuation.encode()
_PLAIN = bytes.maketrans(string.ascii_uppercase.encode() + b"\t\v\f\r", string.ascii_lowercase.encode() + b"    ")


def normal(line: bytes) -> bytes:
    """A-Z lower-cased, ASCII punctuation gone, runs of blanks as one space."""
    return b" ".join(line.lower().translate(None, _PUNCTUATION).split())


def band_keys(lines: list[bytes]) -> tuple[np.ndarray, ...]:
    """The MinHash keys of each line's runs of six bytes, a sketch, one bit of each of 64 of the minima, and two more such sketches of other bits.
    Sketches of lines whose runs have a Jaccard similarity of s differ in half of 1 - s of their bits."""
    lines = [x.ljust(GRAM, b"\0") for x in lines]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    data = b"".join(lines)
    grams = np.empty(len(data) - GRAM + 1, np.uint64)
    for j in range(8):  # eight bytes at a time, of which a run has the first six
        grams[j::8] = np.frombuffer(data + b"\0\0", "<u8", len(grams[j::8]), j)
    grams &= np.uint64((1 << 8 * GRAM) - 1)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(31)
    grams *= np.uint64(0x94D049BB133111EB)
    inside = np.ones(len(data), bool)  # runs that start here end in the same line
    for j in range(1, GRAM):
        inside[np.cumsum(sizes) - j] = False
    least = minima(grams[inside[:len(grams)]], sizes - GRAM + 1, ROWS * BANDS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.ones((len(lines), 1), np.uint64)
    for row in range(ROWS):
        keys = (keys ^ least[:, row::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    place = np.arange(64, dtype=np.uint64)
    bits = ((least[:, :64] + place * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x94D049BB133111EB))
    return keys, *(np.bitwise_or.reduce((bits >> np.uint64(63 - i) & np.uint64(1)) << place, axis=1) for i in range(3))


def minima(hashes: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values for each set by one hash of each member: a member falls into one of ``n`` bins, and each bin has its minimum. An empty
    bin takes the minimum of another, drawn for it in the same way in every set, so values of two sets agree as often as members."""
    out = np.full(len(sizes) * n, NONE, np.uint32)
    bins = hashes >> np.uint64(32)
    bins *= np.uint64(n)
    bins >>= np.uint64(32)
    bins += np.repeat(np.arange(len(sizes), dtype=np.uint64) * np.uint64(n), sizes)
    np.minimum.at(out, bins.view(np.int64), hashes.astype(np.uint32))
    own = out.reshape(len(sizes), n)
    out = own.copy()
    rng, some = np.random.default_rng(5), np.flatnonzero((own == NONE).any(axis=1))
    while len(some):
        part = np.where(out[some] == NONE, own[some][:, rng.integers(0, n, n)], out[some])
        out[some] = part
        some = some[(part == NONE).any(axis=1)]
    return out


def _texts_of(batch: pa.RecordBatch, column: str, least_words: int) -> Iterator[tuple[int, int, bytes]]:
    """Row, number and normal form of each line with enough words or characters."""
    for row, text in enumerate(utf8(batch.column(column))):
        for number, line in enumerate(text.translate(_PLAIN, _PUNCTUATION).split(b"\n")):  # as ``normal``, whole texts at once
            form = line.strip(b" ")
            while b"  " in form:
                form = form.replace(b"  ", b" ")
            if form and (form.count(b" ") >= least_words - 1 or len(form) >= LEAST_CHARS and len(form.decode()) >= LEAST_CHARS):
                yield row, number, form


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``k``, a hash of id and text, with the two: rows that agree in both are one document with several rows."""
    return docs.select(F.xxhash64(id_col, text_col).alias("k"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def lines(docs: DataFrame, least_words: int) -> DataFrame:
    """A row per line with ``least_words`` words or 30 characters or more: document, line number, hash of its normal form."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            number: dict[bytes, int] = {}
            rows, nos, which = [], [], []
            for row, no, form in _texts_of(batch, "text", least_words):
                rows.append(row)
                nos.append(no)
                which.append(number.setdefault(form, len(number)))
            if not rows:
                continue
            h = np.array([xxhash.xxh3_64_intdigest(x) for x in number], np.uint64).view(np.int64)
            which = np.array(which)
            ids = batch.select(["k", "id"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*ids.columns, *map(pa.array, (np.array(nos, np.int32), h[which]))], names=["k", "id", "line", "h"])

    return docs.mapInArrow(run, f"k bigint, id {column_type(docs, 'id')}, line int, h bigint")


def candidates(docs: DataFrame, least_words: int, similarity: float, crowd: int, draws: int) -> DataFrame:
    """Rows of three ``kind``s: the sketch ``a``, hash ``b``, further sketches ``v`` and ``w`` and length ``n`` of each line (``OWN_LINE``), pairs of different sketches ``a``, ``b`` that share a band and
    differ in no more bits than ``APART`` has it, of lines whose lengths allow for the similarity (``PAIR``), and each sketch ``a`` of a key ``b`` that has over ``crowd``
    of them, which are paired in part only (``CROWD``).

    Keys travel as packed bytes, 13 for a key, its sketch and about the length of the line, in buckets of about ``BUCKET`` bytes. A bucket is worked on in parts: of what came
    before, a part sees the keys with few sketches whole, and the first ``crowd`` sketches of the others.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(docs.sparkSession.sparkContext.defaultParallelism, size * MEMBER.itemsize * BANDS // (LINE * BUCKET) + 1)

    steps = int(-np.log(similarity) / np.log(STEPS)) + 1  # lengths farther apart rule the similarity out

    def spread(bucket: np.ndarray, records: np.ndarray) -> dict[int, bytes]:
        order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
        there, first = np.unique(bucket[order], return_index=True)
        return {int(b): part.tobytes() for b, part in zip(there, np.split(records[order], first[1:]), strict=True)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            forms = list({form: None for _, _, form in _texts_of(batch, "text", least_words)})
            if not forms:
                continue
            own, members = np.empty(len(forms), OWN), np.empty(len(forms) * BANDS, MEMBER)
            own["h"] = np.array([xxhash.xxh3_64_intdigest(x) for x in forms], np.uint64).view(np.int64)
            where = np.empty(len(members), np.int64)
            for at in range(0, len(forms), LINES_AT_ONCE):
                keys, *sketches = band_keys(forms[at:at + LINES_AT_ONCE])
                for name, bits in zip("svw", sketches, strict=True):
                    own[name][at:at + LINES_AT_ONCE] = bits
                to = slice(at * BANDS, at * BANDS + keys.size)
                where[to] = keys.ravel() % np.uint64(buckets)
                members["key"][to] = keys.ravel() >> np.uint64(32)
            members["s"] = np.repeat(own["s"], BANDS)
            size = np.fromiter((len(x.decode()) for x in forms), np.float64, len(forms))
            own["n"] = size
            members["n"] = np.repeat(np.minimum(np.log(size) / np.log(STEPS), 255).astype(np.uint8), BANDS)
            mine, theirs = spread(own["s"] % np.uint64(buckets), own), spread(where, members)
            both = sorted(mine.keys() | theirs.keys())
            yield pa.RecordBatch.from_arrays([pa.array(both, pa.int64()), pa.array([mine.get(x, b"") for x in both], pa.binary()),
                                              pa.array([theirs.get(x, b"") for x in both], pa.binary())], names=["bucket", "mine", "theirs"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, seen, wait, size = None, np.empty(0, MEMBER), [], 0

        def part(more: bool) -> Iterator[pa.RecordBatch]:
            nonlocal seen, wait, size
            crowds: list[np.ndarray] = []
            pairs, seen = _meet(np.concatenate([seen, *wait]), crowd, draws, steps, more, crowds, not more and not len(seen))
            wait, size = [], 0
            for at in range(0, len(pairs), ROWS_OUT):
                yield _rows(PAIR, pairs[at:at + ROWS_OUT].T)
            for some in crowds:
                some[:, 1] = some[:, 1] << np.uint64(32) | np.uint64(bucket or 0)
                for at in range(0, len(some), ROWS_OUT):
                    yield _rows(CROWD, some[at:at + ROWS_OUT].T)

        for batch in batches:
            for b, mine, theirs in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if b != bucket or size > PART:
                    yield from part(b == bucket)
                    bucket = b
                wait.append(np.frombuffer(theirs, MEMBER))
                size += len(theirs)
                if mine:
                    own = np.frombuffer(mine, OWN)
                    yield _rows(OWN_LINE, [own["s"], own["h"], own["v"], own["w"], own["n"].astype(np.int64)])
        yield from part(False)
        release()

    packed = docs.mapInArrow(run, "bucket bigint, mine binary, theirs binary")
    return packed.repartition(int(buckets), "bucket").sortWithinPartitions("bucket").mapInArrow(met, "kind int, a bigint, b bigint, v bigint, w bigint, n bigint")


def _rows(kind: int, columns: list[np.ndarray] | np.ndarray) -> pa.RecordBatch:
    given = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in columns]
    n = len(given[0])
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *given, *[pa.nulls(n, pa.int64())] * (5 - len(given))],
                                      names=["kind", "a", "b", "v", "w", "n"])


def _meet(members: np.ndarray, crowd: int, draws: int, steps: int, more: bool = True, crowds: list[np.ndarray] | None = None,
          whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near sketches that share a key, and, if there are ``more``, the members that later ones must meet. Up to ``crowd`` sketches of a key all meet. Of
    more, each in turn meets those that have not yet been paired ``draws`` times: a set of near lines becomes a few stars. These sketches and their keys go
    to ``crowds`` too, all of them however many parts a key is met in: ``across`` pairs those that the stars leave apart. Where the members are a ``whole``
    bucket, sketches that are near no other of their key but those they are paired with here are left out, unless a key has over ``MATCHED`` of them."""
    key = members["key"].astype(np.uint64) << np.uint64(32) | members["s"] >> np.uint64(32)
    order = np.argsort(key)
    key, s, size = key[order], members["s"][order], members["n"][order].astype(np.int16)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (s[1:] != s[:-1]) | (size[1:] != size[:-1])
    key, s, size = (key[new] >> np.uint64(32)).astype(np.int64), s[new], size[new]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(first)
    n = np.diff(np.append(starts, len(key)))
    out, few = [np.empty((0, 2), np.uint64)], np.flatnonzero(np.repeat((n > 1) & (n <= crowd), n))
    for d in range(1, min(crowd, int(n.max(initial=1)))):
        few = few[few + d < len(key)]
        few = few[key[few] == key[few + d]]
        i = few[(np.bitwise_count(s[few] ^ s[few + d]) <= APART[np.minimum(size[few], size[few + d])])
                & (np.abs(size[few] - size[few + d]) <= steps)]
        out.append(np.stack([s[i], s[i + d]], 1))
    large = np.repeat(n > crowd, n)
    for at, m in zip(starts[n > crowd].tolist(), n[n > crowd].tolist(), strict=True):
        own, own_sizes, times = s[at:at + m], size[at:at + m], np.zeros(m, np.int8)
        left, sizes, place, met = own, own_sizes, np.arange(m), np.zeros(m, np.int32)
        while len(left) > 1:
            first, last, one, left, sizes, times, place = left[0], sizes[0], place[0], left[1:], sizes[1:], times[1:], place[1:]
            near = (np.bitwise_count(left ^ first) <= APART[np.minimum(sizes, last)]) & (np.abs(sizes - last) <= steps)
            if near.any():
                out.append(np.stack([np.full(near.sum(), first), left[near]], 1))
                met[one] += near.sum()
                met[place[near]] += 1
                times = times + near
                some = times < draws
                left, sizes, times, place = left[some], sizes[some], times[some], place[some]
        if whole and crowds is not None and m <= MATCHED:
            for i in range(0, m, max((1 << 18) // m, 1)):
                to = slice(i, min(i + max((1 << 18) // m, 1), m))
                near = np.bitwise_count(own[to, None] ^ own) <= APART[np.minimum(own_sizes[to, None], own_sizes)]
                near &= np.abs(own_sizes[to, None] - own_sizes) <= steps
                large[at:at + m][to] = near.sum(axis=1) - 1 > met[to]  # near itself
    if crowds is not None:
        crowds.append(np.stack([s[large], key[large].astype(np.uint64)], 1))
    place = np.arange(len(key)) - np.repeat(starts, n)
    pairs = np.sort(np.concatenate(out), axis=1)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    _, once = np.unique(pairs[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ pairs[:, 1], return_index=True)
    seen = np.flatnonzero(place < max(crowd, draws)) if more else np.zeros(0, np.int64)
    rest = np.empty(len(seen), MEMBER)
    rest["key"], rest["s"], rest["n"] = key[seen], s[seen], size[seen]
    return pairs[once], rest


def edits(a: str, b: str) -> int:
    """Levenshtein distance, a column of the table at a time as the bits of two numbers."""
    while a and b and a[-1] == b[-1]:  # common ends cost nothing; cut in steps that grow
        n = 1
        while 2 * n < min(len(a), len(b)) and a[-2 * n:] == b[-2 * n:]:
            n *= 2
        a, b = a[:-n], b[:-n]
    while a and b and a[0] == b[0]:
        n = 1
        while 2 * n < min(len(a), len(b)) and a[:2 * n] == b[:2 * n]:
            n *= 2
        a, b = a[n:], b[n:]
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for c in b:
        same = at.get(c, 0)
        zero = (((same & up) + up) ^ up) | same | down
        more, less = down | ~(zero | up) & full, up & zero
        score += bool(more & top) - bool(less & top)
        more, less = (more << 1 | 1) & full, (less << 1) & full
        up, down = less | ~(zero | more) & full, more & zero
    return score


def edits_of(pairs: list[tuple[str, str]], most: list[int]) -> list[int]:
    """``edits`` of each pair where they are no more than its ``most``, and otherwise some number above that. Pairs of up to ``LONG`` characters, and of
    about equal lengths, are counted side by side, ``CELLS`` characters at once, those whose two lengths differ about alike together."""
    out = [0] * len(pairs)
    sizes = [max(len(a), len(b)) for a, b in pairs]
    apart = [abs(len(a) - len(b)) for a, b in pairs]
    order = sorted(range(len(pairs)), key=sizes.__getitem__)
    at = 0
    while at < len(order):
        end, least = at + 1, sizes[order[at]]
        while end < len(order) and sizes[order[end]] <= min((1.1 if end - at >= MANY else 1.4) * least + 16, LONG):
            end += 1
        step = max(CELLS // max(sizes[order[end - 1]], 1), 1)
        for i in range(at, end, step):
            some = order[i:min(i + step, end)]
            for j, n in zip(some, _least_edits([pairs[j] for j in some]).tolist(), strict=True):
                out[j] = n
        open_ = sorted((i for i in order[at:end] if out[i] <= most[i]), key=apart.__getitem__)
        for i in range(0, len(open_), step):
            some = open_[i:i + step]
            found = _edits_at_once([pairs[j] for j in some], max(most[j] for j in some)).tolist() if len(some) >= FEW else [edits(*pairs[j]) for j in some]
            for j, n in zip(some, found, strict=True):
                out[j] = n
        at = end
    return out


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)


def _least_edits(pairs: list[tuple[str, str]]) -> np.ndarray:
    """For each pair, the characters that one text has more of than the other: there are no fewer edits."""
    counts = []
    for texts in zip(*pairs, strict=True):
        row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
        counts.append(np.bincount(row << 6 | _codes(texts) & 63, minlength=len(texts) << 6).reshape(-1, 64))
    more = counts[0] - counts[1]
    return np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))


def _edits_at_once(pairs: list[tuple[str, str]], most: int) -> np.ndarray:
    """As ``edits`` up to ``most``, a number per pair, with 64 rows of the table in a word. The shorter texts are made equally long by a character of their
    own in front of both texts of a pair, which costs no edit. ``most`` edits, by which lengths differ too, lead no farther from the diagonal than
    ``below`` and ``above``; words beyond are taken to have one edit more in each row and column, which is never too few."""
    short, long = zip(*[(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs], strict=True)
    m, n = (np.fromiter(map(len, x), np.int64, len(pairs)) for x in (short, long))
    below, above = max((most - int((n - m).min())) // 2, 0), (most + int((n - m).max())) // 2
    top = max(int(m.max()), 1)
    words = (top + 63) // 64
    codes, others = _codes(short), _codes(long)
    number = np.zeros(int(max(codes.max(initial=0), others.max(initial=0))) + 1, np.int64)
    number[codes] = 1
    number = np.where(number, np.cumsum(number), 0)  # 0 for characters that no first text has
    kinds = int(number.max()) + 2  # the last for the character in front
    if len(pairs) > 1 and words * kinds * len(pairs) > MASKS:
        half = len(pairs) // 2
        return np.concatenate([_edits_at_once(pairs[:half], most), _edits_at_once(pairs[half:], most)])
    n, rows = n + top - m, np.arange(len(pairs)) * kinds
    lead, cols = (top - m)[:, None], int(n.max())
    x, place = np.full((len(pairs), top), kinds - 1), np.arange(top)
    x[place >= lead] = number[codes]
    x += rows[:, None]
    masks = np.zeros((words, len(pairs) * kinds), np.uint64)
    for w in range(words):
        here = place[64 * w:64 * w + 64]
        np.bitwise_or.at(masks[w], x[:, here].ravel(), np.tile(np.uint64(1) << (here % 64).astype(np.uint64), len(pairs)))
    seen, at = np.full((len(pairs), cols), kinds - 1), np.arange(cols)
    seen[(at >= lead) & (at < n[:, None])] = number[others]
    seen += rows[:, None]
    seen = seen.T[::-1].copy()  # last column first
    word = np.arange(words)  # word w works on column t - w in step t, with what the word before it passed on in the last step
    starts = np.maximum(64 * word - below, 0) + word
    ends = np.minimum(64 * word + 63 + above, cols - 1) + word
    one, last, end = np.uint64(1), np.uint64(63), np.uint64((top - 1) % 64)
    up, down = np.full((words, len(pairs)), ~np.uint64(0)), np.zeros((words, len(pairs)), np.uint64)
    more_in, less_in, more_out, less_out = np.zeros((4, words + 1, len(pairs)), np.uint64)
    more_in[0] = more_out[0] = 1
    spare = np.empty((6, words, len(pairs)), np.uint64)
    offsets = word[:, None] * masks.shape[1]
    masks, score, out = masks.ravel(), np.zeros(len(pairs), np.int64), np.full(len(pairs), top, np.int64)  # score: in the last row of word high - 1
    low = high = 0
    for t in range(int(ends[-1]) + 1):
        if high < words and t >= starts[high]:  # its score, before the column that the word above it has done already
            score += min(64 * high + 64, top) - 64 * high
            if high:
                score -= (more_in[high] - less_in[high]).view(np.int64)
            high += 1
        while ends[low] < t:
            low += 1
        if low and t - low > ends[low - 1] - (low - 1):  # no word above does this column
            more_in[low] = more_out[low] = 1
            less_in[low] = less_out[low] = 0
        u, d, m_in, l_in = up[low:high], down[low:high], more_in[low:high], less_in[low:high]
        same, either, zero, more, less, at = spare[:, :high - low]
        at = at.view(np.int64)
        np.add(seen[cols - 1 - t + low:cols - 1 - t + high], offsets[low:high], out=at)
        masks.take(at, out=same, mode="clip")
        np.bitwise_or(same, d, out=either)
        same |= l_in
        np.bitwise_and(same, u, out=zero)
        zero += u
        zero ^= u
        zero |= same
        np.bitwise_or(zero, u, out=more)
        np.invert(more, out=more)
        more |= d
        np.bitwise_and(u, zero, out=less)
        if high == words:
            score += (more[-1] >> end & one).view(np.int64)
            score -= (less[-1] >> end & one).view(np.int64)
            np.copyto(out, score, where=n == t - high + 2)
        np.right_shift(more, last, out=more_out[low + 1:high + 1])
        np.right_shift(less, last, out=less_out[low + 1:high + 1])
        if high < words:
            score += (more_out[high] - less_out[high]).view(np.int64)
        more <<= one
        more |= m_in
        less <<= one
        less |= l_in
        np.bitwise_and(more, either, out=d)
        either |= more
        np.invert(either, out=either)
        np.bitwise_or(less, either, out=u)
        more_in, more_out, less_in, less_out = more_out, more_in, less_out, less_in
    return out


def alike(a: str, b: str) -> float:
    """1 less the edit distance over the longer length."""
    return 1 - edits(a, b) / max(len(a), len(b), 1)


def gaps(a: str, b: str) -> list[tuple[str, str]]:
    """What the two have between the words of a longest common sequence of words, each word with a blank after it."""
    x, y = [w + " " for w in a.split(" ")], [w + " " for w in b.split(" ")]
    at: dict[str, int] = {}
    for i, w in enumerate(x):
        at[w] = at.get(w, 0) | 1 << i
    full = row = (1 << len(x)) - 1
    rows = []
    for w in y:  # a bit is 0 where the word makes the sequence longer
        same = row & at.get(w, 0)
        row = (row + same | row - same) & full
        rows.append(row)
    out, i, j, i_end, j_end = [], len(x) - 1, len(y) - 1, len(x), len(y)
    while i >= 0 and j >= 0:
        if rows[j] >> i & 1:
            i -= 1
        elif j and not rows[j - 1] >> i & 1:
            j -= 1
        else:
            if i + 1 < i_end or j + 1 < j_end:
                out.append(("".join(x[i + 1:i_end]), "".join(y[j + 1:j_end])))
            i_end, j_end = i, j
            i, j = i - 1, j - 1
    if i_end or j_end:
        out.append(("".join(x[:i_end]), "".join(y[:j_end])))
    return out


def _by_gaps(a: str, b: str, similarity: float) -> bool:
    """Whether edits of the gaps between common words alone show the similarity. The gaps' own distances are counted where they may be few enough."""
    size, between = max(len(a), len(b), 1), gaps(a, b)
    longer, apart = sum(max(len(x), len(y)) for x, y in between), sum(abs(len(x) - len(y)) for x, y in between)
    if 1 - longer / size >= similarity or 1 - max(longer / 2, apart) / size < similarity:
        return 1 - longer / size >= similarity
    return 1 - sum(edits(x, y) for x, y in between) / size >= similarity


def reaches(a: str, b: str, similarity: float) -> bool:
    """Whether ``alike`` is ``similarity`` or more."""
    return all_reach([(a, b)], similarity)[0]


def all_reach(pairs: list[tuple[str, str]], similarity: float, likely: bool = True) -> list[bool]:
    """``reaches`` of each pair. Where most pairs are ``likely`` to be so, gaps between common words are looked at first in long ones, as they are
    enough to say yes for most that differ by words. The others' distances are counted together."""
    out, open_ = [], []
    for i, (a, b) in enumerate(pairs):
        size = max(len(a), len(b), 1)
        out.append(1 - abs(len(a) - len(b)) / size >= similarity)
        if out[i]:
            out[i] = likely and size > WORDY and _by_gaps(a, b, similarity)
            if not out[i]:
                open_.append(i)
    sizes = [max(len(pairs[i][0]), len(pairs[i][1]), 1) for i in open_]
    edited = edits_of([pairs[i] for i in open_], [int((1 - similarity) * n) + 1 for n in sizes])
    for i, n, size in zip(open_, edited, sizes, strict=True):
        out[i] = 1 - n / size >= similarity
    return out


def verified(pairs: DataFrame, docs: DataFrame, distinct: DataFrame, least_words: int, similarity: float, likely: bool = True) -> DataFrame:
    """The pairs whose lines have the edit similarity. Only lines that may be in a pair leave the documents, compressed, and only documents
    in which such a line comes first are read for them (``distinct``)."""
    names = kept(pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct())
    first = distinct.join(names, "h", "left_semi").select(F.col("first.k").alias("k"))
    wanted = docs.sparkSession.sparkContext.broadcast((marks.marked(first, "k"), marks.marked(names, "h")))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        in_docs, in_lines = wanted.value
        some = (batch.filter(pa.array(marks.among(in_docs, batch.column("k").to_numpy(zero_copy_only=False)))) for batch in batches)
        for batch in pieces(some, "text", PIECE):
            forms = list({form: None for _, _, form in _texts_of(batch, "text", least_words)})
            h = np.array([xxhash.xxh3_64_intdigest(x) for x in forms], np.uint64)
            found = np.flatnonzero(marks.among(in_lines, h))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)[found]), pa.array([pack(forms[i]) for i in found], pa.binary())],
                                             names=["h", "form"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, PAIRS_AT_ONCE):
                some = batch.slice(at, PAIRS_AT_ONCE)
                both = zip(some.column(2).to_pylist(), some.column(3).to_pylist(), strict=True)
                good = all_reach([(unpack(x).decode(), unpack(y).decode()) for x, y in both], similarity, likely)
                yield some.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
                both = None
        release()

    form = docs.mapInArrow(texts, "h bigint, form binary").dropDuplicates(["h"])
    both = pairs.join(form.select(F.col("h").alias("a"), F.col("form").alias("x")), "a").join(
        form.select(F.col("h").alias("b"), F.col("form").alias("y")), "b").select("a", "b", "x", "y")
    return both.mapInArrow(compared, "a bigint, b bigint")


def across(found: DataFrame, near: DataFrame, low: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs of lines that may be linked, have not been compared, and are in different groups (``roots``): those of the crowds of a key, those with equal sketches, and
    those with near sketches (``near``) of which one has lines in several groups. Lines of one group are not paired, so a crowd of near lines is not multiplied out."""
    own = found.where(f"kind = {OWN_LINE}").select(F.col("a").alias("s"), F.col("b").alias("h"), "v", "w", "n")

    def named(keys: DataFrame) -> DataFrame:
        """The lines of the sketches ``s`` of each ``key`` that has lines in several groups."""
        some = own.join(keys.select("s").distinct(), "s", "left_semi").distinct()
        some = some.join(roots.select(F.col("node").alias("h"), "root"), "h", "left").withColumn("root", F.coalesce("root", "h"))
        every = keys.join(some, "s")
        open_ = every.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("key")
        return kept(every.join(open_, "key", "left_semi"))

    def paired(rows: DataFrame) -> DataFrame:
        may = F.expr(f"x.root < y.root AND least(x.n, y.n) >= greatest(x.n, y.n) * {similarity - 1e-9}D AND bit_count(x.s ^ y.s) <= {APART_SQL} "
                     f"AND bit_count(x.s ^ y.s) + bit_count(x.v ^ y.v) + bit_count(x.w ^ y.w) <= {FAR}")
        return rows.alias("x").join(rows.alias("y"), (F.col("x.key") == F.col("y.key")) & may).select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b"))

    crowds = found.where(f"kind = {CROWD}").select(F.col("b").alias("key"), F.col("a").alias("s")).distinct()
    equal = low.where("lines > 1").select(F.col("s").alias("key"), "s")
    members, lines_of = named(crowds), named(equal)
    several = lines_of.select("s").distinct()
    near = kept(near.join(several, F.col("a") == F.col("s"), "left_semi").union(near.join(several, F.col("b") == F.col("s"), "left_semi")).distinct())
    sides = named(near.select(F.xxhash64("a", "b").alias("key"), F.explode(F.array("a", "b")).alias("s")))
    return reduce(DataFrame.union, [paired(x) for x in (members, lines_of, sides)]).distinct()


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 5, similarity: float = 0.8,
            crowd: int = 8, draws: int = 3) -> DataFrame:
    """The line occurrences to drop: ``k`` and ``id`` of the document, ``line`` (from 0), and ``of_id`` and ``of_line``,
    the occurrence that stays: the first, by id (null last) and line, of its group.

    Lines are what newlines part. Those with fewer than ``least_words`` words and 30 characters say too little to be called copies and
    are left alone. Equal normal forms are one line; different ones are linked if they share a MinHash band of
    their runs of six bytes, their sketches are near, and their edit similarity is at least ``similarity``; a group is what links connect.
    Lines with equal sketches are first compared with the smallest of them; where more than ``crowd`` sketches share a band, each is first
    compared with ``draws`` near ones of it, if there are so many. Then all pairs of these that are still in different groups are compared
    (see ``across``), so neither number loses a link. Null and empty texts have no such line.
    """
    rows = keyed(docs, id_col, text_col)
    every = written(lines(rows, least_words), "lines")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "k", "line")
    distinct = written(every.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n")), "distinct")
    found = written(candidates(rows, least_words, similarity, crowd, draws), "candidates")
    own = found.where(f"kind = {OWN_LINE}").select(F.col("a").alias("s"), F.col("b").alias("h"), "v", "w", "n").distinct()
    low = written(own.groupBy("s").agg(F.min(F.struct("h", "v", "w", "n")).alias("of"), F.count("*").alias("lines")), "sketches")
    met = found.where(f"kind = {PAIR}").select("a", "b").distinct()
    near = met.join(low.select(F.col("s").alias("a"), F.col("of").alias("x")), "a").join(low.select(F.col("s").alias("b"), F.col("of").alias("y")), "b")
    near = near.where(f"least(x.n, y.n) >= greatest(x.n, y.n) * {similarity - 1e-9}D AND bit_count(a ^ b) + bit_count(x.v ^ y.v) + bit_count(x.w ^ y.w) <= {FAR}")
    same = own.select("s", "h").join(low.where("lines > 1"), "s").where("h != of.h").select(F.col("of.h").alias("x"), F.col("h").alias("y"))
    pairs = near.select(F.col("x.h").alias("x"), F.col("y.h").alias("y")).union(same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    roots = kept(components(verified(kept(pairs), rows, distinct, least_words, similarity), "a", "b"))
    rest = kept(across(found, met, low, roots, similarity))
    if not rest.isEmpty():
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(verified(rest, rows, distinct, least_words, similarity, likely=False))
        roots = components(links, "a", "b")
    roots = roots.withColumnRenamed("node", "h")
    member = kept(distinct.join(roots, "h", "left").where("n > 1 OR root IS NOT NULL").select("h", "first", F.coalesce("root", "h").alias("root")))
    stays = member.join(member.groupBy("root").agg(F.min("first").alias("stays")), "root").select("h", "stays")
    return every.join(stays, "h").where(~F.struct(F.col("id").isNull().alias("none"), "id", "k", "line").eqNullSafe(F.col("stays"))) \
        .select("k", "id", "line", F.col("stays.id").alias("of_id"), F.col("stays.line").alias("of_line"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, and the counts ``n_lines`` and ``n_dropped``.

    See ``repeats``. Lines that stay keep their bytes and order. A text that loses all its lines is empty; a null text
    stays null with 0 lines. Rows that agree in id and text lose the same lines. Columns of ``docs`` with the names of the new ones
    are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    dropped = repeats(docs, id_col, text_col, **options).groupBy("k").agg(F.collect_set("line").alias("dropped_"))
    parts = F.split(text_col, "\n", -1)
    rest = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("dropped_", i)), "\n")
    return (docs.withColumn("k_", F.xxhash64(id_col, text_col)).join(dropped.withColumnRenamed("k", "k_"), "k_", "left")
            .withColumn("n_lines", F.coalesce(F.size(parts), F.lit(0))).withColumn("n_dropped", F.coalesce(F.size("dropped_"), F.lit(0)))
            .withColumn(text_col, F.when(F.col("dropped_").isNull(), F.col(text_col)).otherwise(rest)).drop("k_", "dropped_"))
