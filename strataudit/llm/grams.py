"""Byte n-grams of many texts at once, as sorted numbers."""

from __future__ import annotations

import numpy as np

PAD = 2  # stands before a text; a control byte
ROW_BITS = 24  # a number holds up to five bytes and the row that they come from


def packed(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """``order``-grams that end at each byte of each text, with the rows' numbers in the low bits, sorted and
    distinct; and how often each occurs. A text's first bytes follow on ``order - 1`` pads."""
    assert order <= 5 and len(texts) < 1 << ROW_BITS
    gap = bytes([PAD]) * (order - 1)
    data = np.frombuffer(gap + gap.join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    rows = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    ends = np.arange(len(rows), dtype=np.int64) + (rows + 1) * (order - 1)
    gram = np.zeros(len(rows), np.uint64)
    for back in range(order - 1, -1, -1):
        gram = (gram << np.uint64(8)) | data[ends - back]
    return runs((gram << np.uint64(ROW_BITS)) | rows.astype(np.uint64))


def runs(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the number or the summed weight of each."""
    if weights is None:
        values = np.sort(values)
    else:
        order = np.argsort(values, kind="stable")
        values, weights = values[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(values))) if weights is None else \
        (np.add.reduceat(weights, first) if len(first) else weights[:0])
    return values[first], counts


def split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams and rows of packed numbers."""
    return keys >> np.uint64(ROW_BITS), (keys & np.uint64((1 << ROW_BITS) - 1)).astype(np.int64)


def found(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in a sorted table, and whether it is there."""
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return at, (table[at] == values) if len(table) else np.zeros(len(values), bool)
