"""Character n-grams of words, hashed in numpy over whole blocks of text.

A text is lower-cased ASCII-wise and handled as UTF-8 bytes; each blank is a word
boundary. The n-grams of a word include its boundaries (``_word_``), so prefixes and
suffixes differ from inner parts. Every n-gram is hashed to one of ``2 ** bits`` rows.
"""

from __future__ import annotations

import numpy as np

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = np.uint32(0x01000193)


def clean(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes with every blank as one space byte."""
    out = _LOWER[data]
    out[BLANK[out]] = 32
    return out


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The cleaned bytes of all texts, each between spaces, and the start of each text."""
    data = np.frombuffer(b" " + b"  ".join(texts) + b" " * 9, np.uint8)
    lens = np.array([len(t) + 2 for t in texts], np.int64)
    return clean(data), np.concatenate([[0], np.cumsum(lens)])


def grams(text: np.ndarray, sizes: tuple[int, ...], bits: int):
    """Yields per size: the row of the n-gram that starts at each byte, and where one is (no blank inside)."""
    blank = text == 32
    n_max = max(sizes)
    n = len(text) - n_max
    if n <= 0:
        return
    h = np.full(n, 0x811C9DC5, np.uint32)
    inner = np.zeros(n, bool)  # a blank between the first and the last byte
    mask = np.uint32((1 << bits) - 1)
    for size in range(1, n_max + 1):
        h = (h ^ text[size - 1:size - 1 + n]) * _P
        if size > 2:
            inner |= blank[size - 2:size - 2 + n]
        if size in sizes:
            mixed = h ^ (h >> np.uint32(15))
            mixed = (mixed * np.uint32(0x85EBCA6B)) ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)
            mixed ^= mixed >> np.uint32(13)
            yield mixed & mask, ~inner & ~(blank[:n] & blank[size - 1:size - 1 + n])


def bag_sums(texts: list[bytes], weights: np.ndarray, sizes: tuple[int, ...], bits: int):
    """Per text: the sum of the weights of its n-grams, and their number."""
    text, starts = padded(texts)
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    ends = starts[:-1]
    for row, ok in grams(text, sizes, bits):
        value = np.where(ok, weights[row], 0).astype(np.float64)
        at = np.minimum(ends, len(value) - 1)
        total += np.add.reduceat(value, at)
        count += np.add.reduceat(ok.astype(np.int64), at)
    return total, count


def bags(texts: list[bytes], sizes: tuple[int, ...], bits: int):
    """All n-grams: (text number, row) of each."""
    text, starts = padded(texts)
    which, rows = [], []
    for row, ok in grams(text, sizes, bits):
        at = np.flatnonzero(ok)
        rows.append(row[at])
        which.append((np.searchsorted(starts, at, "right") - 1).astype(np.int32))
    return (np.concatenate(which), np.concatenate(rows)) if rows else (np.zeros(0, np.int32), np.zeros(0, np.uint32))
