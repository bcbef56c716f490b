"""Numpy helpers for Arrow batches of texts inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
#: The ASCII white space.
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def text_chunks(texts: pa.Array, max_bytes: int = 1 << 21, lower: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets of rows, bytes) of runs of whole texts; null is empty. A longer text is a run of its own."""
    if lower:
        texts = pc.utf8_lower(texts.cast(pa.large_string()))
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    row = 0
    while row < len(texts):
        before = ends[row - 1] if row else 0
        last = max(row + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        part = texts.slice(row, last - row)
        start = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset]
        total = int(ends[last - 1] - before)
        data = part.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8, count=total, offset=int(start)) if total else np.zeros(0, np.uint8)
        yield row, np.concatenate([[0], ends[row:last] - before]).astype(np.int64), raw
        row = last


class WordHasher:
    """Hashes of all words (runs of anything but white space) of a run of texts, by differences of prefix sums."""

    def __init__(self) -> None:
        self._power = powers(_MULTIPLIER, 1 << 16)
        self._inverse = powers(_INVERSE, 1 << 16)

    def __call__(self, offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word, and the number of words before each text (one more than texts)."""
        n = len(raw)
        if n > len(self._power):
            size = 1 << int(n).bit_length()
            self._power, self._inverse = powers(_MULTIPLIER, size), powers(_INVERSE, size)
        inside = ~SPACES[raw]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.concatenate([[False], inside])
        after = np.concatenate([inside, [False]])
        starts = np.flatnonzero(after & (~before | edge))
        ends = np.flatnonzero(before & (~after | edge))
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self._power[:n])])
            words = mix((sums[ends] - sums[starts]) * self._inverse[starts] if n else np.zeros(0, np.uint64))
        return words, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of `size` words; one of all words if there are fewer, none if there are none."""
    if not len(words):
        return words
    width = min(size, len(words))
    n = len(words) - width + 1
    with np.errstate(over="ignore"):
        out = np.full(n, np.uint64(width))
        for i in range(width):
            out = out * np.uint64(0xD6E8FEB86659FD93) + words[i:i + n]
    return mix(out)
