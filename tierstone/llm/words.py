"""Words of many texts at once, as 64-bit hashes, from the bytes of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_MULTIPLIER = 0x9FB21C651E98DF25 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
BLOCK_BYTES = 512 << 10

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters every bit."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def powers_of(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    if n > 1:
        out[1:] = _U(base)
        np.multiply.accumulate(out, out=out)
    return out


class WordHasher:
    """Hashes words of up to ``BLOCK_BYTES`` of text in one pass; longer texts in one own pass."""

    def __init__(self):
        self._up, self._down = powers_of(_MULTIPLIER, 1 << 16), powers_of(_INVERSE, 1 << 16)

    def _grown(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self._up):
            self._up, self._down = powers_of(_MULTIPLIER, n), powers_of(_INVERSE, n)
        return self._up, self._down

    def words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words (A-Z in lower case) and, per text, where its words end.

        ``data``: the texts' bytes, one after the other; ``ends``: where each text ends.
        """
        if not len(data):
            return np.zeros(0, dtype=np.uint64), np.zeros(len(ends), dtype=np.int64)
        inside = ~_IS_SPACE[data]
        starts_at = inside.copy()
        starts_at[1:] &= ~inside[:-1]
        cut = ends[:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        starts_at[cut] = inside[cut]  # a word never runs on into the next text
        begin = np.flatnonzero(starts_at)
        if not len(begin):
            return np.zeros(0, dtype=np.uint64), np.zeros(len(ends), dtype=np.int64)
        up, down = self._grown(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        value = (_LOWER[data].astype(np.uint64) + _U(1)) * inside
        np.cumsum(value * up[: len(data)], out=sums[1:])
        # white space adds nothing, so a word may be taken to end where the next one begins
        stop = np.append(begin[1:], len(data))
        hashes = mix((sums[stop] - sums[begin]) * down[begin])
        return hashes, np.searchsorted(begin, ends, side="left")


def text_blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``[a, b)`` of the batch with the bytes of their texts and their ends; nulls are empty."""
    texts = batch.column(column).cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BLOCK_BYTES, side="right")) - 1)
        b = min(b, len(texts))
        yield a, b, data[offsets[a] : offsets[b]], offsets[a + 1 : b + 1] - offsets[a]
        a = b


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words; with fewer words, one hash of the whole sequence."""
    if not len(words):
        return words
    n, runs = len(words), max(1, len(words) - size + 1)
    width = min(size, n)
    out = np.full(runs, width, dtype=np.uint64)
    for i in range(width):
        out = out * _U(_MULTIPLIER) + words[i : i + runs]
        out ^= out >> _U(29)
    return mix(out)
