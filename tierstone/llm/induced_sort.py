"""Suffix sorting by external induced sorting, in bulk array steps.

Suffixes are told apart as smaller (S) or larger (L) than their right neighbours. The leftmost S
suffixes are sorted by recursion on names of the pieces between them; from their order one sweep
induces that of the L suffixes, and a sweep back that of the S suffixes. A sweep takes suffixes
in ascending order from a priority queue and puts their left neighbours into it.

The queue takes and gives arrays of (key, position) tuples, one 64-bit word each with the key
above, kept by ranges of keys, and puts the ranges that are not being swept on disk when it holds
more than ``memory`` bytes. Since tuples of equal key arrive in order, a range only needs a stable
sort by key. The text, its types and the results are arrays in memory: the caller cuts its input
into shards that fit.
"""

from __future__ import annotations

import os
from tempfile import TemporaryDirectory

import numpy as np

RANGES = 512
SEEDS_PER_RANGE = 700  # fewer, and the steps per range cost more than the tuples in it
_KEY = 32  # bits below the key, which hold the position
_POSITION = np.int64((1 << _KEY) - 1)


class TupleQueue:
    """A priority queue of (key, position) with non-decreasing removals, by ranges of keys.

    Ranges are as wide as a power of two, so that a shift tells them apart."""

    def __init__(self, top: int, folder: str, memory: int, ranges: int = RANGES):
        self.bits = (max(1, -(-top // ranges)) - 1).bit_length()
        self.ranges = max(1, -(-top >> self.bits))
        self._parts: list[list[np.ndarray]] = [[] for _ in range(self.ranges)]
        self._spilled: set[int] = set()
        self._folder, self._memory, self._held = folder, memory, 0

    def push(self, tuples: np.ndarray) -> None:
        if not len(tuples):
            return
        where = (tuples >> (_KEY + self.bits)).astype(np.uint16)
        if (where != where[0]).any():
            order = np.argsort(where, kind="stable")  # by digits
            tuples, where = tuples[order], where[order]
        cuts = [0, *(np.flatnonzero(where[1:] != where[:-1]) + 1).tolist(), len(tuples)]
        for a, b, index in zip(cuts, cuts[1:], where[cuts[:-1]].tolist()):
            self._parts[index].append(tuples[a:b])
        self._held += tuples.nbytes
        if self._held > self._memory:
            self._spill()

    def _file(self, index: int) -> str:
        return os.path.join(self._folder, f"range-{id(self)}-{index}")

    def _spill(self) -> None:
        for index, parts in enumerate(self._parts):
            if parts:
                with open(self._file(index), "ab") as out:
                    for part in parts:
                        out.write(part.tobytes())
                self._spilled.add(index)
                self._parts[index] = []
        self._held = 0

    def take(self, index: int) -> list[np.ndarray]:
        """All tuples of a range, in order of arrival."""
        parts = self._parts[index]
        self._held -= sum(x.nbytes for x in parts)
        self._parts[index] = []
        if index in self._spilled:
            parts = [np.fromfile(self._file(index), dtype=np.int64), *parts]
            os.remove(self._file(index))
            self._spilled.discard(index)
        return parts


def _tuples(keys: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return (keys.astype(np.int64) << _KEY) | positions


def _sweep(seeds: np.ndarray, seed_keys: np.ndarray, left_keys: np.ndarray, top: int, folder: str, memory: int) -> np.ndarray:
    """Positions that the seeds induce, in sweep order; seeds come in that order and are left out.

    Seeds have odd keys, induced positions even ones. ``left_keys``: for each position, the key of
    its left neighbour, or -1 where that is not induced.
    """
    queue, out = TupleQueue(top, folder, memory, min(RANGES, 1 + len(seeds) // SEEDS_PER_RANGE)), []
    width = 1 << queue.bits
    small = np.uint16 if width <= 1 << 16 else np.int64  # sorted by digits, not by comparisons
    starts = np.searchsorted(seed_keys, np.arange(queue.ranges + 1) * width).tolist()
    seeds = _tuples(seed_keys, seeds)

    def by_key(tuples: np.ndarray, base: int) -> np.ndarray:
        return tuples[np.argsort(((tuples >> _KEY) - base).astype(small), kind="stable")]

    for index in range(queue.ranges):
        waiting, base = [*queue.take(index), seeds[starts[index] : starts[index + 1]]], index * width
        waiting = np.concatenate(waiting) if len(waiting) > 1 else waiting[0]
        if width > 2:  # else induced positions, which have the even key, come first already
            waiting = by_key(waiting, base)
        while len(waiting):
            at = waiting & _POSITION
            new = left_keys[at]
            there = (new >= 0) & (new < base + width)
            n = len(waiting)
            if there.any():
                # the longest run from the front whose pushes all come after it; else the first key alone
                keys = waiting >> _KEY
                lowest = np.minimum.accumulate(np.where(there, new, top))
                bad = np.flatnonzero(lowest <= keys)
                if len(bad):
                    n = int(np.searchsorted(keys, keys[bad[0]])) or int(np.searchsorted(keys, keys[0], side="right"))
                    new, there, at = new[:n], there[:n], at[:n]
            done, waiting = waiting[:n], waiting[n:]
            out.append(at[(done >> _KEY) & 1 == 0].astype(np.int32))
            later = new >= base + width
            queue.push(_tuples(new[later], at[later] - 1))
            if there.any():
                # after those of the same key that wait already: they were induced before
                waiting = by_key(np.concatenate([waiting, _tuples(new[there], at[there] - 1)]), base)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int32)


def _is_s(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last symbol is the least, and unique."""
    n = len(text)
    up = np.ones(n, dtype=bool)
    differs = text[:-1] != text[1:]
    nearest = np.where(differs, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    at = np.minimum(nearest, n - 2)
    up[:-1] = text[at] < text[at + 1]
    return up


def _names(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, top: int) -> tuple[np.ndarray, int]:
    """Ranks of the pieces from each LMS position to the next, and how many differ.

    Pieces are compared by as many symbols at a time as fit a word beside the names so far."""
    length = np.append(np.diff(lms) + 1, 1)
    bits = (2 * top + 1).bit_length()
    together = max(1, (62 - len(lms).bit_length()) // bits)
    symbols = np.zeros(len(text) + together, dtype=np.int64)
    symbols[: len(text)] = 2 * text.astype(np.int64) + is_s + 1
    names, step = np.zeros(len(lms), dtype=np.int64), 0
    open_ = np.arange(len(lms))
    while len(open_):
        key, begin, rest = names[open_], lms[open_] + step, length[open_] - step
        for i in range(together):
            key <<= bits
            key |= np.where(rest > i, symbols[begin + i], 0)
        order = np.argsort(key)
        ranked, group = key[order], names[open_[order]]
        new = np.ones(len(order), dtype=bool)
        new[1:] = ranked[1:] != ranked[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(order)))
        # names are the number of smaller pieces: rank within the old group, from its start
        heads = np.flatnonzero(np.diff(group, prepend=-1))
        old = np.repeat(heads, np.diff(np.append(heads, len(order))))
        names[open_[order]] = group + np.repeat(first, size) - old
        step += together
        more = np.repeat(size > 1, size) & (rest[order] > together)
        open_ = np.sort(open_[order[more]])
    held = np.zeros(len(lms), dtype=bool)
    held[names] = True
    rank = np.cumsum(held) - 1
    return rank[names], int(rank[-1]) + 1


def suffix_array(text: np.ndarray, top: int, folder: str, memory: int) -> np.ndarray:
    """Sorted suffixes of ``text``, symbols below ``top``, the last one 0 and nowhere else."""
    n = len(text)
    if n < 3:
        return np.arange(n - 1, -1, -1, dtype=np.int32)
    is_s = _is_s(text)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    names, distinct = _names(text, is_s, lms, top)
    if distinct == len(lms):
        order = np.empty(len(lms), dtype=np.int64)
        order[names] = np.arange(len(lms))
    else:
        order = suffix_array(names, distinct, folder, memory)
    seeds = lms[order]
    symbol, left = text.astype(np.int32), np.empty(n, dtype=np.int32)
    left[0] = -1
    left[1:] = np.where(is_s[:-1], -1, 2 * symbol[:-1])
    larger = _sweep(seeds, 2 * symbol[seeds] + 1, left, 2 * top, folder, memory)
    # the other way round, keys count down from the greatest symbol
    left[1:] = np.where(is_s[:-1], 2 * (top - 1 - symbol[:-1]), -1)
    down = larger[::-1]
    smaller = _sweep(down, 2 * (top - 1 - symbol[down]) + 1, left, 2 * top, folder, memory)
    return _merge(symbol, larger, smaller[::-1], top)


def _merge(symbol: np.ndarray, larger: np.ndarray, smaller: np.ndarray, top: int) -> np.ndarray:
    """All suffixes: per first symbol the L ones, then the S ones; the last suffix comes first."""
    of_l, of_s = symbol[larger], symbol[smaller]
    out = np.empty(1 + len(larger) + len(smaller), dtype=np.int32)
    out[0] = len(symbol) - 1
    some_s, some_l = (np.cumsum(np.bincount(x, minlength=top)) for x in (of_s, of_l))
    before = np.concatenate([[0], some_s[:-1]])  # S suffixes with a smaller symbol
    out[1 + np.arange(len(larger)) + before[of_l]] = larger
    out[1 + np.arange(len(smaller)) + some_l[of_s]] = smaller
    return out


def sort_suffixes(data: np.ndarray, memory: int = 64 << 20) -> np.ndarray:
    """The suffix array of bytes; zeros in ``data`` are separators like any other symbol."""
    text = np.append(data.astype(np.uint16) + 1, np.uint16(0))
    with TemporaryDirectory() as folder:
        return suffix_array(text, 257, folder, memory)[1:]
