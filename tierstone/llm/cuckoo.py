"""A cuckoo filter: approximate membership that supports deletion. Arrays of a task, not tables."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MAX_KICKS = 500
_MAGIC = b"CKF1"
_ODD = np.uint64(0x9E3779B97F4A7C15)


class CuckooFilter:
    """16-bit fingerprints in buckets of four; each key has two buckets.

    Keys are uniform 64-bit hashes. ``contains`` has no false negatives for keys that were
    inserted and not deleted, and about ``8 / 65535`` false positives. Deleting a key that was
    never inserted is not allowed: callers keep the exact counts that rule it out.
    """

    def __init__(self, capacity: int):
        self.n = 1 << max(0, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * 0.84)))))
        self.table = np.zeros((self.n, SLOTS), dtype=np.uint16)
        self.count = 0
        self._random = np.random.default_rng(self.n)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k = keys.astype(np.uint64) * _ODD
        k ^= k >> np.uint64(29)
        prints = (k >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (k & np.uint64(self.n - 1)).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        jump = (prints.astype(np.uint64) * _ODD) >> np.uint64(20)
        return bucket ^ (jump & np.uint64(self.n - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(np.asarray(keys))
        p = prints[:, None]
        return (self.table[first] == p).any(axis=1) | (self.table[second] == p).any(axis=1)

    def _place(self, buckets: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Put each print in its bucket if there is room; returns which found room."""
        order = np.argsort(buckets, kind="stable")
        b = buckets[order]
        rank = np.arange(len(b)) - np.searchsorted(b, b)
        free = self.table[b] == 0
        # the rank-th free slot of the bucket
        position = np.cumsum(free, axis=1) * free
        hit = position == (rank + 1)[:, None]
        ok = hit.any(axis=1)
        self.table[b[ok], hit[ok].argmax(axis=1)] = prints[order][ok]
        placed = np.zeros(len(b), dtype=bool)
        placed[order] = ok
        return placed

    def insert(self, keys: np.ndarray) -> bool:
        """Insert distinct, absent keys. False if the filter is too full: build a larger one."""
        prints, first, second = self._places(np.asarray(keys))
        left = ~self._place(first, prints)
        ids = np.flatnonzero(left)
        if len(ids):
            ids = ids[~self._place(second[ids], prints[ids])]
        self.count += len(prints)
        for bucket, p in zip(first[ids].tolist(), prints[ids].tolist()):
            if not self._kick(bucket, p):
                return False
        return True

    def _kick(self, bucket: int, p: int) -> bool:
        for _ in range(MAX_KICKS):
            row = self.table[bucket]
            free = np.flatnonzero(row == 0)
            if len(free):
                row[free[0]] = p
                return True
            slot = int(self._random.integers(SLOTS))
            p, row[slot] = int(row[slot]), p
            bucket = int(self._other(np.array([bucket]), np.array([p], dtype=np.uint16))[0])
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Remove one fingerprint for each of these keys, all of them inserted before."""
        prints, first, second = self._places(np.asarray(keys))
        for p, a, b in zip(prints.tolist(), first.tolist(), second.tolist()):
            for bucket in (a, b):
                found = np.flatnonzero(self.table[bucket] == p)
                if len(found):
                    self.table[bucket, found[0]] = 0
                    self.count -= 1
                    break
            else:
                raise KeyError("deleted a key that the filter does not hold")

    def to_bytes(self) -> bytes:
        return _MAGIC + np.array([self.n, self.count], dtype="<i8").tobytes() + self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> CuckooFilter:
        if blob[:4] != _MAGIC:
            raise ValueError("not a cuckoo filter")
        found = cls(1)
        found.n, found.count = (int(x) for x in np.frombuffer(blob, "<i8", 2, 4))
        found.table = np.frombuffer(blob, "<u2", offset=20).reshape(found.n, SLOTS).copy()
        found._random = np.random.default_rng(found.n)
        return found
