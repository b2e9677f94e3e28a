"""A cuckoo filter of 64-bit keys over numpy arrays, with insertion and deletion.

A key has a 32-bit fingerprint and two buckets of four slots, each reachable
from the other by the fingerprint alone. Keys are placed together: those that
find a free slot in either bucket first, the rest one by one with evictions.
Deletion takes out one copy of the fingerprint, so only keys that were
inserted may be deleted; the exact table behind the filter sees to that.
"""

from __future__ import annotations

import numpy as np

from namepulse.llm.text import mix

SLOTS = 4
_KICKS = 500


class CuckooFilter:
    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), np.uint32)

    @classmethod
    def of(cls, keys: np.ndarray, load: float = 0.8) -> "CuckooFilter":
        """A filter with room for ``keys``, holding them; it doubles until they fit."""
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(keys)) / (SLOTS * load)))))
        while True:
            made = cls(buckets)
            if made.insert(keys):
                return made
            buckets *= 2

    @classmethod
    def load(cls, blob: bytes) -> "CuckooFilter":
        made = cls(1)
        made.table = np.frombuffer(blob, np.uint32).reshape(-1, SLOTS).copy()
        return made

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mixed = mix(keys.astype(np.uint64))
        prints = (mixed >> np.uint64(32)).astype(np.uint32)
        prints[prints == 0] = 1
        first = (mixed & np.uint64(len(self.table) - 1)).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        step = mix(np.asarray(prints, np.uint64)) & np.uint64(len(self.table) - 1)
        return bucket ^ step.astype(np.int64)

    def insert(self, keys: np.ndarray) -> bool:
        """Add keys; False if the filter is too full, after which it must be made anew."""
        prints, first, second = self._places(keys)
        left = np.arange(len(keys))
        for buckets in (first, second):
            left = left[self._fill(prints[left], buckets[left])]
        return all(self._evict(prints[i], int(first[i])) for i in left)

    def _fill(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Put fingerprints into free slots of their buckets; indexes of those without room."""
        order = np.argsort(buckets, kind="stable")
        sorted_buckets = buckets[order]
        rank = np.arange(len(order)) - np.searchsorted(sorted_buckets, sorted_buckets)
        free = self.table[sorted_buckets] == 0
        fits = rank < free.sum(axis=1)
        # The slot of the rank-th free place of the bucket.
        slot = (np.cumsum(free, axis=1) > rank[:, None]).argmax(axis=1)
        self.table[sorted_buckets[fits], slot[fits]] = prints[order[fits]]
        return order[~fits]

    def _evict(self, fingerprint: np.uint32, bucket: int) -> bool:
        for kick in range(_KICKS):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = fingerprint
                return True
            slot = (kick + int(fingerprint)) % SLOTS
            fingerprint, self.table[bucket, slot] = self.table[bucket, slot], fingerprint
            bucket = int(self._other(bucket, fingerprint))
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were inserted."""
        for fingerprint, *buckets in zip(*self._places(keys), strict=True):
            for bucket in buckets:
                at = np.flatnonzero(self.table[bucket] == fingerprint)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        prints, first, second = self._places(keys)
        return (self.table[first] == prints[:, None]).any(axis=1) | (self.table[second] == prints[:, None]).any(axis=1)
