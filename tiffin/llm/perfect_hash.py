"""Minimal perfect hash over distinct 64-bit keys, by levels of bit arrays.

Each level holds about twice as many bits as keys are left; a key that is alone
on its bit stays, the others go on. A key's number is the rank of its bit, so n
keys get the numbers 0 to n - 1 and a lookup takes a constant number of steps.
Keys that were not built in also get a number, or -1; the caller tells them apart
by a stored fingerprint.
"""

from __future__ import annotations

import numpy as np

SPREAD = 2.0


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers, another for each seed."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """``sizes``: bits of each level, multiples of 64; ``words``: the bits of all levels."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes.astype(np.uint64), words
        self.first = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.uint64) if len(sizes) else self.sizes
        counts = np.bitwise_count(words).astype(np.int64)
        self.rank = np.cumsum(counts) - counts

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, words = keys.astype(np.uint64), [], []
        while len(left):
            size = -(-int(SPREAD * len(left) + 1) // 64) * 64
            at = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[at]]
        return cls(np.array(sizes, dtype="<u8"), np.concatenate(words) if words else np.zeros(0, "<u8"))

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys that meet no bit."""
        keys = keys.astype(np.uint64)
        out, left = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.first[level] + mixed(keys[left], level) % size
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            held = (self.words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[held]] = (self.rank[word] + below)[held]
            left = left[~held]
        return out
