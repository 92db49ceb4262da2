"""Hashes of the words of whole texts, straight from their UTF-8 bytes, a few megabytes at a time.

A word's hash is the sum of its bytes' random odd numbers, each times a power of its
place, mixed; A-Z count as a-z. Two words agree by chance about once in 2^60 pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_SEED = 42
_FACTOR = np.uint64(xxhash.xxh64_intdigest("place", _SEED) | 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def byte_values(between: bytes) -> np.ndarray:
    """A random odd number for each byte, the same for A-Z and a-z; 0 for the ASCII bytes ``between`` words."""
    values = np.array([xxhash.xxh64_intdigest(bytes([b]).lower(), _SEED) | 1 for b in range(256)], dtype=np.uint64)
    values[list(between)] = 0
    return values


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts (null: none) one after another, and where each begins, and their end."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def _hashed(raw: np.ndarray, begins: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and where they start; a word also ends where a text begins (``begins``)."""
    values = values[raw]
    word = values != 0
    new = word.copy()
    new[1:] &= ~word[:-1]
    new[begins] = word[begins]
    starts = np.flatnonzero(new)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    lengths = np.diff(np.append(starts, len(raw)))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()) + 1, _FACTOR))
    return mixed(np.add.reduceat(values[starts[0] :] * powers[place], starts - starts[0])), starts


def word_hashes(texts: pa.Array, values: np.ndarray, at_once: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts one after another, their starts among the texts' bytes, and each text's end among the words."""
    raw, offsets = text_bytes(texts)
    hashes, starts, a = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)], 0
    while a < len(raw):
        b = min(len(raw), a + at_once)
        while b < len(raw) and values[raw[b]]:  # a piece ends between words
            b += 1
        begins = offsets[:-1][(offsets[:-1] >= a) & (offsets[:-1] < b)]
        got = _hashed(raw[a:b], begins - a, values)
        hashes.append(got[0])
        starts.append(got[1] + a)
        a = b
    starts = np.concatenate(starts)
    return np.concatenate(hashes), starts, np.searchsorted(starts, offsets[1:])
