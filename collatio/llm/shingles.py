"""Hashed word shingles of UTF-8 texts, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word -> 64-bit hash, the same in every process; remembers a bounded number of words."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = found
        return found


def words(text: bytes) -> list[bytes]:
    """Runs of anything but ASCII white space, with A-Z lowered: bytes.lower and bytes.split know ASCII only."""
    return text.lower().split()


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words in order; of the whole sequence if it is shorter; nothing for no words."""
    if not len(hashes):
        return hashes
    size = min(n, len(hashes))
    out = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out = mix(out * STEP + hashes[i : len(hashes) - size + 1 + i])
    return out


def word_hashes(text: bytes, known: WordHashes) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))


def shingle_set(text: bytes, n: int, known: WordHashes) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(shingles(word_hashes(text, known), n))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two sorted sets have in common."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
