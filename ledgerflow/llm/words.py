"""Words of texts as 64-bit numbers, remembered per worker up to a bound."""

from __future__ import annotations

import numpy as np
import xxhash


class WordHashes(dict):
    """XXH3 of a word (bytes); ``fixed`` words have the hashes they are given."""

    def __init__(self, most: int, fixed: dict[bytes, int] | None = None):
        super().__init__(fixed or {})
        self.most, self.fixed = most, fixed or {}

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
            self.update(self.fixed)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def planes(a: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: sorted or small numbers then compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def from_planes(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(kind).ravel()


def narrow(a: np.ndarray) -> bytes:
    """Unsigned numbers in the fewest bytes that hold the largest, with a byte that tells how many."""
    kind = np.min_scalar_type(int(a.max()) if len(a) else 0)
    return bytes([kind.itemsize]) + planes(a.astype(kind))


def from_narrow(blob: bytes) -> np.ndarray:
    return from_planes(blob[1:], np.dtype(f"u{blob[0]}")).astype(np.uint64)
