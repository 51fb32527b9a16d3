"""Words of a text as bytes, and hashes of words and word sequences as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

#: ASCII letters in lower case and digits stay, other ASCII becomes a space, other bytes of UTF-8 stay.
PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())
CACHE = 1 << 18


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(PLAIN).split()


class Hashes(dict):
    """64-bit hashes of words. Words seen before are looked up; beyond CACHE words it starts anew."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sequences(hashes: np.ndarray, offsets: list[int]) -> np.ndarray:
    """A hash for each place i of the words at i + each offset, in this order."""
    n = len(hashes) - max(offsets)
    out = np.zeros(max(0, n), dtype=np.uint64)
    for offset in offsets:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[offset : offset + len(out)] + np.uint64(offset + 1))
    return out
