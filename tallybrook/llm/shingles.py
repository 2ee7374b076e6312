"""Words and word shingles of whole texts as 64-bit numbers, computed in batches."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
    + [(0x9E3779B97F4A7C15 * (2 * i + 3) ^ 0x5851F42D4C957F2D) % 2**64 | 1 for i in range(40)],
    dtype=np.uint64,
)
_MOST_KNOWN = 500_000


class WordHashes:
    """Hashes of words, remembered up to a bound."""

    def __init__(self) -> None:
        self._known: dict[bytes, int] = {}

    def of(self, words: Iterable[bytes], count: int) -> np.ndarray:
        known = self._known
        if len(known) > _MOST_KNOWN:
            known.clear()

        def number(word: bytes) -> int:
            found = known.get(word)
            if found is None:
                found = known[word] = xxhash.xxh3_64_intdigest(word)
            return found

        return np.fromiter(map(number, words), np.uint64, count)


def mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    numbers = (numbers ^ (numbers >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return numbers ^ (numbers >> np.uint64(32))


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """A number for each run of ``length`` words in a row."""
    count = len(words) - length + 1
    total = np.zeros(count, np.uint64)
    for place in range(length):
        total += words[place : place + count] * _FACTORS[place]
    return mixed(total)


def shingle_set(words: np.ndarray, length: int) -> np.ndarray:
    """Distinct shingles in ascending order; fewer words than ``length`` are one shingle."""
    if not len(words):
        return words
    if len(words) < length:
        return runs(words, len(words)) + np.uint64(len(words))
    return np.unique(runs(words, length))


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words between the six ASCII blanks; only A to Z are lower-cased."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()
