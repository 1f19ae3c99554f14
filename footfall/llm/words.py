"""Words of a text and their 64-bit hashes, as arrays."""

from __future__ import annotations

import numpy as np
import xxhash

#: Hashes kept in memory by one worker; the table starts anew beyond it.
CACHED_WORDS = 1 << 17

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
     0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
    dtype=np.uint64,
)


class WordHasher(dict):
    """Maps a word (bytes) to its hash, remembering the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: One for all operators: a worker may run several of them.
HASHER = WordHasher()


def to_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return to_bytes(text).lower().split()


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


def gram_hashes(hashes: np.ndarray, offsets: tuple[int, ...], seed: int = 0) -> np.ndarray:
    """One hash for each place where all ``offsets`` lie within the text."""
    count = len(hashes) - max(offsets)
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, np.uint64(seed), np.uint64)
    for i, offset in enumerate(offsets):
        rounds = np.uint64(2 * (i // len(_MULTIPLIERS)) + 1)
        total += hashes[offset : offset + count] * (_MULTIPLIERS[i % len(_MULTIPLIERS)] * rounds)
    return mix(total)


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width``-word shingles; the whole text where it has fewer words."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    width = min(width, len(hashes))
    return np.unique(gram_hashes(hashes, tuple(range(width)), seed=width))
