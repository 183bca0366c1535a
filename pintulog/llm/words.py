"""Words and word shingles of texts, hashed in numpy within Arrow batches.

A word is a longest run without the six ASCII white space characters, after A-Z are
lower-cased; all other characters count as they are. A shingle is ``size`` consecutive
words. Words have a strong 64-bit hash, and a shingle's hash mixes those of its words, so
sets of hashes stand for sets of shingles.
"""

import numpy as np
import xxhash

MAX_WORDS = 200_000


class WordHashes(dict):
    """64-bit hash of each word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()
# Odd multipliers, one for each place of a word in a shingle.
_PLACES = np.random.default_rng(5).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """The hash of the shingle at each word; fewer words than ``size`` are one shingle."""
    count = len(hashes)
    if not count:
        return hashes
    if count < size:
        place = _PLACES[: count]
        return mixed(np.array([(hashes * place).sum(dtype=np.uint64) + np.uint64(count)]))
    n = count - size + 1
    total = hashes[:n] * _PLACES[0]
    for k in range(1, size):
        total = total + hashes[k : k + n] * _PLACES[k]
    return mixed(total)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Distinct shingle hashes of the whole text, sorted; empty without words."""
    return np.unique(shingles(word_hashes(words(text)), size))


def set_key(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a sorted set, as two signed integers."""
    number = xxhash.xxh3_128_intdigest(values.tobytes())
    return tuple(x - (1 << 64) if x >> 63 else x for x in (number >> 64, number & (1 << 64) - 1))
