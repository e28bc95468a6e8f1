"""Hashes of word sequences in numpy, and packed columns of them."""

from __future__ import annotations

import numpy as np
import xxhash

CACHED = 400_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_words: dict[bytes, int] = {}


def _of_word(word: bytes) -> int:
    if len(_words) >= CACHED:
        _words.clear()
    value = _words[word] = xxhash.xxh3_64_intdigest(word)
    return value


def forget() -> None:
    """Give up what this worker keeps, for a stage that keeps something else."""
    _words.clear()


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = _words.get
    return np.fromiter((known(w) or _of_word(w) for w in words), dtype=np.uint64, count=len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: list[bytes], size: int) -> np.ndarray:
    """The 64-bit hash of each ``size`` words in a row, in order."""
    own = word_hashes(words)
    n = len(own) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total = total * _STEP + own[k : k + n]
        total ^= total >> np.uint64(29)
    return _mixed(total)


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """The distinct shingles of a text in order of their hashes: its windows of ``size``
    words with A-Z in lower case, or all words where there are fewer."""
    words = text.lower().split() if text else []
    return np.unique(window_hashes(words, min(size, len(words)))) if words else np.zeros(0, dtype=np.uint64)


def lot_of(hashes: np.ndarray, lots: int) -> np.ndarray:
    """Which of ``lots`` equal ranges each hash falls in."""
    return (((hashes >> np.uint64(32)) * np.uint64(lots)) >> np.uint64(32)).astype(np.int32)


def split_by(lot: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The positions of each lot, in their order."""
    order = np.argsort(lot, kind="stable")
    there, begins = np.unique(lot[order], return_index=True)
    return [(int(k), part) for k, part in zip(there, np.split(order, begins[1:]), strict=True)] if len(lot) else []


def packed(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def joined(column, kind: str) -> np.ndarray:
    """All values of a column of packed arrays, end to end."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)
