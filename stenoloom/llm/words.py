"""Words of texts in any script, and their hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex
import xxhash

#: Scripts written without spaces give one word per character.
_WORDS = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]|(?:(?![\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}])[\p{L}\p{M}\p{N}])+")


def words(text: str | None) -> list[str]:
    """Words in lower case, without punctuation."""
    return _WORDS.findall(text.lower()) if text else []


@lru_cache(maxsize=200_000)
def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


def word_hashes(tokens: list[str]) -> np.ndarray:
    """64-bit hash of every word, in order."""
    return np.array([_hash(w) for w in tokens], np.uint64)


def combined(columns: list[np.ndarray]) -> np.ndarray:
    """One hash for every row of hashes in ``columns``; their order counts."""
    out = np.zeros(len(columns[0]), np.uint64)
    with np.errstate(over="ignore"):
        for h in columns:
            out = out * np.uint64(0x9E3779B97F4A7C15) + h
            out ^= out >> np.uint64(29)
    return out
