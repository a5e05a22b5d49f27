"""Five-word shingles of a text as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def words(text: str | None) -> list[bytes]:
    """A-Z lowered, split at blanks and the control characters 9 to 13 (the defaults of bytes.lower and bytes.split)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_sequence(text: str | None) -> np.ndarray:
    """Hashes of the 5-word shingles in text order; a shorter text is one shingle, a text without words none."""
    parts = words(text)
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) < WIDTH:
        # keyed apart from full shingles, so a short text only equals the same short text
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts), seed=len(parts))], np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashed = np.fromiter(map(digest, parts), np.uint64, len(parts))
    n = len(parts) - WIDTH + 1
    out = np.zeros(n, np.uint64)
    for j in range(WIDTH):
        out = out * _FACTOR + hashed[j:j + n]
    out ^= out >> _SHIFT
    out *= _MIX
    return out ^ (out >> _SHIFT)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_sequence(text))
