"""Word-shingle sets and min-max signatures of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from skyledger.llm.common import Words

SEED = 20240601


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, end to end, and their offsets.

    A-Z are lowered first.  A text of fewer words than ``width`` has one shingle, all of it; one without words has none.
    """
    words = Words(column, lower_ascii=True)
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.values.to_pylist()), np.uint64, len(words.values))
    word = known[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    n = len(word)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width):
        rolled = rolled * np.uint64(0xC2B2AE3D27D4EB4F) + word[j:n - width + 1 + j] if n >= width else rolled
    rolled = mixed(rolled)
    sets = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= width:
            sets.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            h = np.uint64(width)
            for x in word[a:b]:
                h = mixed(np.array([h]))[0] ^ x
            sets.append(mixed(np.array([h])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate(sets or [np.zeros(0, np.uint64)]), np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int64)


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 32, count, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, count, np.uint32)


def min_max_signatures(hashes: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """Per non-empty set, the minimum and the maximum under each of ``count`` permutations of the 32-bit numbers.

    Two sets agree in either value with the probability of their Jaccard similarity, so
    ``2 * count`` signature values cost ``count`` hash evaluations per element.
    """
    filled = first[:-1][np.diff(first) > 0]
    out = np.empty((len(filled), 2 * count), np.uint32)
    if not len(filled):
        return out
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    for i, (a, b) in enumerate(zip(*permutations(count), strict=True)):
        y = x * a
        y += b
        y ^= y >> np.uint32(16)
        out[:, 2 * i] = np.minimum.reduceat(y, filled)
        out[:, 2 * i + 1] = np.maximum.reduceat(y, filled)
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key per band of ``rows`` signature values."""
    parts = signatures[:, :bands * rows].reshape(len(signatures), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(rows):
        key = mixed(key * np.uint64(0xC2B2AE3D27D4EB4F) + parts[:, :, j])
    return key
