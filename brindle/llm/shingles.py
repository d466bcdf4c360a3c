"""Word-shingle sets and their SuperMinHash signatures, in numpy for one batch of texts."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class _Codes(dict):
    """Word to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word)
        return code


_codes = _Codes()
forget = _codes.clear


def word_codes(text: str) -> np.ndarray:
    """Hashes of the words, A-Z in lower case.  bytes.lower and bytes.split know ASCII only, as wanted."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_codes.__getitem__, found), dtype=np.uint64, count=len(found))


def shingle_set(text: str, k: int = 3) -> np.ndarray:
    """Sorted distinct hashes of all k-word shingles; the whole sequence as one when it is shorter; none without words."""
    w = word_codes(text)
    if not len(w):
        return w
    n = min(k, len(w))
    h = np.full(len(w) - n + 1, n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            h = mix(h * _MIX + w[i : len(w) - n + 1 + i])
    return np.unique(h)


PART = 100_000  # elements that step through the slots together


def superminhash(sets: list[np.ndarray], m: int = 128) -> np.ndarray:
    """One row of m slots per set; a set of any size passes in parts, for a slot holds the least offer of all elements."""
    if max(map(len, sets), default=0) <= PART:
        return _step(sets, m)
    return np.stack([np.minimum.reduce([_step([s[i : i + PART]], m)[0] for i in range(0, max(len(s), 1), PART)]) for s in sets]) if sets else np.empty((0, m))


def _step(sets: list[np.ndarray], m: int) -> np.ndarray:
    """One row of m slots per set.

    Element e visits the slots in its own random order; at its j-th visit it offers j + r with a fresh r in [0, 1).
    All elements of all sets take their j-th step together.  A set stops as soon as each of its slots holds less than
    the next j, because no later offer can win.
    """
    sig = np.full((len(sets), m), np.inf)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if not sizes.sum():
        return sig
    h = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), sizes)
    order = None
    flat = sig.reshape(-1)
    with np.errstate(over="ignore"):
        for j in range(m):
            x = mix(h + _MIX * np.uint64(j + 1))
            r = (x >> np.uint64(32)).astype(np.float64) / 4294967296.0
            pick = j + ((x & np.uint64(0xFFFFFFFF)) % np.uint64(m - j)).astype(np.int64)
            if order is None:
                order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(h), 1))
            rows = np.arange(len(h))
            slot = order[rows, pick]
            order[rows, pick] = order[rows, j]
            order[rows, j] = slot
            np.minimum.at(flat, doc * m + slot, j + r)
            open_ = sig.max(axis=1) >= j + 1
            keep = open_[doc]
            if not keep.any():
                break
            if not keep.all():
                h, doc, order = h[keep], doc[keep], order[keep]
    return sig


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """Hash of each band of so many slots: (sets, slots / rows)."""
    with np.errstate(over="ignore"):
        bits = np.ascontiguousarray(sig).view(np.uint64).reshape(len(sig), -1, rows)
        h = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64) + np.uint64(1), bits.shape[:2]).copy()
        for i in range(rows):
            h = mix(h * _MIX + bits[:, :, i])
    return h


def jaccard_counts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
