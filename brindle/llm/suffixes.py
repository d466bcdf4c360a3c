"""Suffix sorting in two stages, and runs of equal prefixes, in numpy for one block of text."""

from __future__ import annotations

import numpy as np

SEPARATOR = 0xFF  # a byte that UTF-8 never contains


def _words(text: np.ndarray, depth: int) -> np.ndarray:
    """At each place the next eight bytes as one big-endian number."""
    padded = np.concatenate([text, np.full(depth + 8, SEPARATOR, np.uint8)]).astype(np.uint64)
    w = (padded[:-1] << np.uint64(8)) | padded[1:]
    w = (w[:-2] << np.uint64(16)) | w[2:]
    return (w[:-4] << np.uint64(32)) | w[4:]


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one that starts a byte later; the last suffix counts as larger."""
    n = len(text)
    step = np.flatnonzero(text[:-1] != text[1:])
    nxt = np.searchsorted(step, np.arange(n))
    out = np.zeros(n, bool)
    has = nxt < len(step)
    at = step[nxt[has]]
    out[has] = text[at] < text[at + 1]
    return out


def _direct(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """The given suffixes in order of their first bytes, eight at a time; only ties are looked at again."""
    order = places.copy()
    tied = np.arange(len(order))
    group = np.zeros(len(order), np.int64)
    for shift in range(0, depth, 8):
        key = words[order[tied] + shift]
        by = np.lexsort((key, group))
        order[tied] = order[tied][by]
        key, group = key[by], group[by]
        new = np.ones(len(tied), bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        number = np.cumsum(new)
        alone = new & np.r_[new[1:], True]
        tied, group = tied[~alone], number[~alone]
        if not len(tied):
            break
    return order


def suffix_order(text: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """All suffixes in the order of their first `depth` bytes (ties in any order).

    Stage one sorts only suffixes smaller than their successors.  Stage two scans the buckets of first bytes from low to high:
    each suffix found puts its larger predecessor at the next free place of that one's bucket.
    """
    n = len(text)
    words = _words(text, depth) if words is None else words
    small = smaller_than_successor(text)
    direct = _direct(np.flatnonzero(small), words, depth)
    head = text[direct] if len(direct) else np.empty(0, np.uint8)
    cut = np.searchsorted(head, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[int(text[-1])].append(np.array([n - 1]))  # the end of the text is smaller than any byte
    out = []
    for c in range(256):
        layers = waiting[c]
        now = np.concatenate(layers) if layers else np.empty(0, np.int64)
        found = [now]
        while len(now):  # a run of one byte puts its own predecessors into the same bucket
            before = now[now > 0] - 1
            now = before[(text[before] == c) & ~small[before]]
            found.append(now)
        bucket = np.concatenate([*found, direct[cut[c] : cut[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~small[before] & (text[before] > c)]
        if len(before):
            letters = text[before]
            by = np.argsort(letters, kind="stable")
            before, letters = before[by], letters[by]
            starts = np.flatnonzero(np.r_[True, letters[1:] != letters[:-1]])
            for a, b in zip(starts, np.r_[starts[1:], len(before)]):
                waiting[int(letters[a])].append(before[a:b])
    return np.concatenate(out)


def equal_prefixes(order: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """For each suffix but the first: does it share its first `length` bytes with the one before it?"""
    same = np.ones(max(len(order) - 1, 0), bool)
    at = np.flatnonzero(same)
    for shift in range(0, length, 8):
        a, b = words[order[at] + shift], words[order[at + 1] + shift]
        rest = length - shift
        if rest < 8:
            a, b = a >> np.uint64(64 - 8 * rest), b >> np.uint64(64 - 8 * rest)
        ok = a == b
        same[at[~ok]] = False
        at = at[ok]
    return same
