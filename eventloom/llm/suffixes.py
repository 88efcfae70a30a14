"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays.

A suffix is of type S when it is smaller than the one after it, else L.  The
leftmost S suffixes of each run (LMS) are sorted first, through their
substrings and the string of their names; all other suffixes follow from them
in two linear sweeps.  A sweep handles one first symbol at a time: the entries
of a bucket are final when the sweep reaches it, so their predecessors can be
dealt to the later buckets together.
"""

from __future__ import annotations

import numpy as np

# A string of more distinct symbols is sorted by rank doubling: a sweep would
# have about as many buckets as entries.
_SMALL_ALPHABET = 1024


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S; an end smaller than all symbols is assumed."""
    n = len(text)
    rises = np.zeros(n, dtype=np.int8)
    rises[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1])
    rises[-1:] = -1
    settled = np.where(rises != 0, np.arange(n), n)
    following = np.minimum.accumulate(settled[::-1])[::-1]
    return rises[following] > 0


def _deal(targets: np.ndarray, entries: np.ndarray, inbox: list[list[np.ndarray]]) -> None:
    """Append entries to the boxes of their targets, keeping their order."""
    if not entries.size:
        return
    order = np.argsort(targets, kind="stable")
    entries, targets = entries[order], targets[order]
    cuts = np.flatnonzero(targets[1:] != targets[:-1]) + 1
    for part, box in zip(np.split(entries, cuts), targets[np.concatenate(([0], cuts))].tolist()):
        inbox[box].append(part)


def _closed(seed: list[np.ndarray], text: np.ndarray, kind: np.ndarray, symbol: int) -> np.ndarray:
    """Entries of a bucket with those they induce in the same bucket, in sweep order."""
    parts = list(seed)
    now = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    while now.size:
        before = now[now > 0] - 1
        now = before[(text[before] == symbol) & kind[before]]
        if now.size:
            parts.append(now)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """All suffixes in order, given the LMS suffixes in order."""
    lows: list[np.ndarray] = []
    inbox: list[list[np.ndarray]] = [[] for _ in range(size)]
    of_symbol: list[list[np.ndarray]] = [[] for _ in range(size)]
    _deal(text[lms], lms, of_symbol)
    is_l = ~is_s
    # The end marker, smallest of all, induces the last suffix.
    inbox[int(text[-1])].append(np.array([len(text) - 1]))
    for symbol in range(size):
        low = _closed(inbox[symbol], text, is_l, symbol)
        lows.append(low)
        swept = np.concatenate([low, *of_symbol[symbol]])
        before = swept[swept > 0] - 1
        before = before[text[before] > symbol]
        _deal(text[before], before, inbox)
    highs: list[np.ndarray] = [None] * size
    inbox = [[] for _ in range(size)]
    for symbol in range(size - 1, -1, -1):
        high = _closed(inbox[symbol], text, is_s, symbol)
        highs[symbol] = high[::-1]
        swept = np.concatenate([high, lows[symbol][::-1]])
        before = swept[swept > 0] - 1
        before = before[text[before] < symbol]
        _deal(text[before], before, inbox)
    return np.concatenate([part for pair in zip(lows, highs) for part in pair])


def _same_substring(text: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    same = np.ones(len(a), dtype=bool)
    at, step = np.arange(len(a)), 0
    while at.size:
        equal = text[a[at] + step] == text[b[at] + step]
        same[at[~equal]] = False
        step += 1
        at = at[equal]
        at = at[sizes[at] > step]
    return same


def _by_doubling(text: np.ndarray) -> np.ndarray:
    """Suffix array of a string over a large alphabet, by doubling sorted prefixes."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        steps = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = steps
        if steps[-1] == n - 1 or width >= n:
            return order
        width *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a string of small non-negative integers, in order."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    size = int(text.max()) + 1
    if size > _SMALL_ALPHABET:
        return _by_doubling(text)
    is_s = suffix_types(text)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(lms) < 2:
        return _induce(text, is_s, lms, size)
    # Sort the LMS substrings by inducing from LMS suffixes in any order.
    rough = _induce(text, is_s, lms, size)
    place = np.full(n, -1, dtype=np.int64)
    place[lms] = np.arange(len(lms))
    ordered = rough[place[rough] >= 0]
    sizes = np.append(np.diff(lms) + 1, n - lms[-1])[place[ordered]]
    last = ordered == lms[-1]
    alike = (sizes[1:] == sizes[:-1]) & ~last[1:] & ~last[:-1]
    pairs = np.flatnonzero(alike)
    alike[pairs] = _same_substring(text, ordered[pairs], ordered[pairs + 1], sizes[pairs])
    names = np.concatenate(([0], np.cumsum(~alike)))
    reduced = np.empty(len(lms), dtype=np.int64)
    reduced[place[ordered]] = names
    order = ordered if names[-1] == len(lms) - 1 else lms[suffix_array(reduced)]
    return _induce(text, is_s, order, size)


def permuted_common_prefixes(text: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """At each text position the symbols shared with the suffix before it in order, up to ``most``."""
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[array[1:]] = array[:-1]
    shared = np.zeros(n, dtype=np.int64)
    # As many symbols as fit are compared at once; a symbol past the end equals none.
    bits = int(text.max(initial=0) + 1).bit_length()
    per = min(most, max(1, 63 // bits)) if most else 1
    padded = np.zeros(n + most + 2 * per, dtype=np.int64)
    padded[:n] = text.astype(np.int64) + 1
    packed = padded[:n + most + per].copy()
    for k in range(1, per):
        packed |= padded[k:k + len(packed)] << (bits * k)
    at = np.flatnonzero(before >= 0)
    for step in range(0, most, per):
        apart = packed[at + step] ^ packed[before[at] + step]
        ends = apart != 0
        lowest = apart[ends] & -apart[ends]
        shared[at[ends]] = step + np.log2(lowest).astype(np.int64) // bits
        at = at[~ends]
        if not at.size:
            break
    shared[at] = most
    return np.minimum(shared, most)
