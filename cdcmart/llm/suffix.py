"""Suffix arrays by induced sorting, vectorised with NumPy.

The steps are those of SA-IS: classify suffixes, sort the leftmost-smaller (LMS) substrings
by inducing from their last characters, name them, recurse on the string of names unless
all differ, and induce the whole array from the sorted LMS suffixes. Inducing scans the array
in order; here it advances by runs of entries that are final already, so a pass takes some
square root of n NumPy steps on ordinary data. Common prefixes are computed in text
order (permuted): an entry whose predecessor character equals that of its neighbour follows
from the entry before it, the others are compared directly.
"""

from __future__ import annotations

import numpy as np

#: Entries in the shortest and the longest run that inducing tries to take in one step.
_SHORT, _LONG = 32, 1 << 15


def _types(s: np.ndarray) -> np.ndarray:
    """True for S-type suffixes (smaller than their right neighbour); the last is S by rule."""
    n = len(s)
    smaller = np.empty(n, bool)
    smaller[-1] = True
    step = np.sign(np.diff(s.astype(np.int64)))
    if n > 1:
        # Equal neighbours take the type of the next position that differs.
        differs = np.flatnonzero(step)
        at = np.searchsorted(differs, np.arange(n - 1))
        found = np.where(at < len(differs), step[differs[np.minimum(at, len(differs) - 1)]] if len(differs) else 0, -1)
        smaller[:-1] = found > 0
    return smaller


def _ranks(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of each item among equal ones before it, and (distinct chars, counts)."""
    # NumPy sorts 16-bit numbers by radix.
    narrow = chars.astype(np.uint16) if len(chars) and chars.max() < 1 << 16 else chars
    order = np.argsort(narrow, kind="stable")
    ranked = chars[order]
    first = np.concatenate([[0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1])[: len(ranked)]
    counts = np.append(first[1:], len(ranked)) - first
    rank = np.empty(len(chars), np.int64)
    rank[order] = np.arange(len(chars)) - np.repeat(first, counts)
    return rank, ranked[first], counts


def _induce(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The suffix array induced from LMS suffixes in the given order; s ends with a unique least 0."""
    n = len(s)
    sa = np.full(n, -1, np.int64)
    # Seeds go to the ends of their buckets, in order.
    chars = s[seeds]
    rank, kinds, counts = _ranks(chars)
    total = np.zeros(len(bounds), np.int64)
    total[kinds] = counts
    sa[bounds[chars + 1] - total[chars] + rank if len(bounds) > 1 else rank] = seeds
    seeded = sa >= 0

    head = bounds[:-1].copy()
    i, run = 0, _SHORT
    while i < n:
        # The longest run that no entry of its own falls into.
        j = min(n, i + run)
        run = min(2 * run, _LONG)
        block = sa[i:j]
        ready = block > 0
        from_ = block[ready] - 1
        large = ~smaller[from_]
        from_ = from_[large]
        if len(from_):
            places = i + np.flatnonzero(ready)[large]
            rank, kinds, counts = _ranks(s[from_])
            slots = head[s[from_]] + rank
            inside = slots < j
            if inside.any():
                # Entries up to the first slot inside the run are final; the rest waits.
                stop = max(i + 1, int(slots[inside].min()))
                cut = places < stop
                from_, slots = from_[cut], slots[cut]
                j, run = stop, max(_SHORT, 2 * (stop - i))
            if len(from_):
                # Slots rise within a bucket, so the last one written is the highest.
                head[s[from_]] = slots + 1
                sa[slots] = from_
        i = j
    # Only L-type entries remain, the seeds are induced anew (but for the sentinel).
    sa[seeded & (np.arange(n) > 0)] = -1
    tail = bounds[1:].copy()
    i, run = n, _SHORT
    while i > 0:
        j = max(0, i - run)
        run = min(2 * run, _LONG)
        block = sa[j:i][::-1]
        ready = block > 0
        from_ = block[ready] - 1
        small = smaller[from_]
        from_ = from_[small]
        if len(from_):
            places = i - 1 - np.flatnonzero(ready)[small]
            rank, kinds, counts = _ranks(s[from_])
            slots = tail[s[from_]] - 1 - rank
            inside = slots >= j
            if inside.any():
                stop = min(i - 1, int(slots[inside].max()) + 1)
                cut = places >= stop
                from_, slots = from_[cut], slots[cut]
                j, run = stop, max(_SHORT, 2 * (i - stop))
            if len(from_):
                tail[s[from_]] = slots
                sa[slots] = from_
        i = j
    return sa


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes of ``text`` (non-negative integers) in lexicographic order."""
    s = np.empty(len(text) + 1, np.int64)
    kinds, s[:-1] = np.unique(text, return_inverse=True)
    s[:-1] += 1
    s[-1] = 0
    return _sorted(s, len(kinds) + 1)[1:]


def _sorted(s: np.ndarray, kinds: int) -> np.ndarray:
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    bounds = np.r_[0, np.cumsum(np.bincount(s, minlength=kinds))]
    smaller = _types(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    first = _induce(s, smaller, lms, bounds)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ranked = first[is_lms[first]]
    names = _names(s, smaller, lms, ranked)
    if names.max() + 1 < len(lms):
        order = _sorted(names, int(names.max()) + 1)
        ranked = lms[order]
    return _induce(s, smaller, ranked, bounds)


def _names(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings in text order: equal substrings share a name."""
    ends = np.r_[lms[1:], lms[-1]]
    end_of = np.zeros(len(s), np.int64)
    end_of[lms] = ends
    a, b = ranked[:-1], ranked[1:]
    length = end_of[b] - b + 1
    equal = (end_of[a] - a + 1) == length
    open_ = np.flatnonzero(equal)
    step = 0
    while len(open_):
        left, right = s[a[open_] + step], s[b[open_] + step]
        same = (left == right) & (smaller[a[open_] + step] == smaller[b[open_] + step])
        equal[open_[~same]] = False
        open_ = open_[same]
        step += 1
        open_ = open_[length[open_] > step]
    found = np.zeros(len(s), np.int64)
    found[ranked] = np.r_[0, np.cumsum(~equal)]
    return found[lms]


def permuted_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each text position, the common prefix with the suffix before it in the array."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    # Reducible: the characters to the left agree, so the prefix is that of i - 1 less one.
    at = np.arange(n)
    reducible = (at > 0) & (before > 0)
    reducible[reducible] = text[at[reducible] - 1] == text[before[reducible] - 1]
    whole = np.zeros(n, np.int64)
    open_ = np.flatnonzero(~reducible & (before >= 0))
    padded = np.r_[text.astype(np.int64), np.full(64, -1)]
    step = 0
    while len(open_):
        wide = np.arange(8 if step < 64 else 64)
        i, j = open_ + whole[open_], before[open_] + whole[open_]
        left = np.minimum(i[:, None] + wide, n)
        right = np.minimum(j[:, None] + wide, n)
        same = (padded[left] == padded[right]) & (left < n) & (right < n)
        run = np.where(same.all(1), len(wide), same.argmin(1))
        whole[open_] += run
        open_ = open_[run == len(wide)]
        step += len(wide)
    start = np.maximum.accumulate(np.where(reducible, -1, at))
    return np.where(reducible, whole[start] - (at - start), whole)
