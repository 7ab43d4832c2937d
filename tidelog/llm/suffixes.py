"""Suffix arrays by induced sorting, in numpy.

Suffixes are S-type or L-type, as they are smaller or larger than the next
one. The substrings between leftmost S-type positions are sorted by induction
and named; the string of names is sorted recursively; the order of these
positions then induces all suffixes. Induction goes through the 256 buckets
of first bytes, each handled as whole arrays. Names of more than one byte are
written with several, so every level works on bytes.
"""

from __future__ import annotations

import numpy as np

#: Below this length suffixes are sorted by comparison.
SHORT = 48


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a uint8 array in order; a suffix that is a
    prefix of another one comes first."""
    n = len(text)
    if n <= SHORT:
        data = text.tobytes()
        return np.array(sorted(range(n), key=lambda i: data[i:]), np.int64)
    small = _s_types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        placed = _induce(text, small, lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ranked = placed[is_lms[placed]]
        names, distinct = _names(text, lms, ranked)
        if distinct < len(lms):
            ranked = lms[_sort_names(names, distinct, n)]
        lms = ranked
    return _induce(text, small, lms)


def _s_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one is not."""
    n = len(text)
    step = np.ones(n, np.int8) * -1
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    decided = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(decided[::-1])[::-1]] > 0


class _Buckets:
    """Positions put into buckets of first bytes, in the order they come."""

    def __init__(self, text: np.ndarray):
        self.text = text
        self.parts: list[list[np.ndarray]] = [[] for _ in range(256)]

    def add(self, positions: np.ndarray) -> None:
        if not len(positions):
            return
        first = self.text[positions]
        order = np.argsort(first, kind="stable")
        first = first[order]
        cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
        for part in np.split(positions[order], cuts):
            self.parts[self.text[part[0]]].append(part)

    def take(self, bucket: int) -> np.ndarray:
        parts, self.parts[bucket] = self.parts[bucket], []
        return np.concatenate(parts) if parts else _NONE


_NONE = np.zeros(0, np.int64)


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the leftmost S-type ones in order (or, for
    sorting the substrings between them, in any)."""
    used = np.flatnonzero(np.bincount(text, minlength=256)).tolist()
    larges, starts = _Buckets(text), _Buckets(text)
    starts.add(lms)
    larges.add(np.array([len(text) - 1]))
    ordered: dict[int, np.ndarray] = {}
    for bucket in used:
        rounds, out = [], []
        now = larges.take(bucket)
        while len(now):
            rounds.append(now)
            before = now[now > 0] - 1
            before = before[~small[before]]
            same = text[before] == bucket
            now = before[same]
            out.append(before[~same])
        ordered[bucket] = np.concatenate(rounds) if rounds else _NONE
        before = starts.take(bucket) - 1
        out.append(before)  # L-type by definition
        larges.add(np.concatenate(out))
    smalls = _Buckets(text)
    result: list[np.ndarray] = []
    for bucket in reversed(used):
        rounds, out = [], []
        now = smalls.take(bucket)
        while len(now):
            rounds.append(now)
            before = now[now > 0] - 1
            before = before[small[before]]
            same = text[before] == bucket
            now = before[same]
            out.append(before[~same])
        large = ordered[bucket][::-1]
        before = large[large > 0] - 1
        out.append(before[small[before]])
        smalls.add(np.concatenate(out))
        result += [*rounds, large]
    return np.concatenate(result)[::-1]


def _names(text: np.ndarray, lms: np.ndarray, ranked: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the substrings from each of ``lms`` to the next, in text order,
    equal ones alike; and how many there are."""
    n = len(text)
    length = np.zeros(n, np.int64)
    length[lms] = np.diff(lms, append=n) + 1
    length[lms[-1]] = 0  # runs into the end: like no other
    a, b = ranked[:-1], ranked[1:]
    new = (length[a] != length[b]) | (length[a] == 0)
    pairs = np.flatnonzero(~new)
    at = 0
    while len(pairs):
        differ = text[a[pairs] + at] != text[b[pairs] + at]
        new[pairs[differ]] = True
        pairs = pairs[~differ]
        at += 1
        pairs = pairs[length[a[pairs]] > at]
    rank = np.zeros(n, np.int64)
    rank[ranked] = np.concatenate([[0], np.cumsum(new)])
    return rank[lms], int(new.sum()) + 1


def _sort_names(names: np.ndarray, distinct: int, n: int) -> np.ndarray:
    """Suffix array of a string of names."""
    width = 1 if distinct <= 256 else 2 if distinct <= 65536 else 4
    if width * len(names) > 0.8 * n:  # would not get shorter
        return _doubled(names)
    written = names.astype(f">u{width}").view(np.uint8)
    found = suffix_array(written)
    return found[found % width == 0] // width


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix array by doubling the length that is ranked."""
    rank, step, n = names + 1, 1, len(names)
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] if step < n else 0
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        ranked = np.concatenate([[1], 1 + np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = ranked
        if ranked[-1] == n or step >= n:
            return order
        step *= 2


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position the length that its suffix shares with the one before
    it in ``order``.

    It falls by one from a position to the next unless the byte before them
    differs too; only at such positions bytes are compared, eight at a time.
    """
    n = len(text)
    if n < 2:
        return np.zeros(n, np.int64)
    before = np.empty(n, np.int64)
    before[order[1:]], before[order[0]] = order[:-1], -1
    carried = np.zeros(n, bool)
    carried[1:] = (before[1:] > 0) & (text[:-1] == text[np.maximum(before[1:], 1) - 1])
    starts = np.flatnonzero(~carried)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    words = np.ascontiguousarray(eight).view("<u8")[:, 0]
    shared = np.zeros(n, np.int64)
    i = starts[before[starts] >= 0]
    j = before[i]
    at = np.zeros(len(i), np.int64)
    while len(i):
        inside = np.maximum(i, j) + at < n
        x, y = words[np.where(inside, i + at, 0)], words[np.where(inside, j + at, 0)]
        equal = inside & (x == y)
        stop = ~equal
        diff = (x ^ y)[stop]
        low = diff & (~diff + np.uint64(1))
        bits = np.zeros(len(diff), np.int64)
        bits[diff != 0] = np.log2(low[diff != 0].astype(float)).astype(np.int64)
        extra = np.where(inside[stop] & (diff != 0), bits // 8, 0)
        ends = np.minimum(at[stop] + extra, n - np.maximum(i[stop], j[stop]))
        shared[i[stop]] = np.maximum(ends, 0)
        i, j, at = i[equal], j[equal], at[equal] + 8
        over = np.maximum(i, j) + at >= n
        shared[i[over]] = n - np.maximum(i[over], j[over])
        i, j, at = i[~over], j[~over], at[~over]
    origin = np.maximum.accumulate(np.where(carried, 0, np.arange(n)))
    return np.maximum(shared[origin] - (np.arange(n) - origin), 0)
