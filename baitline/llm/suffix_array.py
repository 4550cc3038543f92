"""Enhanced suffix array over short byte strings, and its maximal repeat groups.

Suffixes are sorted by their bytes up to the end of their string (at most MOST bytes); the common prefixes of
neighbours are the LCP array. A stack scan over it gives the tree of common-prefix intervals: all suffixes that share a
prefix of some length. An interval is a maximal repeat if its prefix can't be extended to the left, that is if the
bytes before its suffixes differ; where the byte before a suffix isn't among the given suffixes it counts as different.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

MOST = 168


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, big-endian, with zeros after the end."""
    w = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    w = (w[:-1] << np.uint64(8)) | w[1:]
    w = (w[:-2] << np.uint64(16)) | w[2:]
    w = (w[:-4] << np.uint64(32)) | w[4:]
    return w[: len(data) + 1]


def sorted_suffixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): the suffixes data[starts:ends] sorted, and each one's common prefix with the one before it (0 first)."""
    n = len(starts)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    length = ends - starts
    if length.max() > MOST:
        raise ValueError(f"a suffix is longer than {MOST} bytes")
    words = words_at(data)
    columns = []
    for at in range(0, int(length.max()), 8):
        w = words[np.minimum(starts + at, len(data))]
        beyond = np.clip(8 - (length - at), 0, 8).astype(np.uint64) * np.uint64(8)  # bits after the string's end
        w = np.where(beyond >= 64, np.uint64(0), (w >> np.minimum(beyond, np.uint64(63))) << np.minimum(beyond, np.uint64(63)))
        columns.append(w)
    order = np.lexsort((length, *reversed(columns)))
    lcp = np.zeros(n, np.int64)
    open_ = np.ones(max(n - 1, 0), bool)
    for w in columns:
        w = w[order]
        differ = w[1:] ^ w[:-1]
        same = open_ & (differ == 0)
        lcp[1:][same] += 8
        now = open_ & (differ != 0)
        if now.any():
            x = differ[now]
            lead = np.zeros(len(x), np.int64)
            for shift in (32, 16, 8):
                clear = x >> np.uint64(64 - shift) == 0
                lead += clear * (shift // 8)
                x = np.where(clear, x << np.uint64(shift), x)
            lcp[1:][now] += lead
        open_ = same
    lcp[1:] = np.minimum(lcp[1:], np.minimum(length[order][1:], length[order][:-1]))
    return order, lcp


def intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(length, from, to) of every common-prefix interval of at least ``least``, by a stack scan; to is exclusive."""
    stack: list[tuple[int, int]] = []  # (length, from)
    for i, now in enumerate([*lcp[1:].tolist(), 0], start=1):
        if now < least:
            now = 0
        begin = i - 1
        while stack and stack[-1][0] > now:
            length, begin = stack.pop()
            yield length, begin, i
        if now and (not stack or stack[-1][0] < now):
            stack.append((now, begin))


def _runs(order: np.ndarray, lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of stretches of the array whose suffixes share ``least`` bytes or more with a neighbour; to is exclusive."""
    ends = np.flatnonzero(np.diff(np.concatenate(([False], lcp >= least, [False])).astype(np.int8)))
    return ends[::2] - 1, ends[1::2]


def _in_runs(order: np.ndarray, lcp: np.ndarray, before: np.ndarray, low: np.ndarray, high: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """The maximal repeats of these stretches. An interval is diverse if the byte before is unknown for one of its
    suffixes or changes between two neighbours, which running counts tell."""
    left = before[order]
    unknown = np.concatenate(([0], np.cumsum(left < 0))).tolist()
    changes = np.concatenate(([0], np.cumsum(left[1:] != left[:-1]))).tolist()
    for start, stop in zip(low.tolist(), high.tolist()):
        for length, a, b in intervals(np.concatenate(([0], lcp[start + 1 : stop])), least):
            a, b = a + start, b + start
            if unknown[b] > unknown[a] or changes[b - 1] > changes[a]:
                yield length, order[a:b]


def maximal_repeats(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, suffix numbers) of each maximal repeat of at least ``least`` bytes, with all its occurrences.

    before: the byte before each suffix, or a negative number where the suffix that begins there isn't given.
    """
    order, lcp = sorted_suffixes(data, starts, ends)
    yield from _in_runs(order, lcp, before, *_runs(order, lcp, least), least)


def later_occurrences(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray, place: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix numbers, lengths): of each maximal repeat all occurrences but the one first in ``place``.

    Most repeats have two occurrences and are a stretch of their own; those are found all at once.
    """
    order, lcp = sorted_suffixes(data, starts, ends)
    low, high = _runs(order, lcp, least)
    two = high - low == 2
    a, b, length = order[low[two]], order[low[two] + 1], lcp[low[two] + 1]
    fine = (before[a] < 0) | (before[b] < 0) | (before[a] != before[b])
    found = [(np.where(place[a] < place[b], b, a)[fine], length[fine])]
    for n, members in _in_runs(order, lcp, before, low[~two], high[~two], least):
        rest = members[place[members] != place[members].min()]
        found.append((rest, np.full(len(rest), n)))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(2))
