"""A minimal acyclic transducer: words to id sequences, in flat arrays that can be memory-mapped.

Words are added in byte order; a state is frozen, and merged with an equal one, as soon as no later word can extend
it, so suffixes are shared and the automaton is minimal for its language. Outputs ride on a perfect hash: every
transition carries the number of words that end before it is taken, so a word's rank among the sorted words is the
sum along its path, and the rank points into one flat array of ids. Two words may therefore share suffix states
although their ids differ.

File layout, little-endian: a header of six uint32 (magic, words, states, transitions, ids, 0), then first[states + 1],
final[states] as uint32, labels[transitions] as uint32, targets, skips, offsets[words + 1], ids.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable

import numpy as np

MAGIC = 0x42414954


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The automaton of (word, ids) pairs as bytes. Words must be distinct; the empty word is allowed."""
    ordered = sorted(entries)
    register: dict[tuple, int] = {}
    arcs_of: list[tuple] = []
    final_of: list[bool] = []
    size_of: list[int] = []  # words accepted from a state

    def freeze(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, *arcs)
        if key not in register:
            register[key] = len(arcs_of)
            arcs_of.append(tuple(arcs))
            final_of.append(final)
            size_of.append(final + sum(size_of[t] for _, t in arcs))
        return register[key]

    path: list[list] = [[False, []]]  # the states of the last word that may still grow: [final, arcs]
    last = b""
    for n, (word, _) in enumerate(ordered):
        if n and word == last:
            raise ValueError(f"the word {word!r} is given twice")
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        for depth in range(len(last), shared, -1):
            state = path.pop()
            path[-1][1].append((last[depth - 1], freeze(*state)))
        path.extend([False, []] for _ in range(len(word) - shared))
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        state = path.pop()
        path[-1][1].append((last[depth - 1], freeze(*state)))
    root = freeze(*path[0])

    first = np.zeros(len(arcs_of) + 1, "<u4")
    labels, targets, skips = [], [], []
    for state, arcs in enumerate(arcs_of):
        before = int(final_of[state])
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            skips.append(before)
            before += size_of[target]
        first[state + 1] = len(labels)
    offsets = np.zeros(len(ordered) + 1, "<u4")
    offsets[1:] = np.cumsum([len(ids) for _, ids in ordered]) if ordered else []
    ids = np.fromiter((i for _, word_ids in ordered for i in word_ids), "<u4")
    header = np.array([MAGIC, len(ordered), len(arcs_of), len(labels), len(ids), root], "<u4")
    parts = [header, first, np.array(final_of, "<u4"), np.array(labels, "<u4"), np.array(targets, "<u4"), np.array(skips, "<u4"), offsets, ids]
    return b"".join(p.tobytes() for p in parts)


class Lexicon:
    """Looks words up in a compiled automaton; the arrays are views of the mapped file."""

    def __init__(self, data: bytes | mmap.mmap):
        view = memoryview(data).cast("I")
        magic, self.n_words, states, arcs, ids, self.root = view[:6]
        if magic != MAGIC:
            raise ValueError("not a lexicon")
        at = 6
        parts = []
        for n in (states + 1, states, arcs, arcs, arcs, self.n_words + 1, ids):
            parts.append(view[at : at + n])
            at += n
        self.first, self.final, self.labels, self.targets, self.skips, self.offsets, self.ids = parts

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def find(self, word: bytes) -> memoryview | None:
        """The word's ids as a view of uint32, or None."""
        state, rank = self.root, 0
        first, labels, targets, skips = self.first, self.labels, self.targets, self.skips
        for label in word:
            low, high = first[state], first[state + 1]
            while low < high:  # arcs are in label order
                middle = (low + high) // 2
                if labels[middle] < label:
                    low = middle + 1
                else:
                    high = middle
            if low >= first[state + 1] or labels[low] != label:
                return None
            rank += skips[low]
            state = targets[low]
        return self.ids[self.offsets[rank] : self.offsets[rank + 1]] if self.final[state] else None
