"""A lexicon of words as a minimal acyclic transducer in a file that is memory-mapped.

Words are added in order; a state whose arcs and ends equal those of an earlier one is that
one, so suffixes are shared as prefixes are. An arc carries the number of words that come
before those it leads to, so that the numbers along a word add up to its place, where its
ids are found. Many words are looked up at once: a step takes the next byte of all of them.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable

import numpy as np

SECTIONS = (("arcs", np.int64), ("targets", np.int64), ("skips", np.int64), ("final", np.int64), ("offsets", np.int64), ("ids", np.uint8))


class _Builder:
    """States by their arcs, ends and shared suffixes."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.states: list[tuple[bool, list[tuple[int, int]]]] = []
        self.words: list[int] = []  # that lead on from each state
        self.path: list[tuple[bool, list[tuple[int, int]]]] = [(False, [])]
        self.last = b""

    def _freeze(self, length: int) -> None:
        """States behind the first ``length`` bytes of the last word are complete."""
        while len(self.path) > length + 1:
            final, arcs = self.path.pop()
            key = final, tuple(arcs)
            state = self.known.get(key)
            if state is None:
                state = self.known[key] = len(self.states)
                self.states.append((final, arcs))
                self.words.append(final + sum(self.words[t] for _, t in arcs))
            self.path[-1][1].append((self.last[len(self.path) - 1], state))

    def add(self, word: bytes) -> None:
        """The next word, which must come behind all earlier ones."""
        if word <= self.last:
            raise ValueError("words must ascend and not be empty")
        common = 0
        while common < len(self.last) and self.last[common] == word[common]:
            common += 1
        self._freeze(common)
        self.path += [(False, []) for _ in word[common:]]
        self.path[-1] = True, self.path[-1][1]
        self.last = word

    def root(self) -> int:
        self._freeze(0)
        self.states.append(self.path[0])
        self.words.append(0)
        return len(self.states) - 1


def compile_lexicon(words: Iterable[tuple[bytes, bytes]]) -> bytes:
    """The file of distinct, non-empty words in ascending order with the bytes of their ids."""
    build, offsets, ids = _Builder(), [0], []
    for word, own in words:
        build.add(word)
        ids.append(own)
        offsets.append(offsets[-1] + len(own))
    root = build.root()
    number = {root: 0}  # the root is state 0, so that a look-up begins with zeros
    for state in range(root):
        number[state] = state + 1
    arcs = []
    for state, (final, own) in enumerate(build.states):
        skip = int(final)
        for byte, target in own:
            arcs.append((number[state] << 8 | byte, number[target], skip))
            skip += build.words[target]
    arcs.sort()
    final = np.zeros(len(build.states), np.int64)
    for state, (ends, _) in enumerate(build.states):
        final[number[state]] = ends
    table = np.array(arcs, np.int64).reshape(-1, 3)
    parts = [table[:, 0], table[:, 1], table[:, 2], final, np.array(offsets, np.int64), np.frombuffer(b"".join(ids), np.uint8)]
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, read from a file where it lies."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        sizes, at = np.frombuffer(data, np.int64, len(SECTIONS)), 8 * len(SECTIONS)
        for (name, kind), size in zip(SECTIONS, sizes.tolist(), strict=True):
            setattr(self, name, np.frombuffer(data, kind, size, at))
            at += size * np.dtype(kind).itemsize

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word, -1 if it is not in the lexicon."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        found = np.full(len(words), -1, np.int64)
        if not len(self.arcs):
            return found
        left = np.flatnonzero(sizes > 0)
        state, place, at = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64), 0
        while len(left):
            keys = state << 8 | flat[starts[left] + at]
            arc = np.minimum(np.searchsorted(self.arcs, keys), len(self.arcs) - 1)
            go = self.arcs[arc] == keys
            left, arc, place = left[go], arc[go], place[go]
            state, place, at = self.targets[arc], place + self.skips[arc], at + 1
            ended = sizes[left] == at
            whole = ended & (self.final[state] > 0)
            found[left[whole]] = place[whole]
            left, state, place = left[~ended], state[~ended], place[~ended]
        return found

    def ids_of(self, place: int) -> bytes:
        """The ids of the word at a place, as they were given."""
        return self.ids[self.offsets[place] : self.offsets[place + 1]].tobytes()
