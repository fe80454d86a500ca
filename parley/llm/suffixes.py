"""Suffix automaton over word numbers, of one sequence or of several."""

from __future__ import annotations

from array import array
from collections.abc import Sequence

import numpy as np


class SuffixAutomaton:
    """States in flat arrays: ``length``, ``link``, and one arc (``word``, ``to``) each.

    Most states have a single arc; further arcs of branching states are in
    ``more``, a dictionary of word to state for each such state.  State 0 is
    the root.  ``add`` appends a whole sequence, beginning at the root, and
    returns the state of each of its prefixes; after it, the state of the
    sequence's own string has exactly its length.
    """

    def __init__(self):
        self.length, self.link = array("i", [0]), array("i", [-1])
        self.word, self.to = array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}

    def _state(self, length: int, link: int, word: int = -1, to: int = 0) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(word)
        self.to.append(to)
        return len(self.length) - 1

    def step(self, state: int, word: int) -> int:
        """The state an arc leads to, 0 where there is none."""
        if self.word[state] == word:
            return self.to[state]
        arcs = self.more.get(state)
        return arcs.get(word, 0) if arcs else 0

    def _split(self, p: int, q: int, word: int) -> int:
        """A copy of ``q`` for the strings that reach it through ``p``."""
        copy = self._state(self.length[p] + 1, self.link[q], self.word[q], self.to[q])
        if q in self.more:
            self.more[copy] = dict(self.more[q])
        self.link[q] = copy
        while p >= 0 and self.step(p, word) == q:
            if self.word[p] == word:
                self.to[p] = copy
            else:
                self.more[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: Sequence[int]) -> list[int]:
        length, link, first, to, more = self.length, self.link, self.word, self.to, self.more
        last, prefixes = 0, []
        for c in words:
            q = self.step(last, c)
            if q:                                    # known from an earlier sequence
                last = q if length[q] == length[last] + 1 else self._split(last, q, c)
                prefixes.append(last)
                continue
            now, p = self._state(length[last] + 1, 0), last
            while p >= 0:
                if first[p] < 0:
                    first[p], to[p] = c, now
                elif first[p] == c:
                    q = to[p]
                    break
                else:
                    arcs = more.get(p)
                    if arcs is None:
                        more[p] = {c: now}
                    elif c in arcs:
                        q = arcs[c]
                        break
                    else:
                        arcs[c] = now
                p = link[p]
            if p >= 0:
                link[now] = q if length[q] == length[p] + 1 else self._split(p, q, c)
            last = now
            prefixes.append(now)
        return prefixes

    def by_length(self) -> list[int]:
        """All states but the root, shortest first: a state follows its link."""
        return (np.argsort(np.frombuffer(self.length, np.int32)[1:], kind="stable") + 1).tolist()
