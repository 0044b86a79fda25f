"""Generalised suffix automaton over sequences of word numbers, and matching against it."""

from __future__ import annotations

from collections.abc import Iterable


class SuffixAutomaton:
    """States are classes of factors that end at the same places of the sequences.

    ``steps[state * words + word]`` is the following state. ``longest[s]`` is
    the length of the longest factor of a state, ``link[s]`` the state of its
    longest suffix that ends at more places. State 0 is the empty factor.
    """

    def __init__(self, words: int):
        self.words = words
        self.steps: dict[int, int] = {}
        self.link, self.longest = [-1], [0]
        self._out: list[list[int]] = [[]]  # words that lead on from a state

    def add(self, sequence: Iterable[int]) -> None:
        last = 0
        for word in sequence:
            last = self._extended(last, word)

    def _state(self, length: int) -> int:
        self.longest.append(length)
        self.link.append(0)
        self._out.append([])
        return len(self.longest) - 1

    def _lead(self, state: int, word: int, to: int) -> None:
        at = state * self.words + word
        if at not in self.steps:
            self._out[state].append(word)
        self.steps[at] = to

    def _split(self, p: int, word: int, q: int) -> int:
        """The state of ``p``'s longest factor and ``word``; made of ``q`` where ``q`` also holds longer ones."""
        if self.longest[q] == self.longest[p] + 1:
            return q
        copy = self._state(self.longest[p] + 1)
        for w in self._out[q]:
            self._lead(copy, w, self.steps[q * self.words + w])
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.steps.get(p * self.words + word) == q:
            self.steps[p * self.words + word] = copy
            p = self.link[p]
        return copy

    def _extended(self, last: int, word: int) -> int:
        q = self.steps.get(last * self.words + word)
        if q is not None:  # another sequence has this prefix
            return self._split(last, word, q)
        new = self._state(self.longest[last] + 1)
        p = last
        while p >= 0 and p * self.words + word not in self.steps:
            self._lead(p, word, new)
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.steps[p * self.words + word])
        return new

    def finish(self) -> None:
        """Drop what only the building needs."""
        del self._out

    def follow(self, sequence: Iterable[int], state: int = 0, length: int = 0) -> Iterable[tuple[int, int]]:
        """After each word, the state and the length of the longest suffix of what was read that is a factor."""
        steps, link, longest, words = self.steps, self.link, self.longest, self.words
        for word in sequence:
            to = steps.get(state * words + word)
            while to is None and state:
                state = link[state]
                length = longest[state]
                to = steps.get(state * words + word)
            if to is None:
                length = 0
            else:
                state = to
                length += 1
            yield state, length

    def suffix_state(self, state: int, length: int) -> int:
        """The state that holds the suffix of ``length`` words of ``state``'s factors."""
        while self.longest[self.link[state]] >= length:
            state = self.link[state]
        return state
