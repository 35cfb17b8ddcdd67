"""A suffix automaton over sequences of whole numbers, with occurrence counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """All substrings of the sequences added, and how often each occurs."""

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, step: dict[int, int], link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of state q for the shorter strings that reach it from p by c."""
        step, link = self.step, self.link
        copy = self._state(dict(step[q]), link[q], self.length[p] + 1)
        while p >= 0 and step[p].get(c) == q:
            step[p][c] = copy
            p = link[p]
        link[q] = copy
        return copy

    def add(self, sequence: Iterable[int], times: int = 1) -> None:
        """Add a sequence that occurs ``times`` times."""
        step, link, length = self.step, self.link, self.length
        last = 0
        for c in sequence:
            q = step[last].get(c)
            if q is not None:  # known from an earlier sequence
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
            else:
                new, p = self._state({}, 0, length[last] + 1), last
                while p >= 0 and c not in step[p]:
                    step[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = step[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = new
            self.count[last] += times

    def total(self) -> None:
        """Sum the counts; call once, after the last ``add``."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] >= 0:
                self.count[self.link[s]] += self.count[s]

    def repeated_windows(self, sequence: Sequence[int], size: int, least: int = 2) -> list[bool]:
        """For each window of ``size`` items of ``sequence``, whether it occurs
        at least ``least`` times: its matching statistics, cut at ``size``."""
        step, link, length, count = self.step, self.link, self.length, self.count
        state, matched, out = 0, 0, []
        for i, c in enumerate(sequence):
            while state and c not in step[state]:
                state = link[state]
                matched = length[state]
            if c in step[state]:
                state, matched = step[state][c], matched + 1
            while state and length[link[state]] >= size:
                state = link[state]
            matched = min(matched, length[state])
            if i >= size - 1:
                out.append(matched >= size and count[state] >= least)
        return out
