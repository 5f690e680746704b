"""Suffix automata over sequences of whole numbers, with the earliest place of every substring."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """All substrings of a set of sequences; each state knows the earliest place one ends at.

    Places may be any ordered values; ``add`` takes those of a sequence's symbols."""

    def __init__(self):
        self.arcs: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.earliest: list = [None]

    def add(self, symbols: Sequence[int], places: Iterable) -> None:
        """Add one sequence; call ``settle`` after the last."""
        state = 0
        for symbol, place in zip(symbols, places):
            state = self._extended(state, symbol, place)

    def _state(self, length: int, arcs: dict[int, int], link: int, place) -> int:
        self.arcs.append(arcs)
        self.length.append(length)
        self.link.append(link)
        self.earliest.append(place)
        return len(self.length) - 1

    def _split(self, at: int, symbol: int, target: int) -> int:
        """The state of the target's strings no longer than one symbol after ``at``."""
        if self.length[target] == self.length[at] + 1:
            return target
        clone = self._state(self.length[at] + 1, dict(self.arcs[target]), self.link[target], None)
        self.link[target] = clone
        while at >= 0 and self.arcs[at].get(symbol) == target:
            self.arcs[at][symbol] = clone
            at = self.link[at]
        return clone

    def _extended(self, last: int, symbol: int, place) -> int:
        known = self.arcs[last].get(symbol)
        if known is not None:
            state = self._split(last, symbol, known)
            if self.earliest[state] is None or place < self.earliest[state]:
                self.earliest[state] = place
            return state
        state = self._state(self.length[last] + 1, {}, 0, place)
        at = last
        while at >= 0 and symbol not in self.arcs[at]:
            self.arcs[at][symbol] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split(at, symbol, self.arcs[at][symbol])
        return state

    def settle(self) -> None:
        """Pass the earliest places on to the suffixes, longest strings first."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            link, place = self.link[state], self.earliest[state]
            if link > 0 and (self.earliest[link] is None or place < self.earliest[link]):
                self.earliest[link] = place

    def statistics(self, symbols: Sequence[int], least: int) -> Iterable:
        """Stream a sequence: for each symbol, the earliest end of the ``least`` symbols up to it, or None."""
        state, matched = 0, 0
        for symbol in symbols:
            while state and symbol not in self.arcs[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.arcs[state]:
                state = self.arcs[state][symbol]
                matched += 1
            if matched < least:
                yield None
                continue
            while self.length[self.link[state]] >= least:
                state = self.link[state]
                matched = self.length[state]
            yield self.earliest[state]
