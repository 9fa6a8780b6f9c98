"""Finite-state transducers over small alphabets, as tables of arcs, and their composition."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer that writes one symbol for each that it reads.

    ``arcs`` maps (state, symbol) to (next state, written symbol); a pair without an arc keeps the state and writes the
    symbol as it is. ``marks`` has what a state says of the whole string if the string ends there.
    """

    start: object
    arcs: dict[tuple[object, str], tuple[object, str]]
    marks: dict[object, frozenset[str]]

    def step(self, state, symbol: str) -> tuple[object, str]:
        return self.arcs.get((state, symbol), (state, symbol))

    def run(self, symbols: Iterable[str]) -> tuple[list[str], frozenset[str]]:
        """The symbols written, and the marks of the last state."""
        state, written = self.start, []
        for symbol in symbols:
            state, out = self.step(state, symbol)
            written.append(out)
        return written, self.marks.get(state, frozenset())


def compose(first: Transducer, second: Transducer, alphabet: Iterable[str]) -> Transducer:
    """The transducer that writes what ``second`` writes for what ``first`` writes, for every reachable state."""
    alphabet, start = list(alphabet), (first.start, second.start)
    arcs, marks, waiting = {}, {}, [start]
    while waiting:
        state = waiting.pop()
        if state in marks:
            continue
        marks[state] = first.marks.get(state[0], frozenset()) | second.marks.get(state[1], frozenset())
        for symbol in alphabet:
            left, between = first.step(state[0], symbol)
            right, out = second.step(state[1], between)
            arcs[state, symbol] = ((left, right), out)
            waiting.append((left, right))
    return Transducer(start, arcs, marks)
