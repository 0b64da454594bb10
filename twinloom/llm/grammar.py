"""Weighted finite-state transducers over the words of a clause.

A transducer reads symbols, moves between states and adds weights; where it has no arc for a symbol it stays and
writes the symbol as it is. ``compose`` runs one on the output of another as a single machine.
"""

from __future__ import annotations

from dataclasses import dataclass, field

Arc = tuple[str, str, float]  # next state, symbol written, weight


@dataclass(frozen=True)
class Transducer:
    """``arcs`` by (state, symbol read); ``ends`` adds a weight for the state a clause ends in."""

    start: str
    arcs: dict[tuple[str, str], Arc]
    ends: dict[str, float] = field(default_factory=dict)

    def step(self, state: str, symbol: str) -> Arc:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))

    def run(self, symbols: list[str]) -> tuple[float, list[str]]:
        state, weight, written = self.start, 0.0, []
        for symbol in symbols:
            state, out, added = self.step(state, symbol)
            weight += added
            written.append(out)
        return weight + self.ends.get(state, 0.0), written


def compose(one: Transducer, two: Transducer, alphabet: list[str]) -> Transducer:
    """``two`` after ``one``: states are pairs, weights add up. Only pairs that can be reached are built."""
    start = (one.start, two.start)
    arcs: dict[tuple[str, str], Arc] = {}
    ends: dict[str, float] = {}
    todo, seen = [start], {start}

    def name(pair: tuple[str, str]) -> str:
        return "/".join(pair)

    while todo:
        pair = todo.pop()
        ends[name(pair)] = one.ends.get(pair[0], 0.0) + two.ends.get(pair[1], 0.0)
        for symbol in alphabet:
            first, middle, w1 = one.step(pair[0], symbol)
            second, out, w2 = two.step(pair[1], middle)
            following = (first, second)
            arcs[name(pair), symbol] = (name(following), out, w1 + w2)
            if following not in seen:
                seen.add(following)
                todo.append(following)
    return Transducer(name(start), arcs, ends)
