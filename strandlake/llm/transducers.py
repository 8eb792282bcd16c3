"""Weighted finite-state transducers over small alphabets: arcs, composition, and best paths.

A transducer reads one symbol an arc and writes one. Weights add along a path and the heaviest path counts (the
tropical semiring with signs turned), so a transducer may guess what comes later and is held to its guess by its
final states. Paths of equal weight are told apart by their outputs, the first in order wins.

Defined cases: an empty input has the empty output if the start is final; an input that no path accepts has none.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Sequence
from dataclasses import dataclass, field


@dataclass
class Transducer:
    """``arcs[state][symbol]`` lists ``(output, weight, next state)``; states are numbers, 0 is the start."""

    arcs: list[dict[str, list[tuple[str, float, int]]]] = field(default_factory=lambda: [{}])
    final: set[int] = field(default_factory=set)

    def paths(self, symbols: Sequence[str]) -> list[tuple[float, tuple[str, ...]]]:
        """Weight and output of every accepting path, by plain enumeration (for tests)."""
        live: list[tuple[int, float, tuple[str, ...]]] = [(0, 0.0, ())]
        for x in symbols:
            live = [(q, w + dw, (*out, o)) for p, w, out in live for o, dw, q in self.arcs[p].get(x, ())]
        return [(w, out) for p, w, out in live if p in self.final]

    def best(self, symbols: Sequence[str]) -> tuple[float, tuple[str, ...]] | None:
        """Weight and output of the heaviest accepting path, state by state."""
        live: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}  # outputs as linked cells, shared by the paths that begin alike
        for x in symbols:
            nxt: dict[int, tuple[float, tuple | None]] = {}
            for p, (w, cell) in live.items():
                for o, dw, q in self.arcs[p].get(x, ()):
                    held = nxt.get(q)
                    if held is None or w + dw > held[0] or w + dw == held[0] and _before((cell, o), held[1]):
                        nxt[q] = (w + dw, (cell, o))
            live = nxt
        ends = [(w, _unrolled(cell)) for p, (w, cell) in live.items() if p in self.final]
        return min(ends, key=lambda e: (-e[0], e[1])) if ends else None


def _unrolled(cell: tuple | None) -> tuple[str, ...]:
    out = []
    while cell is not None:
        cell, o = cell
        out.append(o)
    return tuple(reversed(out))


def _before(a: tuple | None, b: tuple | None) -> bool:
    """Whether the output ``a`` sorts before ``b`` of the same length; what both begin with is one shared cell."""
    less = False
    while a is not b and a is not None and b is not None:
        (a, x), (b, y) = a, b
        if x != y:
            less = x < y
    return less


def build(start: Hashable, step: Callable[[Hashable, str], Iterable[tuple[str, float, Hashable]]], alphabet: Iterable[str], accepts: Callable[[Hashable], bool]) -> Transducer:
    """The transducer of all states that ``step(state, symbol)`` reaches from ``start``."""
    number, todo, out = {start: 0}, [start], Transducer()
    alphabet = list(alphabet)
    while todo:
        state = todo.pop()
        own = out.arcs[number[state]]
        for x in alphabet:
            for o, w, nxt in step(state, x):
                if nxt not in number:
                    number[nxt] = len(out.arcs)
                    out.arcs.append({})
                    todo.append(nxt)
                own.setdefault(x, []).append((o, w, number[nxt]))
    out.final = {i for s, i in number.items() if accepts(s)}
    return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What ``second`` makes of the output of ``first``: pairs of states, weights added."""
    alphabet = sorted({x for arcs in first.arcs for x in arcs})

    def step(state: tuple[int, int], x: str) -> Iterable[tuple[str, float, tuple[int, int]]]:
        p, r = state
        for mid, w, q in first.arcs[p].get(x, ()):
            for o, v, s in second.arcs[r].get(mid, ()):
                yield o, w + v, (q, s)

    return build((0, 0), step, alphabet, lambda s: s[0] in first.final and s[1] in second.final)
