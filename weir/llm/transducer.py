"""Minimal acyclic transducers from sorted terms to their ordinals, walked by many terms at once."""

from __future__ import annotations

import io
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Transducer:
    """States are numbers; an edge is its state * 256 + byte, and the edges are in order.

    A term's ordinal is the sum of the ``output`` of its edges: how many terms leave its path to the left.
    """

    edges: np.ndarray
    target: np.ndarray
    output: np.ndarray
    final: np.ndarray
    root: int
    terms: int

    def ordinals(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The ordinal of each span of ``data``, -1 where it is no term. All spans advance by a byte at a time."""
        found = np.full(len(starts), -1, np.int64)
        if not len(self.edges):
            return found
        alive, at, state = np.arange(len(starts)), starts.copy(), np.full(len(starts), self.root, np.int64)
        total = np.zeros(len(starts), np.int64)
        while len(alive):
            wanted = (state << 8) | data[at]
            edge = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
            on = self.edges[edge] == wanted
            alive, edge = alive[on], edge[on]
            at, total, state = at[on] + 1, total[on] + self.output[edge], self.target[edge]
            ended = at == stops[alive]
            whole = ended & self.final[state]
            found[alive[whole]] = total[whole]
            alive, at, total, state = alive[~ended], at[~ended], total[~ended], state[~ended]
        return found

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal: at each state the last edge that does not overshoot it."""
        if not 0 <= ordinal < self.terms:
            raise IndexError(ordinal)
        path, state = bytearray(), self.root
        while ordinal or not self.final[state]:
            first, last = np.searchsorted(self.edges, [state << 8, (state + 1) << 8])
            edge = first + int(np.searchsorted(self.output[first:last], ordinal, "right")) - 1
            path.append(int(self.edges[edge]) & 255)
            ordinal -= int(self.output[edge])
            state = int(self.target[edge])
        return bytes(path)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(
            out, edges=self.edges, target=self.target, output=self.output, final=self.final, about=np.array([self.root, self.terms]))
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Transducer:
        held = np.load(io.BytesIO(data))
        root, terms = held["about"].tolist()
        return Transducer(held["edges"], held["target"], held["output"], held["final"], root, terms)


def build(terms: Iterable[bytes]) -> Transducer:
    """The minimal transducer of distinct, sorted, non-empty terms, read one after the other.

    Only the path of the last term is open; what a new term leaves behind is closed from its end, and a
    closed state that equals an earlier one is replaced by it.
    """
    register: dict[tuple, int] = {}
    final: list[bool] = []
    accepted: list[int] = []
    edges: list[list[tuple[int, int]]] = []
    # An open state: its closed edges, whether a term ends there, and the byte of its open edge.
    path: list[list] = [[[], False, -1]]

    def close(state: list) -> int:
        key = (state[1], tuple(state[0]))
        number = register.get(key)
        if number is None:
            number = register[key] = len(final)
            final.append(state[1])
            edges.append(state[0])
            accepted.append(state[1] + sum(accepted[t] for _, t in state[0]))
        return number

    def close_below(depth: int) -> None:
        while len(path) > depth + 1:
            number = close(path.pop())
            path[-1][0].append((path[-1][2], number))

    before, n = b"", 0
    for term in terms:
        if term <= before:
            raise ValueError("terms must be distinct, sorted and not empty")
        common, limit = 0, min(len(term), len(before))
        while common < limit and term[common] == before[common]:
            common += 1
        close_below(common)
        for byte in term[common:]:
            path[-1][2] = byte
            path.append([[], False, -1])
        path[-1][1] = True
        before, n = term, n + 1
    close_below(0)
    root = close(path[0])
    keys, target, output = [], [], []
    for state, out in enumerate(edges):
        passed = int(final[state])
        for byte, to in out:
            keys.append((state << 8) | byte)
            target.append(to)
            output.append(passed)
            passed += accepted[to]
    return Transducer(np.array(keys, np.int64), np.array(target, np.int64), np.array(output, np.int64), np.array(final, bool), root, n)
