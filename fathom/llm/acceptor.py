"""Minimised acceptors of word lists, and their composition with a one-edit transducer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class Acceptor:
    """The minimal acyclic automaton of sorted distinct words, as arrays.

    Edges are sorted by (state, symbol). A word's number is its place in the list: the sum of `skip` along its edges,
    where skip counts the words that leave their common state before the edge.
    """

    def __init__(self, words: list[str]):
        known: dict[tuple, int] = {}
        final: list[bool] = []
        edges: list[tuple] = []
        path: list[list] = [[False, []]]  # the states of the last word that may still get edges: final, [(symbol, target)]

        def settle(down_to: int, word: str) -> None:
            """States below that depth of the last word get no more edges: equal ones become one state."""
            while len(path) - 1 > down_to:
                end, out = path.pop()
                key = (end, *out)
                state = known.get(key)
                if state is None:
                    state = known[key] = len(final)
                    final.append(end)
                    edges.append(tuple(out))
                path[-1][1].append((word[len(path) - 1], state))

        last = ""
        for word in words:
            same = 0
            while same < min(len(last), len(word)) and last[same] == word[same]:
                same += 1
            settle(same, last)
            path += [[False, []] for _ in range(len(word) - same)]
            path[-1][0] = True
            last = word
        settle(0, last)
        final.append(path[0][0])
        edges.append(tuple(path[0][1]))
        self.initial = len(final) - 1
        self.final = np.array(final, bool)
        self.degree = np.array([len(e) for e in edges], np.int64)
        self.first = np.cumsum(self.degree) - self.degree
        flat = [x for e in edges for x in e]
        self.symbol = np.array([ord(c) for c, _ in flat], np.int64)
        self.target = np.array([t for _, t in flat], np.int64)
        count = [0] * len(final)  # words that a state accepts; targets come before their states
        skip: list[int] = []
        for state, out in enumerate(edges):
            n = int(final[state])
            for _, t in out:
                skip.append(n)
                n += count[t]
            count[state] = n
        self.skip = np.array(skip, np.int64)
        self.state = np.repeat(np.arange(len(final)), self.degree)
        self._key = self.state << 21 | self.symbol

    def out(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All edges of the given states: which of the states, and the edge."""
        n = self.degree[states]
        of = np.repeat(np.arange(len(states)), n)
        return of, self.first[states][of] + np.arange(len(of)) - (np.cumsum(n) - n)[of]

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states' edges of those symbols, -1 where there is none."""
        if not len(self._key):
            return np.full(len(states), -1)
        key = states << 21 | symbols
        at = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
        return np.where(self._key[at] == key, at, -1)


#: Composite states that are followed at once.
FRONT = 1 << 18


def edit_pairs(a: Acceptor, least: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs accepted by acceptor o one-edit transducer o acceptor, as numbers x, y of words and their common prefix's length.

    In the composition both sides read alike, in one state, until the edit; then x has another symbol than y (x < y), or y
    has one more; from there both read alike again, in two states. The edit stands at the end of the words' common
    prefix, so each pair has one accepting path. Only pairs with a common prefix of `least` or more are found. The
    composition is followed level by level from its initial state, in parts of at most about FRONT composite states.
    """
    states, number, depth = np.array([a.initial]), np.array([0]), 0
    todo = [(states, number, depth)]
    while todo:
        states, number, depth = todo.pop()
        if len(states) > FRONT:
            half = len(states) // 2
            todo += [(states[half:], number[half:], depth), (states[:half], number[:half], depth)]
            continue
        of, edge = a.out(states)
        if not len(edge):
            continue
        if depth >= least:
            yield from _edited(a, states, number, of, edge, depth)
        todo.append((a.target[edge], number[of] + a.skip[edge], depth + 1))


def _edited(a: Acceptor, states: np.ndarray, number: np.ndarray, of: np.ndarray, edge: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs whose edit is the next symbol in these states."""
    into, base = a.target[edge], number[of] + a.skip[edge]
    # Replaced: two edges of one state, each pair once.
    after = (np.cumsum(a.degree[states])[of] - np.arange(len(of)) - 1).astype(np.int64)  # edges of the same state behind each one
    one = np.repeat(np.arange(len(edge)), after)
    two = one + 1 + np.arange(len(one)) - (np.cumsum(after) - after)[one]
    yield from _alike(a, into[one], base[one], into[two], base[two], depth)
    # One more in y: x ends here, or goes on with another symbol than the inserted one, which y reads after it.
    ends = np.flatnonzero(a.final[states[of]] & a.final[into])
    if len(ends):
        yield number[of[ends]], base[ends], np.full(len(ends), depth)
    y_of, y_edge = a.out(into)
    x_edge = a.step(states[of][y_of], a.symbol[y_edge])
    ok = (x_edge >= 0) & (a.symbol[y_edge] != a.symbol[edge][y_of])
    x_edge, y_edge, y_of = x_edge[ok], y_edge[ok], y_of[ok]
    yield from _alike(a, a.target[x_edge], number[of][y_of] + a.skip[x_edge], a.target[y_edge], base[y_of] + a.skip[y_edge], depth)


def _alike(a: Acceptor, p: np.ndarray, x: np.ndarray, q: np.ndarray, y: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs of words that end alike from the states p and q on, having the numbers x and y so far."""
    todo = [(p, x, q, y)]
    while todo:
        p, x, q, y = todo.pop()
        if len(p) > FRONT:
            half = len(p) // 2
            todo += [tuple(v[half:] for v in (p, x, q, y)), tuple(v[:half] for v in (p, x, q, y))]
            continue
        both = a.final[p] & a.final[q]
        if both.any():
            yield x[both], y[both], np.full(int(both.sum()), depth)
        fewer = a.degree[p] <= a.degree[q]  # the side of fewer edges offers, the other one is looked up
        some, other = np.where(fewer, p, q), np.where(fewer, q, p)
        of, edge = a.out(some)
        match = a.step(other[of], a.symbol[edge])
        ok = match >= 0
        of, edge, match = of[ok], edge[ok], match[ok]
        if len(of):
            pe, qe = np.where(fewer[of], edge, match), np.where(fewer[of], match, edge)
            todo.append((a.target[pe], x[of] + a.skip[pe], a.target[qe], y[of] + a.skip[qe]))
