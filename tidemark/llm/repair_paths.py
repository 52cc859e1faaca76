"""Cheapest edits of many role sequences at once: cost tables, then the least audit by prefix doubling.

A lattice holds several chunks of conversations one after the other. A chunk of n rows has n + 1 positions, each
with one node per state of the role grammar; an edit is an arc. Costs are found position by position for all
chunks together. Of the arcs that lie on a cheapest path, the ones with the least audit are found by ranks: the
nodes of a position are ranked by the first 1, 2, 4, ... letters of the least audit from there, each round joining
a node's rank with the rank of the node (or nodes) its letters lead to. Equal letters consume equally many rows,
so nodes are only ever compared inside one position, and ranks stay below the number of states.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

INF = 1 << 40
_NONE = 1 << 20


class Grammar(NamedTuple):
    """Allowed role initials as an automaton that starts in state 0: by default `(s?(ua)+)?`."""

    states: int = 4
    arcs: tuple = ((0, "s", 1), (0, "u", 2), (1, "u", 2), (2, "a", 3), (3, "u", 2))
    accept: tuple = (0, 3)
    #: Roles that an edit may set or insert.
    roles: tuple = ("user", "assistant")


class Costs(NamedTuple):
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    #: Added where a truncated row stays.
    truncated: int = 5


class Arc(NamedTuple):
    letter: str
    role: str | None
    step: int
    to: np.ndarray
    weight: np.ndarray


class Lattice:
    """Chunks of `lengths` rows: `initials` of the roles, rows that must go, rows that are truncated.

    `last`: a chunk that ends its conversation, so that rows may be inserted after its last one.
    """

    def __init__(self, initials, must_go, truncated, lengths, last, grammar: Grammar = Grammar(), costs: Costs = Costs()):
        self.grammar, self.lengths = grammar, np.asarray(lengths, dtype=np.int64)
        n, s = int(self.lengths.sum()), grammar.states
        self.base = np.concatenate([[0], np.cumsum(self.lengths + 1)])[:-1].astype(np.int64)
        self.end = self.base + self.lengths
        self.size = n + len(self.lengths)
        self.chunk = np.repeat(np.arange(len(self.lengths)), self.lengths + 1)
        is_end = np.zeros(self.size, dtype=bool)
        is_end[self.end] = True
        self.row = np.cumsum(~is_end) - 1
        alphabet = sorted({a for _, a, _ in grammar.arcs})
        table = np.full((len(alphabet) + 1, s), -1, dtype=np.int64)
        for before, initial, after in grammar.arcs:
            table[alphabet.index(initial), before] = after
        code = {a: i for i, a in enumerate(alphabet)}

        def at_rows(values, fill):
            out = np.full(self.size, fill)
            out[~is_end] = values
            return out

        own = at_rows(np.array([code.get(i, len(alphabet)) for i in initials], dtype=np.int64), len(alphabet))
        stays = at_rows(~np.asarray(must_go, dtype=bool), False)
        extra = at_rows(np.asarray(truncated, dtype=np.int64) * costs.truncated, 0)
        open_end = ~is_end | np.asarray(last, dtype=bool)[self.chunk]

        def only(where, to):
            return np.where(where[:, None], to, -1)

        fixed = np.ones((self.size, 1), dtype=np.int64)
        flat = np.zeros(self.size, dtype=np.int64)
        # In the order of their letters.
        self.arcs = [Arc("D", None, 1, only(~is_end, fixed * np.arange(s)), flat + costs.delete)]
        for role in grammar.roles:
            self.arcs.append(Arc("I", role, 0, only(open_end, fixed * table[code[role[0]]]), flat + costs.insert))
        self.arcs.append(Arc("K", None, 1, only(stays, table[own]), extra))
        for role in grammar.roles:
            self.arcs.append(Arc("R", role, 1, only(stays, fixed * table[code[role[0]]]), extra + costs.rerole))
        self.letters = np.array([" DIKR".index(a.letter) for a in self.arcs])

    def _at(self, step: int) -> np.ndarray:
        return self.base[self.lengths >= step] + step

    def forward(self, entry: np.ndarray) -> np.ndarray:
        """Least cost from the entry of each chunk (chunks x states) to every node."""
        cost = np.full((self.size, self.grammar.states), INF, dtype=np.int64)
        cost[self.base] = entry
        for step in range(int(self.lengths.max(initial=0)) + 1):
            at = self._at(step)
            for _ in range(self.grammar.states - 1):
                for arc in self.arcs:
                    if not arc.step:
                        self._push(cost, at, arc)
            ahead = at[self.end[self.chunk[at]] > at]
            for arc in self.arcs:
                if arc.step:
                    self._push(cost, ahead, arc)
        return cost

    def _push(self, cost: np.ndarray, at: np.ndarray, arc: Arc) -> None:
        for state in range(self.grammar.states):
            to = arc.to[at, state]
            some = at[to >= 0]
            goal = (some + arc.step, to[to >= 0])
            cost[goal] = np.minimum(cost[goal], cost[some, state] + arc.weight[some])

    def backward(self, leave: np.ndarray) -> np.ndarray:
        """Least cost from every node to the end of its conversation, `leave` being the costs after each chunk."""
        cost = np.full((self.size, self.grammar.states), INF, dtype=np.int64)
        cost[self.end] = leave
        for step in range(int(self.lengths.max(initial=0)), -1, -1):
            at = self._at(step)
            for arc in self.arcs:
                if arc.step:
                    self._pull(cost, at, arc)
            for _ in range(self.grammar.states - 1):
                for arc in self.arcs:
                    if not arc.step:
                        self._pull(cost, at, arc)
        return cost

    def _pull(self, cost: np.ndarray, at: np.ndarray, arc: Arc) -> None:
        for state in range(self.grammar.states):
            to = arc.to[at, state]
            some = at[to >= 0]
            cost[some, state] = np.minimum(cost[some, state], cost[some + arc.step, to[to >= 0]] + arc.weight[some])

    def matrices(self) -> np.ndarray:
        """Least cost from each state before a chunk to each state after it."""
        out = np.empty((len(self.lengths), self.grammar.states, self.grammar.states), dtype=np.int64)
        for state in range(self.grammar.states):
            entry = np.full((len(self.lengths), self.grammar.states), INF)
            entry[:, state] = 0
            out[:, state] = self.forward(entry)[self.end]
        return np.minimum(out, INF)

    def solve(self, entry: np.ndarray, leave: np.ndarray, ended: np.ndarray, order: np.ndarray) -> None:
        """Find the arcs of all cheapest paths and rank the nodes on them.

        `ended`: states after a chunk in which the audit ends, or which hold a rank already in `order`.
        """
        before, after = self.forward(entry), self.backward(leave)
        total = (before[self.base] + after[self.base]).min(axis=1)
        self.total = total
        whole = total[self.chunk][:, None]
        self.node = (before < INF) & (after < INF) & (before + after == whole)
        place = np.arange(self.size)[:, None]
        self.on = []
        for arc in self.arcs:
            goal = np.minimum(place + arc.step, self.size - 1)
            reached = arc.weight[:, None] + after[goal, np.maximum(arc.to, 0)]
            self.on.append(self.node & (arc.to >= 0) & (before + reached == whole))
        stop = np.zeros_like(self.node)
        stop[self.end] = ended
        self.stop = stop & self.node
        given = np.zeros_like(before)
        given[self.end] = order
        self.rank = self._ranks(given)
        #: States in which a cheapest path enters a chunk (inserts before its first row come after).
        self.entered = (entry < INF) & (entry + after[self.base] == total[:, None])
        self._choose()

    def _ranks(self, given: np.ndarray) -> np.ndarray:
        states = range(self.grammar.states)
        place = np.arange(self.size)[:, None]
        letter = np.full(self.node.shape, _NONE)
        for code, on in zip(self.letters[::-1], self.on[::-1]):
            letter[on] = code
        rank = np.where(self.stop, given, letter)
        # Where the first letters lead: a position and a set of states there, all with the same letters behind.
        spot = np.where(self.stop | (letter == _NONE), place, place + (letter != 2))
        mask = np.where(self.stop, 1 << np.arange(self.grammar.states), 0)
        for arc, code, on in zip(self.arcs, self.letters, self.on):
            mask |= np.where(on & (letter == code) & ~self.stop, 1 << np.maximum(arc.to, 0), 0)
        while True:
            then = np.full(rank.shape, _NONE)
            for s in states:
                then = np.where(mask >> s & 1 == 1, np.minimum(then, rank[spot, s]), then)
            next_mask, next_spot = np.zeros_like(mask), spot.copy()
            for s in states:
                least = (mask >> s & 1 == 1) & (rank[spot, s] == then)
                next_mask |= np.where(least, mask[spot, s], 0)
                next_spot = np.where(least, spot[spot, s], next_spot)
            key = np.where(self.node, rank * (2 * _NONE) + then, np.iinfo(np.int64).max)
            next_rank = sum((key[:, [s]] < key).astype(np.int64) for s in states)
            next_rank = np.where(self.node, next_rank, _NONE)
            same = (next_mask == mask).all() and (next_spot == spot).all() and (next_rank == rank).all()
            rank, mask, spot = next_rank, next_mask, next_spot
            if same:
                return rank

    def _choose(self) -> None:
        """The arc each node takes: the least letter, then the least rank behind it."""
        place = np.arange(self.size)[:, None]
        best = np.full(self.node.shape, np.iinfo(np.int64).max)
        self.taken = np.full(self.node.shape, -1)
        self.next = place * self.grammar.states + np.arange(self.grammar.states)
        for i, (arc, code, on) in enumerate(zip(self.arcs, self.letters, self.on)):
            goal, to = np.minimum(place + arc.step, self.size - 1), np.maximum(arc.to, 0)
            key = np.where(on & ~self.stop, code * (2 * _NONE) + self.rank[goal, to], np.iinfo(np.int64).max)
            better = key < best
            best = np.where(better, key, best)
            self.taken = np.where(better, i, self.taken)
            self.next = np.where(better, goal * self.grammar.states + to, self.next)

    def paths(self, entry: np.ndarray):
        """(chunk, arc, row) of the edits from state `entry` of each chunk, in order, and the state after each chunk.

        All edits are found at once: the j-th of a chunk by the pointers of the binary digits of j.
        """
        jump = self.next.ravel()
        jumps = []
        while True:
            jumps.append(jump)
            doubled = jump[jump]
            if (doubled == jump).all():
                break
            jump = doubled
        first = self.base * self.grammar.states + entry
        count = self._steps(jumps, first)
        chunk = np.repeat(np.arange(len(first)), count)
        j = np.arange(len(chunk)) - np.repeat(np.cumsum(count) - count, count)
        node = first[chunk]
        for bit, jump in enumerate(jumps):
            node = np.where(j >> bit & 1 == 1, jump[node], node)
        place, state = np.divmod(node, self.grammar.states)
        return chunk, self.taken[place, state], self.row[place], jumps[-1][first] % self.grammar.states

    @staticmethod
    def _steps(jumps: list[np.ndarray], first: np.ndarray) -> np.ndarray:
        """Edits from each first node to the end: the longest sum of powers of two that does not reach it."""
        node, count = first.copy(), np.zeros(len(first), dtype=np.int64)
        final = jumps[-1][first]
        for bit in range(len(jumps) - 1, -1, -1):
            ahead = jumps[bit][node]
            short = ahead != final
            node = np.where(short, ahead, node)
            count += np.where(short, 1 << bit, 0)
        return count + (node != final)


def unit(chunks: int, grammar: Grammar) -> np.ndarray:
    entry = np.full((chunks, grammar.states), INF)
    entry[:, 0] = 0
    return entry


def accepting(chunks: int, grammar: Grammar) -> np.ndarray:
    out = np.full((chunks, grammar.states), INF)
    out[:, list(grammar.accept)] = 0
    return out


def whole_paths(initials, must_go, truncated, lengths, grammar: Grammar = Grammar(), costs: Costs = Costs()):
    """Total costs, and (chunk, arc, row) of the least edits, of whole conversations; the lattice gives the arcs."""
    n = len(lengths)
    lattice = Lattice(initials, must_go, truncated, lengths, [True] * n, grammar, costs)
    leave = accepting(n, grammar)
    lattice.solve(unit(n, grammar), leave, leave == 0, np.zeros_like(leave))
    chunk, arc, row, _ = lattice.paths(np.zeros(n, dtype=np.int64))
    return lattice, chunk, arc, row
