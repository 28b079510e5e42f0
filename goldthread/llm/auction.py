"""Cheapest edits of a conversation: the auction algorithm for shortest paths over a lattice of integer costs.

A node of the lattice is a row and what has been given out so far: nothing, a system row, a user row last or an assistant row
last (states 0 to 3). Arcs are edits. All prices are integers, so every bid is exact.
"""

from __future__ import annotations

from functools import lru_cache

#: Faults of a row, and initials of roles; a row is the byte ``initial + 4 * fault``.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"
OTHER = 3
#: Costs of edits.
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
STATES = 4
#: The state behind an inserted or re-roled row, and the state behind a kept row by its initial.
TURNED = (2, 2, 3, 2)
KEPT = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
#: What closes a conversation from each state: its cost and its edits.
CLOSING = ((0, ""), (4, "II"), (2, "I"), (0, ""))
FAR = float("inf")


def _row_arcs(code: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edits of a row and insertions before it, in the order of their initials: ``label, cost, nodes on, next state``."""
    initial, fault = code % 4, code // 4
    cut = CUT_SHORT * (fault == TRUNCATED)
    arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, TURNED[state])]
    if fault in (FINE, TRUNCATED):
        if initial in KEPT[state]:
            arcs.append(("K", cut, 1, KEPT[state][initial]))
        arcs.append(("R", REROLE + cut, 1, TURNED[state]))
    return [(label, cost, STATES * step + to - state, to) for label, cost, step, to in arcs]


ARCS = [[_row_arcs(code, state) for state in range(STATES)] for code in range(16)]
#: The least cost of passing a row.
LEAST = [min(cost for arcs in of_code for label, cost, _, _ in arcs if label != "I") for of_code in ARCS]


def settle(arcs, origins, price: list, settled: bytearray) -> None:
    """Auction from each origin in turn: raises ``price`` until each is the cheapest way from there to a settled node.

    A path grows from the origin. Its last node bids: if its price is below the best of its arcs, cost and price behind it together,
    the price is raised to that and the path contracted by the node; otherwise the path is extended along the best arc. Prices never
    exceed what an arc allows, so along a path that has reached a settled node they are exact, and its nodes are settled too.
    Origins are best given from the destination on. A node with no way there ends at an infinite price.
    """
    for origin in origins:
        path = [origin]
        while not settled[path[-1]]:
            node = path[-1]
            best, ahead = FAR, -1
            for _, cost, to in arcs(node):
                if cost + price[to] < best:
                    best, ahead = cost + price[to], to
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            elif ahead < 0:
                settled[node] = 1
            else:
                path.append(ahead)
        for node in path:
            settled[node] = 1


class Lattice:
    """The rows of a conversation, or of a stretch of it, with the cost of leaving in each state.

    The node of a row and a state is ``STATES * row + state``; the destination is behind all.
    """

    def __init__(self, rows: bytes, exits: tuple):
        self.rows, self.exits, n = rows, exits, len(rows)
        # States that lead to an exit: what has been given out cannot be taken back.
        most = max(s for s in range(STATES) if exits[s] < FAR)
        self.states = range(STATES if most > 1 else most + 1)
        self.end = STATES * (n + 1)
        self.price, settled = [0] * (self.end + 1), bytearray(self.end + 1)
        settled[self.end] = 1
        least = min(exits)
        for at in range(n, -1, -1):
            layer = [STATES * at + s for s in self.states]
            if at < n:
                # No way on costs less: where prices start, so that bids are few.
                least = min(self.price[STATES + x] for x in layer) + LEAST[rows[at]]
            for node in layer:
                self.price[node] = least
            settle(self.arcs, layer, self.price, settled)

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        at, state = divmod(node, STATES)
        if at == len(self.rows):
            return [("", self.exits[state], self.end)] if self.exits[state] < FAR else []
        return [(label, cost, node + to) for label, cost, to, behind in ARCS[self.rows[at]][state] if behind in self.states]

    def cost(self, state: int) -> float:
        return self.price[state] if state in self.states else FAR

    def trace(self, state: int) -> tuple[str, int]:
        """The least string of edits among the cheapest ones from a state, and the state behind it: along tight arcs only.

        Prices are exact everywhere, so every tight arc goes on to the end; no two arcs of a node have the same label.
        """
        edits, node = [], state
        while True:
            label, _, ahead = next(a for a in self.arcs(node) if a[1] + self.price[a[2]] == self.price[node])
            if ahead == self.end:
                return "".join(edits), node % STATES
            edits.append(label)
            node = ahead


CLOSED = tuple(cost for cost, _ in CLOSING)


@lru_cache(maxsize=20_000)
def cheapest(rows: bytes) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    lattice = Lattice(rows, CLOSED)
    edits, state = lattice.trace(0)
    return lattice.cost(0), edits + CLOSING[state][1]


def crossing(rows: bytes) -> list[list[float]]:
    """The cost of a stretch of rows from each state (first index) to each state behind it."""
    ways = [Lattice(rows, tuple(0 if s == to else FAR for s in range(STATES))) for to in range(STATES)]
    return [[way.cost(s) for way in ways] for s in range(STATES)]


def behind(crossings: list[list[list[float]]]) -> list[tuple]:
    """For each stretch of a conversation the cost from each state behind it to the end: an auction over the stretches."""
    n = len(crossings)
    end = STATES * (n + 1)
    price, settled = [0] * (end + 1), bytearray(end + 1)
    settled[end] = 1

    def arcs(node):
        at, s = divmod(node, STATES)
        if at == n:
            return [("", CLOSED[s], end)]
        return [("", cost, STATES * (at + 1) + to) for to, cost in enumerate(crossings[at][s]) if cost < FAR]

    for at in range(n, -1, -1):
        settle(arcs, range(STATES * at, STATES * (at + 1)), price, settled)
    return [tuple(price[STATES * at:STATES * (at + 1)]) for at in range(1, n + 1)]
