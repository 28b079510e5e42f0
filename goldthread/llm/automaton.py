"""Deterministic automata over bytes, built from small pattern terms.

A term is a byte class or a sequence, choice or repetition of terms. Terms become one automaton by
subset construction, equal states are merged by partition refinement, and the result is laid out as
transition arrays: a state is a list whose entry ``b`` is the state after byte ``b`` and whose last
entry says which rules end there. A text is then scanned by indexing alone.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import getitem

ENDS = 256


def one(chars: bytes | str) -> tuple:
    return ("class", frozenset(chars.encode() if isinstance(chars, str) else chars))


def word(text: str, any_case: bool = False) -> tuple:
    return seq(*[one(c.lower() + c.upper() if any_case else c) for c in text])


def seq(*terms: tuple) -> tuple:
    return ("seq", terms)


def choice(*terms: tuple) -> tuple:
    return ("choice", terms)


def maybe(term: tuple) -> tuple:
    return ("choice", (term, ("seq", ())))


def many(term: tuple, least: int = 0) -> tuple:
    """``least`` or more of ``term``."""
    return ("seq", (*[term] * least, ("loop", term)))


class _Graph:
    """States with byte-class steps and free steps."""

    def __init__(self):
        self.steps: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def lay(self, term: tuple, start: int) -> int:
        """Add ``term`` behind ``start``; gives its end."""
        kind, inner = term
        if kind == "class":
            end = self.state()
            self.steps[start].append((inner, end))
            return end
        if kind == "seq":
            for part in inner:
                start = self.lay(part, start)
            return start
        end = self.state()
        if kind == "loop":
            self.free[start].append(end)
            self.free[self.lay(inner, end)].append(end)
        else:
            for part in inner:
                self.free[self.lay(part, start)].append(end)
        return end

    def closed(self, states: Iterable[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)


def _byte_classes(graph: _Graph) -> list[int]:
    """For each byte the number of its class: bytes of a class are in the same terms."""
    sets = sorted({cls for steps in graph.steps for cls, _ in steps}, key=sorted)
    seen: dict[tuple, int] = {}
    return [seen.setdefault(tuple(b in s for s in sets), len(seen)) for b in range(256)]


def tables(terms: list[tuple], anywhere: bool) -> tuple[list[list[int]], list[frozenset], list[int]]:
    """Minimal transition table by byte class, the rules that end in each state, and the byte classes.

    State 0 is the start. With ``anywhere`` a rule may begin at any byte; otherwise at the first only, and
    a state without a way on is the last one.
    """
    graph = _Graph()
    root = graph.state()
    ends = {}
    for i, term in enumerate(terms):
        first = graph.state()
        graph.free[root].append(first)
        ends[graph.lay(term, first)] = i
    cls = _byte_classes(graph)
    width = max(cls) + 1
    member = [cls.index(c) for c in range(width)]
    start = graph.closed([root])
    number, order, table = {start: 0}, [start], []
    for states in order:
        row = []
        for b in member:
            to = {t for s in states for chars, t in graph.steps[s] if b in chars}
            target = graph.closed(to | {root} if anywhere else to)
            if target not in number:
                number[target] = len(order)
                order.append(target)
            row.append(number[target])
        table.append(row)
    found = [frozenset(ends[s] for s in states if s in ends) for states in order]
    # Merge: states differ if they end other rules or lead to states that differ.
    kinds = {k: i for i, k in enumerate(dict.fromkeys(found))}
    group = [kinds[f] for f in found]
    while True:
        seen: dict[tuple, int] = {}
        finer = [seen.setdefault((group[s], *[group[t] for t in table[s]]), len(seen)) for s in range(len(table))]
        if len(seen) == len(set(group)):
            break
        group = finer
    first = {}
    for s, g in enumerate(finer):
        first.setdefault(g, s)
    return [[finer[t] for t in table[s]] for s in first.values()], [found[s] for s in first.values()], cls


def arrays(terms: list[tuple], anywhere: bool, keep_hit: bool = False) -> list:
    """The start state of the automaton as transition arrays; with ``keep_hit`` an end is never left."""
    table, found, cls = tables(terms, anywhere)
    states: list[list] = [[None] * 257 for _ in table]
    for s, row in enumerate(table):
        stay = keep_hit and found[s]
        states[s][:256] = [states[s]] * 256 if stay else [states[row[c]] for c in cls]
        states[s][ENDS] = found[s]
    return states[0]


def dead(start: list) -> list | None:
    """The state of an anchored automaton from which no rule can end."""
    todo, seen = [start], {id(start)}
    while todo:
        state = todo.pop()
        if not state[ENDS] and all(to is state for to in state[:ENDS]):
            return state
        for to in state[:ENDS]:
            if id(to) not in seen:
                seen.add(id(to))
                todo.append(to)
    return None


def hits(start: list, data: bytes) -> bool:
    """Whether any rule ends somewhere in ``data``: one step per byte for all rules together."""
    return bool(reduce(getitem, data, start)[ENDS])


def longest(start: list, stop: list, data: bytes, at: int) -> tuple[int, int]:
    """The first and the last end of a match that begins at ``at``; -1 without one."""
    state, first, last = start, -1, -1
    for place in range(at, len(data)):
        state = state[data[place]]
        if state is stop:
            break
        if state[ENDS]:
            last = place + 1
            if first < 0:
                first = last
    return first, last
