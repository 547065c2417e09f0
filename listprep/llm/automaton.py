"""Rules as one deterministic automaton over bytes: subset construction, minimisation, transition arrays, and a
vectorised scan of a batch."""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np

# Code points of one lane of the scan.
LANE = 128


class Machine:
    """Nondeterministic automaton built from parts; every part is a pair (entry, exit)."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def one(self, values: frozenset[int]) -> tuple[int, int]:
        a, b = self.state(), self.state()
        self.moves[a].append((values, b))
        return a, b

    def then(self, *parts: tuple[int, int]) -> tuple[int, int]:
        for (_, b), (a, _) in zip(parts, parts[1:], strict=False):
            self.empty[b].append(a)
        return parts[0][0], parts[-1][1]

    def either(self, *parts: tuple[int, int]) -> tuple[int, int]:
        a, b = self.state(), self.state()
        for x, y in parts:
            self.empty[a].append(x)
            self.empty[y].append(b)
        return a, b

    def many(self, part: tuple[int, int], none: bool) -> tuple[int, int]:
        a, b = self.state(), self.state()
        self.empty[a].append(part[0])
        self.empty[part[1]] += [part[0], b]
        if none:
            self.empty[a].append(b)
        return a, b

    def maybe(self, part: tuple[int, int]) -> tuple[int, int]:
        return self.either(part, self.then(self._nothing()))

    def _nothing(self) -> tuple[int, int]:
        a = self.state()
        return a, a

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def parse(m: Machine, rule: str) -> tuple[int, int]:
    """A rule in the usual notation: literals, ``\\xNN``, classes, groups, ``|``, ``?``, ``*``, ``+``, ``{n}``, and
    ``(?i:...)`` for ASCII letters in either case."""
    at = 0

    def char() -> int:
        nonlocal at
        c = rule[at]
        at += 1
        if c == "\\":
            if rule[at] == "x":
                at += 3
                return int(rule[at - 2 : at], 16)
            at += 1
            return ord(rule[at - 1])
        return ord(c)

    def folded(values: set[int], fold: bool) -> frozenset[int]:
        both = {ord(f(chr(v))) for v in values if v < 128 for f in (str.lower, str.upper)} if fold else set()
        return frozenset(values | both)

    def atom(fold: bool) -> tuple[int, int]:
        nonlocal at
        if rule[at] == "(":
            at += 1
            if rule.startswith("?i:", at):
                at += 3
                fold = True
            part = choice(fold)
            at += 1
            return part
        if rule[at] != "[":
            return m.one(folded({char()}, fold))
        at += 1
        values: set[int] = set()
        while rule[at] != "]":
            low = char()
            if rule[at] == "-" and rule[at + 1] != "]":
                at += 1
                values.update(range(low, char() + 1))
            else:
                values.add(low)
        at += 1
        return m.one(folded(values, fold))

    def sequence(fold: bool) -> tuple[int, int]:
        nonlocal at
        parts = []
        while at < len(rule) and rule[at] not in "|)":
            begin = at
            part = atom(fold)
            sign = rule[at] if at < len(rule) else ""
            if sign in ("?", "*", "+") and sign:
                at += 1
                part = m.maybe(part) if sign == "?" else m.many(part, sign == "*")
            elif sign == "{":
                end = at
                close = rule.index("}", at)
                for _ in range(int(rule[at + 1 : close]) - 1):
                    at = begin
                    parts.append(part)
                    part = atom(fold)
                assert at == end
                at = close + 1
            parts.append(part)
        return m.then(*parts)

    def choice(fold: bool) -> tuple[int, int]:
        nonlocal at
        parts = [sequence(fold)]
        while at < len(rule) and rule[at] == "|":
            at += 1
            parts.append(sequence(fold))
        return parts[0] if len(parts) == 1 else m.either(*parts)

    return choice(False)


@dataclass
class Automaton:
    """``moves[state * width + byte_class[byte]]`` is the next state; ``accepts[state]`` has bit r for rule r.
    State 0 is the start. Anchored automata have a dead state, the others go on from the start."""

    moves: np.ndarray
    byte_class: np.ndarray
    accepts: np.ndarray
    width: int
    dead: int


def compile_rules(rules: list[str], anchored: bool = False) -> Automaton:
    """One automaton for all rules. Unless ``anchored``, a match may begin at any byte."""
    m = Machine()
    starts, finals = [], {}
    for r, rule in enumerate(rules):
        a, b = parse(m, rule)
        starts.append(a)
        finals[b] = 1 << r
    used = {frozenset(v) for moves in m.moves for v, _ in moves}
    label = {b: tuple(b in v for v in used) for b in range(256)}
    kinds = {k: i for i, k in enumerate(dict.fromkeys(label.values()))}
    byte_class = np.array([kinds[label[b]] for b in range(256)], np.uint8)
    sample = [next(b for b in range(256) if kinds[label[b]] == i) for i in range(len(kinds))]
    start = m.closure(starts)
    known, todo, table = {start: 0}, [start], []
    while todo:
        here = todo.pop(0)
        row = []
        for b in sample:
            to = [t for s in here for values, t in m.moves[s] if b in values]
            there = m.closure(to) if anchored else m.closure([*to, *starts])
            if there not in known:
                known[there] = len(known)
                todo.append(there)
            row.append(known[there])
        table.append(row)
    accepts = [sum({bit for f, bit in finals.items() if f in s}) for s in known]
    dead = known.get(frozenset(), -1)
    return _minimal(np.array(table), np.array(accepts), byte_class, dead)


def _minimal(table: np.ndarray, accepts: np.ndarray, byte_class: np.ndarray, dead: int) -> Automaton:
    """States that accept alike and move alike are one: parts are split until nothing changes."""
    part = np.unique(accepts, return_inverse=True)[1]
    while True:
        rows = np.column_stack((part, part[table]))
        finer = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    order = {p: i for i, p in enumerate(dict.fromkeys(part.tolist()))}  # the start stays 0
    name = np.array([order[p] for p in part.tolist()])
    first = np.array([part.tolist().index(p) for p in order])
    moves = name[table[first]]
    return Automaton(
        np.ascontiguousarray(moves, dtype=np.int32).ravel(), byte_class, accepts[first], moves.shape[1],
        int(name[dead]) if dead >= 0 else -1,
    )


def scan(a: Automaton, data: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Positions of all bytes after which some rule accepts. One pass: lanes of equal length run side by side from
    the start state; a lane whose predecessor ended elsewhere is run again from there until its states agree with
    those of the first run."""
    if not len(data):
        return np.zeros(0, np.int64)
    rows = -(-len(data) // lane)
    symbols = np.full(rows * lane, a.byte_class[10], np.uint8)
    symbols[: len(data)] = a.byte_class[data]
    grid = np.ascontiguousarray(symbols.reshape(rows, lane).T)
    states = np.empty((lane, rows), np.int32)
    state = np.zeros(rows, np.int32)
    for i in range(lane):
        state = a.moves[state * a.width + grid[i]]
        states[i] = state
    todo = np.flatnonzero(states[-1][:-1]) + 1
    while len(todo):
        state, left, changed = states[-1][todo - 1].copy(), todo, []
        for i in range(lane):
            state = a.moves[state * a.width + grid[i][left]]
            differ = states[i][left] != state
            if not differ.all():
                state, left = state[differ], left[differ]
            if not len(left):
                break
            states[i][left] = state
        else:
            changed = left
        todo = np.asarray(changed, dtype=np.int64) + 1
        todo = todo[todo < rows]
    hit = np.flatnonzero((a.accepts != 0)[states.T.ravel()[: len(data)]])
    return hit


class Barren:
    """Places of a stretch, per state, from which an automaton accepts nothing more up to the stretch's end."""

    def __init__(self, low: int, high: int):
        self.low, self.size = low, high - low
        self.states: dict[int, bytearray] = {}

    def holds(self, state: int, place: int) -> bool:
        marks = self.states.get(state)
        return marks is not None and marks[place - self.low] == 1

    def add(self, path, start: int) -> None:
        for place, state in enumerate(path, start - self.low):
            if state not in self.states:
                self.states[state] = bytearray(self.size)
            self.states[state][place] = 1


def longest(a: Automaton, data: bytes, start: int, end: int, barren: Barren | None = None) -> int:
    """End of the longest match of an anchored automaton at ``start``, or -1. ``barren`` keeps what walks up to the same
    ``end`` found out."""
    state, found, path = 0, -1, array("L")
    for i in range(start, end):
        state = a.moves[state * a.width + a.byte_class[data[i]]]
        if state == a.dead or (barren is not None and barren.holds(int(state), i)):
            break
        if a.accepts[state]:
            found = i + 1
            if path:
                del path[:]
        elif barren is not None:
            path.append(int(state))
    if barren is not None:
        barren.add(path, found if found > start else start)
    return found
