"""Byte automata from regular expressions: Thompson NFA, subset construction, minimisation.

The pattern language: literals, ``[...]`` classes with ranges and ``^``, ``(...)``,
``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}``, ``.``, ``\\xHH``, escaped
characters, and ``(?i:...)`` for either case of ASCII letters. Patterns match bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _class(chars: set[int], either_case: bool) -> frozenset[int]:
    if either_case:
        chars = chars | {c ^ 32 for c in chars if chr(c).isascii() and chr(c).isalpha()}
    return frozenset(chars)


class _Parser:
    """Pattern -> tree of ("set", bytes) | ("cat", items) | ("alt", items) | ("rep", item, least, most)."""

    def __init__(self, pattern: str):
        self.p, self.i = pattern.encode(), 0

    def parse(self):
        tree = self.alternatives(False)
        if self.i != len(self.p):
            raise ValueError(f"unbalanced ) at {self.i}")
        return tree

    def peek(self) -> str:
        return chr(self.p[self.i]) if self.i < len(self.p) else ""

    def alternatives(self, ci: bool):
        items = [self.sequence(ci)]
        while self.peek() == "|":
            self.i += 1
            items.append(self.sequence(ci))
        return items[0] if len(items) == 1 else ("alt", items)

    def sequence(self, ci: bool):
        items = []
        while self.peek() not in ("", "|", ")"):
            items.append(self.repeated(self.atom(ci)))
        return ("cat", items)

    def repeated(self, item):
        while (c := self.peek()) in ("?", "*", "+", "{") and c:
            self.i += 1
            if c == "{":
                end = self.p.index(b"}", self.i)
                least, comma, most = self.p[self.i:end].decode().partition(",")
                self.i = end + 1
                item = ("rep", item, int(least), int(most) if most else (None if comma else int(least)))
            else:
                item = ("rep", item, int(c == "+"), 1 if c == "?" else None)
        return item

    def atom(self, ci: bool):
        c = self.peek()
        self.i += 1
        if c == "(":
            if self.p[self.i:self.i + 3] == b"?i:":
                self.i, ci = self.i + 3, True
            elif self.p[self.i:self.i + 2] == b"?:":
                self.i += 2
            tree = self.alternatives(ci)
            if self.peek() != ")":
                raise ValueError("missing )")
            self.i += 1
            return tree
        if c == "[":
            return ("set", self.bracket(ci))
        if c == ".":
            return ("set", frozenset(range(256)) - {10})
        return ("set", _class({self.escaped() if c == "\\" else ord(c)}, ci))

    def escaped(self) -> int:
        c = self.peek()
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2:self.i], 16)
        return {"n": 10, "r": 13, "t": 9}.get(c, ord(c))

    def bracket(self, ci: bool) -> frozenset[int]:
        negated = self.peek() == "^"
        self.i += negated
        chars: set[int] = set()
        first = True
        while first or self.peek() != "]":
            first = False
            lo = self.member()
            if self.peek() == "-" and self.p[self.i + 1:self.i + 2] not in (b"]", b""):
                self.i += 1
                chars |= set(range(lo, self.member() + 1))
            else:
                chars.add(lo)
        self.i += 1
        chars = _class(chars, ci)
        return frozenset(range(256)) - chars if negated else frozenset(chars)

    def member(self) -> int:
        c = self.peek()
        self.i += 1
        return self.escaped() if c == "\\" else ord(c)


class _Nfa:
    """Byte edges and empty edges; ``build`` wires a tree between two states."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def build(self, tree, start: int, end: int, backwards: bool) -> None:
        kind = tree[0]
        if kind == "set":
            self.edges[start].append((tree[1], end))
        elif kind == "cat":
            items = tree[1][::-1] if backwards else tree[1]
            at = start
            for item in items:
                nxt = self.state()
                self.build(item, at, nxt, backwards)
                at = nxt
            self.empty[at].append(end)
        elif kind == "alt":
            for item in tree[1]:
                self.build(item, start, end, backwards)
        else:
            _, item, least, most = tree
            at = start
            for _ in range(least):
                nxt = self.state()
                self.build(item, at, nxt, backwards)
                at = nxt
            if most is None:
                loop = self.state()
                self.empty[at].append(loop)
                back = self.state()
                self.build(item, loop, back, backwards)
                self.empty[back].append(loop)
                self.empty[loop].append(end)
            else:
                for _ in range(most - least):
                    nxt = self.state()
                    self.empty[at].append(end)
                    self.build(item, at, nxt, backwards)
                    at = nxt
                self.empty[at].append(end)

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """Minimal deterministic automaton: ``step[state, byte]`` and, per state, a bit for each accepted rule.

    State 0 is the start; ``dead`` (or -1) is the state that leads nowhere.
    """

    step: np.ndarray
    accepts: np.ndarray
    dead: int

    def rows(self) -> list[list]:
        """Linked rows: ``row[byte]`` is the next row, ``row[256]`` its rules, ``row[257]`` whether it is dead."""
        out: list[list] = [[None] * 258 for _ in range(len(self.step))]
        for s, row in enumerate(out):
            row[:256] = [out[t] for t in self.step[s]]
            row[256], row[257] = int(self.accepts[s]), s == self.dead
        return out


def compile_rules(patterns: list[str], anchored: bool, backwards: bool = False, first_only: bool = False) -> Automaton:
    """One automaton for all patterns, bit ``i`` of ``accepts`` standing for pattern ``i``.

    ``anchored`` matches from the start alone, otherwise a match may begin at
    every byte. ``first_only`` ends a thread where it first accepts.
    """
    nfa = _Nfa()
    root = nfa.state()
    ends: dict[int, int] = {}
    for i, pattern in enumerate(patterns):
        start, end = nfa.state(), nfa.state()
        nfa.empty[root].append(start)
        nfa.build(_Parser(pattern).parse(), start, end, backwards)
        ends[end] = 1 << i
    if first_only:
        # States from which the end follows without a byte: nothing is read after them.
        for s in range(len(nfa.edges)):
            if s != root and nfa.closure([s]) & ends.keys():
                nfa.edges[s] = []
                nfa.empty[s] = list(nfa.closure([s]) & ends.keys())
    sets = {chars for edges in nfa.edges for chars, _ in edges}
    signature = [tuple(b in chars for chars in sets) for b in range(256)]
    classes = {sig: i for i, sig in enumerate(dict.fromkeys(signature))}
    of_byte = np.array([classes[sig] for sig in signature])
    witness = [int(np.argmax(of_byte == i)) for i in range(len(classes))]
    closures = [nfa.closure([s]) for s in range(len(nfa.edges))]
    start = closures[root]
    moves = [[frozenset().union(*[closures[t] for chars, t in edges if b in chars]) for b in witness] for edges in nfa.edges]
    live = [s for s in range(len(nfa.edges)) if nfa.edges[s]]
    active = set(live)
    number, order, table = {start: 0}, [start], []
    for states in order:  # grows while it is read
        row = []
        own = [s for s in states if s in active]
        for c in range(len(witness)):
            to = frozenset().union(*[moves[s][c] for s in own]) if own else frozenset()
            if not anchored:
                to |= start
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        table.append(row)
    accepts = np.array([sum(bit for end, bit in ends.items() if end in states) for states in order])
    return _minimal(np.array(table), accepts, of_byte)


def _minimal(table: np.ndarray, accepts: np.ndarray, of_byte: np.ndarray) -> Automaton:
    """Partition refinement: states split by what they accept, then by the blocks they step to."""
    _, block = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    rank = {}
    for b in block:  # the start's block first
        rank.setdefault(int(b), len(rank))
    block = np.array([rank[int(b)] for b in block])
    first = np.array([int(np.argmax(block == b)) for b in range(len(rank))])
    step, acc = block[table[first]], accepts[first]
    loops = [s for s in range(len(step)) if acc[s] == 0 and (step[s] == s).all()]
    return Automaton(step[:, of_byte].astype(np.int32), acc.astype(np.int64), loops[0] if loops else -1)
