"""Regular expressions to one minimal deterministic automaton over bytes.

Several patterns are parsed into one nondeterministic automaton, made deterministic by
subset construction and minimised by partition refinement.  The result is plain arrays: a
class for every byte, a transition table (state x class) and the patterns accepted by each
state.  Compiling happens once, on the driver; a scan is one table step a byte.

Known syntax: literals, ``[...]`` and ``[^...]``, ``.`` (any byte), groups, ``|``, ``?``,
``*``, ``+``, ``{n}``, ``{n,}``, ``{n,m}``, and escapes ``\\xHH`` or of a punctuation mark.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class _Pattern:
    """A parsed pattern as a tree: ('set', bytes), ('cat', [..]), ('or', [..]), ('rep', node, least, most)."""

    def __init__(self, source: str, any_case: bool):
        self.s, self.i, self.any_case = source, 0, any_case
        self.tree = self.choice()
        if self.i < len(source):
            raise ValueError(f"unbalanced ) at {self.i} in {source!r}")

    def peek(self) -> str:
        return self.s[self.i] if self.i < len(self.s) else ""

    def take(self) -> str:
        self.i += 1
        return self.s[self.i - 1]

    def choice(self):
        ways = [self.sequence()]
        while self.peek() == "|":
            self.take()
            ways.append(self.sequence())
        return ways[0] if len(ways) == 1 else ("or", ways)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.single()))
        return ("cat", parts)

    def repeated(self, node):
        while self.peek() in ("?", "*", "+", "{") and self.peek():
            mark = self.take()
            if mark == "{":
                end = self.s.index("}", self.i)
                least, comma, most = self.s[self.i:end].partition(",")
                self.i = end + 1
                node = ("rep", node, int(least), int(most) if most else None if comma else int(least))
            else:
                node = ("rep", node, int(mark == "+"), 1 if mark == "?" else None)
        return node

    def single(self):
        c = self.take()
        if c == "(":
            if self.s.startswith("?:", self.i):
                self.i += 2
            inner = self.choice()
            if self.peek() != ")":
                raise ValueError(f"unbalanced ( in {self.s!r}")
            self.take()
            return inner
        if c == "[":
            return ("set", self.members())
        if c == ".":
            return ("set", frozenset(range(256)))
        if c == "\\":
            return ("set", self.cased({self.escape()}))
        raw = c.encode()
        return ("cat", [("set", self.cased({b})) for b in raw]) if len(raw) > 1 else ("set", self.cased({raw[0]}))

    def escape(self) -> int:
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.s[self.i - 2:self.i], 16)
        if c.isalnum():
            raise ValueError(f"unknown escape \\{c} in {self.s!r}")
        return ord(c)

    def members(self) -> frozenset[int]:
        out: set[int] = set()
        inverse = self.peek() == "^"
        if inverse:
            self.take()
        while self.peek() != "]":
            c = self.take()
            if not c.isascii():
                raise ValueError(f"classes hold single bytes: {self.s!r}")
            lo = self.escape() if c == "\\" else ord(c)
            if self.peek() == "-" and self.s[self.i + 1] != "]":
                self.take()
                c = self.take()
                out |= set(range(lo, (self.escape() if c == "\\" else ord(c)) + 1))
            else:
                out.add(lo)
        self.take()
        out = set(self.cased(out))
        return frozenset(set(range(256)) - out if inverse else out)

    def cased(self, out: set[int]) -> frozenset[int]:
        """ASCII letters in both cases if the pattern ignores case."""
        if self.any_case:
            out = out | {b ^ 32 for b in out if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(out)


class _Nfa:
    """States with moves over byte sets and free moves; state 0 is the start."""

    def __init__(self):
        self.free: list[list[int]] = [[]]
        self.move: list[tuple[frozenset[int], int] | None] = [None]

    def state(self) -> int:
        self.free.append([])
        self.move.append(None)
        return len(self.free) - 1

    def add(self, node, at: int) -> int:
        """Lay ``node`` from state ``at``; its last state."""
        kind = node[0]
        if kind == "set":
            here, to = self.state(), self.state()
            self.free[at].append(here)
            self.move[here] = (node[1], to)
            return to
        if kind == "cat":
            for part in node[1]:
                at = self.add(part, at)
            return at
        if kind == "or":
            to = self.state()
            for way in node[1]:
                self.free[self.add(way, at)].append(to)
            return to
        _, inner, least, most = node
        for _ in range(least):
            at = self.add(inner, at)
        if most is None:
            loop, to = self.state(), self.state()
            self.free[at].append(loop)
            self.free[loop].append(to)
            self.free[self.add(inner, loop)].append(loop)
            return to
        to = self.state()
        self.free[at].append(to)
        for _ in range(most - least):
            at = self.add(inner, at)
            self.free[at].append(to)
        return to

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _reverse(node):
    """The tree of the reversed pattern."""
    if node[0] == "cat":
        return ("cat", [_reverse(p) for p in reversed(node[1])])
    if node[0] == "or":
        return ("or", [_reverse(p) for p in node[1]])
    return ("rep", _reverse(node[1]), *node[2:]) if node[0] == "rep" else node


@dataclass(frozen=True)
class Automaton:
    """``classes`` (256 bytes): class of each byte; ``step`` (states x classes): next state;
    ``accepts``: per state the numbers of the patterns it accepts.  State 0 is the start and, in
    an anchored automaton, state ``dead`` (else -1) can accept nothing any more."""
    classes: bytes
    step: np.ndarray
    accepts: list[tuple[int, ...]]
    dead: int


def compile_patterns(patterns: list[tuple[str, bool]], anywhere: bool, backward: bool = False) -> Automaton:
    """The minimal automaton of (pattern, any case) pairs; ``anywhere``: a match may start at any
    byte (the automaton never forgets to look for a new start); ``backward``: of the reversed
    patterns."""
    nfa, ends = _Nfa(), {}
    for k, (source, any_case) in enumerate(patterns):
        tree = _Pattern(source, any_case).tree
        ends[nfa.add(_reverse(tree) if backward else tree, 0)] = k
    classes, sample = _byte_classes({m[0] for m in nfa.move if m})
    start = nfa.closure([0])
    number, order, rows = {start: 0}, [start], []
    for at in order:                                     # grows while it is read
        row = []
        for b in sample:
            to = {nfa.move[s][1] for s in at if nfa.move[s] and b in nfa.move[s][0]}
            nxt = nfa.closure(to | {0}) if anywhere else nfa.closure(to)
            if nxt not in number:
                number[nxt] = len(order)
                order.append(nxt)
            row.append(number[nxt])
        rows.append(row)
    accepts = [tuple(sorted(ends[s] for s in at if s in ends)) for at in order]
    return _minimal(classes, np.array(rows, dtype=np.int32), accepts)


def _byte_classes(sets: set[frozenset[int]]) -> tuple[bytes, list[int]]:
    """Bytes that no set tells apart share a class: (class of each byte, one byte of each class)."""
    number: dict[tuple[bool, ...], int] = {}
    listed = sorted(sets, key=sorted)
    classes = bytes(number.setdefault(tuple(b in s for s in listed), len(number)) for b in range(256))
    return classes, [classes.index(c) for c in range(len(number))]


def _minimal(classes: bytes, step: np.ndarray, accepts: list[tuple[int, ...]]) -> Automaton:
    """Merge states that no continuation tells apart (refine by accepted patterns, then by the
    blocks of the next states until no block splits)."""
    kinds = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
    block = np.array([kinds[a] for a in accepts])
    while True:
        _, first, finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_index=True, return_inverse=True)
        if len(first) == block.max() + 1:
            break
        block = finer.reshape(-1)
    rank = np.empty(len(first), dtype=np.int32)
    rank[np.argsort(first, kind="stable")] = np.arange(len(first))  # in order of first sight: the start stays 0
    finer = finer.reshape(-1)
    keep = np.sort(first)
    step = rank[finer[step[keep]]].astype(np.int32)
    accepts = [accepts[i] for i in keep]
    dead = [s for s in range(len(keep)) if not accepts[s] and (step[s] == s).all()]
    return Automaton(classes, step, accepts, dead[0] if dead else -1)
