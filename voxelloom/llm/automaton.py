"""Byte regexes to minimal deterministic automata.

The syntax is what rules of secrets need: literals, escapes (backslash and a character, or
\\xHH), classes with ranges, groups, alternatives, and the repeats ? * + {m} {m,} {m,n}.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np


class _Parser:
    """Recursive descent to ('set', bytes), ('cat', parts), ('or', parts), ('rep', part, least, most or None)."""

    def __init__(self, pattern: str, either_case: bool):
        self.s, self.at, self.either = pattern, 0, either_case

    def peek(self) -> str:
        return self.s[self.at : self.at + 1]

    def take(self) -> str:
        c = self.s[self.at]
        self.at += 1
        return c

    def parse(self):
        tree = self.alternatives()
        if self.at != len(self.s):
            raise ValueError(f"unexpected {self.peek()!r} at {self.at} in {self.s!r}")
        return tree

    def alternatives(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        part = self.atom()
        while (c := self.peek()) and c in "?*+{":
            self.take()
            if c == "{":
                end = self.s.index("}", self.at)
                least, comma, most = self.s[self.at : end].partition(",")
                self.at = end + 1
                part = ("rep", part, int(least), (int(most) if most else None) if comma else int(least))
            else:
                part = ("rep", part, int(c == "+"), 1 if c == "?" else None)
        return part

    def char(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.s[self.at - 2 : self.at], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def cased(self, chars: set[int]):
        if any(x > 127 for x in chars):
            raise ValueError("only ASCII is supported")
        if self.either:
            chars = chars | {x ^ 32 for x in chars if chr(x).isalpha()}
        return ("set", frozenset(chars))

    def atom(self):
        c = self.peek()
        if c == "(":
            self.take()
            tree = self.alternatives()
            if self.take() != ")":
                raise ValueError("a group isn't closed")
            return tree
        if c == "[":
            self.take()
            chars: set[int] = set()
            while self.peek() != "]":
                a = b = self.char()
                if self.peek() == "-" and self.s[self.at + 1] != "]":
                    self.take()
                    b = self.char()
                chars |= set(range(a, b + 1))
            self.take()
            return self.cased(chars)
        return self.cased({self.char()})


def _reversed(tree):
    """The tree of the same texts read from their ends."""
    kind, *rest = tree
    if kind == "set":
        return tree
    if kind == "rep":
        return (kind, _reversed(rest[0]), *rest[1:])
    parts = [_reversed(x) for x in rest[0]]
    return (kind, parts[::-1] if kind == "cat" else parts)


class _Nfa:
    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.on: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.on.append([])
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        """Grows the tree from `start`; its last state."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.on[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "or":
            end = self.state()
            for part in tree[1]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(part, first)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            hub, body = self.state(), self.state()
            self.free[start].append(hub)
            self.free[hub].append(body)
            self.free[self.add(part, body)].append(hub)
            return hub
        end = self.state()
        self.free[start].append(end)
        for _ in range(most - least):
            body = self.state()
            self.free[start].append(body)
            start = self.add(part, body)
            self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


@dataclass(frozen=True)
class Dfa:
    """next[state, byte class]; kinds[state]: bits of the rules accepted there; classes[byte]. State 0 starts; dead: the state without a way out, or -1."""

    next: np.ndarray
    kinds: np.ndarray
    classes: np.ndarray
    dead: int

    @cached_property
    def rows(self) -> list[list[int]]:
        return self.next.tolist()

    def resets(self) -> np.ndarray:
        """[a, b]: whether the byte classes a and then b lead any state to the start."""
        return (self.next[self.next] == 0).all(axis=0)


def build(patterns: list[tuple[str, bool]], anywhere: bool, backwards: bool = False) -> Dfa:
    """One minimal automaton for all (pattern, either case); anywhere: matches may start at any byte; backwards: it reads
    texts from their ends, so that it accepts where a match begins."""
    nfa = _Nfa()
    root, ends = nfa.state(), {}
    for k, (pattern, either) in enumerate(patterns):
        first = nfa.state()
        nfa.free[root].append(first)
        tree = _Parser(pattern, either).parse()
        ends[nfa.add(_reversed(tree) if backwards else tree, first)] = k
    # bytes that no set tells apart are one class
    sets = sorted({s for edges in nfa.on for s, _ in edges}, key=sorted)
    names: dict[tuple, int] = {}
    classes = np.array([names.setdefault(tuple(b in s for s in sets), len(names)) for b in range(256)], np.int64)
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(len(names))]
    # subset construction
    start = nfa.closure([root])
    known, todo, rows = {start: 0}, [start], []
    while todo:
        subset = todo.pop(0)
        row = []
        for b in sample:
            to = {t for s in subset for chars, t in nfa.on[s] if b in chars}
            to = nfa.closure(to | {root} if anywhere else to)
            if to not in known:
                known[to] = len(known)
                todo.append(to)
            row.append(known[to])
        rows.append(row)
    step = np.array(rows, np.int64)
    kinds = np.array([sum(1 << ends[s] for s in subset if s in ends) for subset in known], np.int64)
    # minimisation by refining the partition of states
    part = np.unique(kinds, return_inverse=True)[1]
    while True:
        _, finer = np.unique(np.column_stack([part[:, None], part[step]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == part.max():
            break
        part = finer
    # the start is 0, and states that accept come last
    groups = sorted(range(part.max() + 1), key=lambda g: (g != part[0], kinds[np.flatnonzero(part == g)[0]] != 0))
    number = np.empty(len(groups), np.int64)
    number[groups] = np.arange(len(groups))
    first = np.array([np.flatnonzero(part == g)[0] for g in groups])
    small, own = number[part[step[first]]], kinds[first]
    stuck = [s for s in range(len(groups)) if not own[s] and (small[s] == s).all() and s]
    return Dfa(small, own, classes, stuck[0] if stuck else -1)
