"""Regular expressions over bytes to minimal deterministic automata: subset construction, then merging.

Syntax: literals, ``\\xHH`` and escaped characters, classes, groups, ``|``, ``? * +`` and ``{n} {n,} {n,m}``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class _Nfa:
    """Transitions on byte sets and empty moves; built by concatenating fragments (start, end)."""

    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def fragment(self, node, reverse: bool) -> tuple[int, int]:
        kind, *rest = node
        start, end = self.state(), self.state()
        if kind == "bytes":
            self.moves[start].append((rest[0], end))
        elif kind == "then":
            at = start
            for part in rest[0][::-1] if reverse else rest[0]:
                a, b = self.fragment(part, reverse)
                self.empty[at].append(a)
                at = b
            self.empty[at].append(end)
        elif kind == "or":
            for part in rest[0]:
                a, b = self.fragment(part, reverse)
                self.empty[start].append(a)
                self.empty[b].append(end)
        else:
            part, least, most = rest
            at = start
            for _ in range(least):
                a, b = self.fragment(part, reverse)
                self.empty[at].append(a)
                at = b
            if most is None:
                a, b = self.fragment(part, reverse)
                self.empty[at].append(a)
                self.empty[b].append(a)
                self.empty[b].append(end)
            for _ in range((most or least) - least):
                self.empty[at].append(end)
                a, b = self.fragment(part, reverse)
                self.empty[at].append(a)
                at = b
            self.empty[at].append(end)
        return start, end


def parse(pattern: bytes, ignore_case: bool = False):
    """The syntax tree of a pattern."""
    at = 0

    def fold(chosen: set[int]) -> frozenset[int]:
        if ignore_case:
            chosen = chosen | {b ^ 32 for b in chosen if chr(b).isalpha() and b < 128}
        return frozenset(chosen)

    def one() -> int:
        nonlocal at
        if pattern[at : at + 2] == b"\\x":
            at += 4
            return int(pattern[at - 2 : at], 16)
        at += 2 if pattern[at : at + 1] == b"\\" else 1
        return pattern[at - 1]

    def atom():
        nonlocal at
        if pattern[at : at + 1] == b"(":
            at += 3 if pattern[at : at + 3] == b"(?:" else 1
            found = alternatives()
            at += 1
            return found
        if pattern[at : at + 1] == b"[":
            at += 1
            chosen, first = set(), True
            while first or pattern[at : at + 1] != b"]":
                low, first = one(), False
                if pattern[at : at + 1] == b"-" and pattern[at + 1 : at + 2] != b"]":
                    at += 1
                    chosen.update(range(low, one() + 1))
                else:
                    chosen.add(low)
            at += 1
            return ("bytes", fold(chosen))
        return ("bytes", fold({one()}))

    def repeated():
        nonlocal at
        found = atom()
        while at < len(pattern) and pattern[at] in b"?*+{":
            if pattern[at] == ord("{"):
                stop = pattern.index(b"}", at)
                low, comma, high = pattern[at + 1 : stop].partition(b",")
                bounds = int(low), (int(high) if high else None) if comma else int(low)
                at = stop + 1
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[chr(pattern[at])]
                at += 1
            found = ("times", found, *bounds)
        return found

    def sequence():
        parts = []
        while at < len(pattern) and pattern[at] not in b"|)":
            parts.append(repeated())
        return ("then", parts)

    def alternatives():
        nonlocal at
        parts = [sequence()]
        while at < len(pattern) and pattern[at] == ord("|"):
            at += 1
            parts.append(sequence())
        return ("or", parts)

    return alternatives()


@dataclass(frozen=True)
class Automaton:
    """``table[state, byte class]`` is the next state, ``accepts[state]`` a bit for each rule; 0 starts."""

    classes: bytes
    table: np.ndarray
    accepts: np.ndarray

    def rows(self) -> list[tuple]:
        """The states as lists that refer to each other; behind the targets, whether no match can
        follow, and the place of the state's rules in ``masks``."""
        rows = [[] for _ in range(len(self.table))]
        codes = np.searchsorted(self.masks(), self.accepts).tolist()
        for number, (row, targets) in enumerate(zip(rows, self.table.tolist(), strict=True)):
            dead = not codes[number] and all(t == number for t in targets)
            row.extend([*(rows[t] for t in targets), dead, codes[number]])
        return rows

    def masks(self) -> list[int]:
        """The sets of rules that states accept, none first."""
        return sorted({0, *self.accepts.tolist()})


def compile_rules(rules: list, anywhere: bool, reverse: bool = False) -> Automaton:
    """One minimal automaton for all syntax trees; ``anywhere`` lets matches begin at every byte."""
    nfa = _Nfa()
    start = nfa.state()
    ends = {}
    for bit, rule in enumerate(rules):
        a, b = nfa.fragment(rule, reverse)
        nfa.empty[start].append(a)
        ends[b] = 1 << bit

    # Bytes that no transition tells apart share a class.
    marks = [tuple(sorted({k for k, m in enumerate(x for s in nfa.moves for x in s) if byte in m[0]})) for byte in range(256)]
    names = {mark: k for k, mark in enumerate(dict.fromkeys(marks))}
    classes = bytes(names[m] for m in marks)
    example = [marks.index(m) for m in names]

    # A set of states is an integer with a bit for each.
    closed = [0] * len(nfa.moves)
    for state in range(len(nfa.moves)):
        seen, todo = 1 << state, [state]
        while todo:
            for s in nfa.empty[todo.pop()]:
                if not seen >> s & 1:
                    seen |= 1 << s
                    todo.append(s)
        closed[state] = seen
    steps = [[0] * len(example) for _ in nfa.moves]
    moving = 0
    for state, moves in enumerate(nfa.moves):
        moving |= (1 << state) * bool(moves)
        for chosen, target in moves:
            for k, byte in enumerate(example):
                if byte in chosen:
                    steps[state][k] |= closed[target]
    first = closed[start]
    number, order, table = {first: 0}, [first], []
    for states in order:  # grows as new subsets are found
        row, rest = [first if anywhere else 0] * len(example), states & moving
        while rest:
            low = rest & -rest
            row = [a | b for a, b in zip(row, steps[low.bit_length() - 1], strict=True)]
            rest ^= low
        for target in row:
            if target not in number:
                number[target] = len(order)
                order.append(target)
        table.append([number[t] for t in row])
    accepts = [sum(bit for end, bit in ends.items() if states >> end & 1) for states in order]
    return _minimal(classes, np.array(table), np.array(accepts, dtype=np.int64))


def _minimal(classes: bytes, table: np.ndarray, accepts: np.ndarray) -> Automaton:
    """States that accept alike and lead to states alike are one; the start keeps number 0."""
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    firsts = np.full(block.max() + 1, -1)
    firsts[block[::-1]] = np.arange(len(block))[::-1]
    order = np.argsort(firsts)
    renumber = np.empty_like(order)
    renumber[order] = np.arange(len(order))
    keep = firsts[order]
    return Automaton(classes, renumber[block[table[keep]]], accepts[keep])
