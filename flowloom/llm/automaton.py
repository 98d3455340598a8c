"""A small rule compiler: regular expressions to one minimised deterministic automaton over bytes.

Supported: literals, escapes of single characters and \\xHH, classes, groups, ``|``, ``?``, ``*``, ``+``, ``{m}`` and ``{m,n}``, all over
ASCII. Each rule is searched leftmost-longest without overlaps. The automaton of a rule keeps the threads of different starts apart, in
order of start; where the first thread accepts, later ones are dropped. When it dies after accepting, the match ended one byte
earlier and the search starts afresh with the current byte. That needs rules to be prompt: after accepting, every further
byte either accepts or kills. ``compile_rules`` checks this and refuses other rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Nfa:
    """Thompson automaton: byte-set edges and empty edges."""
    edges: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({t for s in states for allowed, t in self.edges[s] if byte in allowed})


class _Parser:
    def __init__(self, pattern: str, nfa: Nfa):
        self.p, self.i, self.nfa = pattern, 0, nfa

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2:self.i], 16)
        return ord(c)

    def one_class(self) -> frozenset[int]:
        out: set[int] = set()
        while self.peek() != "]":
            low = self.escaped() if (c := self.take()) == "\\" else ord(c)
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.take()
                high = self.escaped() if (c := self.take()) == "\\" else ord(c)
                out.update(range(low, high + 1))
            else:
                out.add(low)
        self.take()
        return frozenset(out)

    # each of these returns a tree; fragments are built from trees, so a repeated part can be built several times
    def choice(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return ("or", parts)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("then", parts)

    def repeated(self):
        c = self.take()
        if c == "(":
            node = self.choice()
            self.take()
        elif c == "[":
            node = ("byte", self.one_class())
        else:
            node = ("byte", frozenset([self.escaped() if c == "\\" else ord(c)]))
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                end = self.p.index("}", self.i)
                low, _, high = self.p[self.i:end].partition(",")
                node = ("times", node, int(low), int(high or low))
                self.i = end + 1
            else:
                node = ("times", node, int(c == "+"), 1 if c == "?" else None)
        return node

    def build(self, node, start: int) -> int:
        """Add the fragment behind ``start``; its end state is returned."""
        nfa = self.nfa
        if node[0] == "byte":
            end = nfa.state()
            nfa.edges[start].append((node[1], end))
            return end
        if node[0] == "then":
            for part in node[1]:
                start = self.build(part, start)
            return start
        if node[0] == "or":
            end = nfa.state()
            for part in node[1]:
                begin = nfa.state()
                nfa.empty[start].append(begin)
                nfa.empty[self.build(part, begin)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.build(inner, start)
        if high is None:
            loop, end = nfa.state(), nfa.state()
            nfa.empty[start] += [loop, end]
            nfa.empty[self.build(inner, loop)] += [loop, end]
            return end
        ends = [start]
        for _ in range(high - low):
            ends.append(self.build(inner, ends[-1]))
        end = nfa.state()
        for e in ends:
            nfa.empty[e].append(end)
        return end


def parse(pattern: str) -> tuple[Nfa, int, int]:
    nfa = Nfa()
    parser = _Parser(pattern, nfa)
    start = nfa.state()
    end = parser.build(parser.choice(), start)
    if parser.i != len(pattern):
        raise ValueError(f"cannot read {pattern!r} at {parser.i}")
    return nfa, start, end


def search_automaton(pattern: str) -> tuple[list[list[int]], list[list[bool]], list[bool]]:
    """One rule's (next state by byte, match ends before this byte, accepting) by subset construction."""
    nfa, start, end = parse(pattern)
    fresh = nfa.closure({start})
    if end in fresh:
        raise ValueError(f"{pattern!r} matches the empty text")

    def advance(threads: tuple[frozenset[int], ...], byte: int) -> tuple[frozenset[int], ...]:
        seen: set[int] = set()
        out = []
        for t in threads:
            after = frozenset(nfa.step(t, byte) - seen)
            if after:
                seen |= after
                out.append(after)
                if end in after:
                    if len(out) > 1:
                        raise ValueError(f"{pattern!r}: a later start matches before an earlier one is decided")
                    break
        return tuple(out)

    ids: dict[tuple[frozenset[int], ...], int] = {(): 0}
    order, nexts, stops = [()], [], []
    for threads in order:
        row, stop = [], []
        accepting = bool(threads) and end in threads[0]
        for byte in range(256):
            after = advance(threads if accepting else (*threads, fresh), byte)
            ended = accepting and not after
            if accepting and after and end not in after[0]:
                raise ValueError(f"{pattern!r} can go on after a match without matching")
            if ended:
                after = advance((fresh,), byte)
            if after not in ids:
                ids[after] = len(order)
                order.append(after)
            row.append(ids[after])
            stop.append(ended)
        nexts.append(row)
        stops.append(stop)
    return nexts, stops, [bool(t) and end in t[0] for t in order]


@dataclass(frozen=True)
class Automaton:
    """Transition arrays of all rules together: next state and a bitmask of rules whose match ends before the byte."""
    nexts: np.ndarray
    stops: np.ndarray
    accepts: np.ndarray


def compile_rules(patterns: list[str]) -> Automaton:
    """The product of the rules' automata, with states of equal behaviour merged."""
    parts = [search_automaton(p) for p in patterns]
    n_table = [np.array(p[0]) for p in parts]
    s_table = [np.array(p[1]) for p in parts]
    ids = {(0,) * len(parts): 0}
    order = [(0,) * len(parts)]
    nexts, stops = [], []
    for states in order:
        rows = np.stack([n_table[k][s] for k, s in enumerate(states)], axis=1)
        targets = []
        for key in map(tuple, rows.tolist()):
            if key not in ids:
                ids[key] = len(order)
                order.append(key)
            targets.append(ids[key])
        nexts.append(targets)
        stops.append(sum(s_table[k][s].astype(np.int64) << k for k, s in enumerate(states)))
    nexts, stops = np.array(nexts), np.array(stops)
    accepts = np.array([sum(1 << k for k, s in enumerate(states) if parts[k][2][s]) for states in order])
    # minimisation: split blocks until equal states have equal successors
    _, block = np.unique(np.column_stack([accepts, stops]), axis=0, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[nexts]]), axis=0, return_inverse=True)
        if finer.max() == block.max():
            break
        block = finer
    first = np.array([np.flatnonzero(block == b)[0] for b in range(block.max() + 1)])
    to_zero = np.roll(np.arange(len(first)), -int(block[0]))  # the start state gets number 0
    number = np.empty(len(first), np.int64)
    number[to_zero] = np.arange(len(first))
    chosen = first[to_zero]
    return Automaton(number[block[nexts[chosen]]].astype(np.int32), stops[chosen].astype(np.int32), accepts[chosen].astype(np.int32))


class Backwards:
    """Finds where a match that ends at a given place starts: the reversed rule, determinised as it is met."""

    def __init__(self, pattern: str):
        self.nfa, start, end = parse(pattern)
        flipped = Nfa([[] for _ in self.nfa.edges], [[] for _ in self.nfa.empty])
        for s, edges in enumerate(self.nfa.edges):
            for allowed, t in edges:
                flipped.edges[t].append((allowed, s))
        for s, targets in enumerate(self.nfa.empty):
            for t in targets:
                flipped.empty[t].append(s)
        self.nfa, self.goal, self.fresh, self.known = flipped, start, flipped.closure({end}), {}

    def start(self, data: bytes, end: int, least: int) -> int:
        """The smallest start not below ``least`` of a match that ends before ``end``."""
        states, best, i = self.fresh, -1, end
        while i > least and states:
            i -= 1
            key = (states, data[i])
            if key not in self.known:
                self.known[key] = self.nfa.step(*key)
            states = self.known[key]
            if self.goal in states:
                best = i
        return best
