"""Rule regexes compiled into one deterministic automaton over bytes.

A rule's regex goes to a nondeterministic automaton piece by piece; all rules together go through subset construction
and minimisation into one transition array, so that one pass over the bytes of a text runs every rule. The syntax is the
small common part: literals, escapes, classes, groups (``(?i:`` for either case), ``|``, ``?``, ``*``, ``+``, ``{m,n}``.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass, field

import numpy as np

NONE = -1


@dataclass
class Nfa:
    """States with byte-set arcs and empty arcs; built back to front for the reversed language."""

    reverse: bool = False
    arcs: list[list[tuple[frozenset, int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.arcs.append([])
        self.empty.append([])
        return len(self.arcs) - 1

    def build(self, tree: tuple, start: int) -> int:
        """Add ``tree`` after state ``start`` and return where it ends."""
        kind, *rest = tree
        if kind == "set":
            end = self.state()
            self.arcs[start].append((rest[0], end))
            return end
        if kind == "seq":
            for part in reversed(rest[0]) if self.reverse else rest[0]:
                start = self.build(part, start)
            return start
        if kind == "any":
            end = self.state()
            for part in rest[0]:
                self.empty[self.build(part, self._after(start))].append(end)
            return end
        part, least, most = rest
        for _ in range(least):
            start = self.build(part, start)
        if most is None:
            loop = self._after(start)
            self.empty[self.build(part, loop)].append(loop)
            return self._after(loop)
        end = self.state()
        for _ in range(most - least):
            self.empty[start].append(end)
            start = self.build(part, start)
        self.empty[start].append(end)
        return end

    def _after(self, start: int) -> int:
        new = self.state()
        self.empty[start].append(new)
        return new

    def closure(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for nxt in self.empty[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)


def parse(pattern: str) -> tuple:
    tree, end = _branches(pattern, 0, False)
    if end != len(pattern):
        raise ValueError(f"unbalanced ) in {pattern!r}")
    return tree


def _branches(p: str, i: int, either: bool) -> tuple[tuple, int]:
    options, parts = [], []
    while i < len(p) and p[i] != ")":
        if p[i] == "|":
            options.append(("seq", parts))
            parts, i = [], i + 1
            continue
        part, i = _atom(p, i, either)
        least, most, i = _times(p, i)
        parts.append(part if (least, most) == (1, 1) else ("repeat", part, least, most))
    options.append(("seq", parts))
    return (options[0] if len(options) == 1 else ("any", options)), i


def _atom(p: str, i: int, either: bool) -> tuple[tuple, int]:
    if p[i] == "(":
        either = either or p.startswith("(?i:", i)
        i += 4 if p.startswith("(?i:", i) else 3 if p.startswith("(?:", i) else 1
        tree, i = _branches(p, i, either)
        return tree, i + 1
    if p[i] == "[":
        return _byte_class(p, i + 1)
    i += p[i] == "\\"
    letter = p[i]
    return ("set", frozenset(map(ord, {letter.lower(), letter.upper()} if either else {letter}))), i + 1


def _byte_class(p: str, i: int) -> tuple[tuple, int]:
    found: set[int] = set()
    while p[i] != "]":
        i += p[i] == "\\"
        low = high = ord(p[i])
        if p[i + 1] == "-" and p[i + 2] != "]":
            high = ord(p[i + 2])
            i += 2
        found.update(range(low, high + 1))
        i += 1
    return ("set", frozenset(found)), i + 1


def _times(p: str, i: int) -> tuple[int, int | None, int]:
    if i < len(p) and p[i] in "?*+":
        return {"?": (0, 1), "*": (0, None), "+": (1, None)}[p[i]] + (i + 1,)
    if i < len(p) and p[i] == "{":
        end = p.index("}", i)
        low, comma, high = p[i + 1 : end].partition(",")
        return int(low), (int(high) if high else None) if comma else int(low), end + 1
    return 1, 1, i


@dataclass
class Dfa:
    """``next[state + byte]`` is the next state; states are multiples of 256, and those from ``accepting`` on accept.

    ``rules`` tells which rules an accepting state is the end of. ``dead`` is the state nothing leaves, if there is one.
    """

    next: array
    start: int
    accepting: int
    rules: dict[int, tuple[int, ...]]
    dead: int


def compile_rules(patterns: list[str], anywhere: bool = True, reverse: bool = False) -> Dfa:
    """One automaton for all patterns. ``anywhere`` lets a match begin at every byte; ``reverse`` reads backwards."""
    nfa = Nfa(reverse)
    start = nfa.state()
    ends = {nfa.build(parse(p), nfa._after(start)): k for k, p in enumerate(patterns)}
    # Bytes that no arc tells apart share a column.
    sets = {s for arcs in nfa.arcs for s, _ in arcs}
    columns: dict[tuple, int] = {}
    column_of = [columns.setdefault(tuple(b in s for s in sets), len(columns)) for b in range(256)]
    example = {c: b for b, c in enumerate(column_of)}

    first = nfa.closure({start})
    number, order, rows = {first: 0}, [first], []
    for states in order:  # grows while it is read
        row = []
        for c in range(len(columns)):
            met = {end for s in states for on, end in nfa.arcs[s] if example[c] in on}
            to = nfa.closure(met | {start} if anywhere else met)
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        rows.append(row)
    accepts = [tuple(sorted(ends[s] for s in states if s in ends)) for states in order]
    table = np.array(rows)

    # Minimisation: split blocks of states until all of a block go to the same blocks.
    kinds = {kind: i for i, kind in enumerate(sorted(set(accepts)))}
    block = np.array([kinds[a] for a in accepts])
    while True:
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        if finer.max() == block.max():
            break
        block = finer.ravel()
    one_of = {b: i for i, b in enumerate(block.tolist())}
    ranked = sorted(one_of, key=lambda b: (bool(accepts[one_of[b]]), b))
    place = {b: i * 256 for i, b in enumerate(ranked)}
    flat = array("q", (place[block[table[one_of[b], column_of[byte]]]] for b in ranked for byte in range(256)))
    rules = {place[b]: accepts[one_of[b]] for b in ranked if accepts[one_of[b]]}
    accepting = min(rules, default=len(flat))
    dead = next((place[b] for b in ranked if not accepts[one_of[b]] and set(block[table[one_of[b]]]) == {b}), NONE)
    return Dfa(flat, place[block[0]], accepting, rules, dead)
