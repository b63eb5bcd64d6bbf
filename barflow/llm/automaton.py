"""Rule regexes compiled into one deterministic byte automaton, run over many stretches of text at once."""

from __future__ import annotations

import re._constants as C
import re._parser as regex_parser
from dataclasses import dataclass

import numpy as np

LANES = 4096  # stretches of text that advance together


class _Nfa:
    """Thompson's construction: states with byte sets to a next state, and empty moves; ``backwards`` reads rules from their end."""

    def __init__(self, backwards: bool = False):
        self.backwards = backwards
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def read(self, at: int, allowed) -> int:
        to = self.state()
        self.moves[at].append((frozenset(allowed), to))
        return to

    def add(self, items, at: int, flags: int) -> int:
        for op, arg in reversed(items) if self.backwards else items:
            at = self.add_one(op, arg, at, flags)
        return at

    def add_one(self, op, arg, at: int, flags: int) -> int:
        if op is C.LITERAL:
            return self.read(at, _cased({arg}, flags))
        if op is C.IN:
            return self.read(at, _cased(_members(arg), flags))
        if op is C.SUBPATTERN:
            _, more, less, items = arg
            return self.add(items, at, (flags | more) & ~less)
        if op is C.BRANCH:
            end = self.state()
            for items in arg[1]:
                self.empty[self.add(items, at, flags)].append(end)
            return end
        if op is C.MAX_REPEAT:
            least, most, items = arg
            for _ in range(least):
                at = self.add(items, at, flags)
            if most == C.MAXREPEAT:
                head = self.state()
                self.empty[at].append(head)
                self.empty[self.add(items, head, flags)].append(head)
                return head
            end = self.state()
            for _ in range(most - least):
                self.empty[at].append(end)
                at = self.add(items, at, flags)
            self.empty[at].append(end)
            return end
        raise ValueError(f"rules may not use {op}")

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def _members(items) -> set:
    out: set = set()
    for op, arg in items:
        if op is C.LITERAL:
            out.add(arg)
        elif op is C.RANGE:
            out.update(range(arg[0], arg[1] + 1))
        else:
            raise ValueError(f"character sets may not use {op}")
    return out


def _cased(codes: set, flags: int) -> set:
    if flags & C.SRE_FLAG_IGNORECASE:
        codes = codes | {ord(chr(c).swapcase()) for c in codes if chr(c).isascii() and chr(c).isalpha()}
    if max(codes) > 127:
        raise ValueError("rules are over ASCII characters")
    return codes


@dataclass
class Automaton:
    """``step[state * classes + class_of[byte]]`` is the next state times ``classes``.

    States from ``first_accepting`` on accept; ``accepts`` tells which rules, as bits, by state.
    """

    step: np.ndarray
    class_of: np.ndarray
    classes: int
    first_accepting: int
    accepts: np.ndarray
    start: int

    def states(self, data: bytes) -> np.ndarray:
        """The state behind every byte of ``data``, in one pass.

        The text is cut into stretches that advance together, each from the start state; a stretch that
        ought to begin elsewhere is run again from there until it meets the states already found.
        """
        n = len(data)
        rows = max(1, -(-n // LANES))
        lanes = -(-n // rows)
        columns = np.zeros(rows * lanes, np.uint8)
        columns[:n] = self.class_of[np.frombuffer(data, np.uint8)]
        grid = np.ascontiguousarray(columns.reshape(lanes, rows).T)
        found = np.empty((rows, lanes), np.int32)
        state, at = np.full(lanes, self.start * self.classes, np.int32), np.empty(lanes, np.int32)
        for i in range(rows):
            np.add(state, grid[i], out=at)
            np.take(self.step, at, out=state)
            found[i] = state
        wrong = np.arange(1, lanes)
        wrong = wrong[found[-1, wrong - 1] != self.start * self.classes]
        while len(wrong):
            state, open_lanes, changed = found[-1, wrong - 1], wrong, np.zeros(lanes, bool)
            for i in range(rows):
                state = self.step[state + grid[i, open_lanes]]
                differs = state != found[i, open_lanes]
                if not differs.all():
                    open_lanes, state = open_lanes[differs], state[differs]
                    if not len(open_lanes):
                        break
                found[i, open_lanes] = state
            changed[open_lanes] = True  # those whose last state changed make the next one wrong
            wrong = np.flatnonzero(changed[:-1]) + 1
        return found.T.ravel()[:n] // self.classes

    def alive(self) -> np.ndarray:
        """Which rules, as bits, may still be accepted from each state."""
        table, bits = self.step.reshape(-1, self.classes) // self.classes, self.accepts.copy()
        while True:
            more = bits | np.bitwise_or.reduce(bits[table], axis=1)
            if (more == bits).all():
                return bits
            bits = more


def compile_rules(rules: list[str], anchored: bool = False, backwards: bool = False) -> Automaton:
    """One minimal deterministic automaton for all rules.

    Unanchored, a state accepts a rule if some match of it ends there. A line feed must not be part of a rule,
    so it leads back to the start. Byte values that no rule tells apart share a class. Anchored, only matches from
    the first byte on count. ``backwards``, the bytes are given from the last to the first.
    """
    nfa, ends = _Nfa(backwards), {}
    begin = nfa.state()
    for i, rule in enumerate(rules):
        parsed = regex_parser.parse(rule)
        first = nfa.state()
        nfa.empty[begin].append(first)
        ends[nfa.add(parsed, first, parsed.state.flags)] = 1 << i
    sets = sorted({s for moves in nfa.moves for s, _ in moves}, key=sorted)
    kinds: dict[tuple, int] = {}
    class_of = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)], np.uint8)
    sample = [int(np.flatnonzero(class_of == k)[0]) for k in range(len(kinds))]
    if any(10 in s for s in sets):
        raise ValueError("rules may not match line feeds")

    # subset construction
    restart = frozenset() if anchored else nfa.closure([begin])
    first = nfa.closure([begin])
    number, todo, table = {first: 0}, [first], []
    for current in todo:
        line = []
        for byte in sample:
            reached = {to for s in current for allowed, to in nfa.moves[s] if byte in allowed}
            following = nfa.closure(reached) | restart
            if following not in number:
                number[following] = len(todo)
                todo.append(following)
            line.append(number[following])
        table.append(line)
    step = np.array(table)
    accepts = np.array([sum(bit for end, bit in ends.items() if end in states) for states in todo])

    # minimisation: split classes of states until equal states have equal successors
    part = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([part, part[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    keep = np.unique(part, return_index=True)[1]
    accepts, step = accepts[keep], part[step[keep]]
    order = np.argsort(accepts > 0, kind="stable")  # accepting states last
    place = np.argsort(order)
    step, accepts = place[step[order]], accepts[order]
    width = len(kinds)
    return Automaton(
        (step * width).ravel().astype(np.int32), class_of, width, int((accepts == 0).sum()), accepts, int(place[part[0]])
    )
