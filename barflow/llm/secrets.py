"""Secret scans: match ends of all rules from one pass of a combined automaton, starts from its reverse."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from barflow.llm.automaton import Automaton, compile_rules
from barflow.llm.frames import map_texts


@dataclass(frozen=True)
class Rule:
    """Matches are a ``head``, then as many ``tail`` characters as follow, one at least.

    They are taken leftmost first and do not overlap; those with a tail of under ``least`` characters fail.
    A head must not hold a whole match of its own rule.
    """

    kind: str
    head: str
    tail: str
    least: int

    @property
    def pattern(self) -> str:
        return f"{self.head}{self.tail}+"


# The base kinds, in order, then what this scan adds.
ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
RULES = (
    Rule("assign", ASSIGN, "[A-Za-z0-9+/_.=-]", 8),
    Rule("access", "AKIA", "[A-Z0-9]", 12),
    Rule("hex", "", "[0-9a-f]", 32),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY", "-", 5),
    Rule("hosting", "gh[pousr]_", "[A-Za-z0-9]", 36),
)
BASE = 3


class Scanner:
    """The combined automaton of all rules, and its reverse, which leads from the end of a match back to its start."""

    def __init__(self, rules=RULES):
        self.rules = rules
        self.combined: Automaton = compile_rules([r.pattern for r in rules])
        self.bits = self.combined.accepts.astype(np.uint8)
        self.step, self.class_of = self.combined.step.tolist(), self.combined.class_of.tolist()
        back = compile_rules([r.pattern for r in rules], anchored=True, backwards=True)
        self.back = (back.step.tolist(), back.class_of.tolist(), back.start * back.classes)
        by_place = lambda bits: np.repeat(bits, back.classes).tolist()  # states are counted in steps of ``classes``
        self.begins, self.alive = by_place(back.accepts), by_place(back.alive())

    def read(self, texts: list[bytes]) -> tuple[list[int], np.ndarray]:
        """Which rules (as bits) see a long enough tail in each text, and the states behind all bytes, in one pass.

        Texts are followed by a line feed each. Behind each byte of a tail the automaton accepts, so a tail of n bytes is n accepting states in a row.
        """
        states = self.combined.states(b"\n".join(texts) + b"\n")
        accepting = {1: self.bits[states]}  # by length: where so many accepting states in a row begin
        for size in (1, 2, 4, 8, 16):
            shorter = accepting[size]
            accepting[2 * size] = shorter[: max(len(shorter) - size, 0)] & shorter[size:]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        hit = np.zeros(len(texts), np.int64)
        for k, rule in enumerate(self.rules):
            size = 1 << min(rule.least.bit_length() - 1, 5)
            rows, step = accepting[size], rule.least - size
            rows = rows[: max(len(rows) - step, 0)] & rows[step:]  # exact up to twice the longest size kept
            at = np.flatnonzero(rows & np.uint8(1 << k))
            hit[np.searchsorted(ends, at, "right")] |= 1 << k
        return hit.tolist(), states

    def begin(self, data: bytes, rule: int, end: int, least: int) -> int:
        """The leftmost byte from ``least`` on where a match begins of which ``end`` - 1 is the last byte; -1 if none."""
        (step, class_of, state), bit, found = self.back, 1 << rule, -1
        for i in range(end - 1, least - 1, -1):
            state = step[state + class_of[data[i]]]
            if self.begins[state] & bit:
                found = i
            elif not self.alive[state] & bit:
                break
        return found

    def spans(self, data: bytes, rule: int, states: np.ndarray) -> list[tuple[int, int]]:
        """Byte spans of one rule, leftmost first, each on behind the one before.

        ``states`` are those of the combined pass. A match ends with each byte of a run of accepting states, and the
        first match that ends in a run goes on to the run's end. If all matches that end at its first byte begin
        within the span before, the pass is taken up again from the start state behind that span.
        """
        accepting = np.concatenate([[0], self.bits[states] >> rule & 1, [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(accepting))
        least, bit, classes, free, out = self.rules[rule].least, 1 << rule, self.combined.classes, 0, []
        for first, end in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            at = self.begin(data, rule, first + 1, free)
            if at < 0:
                state, first = self.combined.start * classes, -1
                for i in range(free, end):
                    state = self.step[state + self.class_of[data[i]]]
                    if self.bits[state // classes] & bit:
                        first, at = i, self.begin(data, rule, i + 1, free)
                        break
                if first < 0:
                    continue
            # bytes of the tail: those from the first end on
            if end - first >= least:
                out.append((at, end))
            free = end
        return out


def find_secrets(scanner: Scanner, texts: list) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of each text, by start, then by the order of the rules; code points, end exclusive."""
    found: list[list] = [[] for _ in texts]
    raw = [(t or "").encode("utf-8") for t in texts]
    at, size = 0, 0
    for upto in range(1, len(raw) + 1):
        size += len(raw[upto - 1])
        if size < 1 << 22 and upto < len(raw):
            continue
        hits, states = scanner.read(raw[at:upto])
        first = 0
        for i, bits in enumerate(hits, at):
            data = raw[i]
            if bits:
                own = states[first : first + len(data)]
                spans = [(s, k, e) for k in range(len(scanner.rules)) if bits >> k & 1 for s, e in scanner.spans(data, k, own)]
                place = characters(data, {x for s, _, e in spans for x in (s, e)})
                found[i] += [(scanner.rules[k].kind, place[s], place[e]) for s, k, e in sorted(spans)]
            first += len(data) + 1
        at, size = upto, 0
    return found


def characters(data: bytes, places: set) -> dict[int, int]:
    """Byte offsets to code points, in one walk over the text."""
    out, at, n = {}, 0, 0
    for place in sorted(places):
        n += len(data[at:place].decode("utf-8"))
        out[place], at = n, place
    return out


def scan(docs: DataFrame, text: str = "text", keep=("doc_id",), rules=RULES) -> DataFrame:
    """``keep`` columns and ``secrets``, an array of (kind, start, end), for every whole text.

    The automaton is built once on the driver and sent with the function; documents are scanned where they
    are. Null texts count as empty and have none; very long ones are read whole, in one pass; repeated rows are
    scanned one by one; spans of one start come in the order of the rules; an empty table gives an empty one. Of
    other columns only ``keep`` is read; one named ``secrets`` there is refused.
    """
    scanner = Scanner(rules)

    def run(texts):
        return {"secrets": [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in find_secrets(scanner, texts)]}

    return map_texts(docs, run, "secrets array<struct<kind:string,start:int,end:int>>", text, keep)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    scanner, base = Scanner(), [r.kind for r in RULES[:BASE]]

    def run(texts):
        found = find_secrets(scanner, texts)
        line = lambda x: ",".join(f"{k}:{s}:{e}" for k, s, e in x)
        own = [line(y for y in x if y[0] in base) for x in found]
        made = {f"n_{kind}": [sum(y[0] == kind for y in x) for x in found] for kind in base}
        digests = [hashlib.sha256(o.encode()).hexdigest() for o in own]
        return made | {"base_sha256": digests, "spans": [line(x) for x in found]}

    return map_texts(docs, run, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
