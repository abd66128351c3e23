"""Secret scan by one combined deterministic automaton.

Rule regexes become nondeterministic automata over bytes. Subset construction runs all of them side by side: a combined
state holds, for each rule, the threads that started at different places, earliest first (leftmost wins; once a rule has
matched only that thread goes on). States are minimised by partition refinement and written as transition arrays over
byte classes. A text is then scanned once, one table step for each byte, whatever the number of rules; a step that ends a
match carries an event, and a short walk back through the reversed rule gives the match's start.

Rules must be plain: classes, groups, alternation and repeats; a match can only be lengthened a byte at a time once it
is complete (``build`` raises otherwise), which holds for "prefix, then a run of token characters".

Defined cases: a null text is an empty text; offsets count code points; a text is read whole at any length; repeated
rows are rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sommelix.llm.common import per_text


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1  # characters of the group
    ignore_case: bool = False


BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # a run of hex digits counts from 24 on; asking for 24 in the automaton keeps short runs from ending matches
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("private_key", r"-----BEGIN [A-Z ]+-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
)
RULES = BASE_RULES + MORE_RULES


class Nfa:
    """Thompson automaton of one rule: byte edges and empty edges; state 0 starts, ``final`` accepts."""

    def __init__(self, rule: Rule):
        self.edges: list[list[tuple[frozenset, int]]] = [[]]
        self.empty: list[list[int]] = [[]]
        self.fold = rule.ignore_case
        self.final = self._chain(parser.parse(rule.pattern), 0)
        self.start = self.closed({0})
        back: list[list[tuple[frozenset, int]]] = [[] for _ in self.edges]
        back_empty: list[list[int]] = [[] for _ in self.edges]
        for a, out in enumerate(self.edges):
            for to, b in out:
                back[b].append((to, a))
        for a, out in enumerate(self.empty):
            for b in out:
                back_empty[b].append(a)
        self.back, self.back_empty = back, back_empty

    def _new(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def _set(self, items) -> frozenset:
        found: set[int] = set()
        negate = False
        for op, arg in items:
            if op is sre.NEGATE:
                negate = True
            elif op is sre.LITERAL:
                found.add(arg)
            elif op is sre.RANGE:
                found.update(range(arg[0], arg[1] + 1))
            else:
                raise ValueError(f"unsupported in a class: {op}")
        if self.fold:
            found |= {ord(chr(c).swapcase()) for c in found if c < 128 and chr(c).isalpha()}
        if max(found, default=0) > 127:
            raise ValueError("rules are over ASCII")
        return frozenset(set(range(256)) - found if negate else found)

    def _chain(self, nodes, at: int) -> int:
        for op, arg in nodes:
            if op in (sre.LITERAL, sre.IN, sre.NOT_LITERAL):
                to = self._new()
                items = arg if op is sre.IN else [(sre.LITERAL, arg)]
                items = [(sre.NEGATE, None), *items] if op is sre.NOT_LITERAL else items
                self.edges[at].append((self._set(items), to))
                at = to
            elif op is sre.SUBPATTERN:
                at = self._chain(arg[3], at)
            elif op is sre.BRANCH:
                end = self._new()
                for branch in arg[1]:
                    first = self._new()
                    self.empty[at].append(first)
                    self.empty[self._chain(branch, first)].append(end)
                at = end
            elif op is sre.MAX_REPEAT:
                low, high, what = arg
                for _ in range(low):
                    at = self._chain(what, at)
                if high == sre.MAXREPEAT:
                    loop = self._new()
                    self.empty[at].append(loop)
                    self.empty[self._chain(what, loop)].append(loop)
                    at = loop
                else:
                    end = self._new()
                    for _ in range(high - low):
                        self.empty[at].append(end)
                        at = self._chain(what, at)
                    self.empty[at].append(end)
                    at = end
            else:
                raise ValueError(f"unsupported in a rule: {op}")
        return at

    @staticmethod
    def _close(states: set[int], empty: list[list[int]]) -> frozenset:
        todo = list(states)
        while todo:
            for to in empty[todo.pop()]:
                if to not in states:
                    states.add(to)
                    todo.append(to)
        return frozenset(states)

    def closed(self, states: set[int]) -> frozenset:
        return self._close(states, self.empty)

    def move(self, states: frozenset, byte: int) -> frozenset:
        return self.closed({to for s in states for on, to in self.edges[s] if byte in on})

    def first_start(self, data: bytes, low: int, end: int) -> int:
        """The leftmost start, not before low, of a match that ends at end."""
        states, found, at = self._close({self.final}, self.back_empty), -1, end
        while states:
            if 0 in states:
                found = at
            if at == low:
                break
            at -= 1
            byte = data[at]
            states = self._close({a for s in states for on, a in self.back[s] if byte in on}, self.back_empty)
        return found


def _step(nfa: Nfa, state: tuple, byte: int) -> tuple[tuple, bool]:
    """A rule's next (threads, matched), and whether a match has just ended before this byte."""
    threads, matched = state
    if matched:
        on = nfa.move(threads[0], byte)
        if on:
            if nfa.final not in on:
                raise ValueError("a complete match must grow a byte at a time")
            return ((on,), True), False
        threads = ()
    seen: set[int] = set()
    out: list[frozenset] = []
    for states in [*(nfa.move(t, byte) for t in threads), nfa.move(nfa.start, byte)]:
        if new := frozenset(states - seen):
            if nfa.final in new:
                if out:
                    raise ValueError("an earlier start is open while a later one matches")
                return ((new,), True), matched
            out.append(new)
            seen |= new
    return (tuple(out), False), matched


@dataclass(frozen=True)
class Automaton:
    """rows[state][byte class]: the next state, or ~next where matches end; ends[state, class]: rules that end there."""

    rules: tuple[Rule, ...]
    classes: bytes
    rows: list[list[int]]
    ends: dict[tuple[int, int], tuple[int, ...]]

    @property
    def end_class(self) -> int:
        return len(self.rows[0]) - 1


def _minimised(nexts: np.ndarray, events: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block of each state (state 0 in block 0) and a state of each block; blocks are split until all is stable."""
    _, block = np.unique(events, axis=0, return_inverse=True)
    while True:
        _, again = np.unique(np.column_stack([block, block[nexts]]), axis=0, return_inverse=True)
        if again.max() == block.max():
            break
        block = again
    order = np.argsort(np.unique(block, return_index=True)[1], kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    block = rank[block]
    return block, np.unique(block, return_index=True)[1]


def build(rules: tuple[Rule, ...] = RULES) -> Automaton:
    """Subset construction over all rules, then minimisation."""
    nfas = [Nfa(r) for r in rules]
    sets = sorted({on for n in nfas for out in n.edges for on, _ in out}, key=sorted)
    kinds: dict[tuple, int] = {}
    classes = bytes(kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256))
    sample = [classes.index(k) for k in range(len(kinds))]  # a byte of each class
    n_classes = len(kinds) + 1  # the last class ends the text
    steps: list[dict] = [{} for _ in rules]
    fresh = tuple(((), False) for _ in rules)
    ids, todo, nexts, events = {fresh: 0}, [fresh], [], []
    event_ids: dict[tuple, int] = {(): 0}
    for state in todo:
        row, marks = [], []
        for k, byte in enumerate(sample):
            to, over = [], []
            for r, (nfa, own) in enumerate(zip(nfas, state)):
                if (own, k) not in steps[r]:
                    steps[r][own, k] = _step(nfa, own, byte)
                then, ended = steps[r][own, k]
                to.append(then)
                if ended:
                    over.append(r)
            if (to := tuple(to)) not in ids:
                ids[to] = len(ids)
                todo.append(to)
            row.append(ids[to])
            marks.append(event_ids.setdefault(tuple(over), len(event_ids)))
        row.append(0)
        marks.append(event_ids.setdefault(tuple(r for r, s in enumerate(state) if s[1]), len(event_ids)))
        nexts.append(row)
        events.append(marks)
    nexts, events = np.array(nexts), np.array(events)
    block, one_of = _minimised(nexts, events)
    named = list(event_ids)
    rows, ends = [], {}
    for b, s in enumerate(one_of):
        row = []
        for k in range(n_classes):
            to = int(block[nexts[s, k]])
            if over := named[events[s, k]]:
                ends[b, k] = over
                to = ~to
            row.append(to)
        rows.append(row)
    return Automaton(tuple(rules), classes, rows, ends)


class Scanner:
    """Scans texts with an automaton; matches that fail their rule's length are dropped after the scan."""

    def __init__(self, automaton: Automaton):
        self.a = automaton
        self.nfas = [Nfa(r) for r in automaton.rules]
        self.regexes = [re.compile(r.pattern.encode(), re.IGNORECASE * r.ignore_case) for r in automaton.rules]
        self.end = bytes([automaton.end_class])

    def __call__(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, rule number, end) in code points, ordered."""
        data = (text or "").encode("utf-8", "surrogatepass")
        rows, ends = self.a.rows, self.a.ends
        codes = iter(data.translate(self.a.classes) + self.end)
        size, state, found = len(data), 0, []
        last = [0] * len(self.nfas)
        for k in codes:
            to = rows[state][k]
            if to < 0:
                to = ~to
                at = size - codes.__length_hint__()
                for r in ends[state, k]:
                    start = self.nfas[r].first_start(data, last[r], at)
                    last[r] = at
                    found.append((start, r, at))
            state = to
        good = []
        for start, r, at in found:
            rule = self.a.rules[r]
            if len(self.regexes[r].fullmatch(data, start, at)[rule.group]) >= rule.at_least:
                good.append((start, r, at))
        if good and not data.isascii():  # bytes to code points: continuation bytes do not count
            heads = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            place = lambda p: int(heads[p - 1]) if p else 0
            good = [(place(s), r, place(e)) for s, r, e in good]
        return sorted(good)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and the spans (kind, start, end) of every document, ordered by start, then by rule."""
    automaton = build(rules)

    def make():
        scanner = Scanner(automaton)

        def scan(texts):
            return [[[(rules[r].kind, s, e) for s, r, e in scanner(text)] for text in texts]]

        return scan

    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    found = per_text(docs, make, {"spans": ("array<struct<kind:string,start:bigint,end:bigint>>", span)}, ("doc_id",))
    return found.select("row.doc_id", "spans")


def op1_secret_scan(spark, sf_dir) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return found.selectExpr(
        "doc_id",
        *[f"CAST(size(filter(spans, s -> s.kind = '{r.kind}')) AS BIGINT) AS n_{r.kind}" for r in BASE_RULES],
        f"sha2({joined.format(f'filter(spans, s -> s.kind IN ({base}))')}, 256) AS base_sha256",
        f"{joined.format('spans')} AS spans",
    )
