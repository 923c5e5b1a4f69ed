"""Secret scans with one deterministic automaton for all rules.

Rules are built from small combinators, turned into one automaton each by subset
construction with leftmost-longest semantics, multiplied into a combined automaton that
restarts each rule behind its match, and minimised. The result is one transition array over
byte classes; one pass over the bytes of a text serves all rules.

Bytes that no rule can contain put every state back to the start, so a text may be cut behind
each of them without changing the result. The pieces of a batch are scanned side by side: step
t moves all pieces that are longer than t by one array look-up.

The automaton reports where matches end. Their starts come from running a rule's reversed
automaton backwards from there, down to the end of the rule's match before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.shared import small_batches
from ledgerflow.llm.textbytes import pieces, string_buffers

# A rule is a tree: ("set", bytes) | ("seq", parts) | ("alt", parts) | ("opt", part) | ("plus", part)


def chars(text: str) -> tuple:
    return ("set", frozenset(text.encode()))


def word(text: str, any_case: bool = False) -> tuple:
    return ("seq", [("set", frozenset((c.lower() + c.upper()).encode() if any_case else c.encode())) for c in text])


def seq(*parts: tuple) -> tuple:
    return ("seq", list(parts))


def alt(*parts: tuple) -> tuple:
    return ("alt", list(parts))


def opt(part: tuple) -> tuple:
    return ("opt", part)


def plus(part: tuple) -> tuple:
    return ("plus", part)


def times(part: tuple, least: int) -> tuple:
    """part at least ``least`` times."""
    return seq(*[part] * (least - 1), plus(part))


DIGIT, UP, LOW = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VALUE = UP + LOW + DIGIT + "+/_.=-"
_QUOTE, _SPACES = opt(chars("\"'")), opt(plus(chars(" ")))

#: Base kinds, in the order of the contract.
BASE_RULES = {
    "assign": seq(
        alt(word("password", True), word("passwd", True), word("secret", True), word("token", True), seq(word("api", True), opt(chars("_")), word("key", True))),
        _QUOTE, _SPACES, chars(":="), _SPACES, _QUOTE, plus(chars(_VALUE)),
    ),
    "access": seq(word("AKIA"), plus(chars(UP + DIGIT))),
    "hex": times(chars(DIGIT + "abcdef"), 24),
}
#: Further kinds: forge tokens and private key headers.
MORE_RULES = {
    "forge": seq(word("gh"), chars("pousr"), word("_"), plus(chars(UP + LOW + DIGIT))),
    "pem": seq(word("-----BEGIN "), opt(plus(chars(UP + " "))), word("PRIVATE KEY-----")),
}
KINDS = [*BASE_RULES, *MORE_RULES]
#: Characters that a match has at least, and those of the value of an assignment. A shorter match
#: is dropped and still ends the search before it. Only hex counts in the automaton, because its
#: short matches are in every text.
LEAST = {"access": 20, "forge": 34}
LEAST_VALUE = 6


class _Nfa:
    def __init__(self) -> None:
        self.steps: list[list[tuple[frozenset | None, int]]] = []

    def state(self) -> int:
        self.steps.append([])
        return len(self.steps) - 1

    def build(self, rule: tuple, start: int, reverse: bool) -> int:
        """Add the rule behind start; its end state."""
        kind, body = rule
        if kind == "set":
            end = self.state()
            self.steps[start].append((body, end))
            return end
        if kind == "seq":
            for part in reversed(body) if reverse else body:
                start = self.build(part, start, reverse)
            return start
        end = self.state()
        for part in body if kind == "alt" else [body]:
            first = self.state()
            self.steps[start].append((None, first))
            last = self.build(part, first, reverse)
            self.steps[last].append((None, end))
            if kind == "plus":
                self.steps[last].append((None, first))
        if kind == "opt":
            self.steps[start].append((None, end))
        return end

    def closure(self, states: frozenset) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for over, to in self.steps[todo.pop()]:
                if over is None and to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def move(self, states: frozenset, byte: int) -> frozenset:
        return self.closure(frozenset(to for s in states for over, to in self.steps[s] if over and byte in over))


def _compile(rule: tuple, reverse: bool) -> tuple[_Nfa, frozenset, int]:
    nfa = _Nfa()
    start = nfa.state()
    end = nfa.build(rule, start, reverse)
    return nfa, nfa.closure(frozenset([start])), end


def _sets(rule: tuple) -> set[frozenset]:
    kind, body = rule
    if kind == "set":
        return {body}
    return set().union(*(_sets(p) for p in body)) if kind in ("seq", "alt") else _sets(body)


class _Leftmost:
    """Steps of one rule over a text: threads by start, earliest first; a match drops all later ones."""

    def __init__(self, rule: tuple) -> None:
        self.nfa, self.first, self.end = _compile(rule, reverse=False)
        self.idle: tuple = ((), False)

    def _advance(self, threads: tuple, byte: int) -> tuple[tuple, bool]:
        """(threads after byte, does the earliest one match here?); a thread keeps only states no earlier one has."""
        out: list[frozenset] = []
        taken: set[int] = set()
        for states in (*threads, self.first):
            now = self.nfa.move(states, byte) - taken
            if now:
                out.append(now)
                taken |= now
        return tuple(out), bool(out) and self.end in out[0]

    def step(self, state: tuple, byte: int) -> tuple[tuple, bool]:
        """(state, does a match end before this byte?). A state is (threads, has the earliest thread matched?)."""
        threads, matched = state
        if not matched:
            out, hit = self._advance(threads, byte)
            if hit:
                return ((out[0],), True), False
            # a later thread may match first; its match stands only if all earlier ones die
            return (out, False), False
        now = self.nfa.move(threads[0], byte)
        if now:
            # every rule here keeps matching once it matches, until it dies
            assert self.end in now
            return ((now,), True), False
        out, hit = self._advance((), byte)
        return ((out[:1], True) if hit else (out, False)), True


EVENT = 1 << 24
#: Pieces left at which array steps give way to a plain loop.
FEW = 64


class Automaton:
    """step[state * classes + class]: next state (times classes), plus EVENT times the kinds that end before the byte."""

    def __init__(self, rules: dict[str, tuple]) -> None:
        self.kinds = list(rules)
        machines = [_Leftmost(r) for r in rules.values()]
        sets = sorted(set().union(*(_sets(r) for r in rules.values())), key=sorted)
        signature = [tuple(b in s for s in sets) for b in range(256)]
        groups = sorted(set(signature))
        self.byte_class = np.array([groups.index(s) for s in signature], np.uint8)
        self.sync = np.array([not any(s) for s in signature])
        example = [signature.index(g) for g in groups]
        memo: dict = {}
        start = tuple(m.idle for m in machines)
        states, table, events = {start: 0}, [], []
        todo = [start]
        for state in todo:
            row, ends = [], []
            for byte in example:
                moved = []
                for k, (m, s) in enumerate(zip(machines, state, strict=True)):
                    if (k, s, byte) not in memo:
                        memo[k, s, byte] = m.step(s, byte)
                    moved.append(memo[k, s, byte])
                to = tuple(x for x, _ in moved)
                if to not in states:
                    states[to] = len(states)
                    todo.append(to)
                row.append(states[to])
                ends.append(sum(1 << k for k, (_, e) in enumerate(moved) if e))
            table.append(row)
            events.append(ends)
        self._minimise(np.array(table), np.array(events))
        self.backward = [_backward(r) for r in rules.values()]

    def _minimise(self, table: np.ndarray, events: np.ndarray) -> None:
        """Merge states that no continuation tells apart (partition refinement by Moore)."""
        block = np.unique(events, axis=0, return_inverse=True)[1].ravel()
        while True:
            finer = np.unique(np.column_stack([block[:, None], block[table]]), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == block.max():
                break
            block = finer
        first = np.unique(block, return_index=True)[1]
        order = np.argsort(first)  # the start state stays number 0
        number = np.argsort(order)
        classes = table.shape[1]
        self.classes, self.states = classes, len(first)
        self.step = (number[block[table[first[order]]]] * classes + events[first[order]] * EVENT).astype(np.int32).ravel()
        self.plain = self.step.tolist()

    def _tail(self, state: int, codes: list[int]) -> list[tuple[int, int]]:
        step, found = self.plain, []
        for i, c in enumerate(codes):
            state = step[state + c]
            if state >= EVENT:
                found.append((i, state // EVENT))
                state &= EVENT - 1
        return found

    def ends(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, kinds as bits) of the places behind which matches ended; data ends each row with a sync byte."""
        n = len(data)
        cut = self.sync[data]
        cut[offsets[1:] - 1] = True
        stop = np.flatnonzero(cut) + 1
        begin = np.append(0, stop[:-1])
        length = stop - begin
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        code = self.byte_class[data].astype(np.int32)
        active = np.searchsorted(-length, -np.arange(1, (length[0] if n else 0) + 1), side="right")
        state, at = np.zeros(len(begin), np.int32), begin.copy()
        where, what = [], []
        for m in active:
            if m <= FEW:  # no longer worth an array step
                break
            state, at = state[:m], at[:m]
            state += code.take(at)
            state = self.step.take(state)
            if m and state.max() >= EVENT:
                hit = np.flatnonzero(state >= EVENT)
                where.append(at[hit])
                what.append((state[hit] // EVENT).astype(np.uint8))
                state &= EVENT - 1
            at += 1
        rest = np.flatnonzero(at < begin[: len(at)] + length[: len(at)])
        for lane in rest:
            found = self._tail(int(state[lane]), code[at[lane] : begin[lane] + length[lane]].tolist())
            where.append(at[lane] + np.array([i for i, _ in found], np.int64))
            what.append(np.array([k for _, k in found], np.uint8))
        if not where:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        where, what = np.concatenate(where), np.concatenate(what)
        by = np.argsort(where, kind="stable")
        return where[by], what[by]


def _backward(rule: tuple) -> tuple[list[list[int]], list[bool]]:
    """The reversed rule as a table of states by byte (-1: dead) and accepting states."""
    nfa, first, end = _compile(rule, reverse=True)
    states, table, todo = {first: 0}, [], [first]
    for state in todo:
        row = []
        for byte in range(256):
            to = nfa.move(state, byte)
            if to and to not in states:
                states[to] = len(states)
                todo.append(to)
            row.append(states[to] if to else -1)
        table.append(row)
    return table, [end in s for s in states]


def _start(backward: tuple[list[list[int]], list[bool]], data: bytes, end: int, least: int) -> int:
    """The smallest start >= least from which the rule matches up to end."""
    table, accepts = backward
    state, found = 0, -1
    for at in range(end - 1, least - 1, -1):
        state = table[state][data[at]]
        if state < 0:
            break
        if accepts[state]:
            found = at
    return found


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    return Automaton(BASE_RULES | MORE_RULES)


def _long_enough(kind: str, match: bytes) -> bool:
    if kind != "assign":
        return len(match) >= LEAST.get(kind, 0)
    value = match[min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0) + 1 :].lstrip(b" ")
    return len(value[1:] if value[:1] in (b'"', b"'") else value) >= LEAST_VALUE


def text_spans(machine: Automaton, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, str]]]]:
    """(row, spans (start, kind number, end, in characters)) of the rows that have any."""
    n = len(offsets) - 1
    length = np.diff(offsets)
    own = offsets + np.arange(n + 1)  # a newline behind each row
    padded = np.full(len(data) + n, 10, np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(n), length)] = data
    where, what = machine.ends(padded, own)
    row = np.searchsorted(own, where, side="right") - 1
    for r in np.unique(row):
        text = padded[own[r] : own[r + 1] - 1].tobytes()
        done, found = [0] * len(machine.kinds), []
        for end, bits in zip(where[row == r] - own[r], what[row == r], strict=True):
            for k, kind in enumerate(machine.kinds):
                if bits >> k & 1:
                    start = _start(machine.backward[k], text, int(end), done[k])
                    done[k] = int(end)
                    if _long_enough(kind, text[start:end]):
                        found.append((start, k, int(end)))
        if found:
            # UTF-8: characters begin at bytes that are no continuation
            before = np.append(0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
            yield int(r), sorted((int(before[s]), k, int(before[e])) for s, k, e in found)


def _scan(batches: Iterator[pa.RecordBatch], machine: Automaton) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = string_buffers(batch.column("text"))
        found: list[list] = [[] for _ in range(batch.num_rows)]
        for a, b in pieces(offsets):
            for r, spans in text_spans(machine, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]):
                found[a + r] = [{"kind": machine.kinds[k], "start": s, "end": e} for s, k, e in spans]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(found, kind)], names=[*rest, "spans"])


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and spans (kind, start, end in characters) of every row of docs.

    Spans of one kind do not overlap; they stand in order of start, then of KINDS. Null and
    empty texts have none. Repeated rows stay; other columns play no part.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(automaton())
    out = rows.mapInArrow(lambda it: _scan(it, shared.value), f"key {kind}, spans array<struct<kind:string,start:long,end:long>>")
    return out.select(F.col("key").alias(key), "spans")


def span_text(spans: list | None, kinds: list[str]) -> str:
    """kind:start:end of the spans of some kinds, comma-joined (for tests and small tools)."""
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans or [] if s["kind"] in kinds)


def span_sha256(spans: list | None, kinds: list[str]) -> str:
    return hashlib.sha256(span_text(spans, kinds).encode()).hexdigest()
