"""Secret scan by one combined automaton.

The heads of all rules are compiled into a single minimal automaton. It reads every byte
of every text once: text is cut where two bytes send any state to the start, and the pieces
of a slice advance side by side, one byte of each a step. A text in which a rule fired is
read once more from its end by the combined automaton of the reversed rules, which accepts
where a match of a rule begins; from the first such place that is free, the rule's own
automata read forward, longest, which gives the span. No place without a match is read by
a rule, so that the work is linear in the text whatever it holds.

Defined cases: null and empty texts have no spans; offsets count code points; spans of one
kind don't overlap, those of different kinds may; repeated rows are scanned alike; a very
long text is scanned whole, as a slice of its own; an empty table gives no rows; extra
columns are ignored, and redact_secrets passes them on, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import Dfa, build
from .textkit import slices

SCAN_BYTES = 1 << 20
PIECE = 64
#: So few pieces aren't worth a step of all.
FEW = 8


@dataclass(frozen=True)
class Rule:
    """A match is `head` and then characters of `tail`, as many as there are; matches with fewer than `least_tail`
    of them, or `least` in all, are consumed but dropped. fires: a pattern found in every kept match."""

    kind: str
    head: str
    tail: str
    least_tail: int = 1
    least: int = 1
    either_case: bool = False
    fires: str = ""


#: What the base rules of the contract look for, in its order.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]", 12, either_case=True),
    Rule("access", "AKIA", "[A-Z0-9]", least=18),
    Rule("hex", "", "[0-9a-f]", least=16, fires="[0-9a-f]{16}"),
)
#: Further formats that issuers publish.
MORE = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.", "[A-Za-z0-9_-]", 16, fires=r"eyJ[A-Za-z0-9_-]"),
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY----", "-", 1),
)
RULES = BASE + MORE


@cache
def compiled(rules: tuple[Rule, ...]) -> tuple[Dfa, tuple[list, list], list[tuple[list, list, list]]]:
    """The combined automaton, the tables of the reversed one (next by byte, rules that begin), and for each rule the
    tables of its head and its tail."""
    heads = build([(r.fires or r.head + r.tail, r.either_case) for r in rules], anywhere=True)
    back = build([(r.head + r.tail, r.either_case) for r in rules], anywhere=True, backwards=True)
    begins = back.next[:, back.classes].tolist(), back.kinds.tolist()
    own = []
    for r in rules:
        d = build([(r.head, r.either_case)], anywhere=False)
        rows = d.next[:, d.classes].tolist()
        table = [[-1 if x == d.dead else x for x in row] for row in rows]
        inside = build([(r.tail, r.either_case)], anywhere=False)
        member = (inside.kinds[inside.next[0, inside.classes]] != 0).tolist()
        own.append((table, (d.kinds != 0).tolist(), member))
    return heads, begins, own


def fired(dfa: Dfa, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(start, end) of the pieces in which some rule fires, in order; one pass over the bytes."""
    n = len(data)
    if not n:
        return np.zeros((0, 2), np.int64)
    symbol = dfa.classes.astype(np.uint8)[data]
    free = np.flatnonzero(dfa.resets()[symbol[:-1], symbol[1:]]) + 2
    if len(free):
        block = free // PIECE
        free = free[np.concatenate([[True], block[1:] != block[:-1]])]
    edge = np.union1d(offsets, free[free <= n])
    start, size = edge[:-1], np.diff(edge)
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    width = dfa.next.shape[1]
    flat = (dfa.next * width).astype(np.int32).ravel()
    state = np.zeros(len(start), np.int32)
    top = np.zeros(len(start), np.int32)
    at = start.copy()
    live = np.searchsorted(-size, -np.arange(size[0]), side="left")  # pieces longer than each step
    for k in live[live > FEW].tolist():
        s = flat[state[:k] + symbol[at[:k]]]
        state[:k] = s
        np.maximum(top[:k], s, out=top[:k])
        at[:k] += 1
    for j in range(int(live[live <= FEW][0]) if live[-1] <= FEW else 0):  # what few long pieces still hold
        step, s, most = dfa.rows, int(state[j]) // width, 0
        for c in symbol[at[j] : start[j] + size[j]].tolist():
            s = step[s][c]
            if s > most:
                most = s
        top[j] = max(int(top[j]), most * width)
    first = int(np.flatnonzero(dfa.kinds)[0]) * width
    hot = np.sort(np.flatnonzero(top >= first))
    found = np.column_stack([start[hot], start[hot] + size[hot]])
    return found[np.argsort(found[:, 0])]


def _match(text: bytes, at: int, table: list, accepts: list, member: list) -> tuple[int, int]:
    """(start of the tail, end) of the rule's match that starts here; end is -1 if there is none."""
    state, head, i, n = 0, at if accepts[0] else -1, at, len(text)
    while i < n and (state := table[state][text[i]]) >= 0:
        i += 1
        if accepts[state]:
            head = i
    if head < 0:
        return -1, -1
    end = head
    while end < n and member[text[end]]:
        end += 1
    return head, end if end > head else -1


def _starts(text: bytes, begins: tuple[list, list], rules: int) -> list[list[int]]:
    """Where the matches of each rule begin, in order; one pass from the end."""
    step, kinds = begins
    out: list[list[int]] = [[] for _ in range(rules)]
    state, at = 0, len(text)
    for byte in reversed(text):
        state = step[state][byte]
        at -= 1
        if kinds[state]:
            for k in range(rules):
                if kinds[state] >> k & 1:
                    out[k].append(at)
    return [x[::-1] for x in out]


def scan(data: np.ndarray, offsets: np.ndarray, rules: tuple[Rule, ...]) -> dict[int, list[tuple[int, int, int]]]:
    """(start, rule, end) spans in code points of each row that has any."""
    dfa, begins, own = compiled(rules)
    out: dict[int, list] = {}
    pieces = fired(dfa, data, offsets)
    rows = np.searchsorted(offsets, pieces[:, 0], side="right") - 1
    for row in np.unique(rows).tolist():
        base, text = offsets[row], data[offsets[row] : offsets[row + 1]].tobytes()
        spans = []
        for k, (rule, starts) in enumerate(zip(rules, _starts(text, begins, len(rules)), strict=True)):
            done = 0
            for at in starts:
                if at < done:
                    continue
                head, end = _match(text, at, *own[k])
                if end >= 0:
                    done = end
                    if end - head >= rule.least_tail and end - at >= rule.least:
                        spans.append((at, k, end))
        if spans:
            points = np.concatenate([[0], np.cumsum((data[base : offsets[row + 1]] & 0xC0) != 0x80)])
            out[row] = sorted((int(points[a]), k, int(points[e])) for a, k, e in spans)
    return out


def told(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{e}" for a, k, e in spans)


_FOUND = "doc_id long, counts array<long>, base_sha256 string, spans string"


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """One row a document: doc_id, counts by rule, the digest of the spans of the first `base` rules, all spans as kind:start:end."""
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text", SCAN_BYTES):
            n = rows.num_rows
            found = scan(data, offsets, rules)
            counts = np.zeros((n, len(rules)), np.int64)
            digests, all_ = [nothing] * n, [""] * n
            for row, spans in found.items():
                for _, k, _ in spans:
                    counts[row, k] += 1
                all_[row] = told(spans, rules)
                digests[row] = hashlib.sha256(told([x for x in spans if x[1] < base], rules).encode()).hexdigest()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(rules)), pa.array(counts.ravel()))
            yield pa.RecordBatch.from_arrays([rows.column(0), lists, pa.array(digests), pa.array(all_)], names=["doc_id", "counts", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _FOUND)


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]") -> DataFrame:
    """All documents and columns, with each span (overlapping ones as one) replaced in the text; n_chars, if there, follows."""
    names = docs.columns
    at = names.index("text")
    size = names.index("n_chars") if "n_chars" in names and isinstance(docs.schema["n_chars"].dataType, (T.LongType, T.IntegerType)) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text", SCAN_BYTES):
            found = scan(data, offsets, rules)
            if found:
                texts = rows.column(at).to_pylist()
                sizes = rows.column(size).to_pylist() if size is not None else []
                for row, spans in found.items():
                    text, parts, last = texts[row], [], 0
                    for a, _, e in spans:
                        if a >= last:
                            parts += [text[last:a], mask]
                        last = max(last, e)
                    texts[row] = "".join(parts) + text[last:]
                    if sizes:
                        sizes[row] = len(texts[row])
                columns = list(rows.columns)
                columns[at] = pa.array(texts, rows.column(at).type)
                if sizes:
                    columns[size] = pa.array(sizes, rows.column(size).type)
                rows = pa.RecordBatch.from_arrays(columns, schema=rows.schema)
            yield rows

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.col("counts")[0].alias("n_assign"), F.col("counts")[1].alias("n_access"), F.col("counts")[2].alias("n_hex"), "base_sha256", "spans")
