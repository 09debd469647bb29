"""Operator 12: secret scans by one combined deterministic automaton.

A rule is a *head* (a regular expression, possibly empty) followed by a *body* (the longest
run of bytes of a class).  All rules are compiled, once on the driver, into one automaton
over bytes that accepts wherever the head and the first byte of the body of any rule end
(a rule without a head: the least run of its body).  A text is scanned in one pass, one
table step a byte whatever the number of rules; only where a state accepts are the rule's
own small automata used, backward over the head to find where it starts and forward over the
body to find where it ends.

A rule's matches are leftmost, longest and do not overlap; they are reported if the body has
``least`` bytes at least.  Rules do not hide each other.  Texts stay where they are: nothing
is shuffled, and memory is bounded by one text and the tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Automaton, compile_patterns


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    body: str                # a class such as [0-9a-f], or empty: the head alone is the match
    least: int
    any_case: bool = False   # ASCII letters of the head in either case


# The rules.  The first three are the base kinds of the registered query.
RULES = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=\\-]", 12, True),
    Rule("access", "AKIA", "[A-Z0-9]", 14),
    Rule("hex", "", "[0-9a-f]", 16),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", "", 0),
    Rule("jwt", "eyJ[A-Za-z0-9_\\-]+\\.eyJ[A-Za-z0-9_\\-]+\\.", "[A-Za-z0-9_\\-]", 16),
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9\\-]", 10),
    Rule("google", "AIza", "[A-Za-z0-9_\\-]", 35),
    Rule("stripe", "[rs]k_(live|test)_", "[A-Za-z0-9]", 16),
]


class _Edges:
    """The small automata of one rule: where heads that end at a byte start, where a body ends."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self.back = compile_patterns([(rule.head, rule.any_case)], anywhere=False, backward=True) if rule.head else None
        body = compile_patterns([(rule.body, False)], anywhere=False) if rule.body else None
        self.body = bytes(bool(body.accepts[body.step[0, c]]) for c in body.classes) if body else None

    def starts(self, data: bytes, end: int) -> list[int]:
        """All places where a head that ends before ``end`` starts, rightmost first."""
        if self.back is None:
            return [end]
        a: Automaton = self.back
        out, s = [], 0
        for i in range(end - 1, -1, -1):
            s = a.step[s, a.classes[data[i]]]
            if s == a.dead:
                break
            if a.accepts[s]:
                out.append(i)
        return out

    def end(self, data: bytes, at: int) -> int:
        if self.body is None:
            return at
        inside, n = self.body, len(data)
        while at < n and inside[data[at]]:
            at += 1
        return at


class Scanner:
    """The combined automaton of ``rules`` as flat lists for the scan."""

    def __init__(self, rules: list[Rule]):
        leads = [(f"({r.head})" + (r.body if r.head else f"{r.body}{{{max(1, r.least)}}}"), r.any_case) for r in rules]
        both = compile_patterns(leads, anywhere=True)
        self.rules, self.classes = rules, both.classes
        self.edges = [_Edges(r) for r in rules]
        states, width = both.step.shape
        # accepting states come last, so that one comparison a byte tells them
        order = sorted(range(states), key=lambda s: (bool(both.accepts[s]), s))
        place = {s: i for i, s in enumerate(order)}
        self.step = [place[int(t)] * width for s in order for t in both.step[s]]
        self.start = place[0] * width
        self.first_accept = sum(not a for a in both.accepts) * width
        self.accepts = {place[s] * width: a for s, a in enumerate(both.accepts) if a}
        self.states = states

    def hits(self, data: bytes) -> list[tuple[int, int]]:
        """(place, state) of every byte at which a state accepts: the one pass over the text."""
        step, s, accept, out = self.step, self.start, self.first_accept, []
        for i, c in enumerate(data.translate(self.classes)):
            s = step[s + c]
            if s >= accept:
                out.append((i, s))
        return out

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, end) in bytes of all matches, by start, then rule."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        seen: dict[int, int] = {}                 # rule -> end of the last body: places inside it begin no other run
        for i, s in self.hits(data):
            for k in self.accepts[s]:
                e = self.edges[k]
                if e.back is None:                # the run that ends here is long enough: take it whole, once
                    if i >= seen.get(k, 0):
                        at = i + 1 - max(1, e.rule.least)
                        seen[k] = e.end(data, i)
                        found.setdefault(k, []).append((at, -seen[k], at))
                    continue
                body = i if e.body is not None else i + 1
                # a body that lasts since the place before ends where that one ends
                end = seen[k] if body < seen.get(k, 0) else e.end(data, body)
                seen[k] = end
                found.setdefault(k, []).extend((at, -end, body) for at in e.starts(data, body))
        out = []
        for k, ways in found.items():
            past, least = 0, self.rules[k].least
            for at, end, body in sorted(ways):    # leftmost, then longest
                if at >= past:
                    past = -end
                    if past - body >= least:
                        out.append((at, k, past))
        return sorted(out)


def _points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans in code points."""
    if data.isascii():
        return spans
    places = sorted({p for a, _, b in spans for p in (a, b)})
    points, last, n = {}, 0, 0
    for p in places:
        n += len(data[last:p].decode())
        points[p], last = n, p
    return [(points[a], k, points[b]) for a, k, b in spans]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>): one row per document row, its secrets by
    start, then in the order of the rules; places are code points, the end is exclusive.

    Null and empty texts have none.  Rows keep their ids, null and repeated ones too; equal
    texts have equal spans.  A text of any length is scanned whole.  An empty table gives an
    empty result; other columns are ignored."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast(Scanner(rules))      # the rules are a bounded parameter
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = send.value
        names = [r.kind for r in scanner.rules]
        for b in batches:
            rows = []
            for text in b.column(1):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                rows.append([{"kind": names[k], "start": a, "end": z}
                             for a, k, z in _points(data, scanner.spans(data))])
            spans = pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([b.column(0), spans], names=["doc_id", "spans"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>")
