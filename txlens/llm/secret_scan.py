"""Secret scan: all rules in one minimal deterministic automaton, one pass over the bytes.

The combined automaton reads each byte of a text once and reports, for every
rule, the places where a match is first complete. Only there do the rule's own
anchored automata run: backwards to the leftmost start not before the end of the
rule's last match, then forwards to the longest end. This gives each rule's
leftmost, longest, non-overlapping matches for rules whose earlier match never
completes later than one that begins inside it (true of all rules below).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.automaton import Automaton, compile_rules


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; one with fewer than ``least`` bytes after its ``head`` is dropped.

    Lengths are checked on the few matches rather than counted by states, which
    would multiply between rules; only a rule without a literal start counts.
    """

    kind: str
    pattern: str
    head: str = ""
    least: int = 0


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
# The three base rules of the contract, first; the rest are public key formats.
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule("assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", _ASSIGN, 12),
    Rule("access", "AKIA[A-Z0-9]+", least=18),
    Rule("hex", "[0-9a-f]{16,}"),
    Rule("github", "gh[opsur]_[A-Za-z0-9]+", least=40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("google", "AIza[A-Za-z0-9_-]+", least=39),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
SPAN = "array<struct<kind:string,start:long,end:long>>"


@dataclass
class Scanner:
    """The rules compiled: ``scan`` over all rules, and each rule's own two directions."""

    rules: tuple[Rule, ...]
    scan: Automaton
    forward: list[Automaton]
    backward: list[Automaton]
    head: list[Automaton | None]

    @classmethod
    def compile(cls, rules: tuple[Rule, ...] = RULES) -> Scanner:
        one = [r.pattern for r in rules]
        return cls(rules, compile_rules(one, False, first_only=True), [compile_rules([p], True) for p in one],
                   [compile_rules([p], True, backwards=True) for p in one],
                   [compile_rules([r.head], True) if r.head else None for r in rules])

    def linked(self) -> tuple:
        rows = lambda a: a.rows() if a is not None else None
        return (self.scan.rows(), [rows(a)[0] for a in self.forward], [rows(a)[0] for a in self.backward],
                [rows(a)[0] if a else None for a in self.head])


def _longest(row: list, data: bytes, at: int, stop: int, step: int) -> int:
    """Where the longest match from ``at`` towards ``stop`` ends; -1 without one."""
    found = at if row[256] else -1
    while at != stop:
        row = row[data[at] if step > 0 else data[at - 1]]
        if row[257]:
            break
        at += step
        if row[256]:
            found = at
    return found


def find_spans(data: bytes, scanner: Scanner, linked: tuple) -> list[tuple[int, int, int]]:
    """(start, rule, end) in bytes, by start and then the order of the rules."""
    rows, forward, backward, head = linked
    row, hits = rows[0], []
    for i, b in enumerate(data):  # the one pass
        row = row[b]
        if row[256]:
            hits.append((i + 1, row[256]))
    ends = [0] * len(forward)
    spans = []
    for place, bits in hits:
        for r in range(len(forward)):
            if not bits >> r & 1 or place <= ends[r]:
                continue
            start = _longest(backward[r], data, place, ends[r], -1)
            if start < 0:
                continue
            ends[r] = _longest(forward[r], data, start, len(data), 1)
            rule = scanner.rules[r]
            value = start if head[r] is None else _longest(head[r], data, start, len(data), 1)
            if ends[r] - value >= rule.least:
                spans.append((start, r, ends[r]))
    return sorted(spans)


def with_spans(docs: DataFrame, text_col: str = "text", out_col: str = "spans",
               rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``out_col``: every secret of the whole text, in code points, end exclusive.

    Null and empty texts have no spans (an empty array). ``out_col`` replaces a
    column of that name; other columns and repeated rows pass unchanged. The
    text alone travels to Python, in batches bounded by rows and bytes.
    """
    return docs.withColumn(out_col, spans_of(F.col(text_col), rules))


def spans_of(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The array of spans of a text column."""
    scanner = Scanner.compile(rules)

    @F.pandas_udf(SPAN)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        linked = scanner.linked()
        kinds = [r.kind for r in scanner.rules]
        for texts in batches:
            out = []
            for text in texts:
                data = text.encode() if text else b""
                spans = []
                for start, r, end in find_spans(data, scanner, linked):
                    # Offsets in code points; only texts with a match pay for it.
                    first = len(data[:start].decode())
                    spans.append({"kind": kinds[r], "start": first, "end": first + len(data[start:end].decode())})
                out.append(spans)
            yield pd.Series(out)

    return scan(text)


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every found span of ``text_col`` replaced by ``mask``; overlapping spans are merged."""
    spans = F.array_sort(spans_of(F.col(text_col), rules), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"), F.lit(False).alias("any"))
    done = F.aggregate(spans, start, lambda acc, s: F.struct(
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mask)))
        .otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"), F.lit(True).alias("any")))
    rest = F.substring(F.col(text_col), (done["at"] + 1).cast("int"), F.length(text_col))
    return docs.withColumn(text_col, F.when(done["any"], F.concat(done["out"], rest)).otherwise(F.col(text_col)))
