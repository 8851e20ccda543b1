"""Secret scans: all rules in one pass of one automaton over the bytes of each text.

The pass tells where some rule's match ends. Only there does a rule's own reversed automaton run backwards to the
leftmost start that no earlier match of the rule covers, so matches of a rule are leftmost, longest and do not overlap.

Defined cases: a null or empty text has no span; texts of any length are scanned whole; rows are independent, so repeated
rows and null ``doc_id`` give equal rows; an empty table gives an empty table. ``scan`` and ``redact`` drop or keep other
columns as their docstrings say.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekeep.llm.automaton import compile_rules
from tablekeep.llm.common import doc_texts
from tablekeep.session import col


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``head`` then ``tail``; matches with a tail under ``least`` bytes are dropped after the fact.

    ``kept`` tells how much of a match is a secret (0: nothing), where that is more than the pattern can say.
    """

    kind: str
    head: str
    tail: str
    least: int = 0
    kept: Callable[[bytes], int] | None = None


# The base kinds, in the order in which spans at one place are listed. Least lengths are applied after the fact: a short
# match is dropped, yet it hides what lies in it, and counting states of several rules would multiply. Runs of hex digits
# are maximal and everywhere in prose, so only their bound stands in the pattern.
ASSIGN = Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']? *[:=] *["']?""", "[A-Za-z0-9+/_.=-]+", 6)
ACCESS = Rule("access", "AKIA", "[A-Z0-9]+", 16)
HEX = Rule("hex", "", "[0-9a-f]{24,}")
BASE = (ASSIGN, ACCESS, HEX)

# Spans that this method adds to the base ones. A private key goes to its END line, or, without one, on over all that
# bodies are made of: base64, header lines, quote marks, line ends in escaped form too. As such a match may end in four
# dashes of the next header, one of them is enough for the next match.
PRIVATE = "BEGIN ([A-Z]+ ){0,3}PRIVATE KEY-----"

# What a body is, so that texts which only speak of these lines are left alone: header lines and runs of base64 between
# quote marks, blanks and line ends, one run being of a length that no word has. Without an END line only long runs, and
# what may be the last line after them, count.
_GAP = rb"(?:[ \t\r\n\"'>,]|\\[nrt])"
_FIELD = rb"(?:[A-Z][A-Za-z0-9-]++: ?[A-Za-z0-9,.+/=-]++)"
_LONG = rb"[A-Za-z0-9+/]{40,}+"
_HEADER = rb"-{1,5}BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"
_BODY = re.compile(_HEADER + rb"(?:" + _GAP + rb"++|" + _FIELD + rb"|[A-Za-z0-9+/]++={0,2}+)*+-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----")
_RUN = re.compile(_LONG)
_OPEN = re.compile(
    _HEADER + _GAP + rb"*+(?:" + _FIELD + _GAP + rb"++)*+" + _LONG + rb"(?:" + _GAP + rb"++" + _LONG + rb")*+"
    rb"(?:={1,2}|" + _GAP + rb"{1,8}(?:[A-Za-z0-9+/]{12,39}={0,2}|[A-Za-z0-9+/]{1,11}={1,2}))?+" + _GAP + rb"*+-{0,4}"
)


def _whole_key(match: bytes) -> int:
    return len(match) if _BODY.fullmatch(match) and _RUN.search(match) else 0


def _open_key(match: bytes) -> int:
    found = _OPEN.match(match)
    return found.end() if found else 0


ADDED = (
    Rule("github", "gh[opsu]_", "[A-Za-z0-9]+", 36),
    Rule("private_key", "-----" + PRIVATE, "(-{0,4}[\x00-,.-\xff])*-----END ([A-Z]+ ){0,3}PRIVATE KEY-----", kept=_whole_key),
    Rule("private_key", "-{1,5}" + PRIVATE, "(-{0,4}[A-Za-z0-9+/=:,.\"'>\\\\ \t\r\n])*-{0,4}", kept=_open_key),
)
RULES = BASE + ADDED

Span = tuple[int, int, int]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        whole = [r.head + r.tail for r in rules]
        self.all = compile_rules(whole)
        self.back = [compile_rules([p], anywhere=False, reverse=True) for p in whole]
        self.heads = [compile_rules([r.head], anywhere=False) if r.least else None for r in rules]

    def spans(self, data: bytes) -> list[Span]:
        """``(start, end, rule)`` in bytes, by start and then rule."""
        step, state, accepting = self.all.next, self.all.start, self.all.accepting
        hits = []
        for at, byte in enumerate(data):
            state = step[state + byte]
            if state >= accepting:
                hits.append((at, state))
        if not hits:
            return []
        ends: dict[int, list[int]] = {}
        for at, state in hits:
            for rule in self.all.rules[state]:
                run = ends.setdefault(rule, [])
                if run and run[-1] == at:
                    run[-1] = at + 1
                else:
                    run.append(at + 1)
        found = []
        for rule, stops in ends.items():
            covered = 0
            for stop in stops:
                start = self._start(rule, data, covered, stop)
                if start is None:
                    continue
                covered = stop
                kept = self.rules[rule].kept
                if kept is not None:
                    stop = start + kept(data[start:stop])
                    if stop == start:
                        continue
                if self.heads[rule] is None or stop - self._head_end(rule, data, start) >= self.rules[rule].least:
                    found.append((start, stop, rule))
        return self._joined(sorted(found, key=lambda s: (s[0], s[2])))

    def _joined(self, found: list[Span]) -> list[Span]:
        """Spans that overlap and come from different rules of one kind as one."""
        out: list[Span] = []
        latest: dict[str, int] = {}
        for start, stop, rule in found:
            kind = self.rules[rule].kind
            at = latest.get(kind)
            if at is not None and start < out[at][1]:
                out[at] = (out[at][0], max(stop, out[at][1]), out[at][2])
            else:
                latest[kind] = len(out)
                out.append((start, stop, rule))
        return out

    def _start(self, rule: int, data: bytes, lowest: int, stop: int) -> int | None:
        dfa, best = self.back[rule], None
        state = dfa.start
        for at in range(stop - 1, lowest - 1, -1):
            state = dfa.next[state + data[at]]
            if state == dfa.dead:
                break
            if state >= dfa.accepting:
                best = at
        return best

    def _head_end(self, rule: int, data: bytes, start: int) -> int:
        dfa, best = self.heads[rule], start
        state = dfa.start
        for at in range(start, len(data)):
            state = dfa.next[state + data[at]]
            if state == dfa.dead:
                break
            if state >= dfa.accepting:
                best = at + 1
        return best


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """Compiled once per Python process."""
    return Scanner(rules)


def text_spans(text: str, rules: tuple[Rule, ...] = RULES) -> list[Span]:
    """Spans in code points."""
    data = text.encode()
    spans = scanner(rules).spans(data)
    if not spans or len(data) == len(text):
        return spans
    # Code points before each byte: bytes that do not continue a character.
    before = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
    return [(int(before[a]), int(before[b]), rule) for a, b, rule in spans]


def listed(spans: list[Span], rules: tuple[Rule, ...] = RULES) -> str:
    return ",".join(f"{rules[rule].kind}:{start}:{end}" for start, end, rule in spans)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, spans`` per row, with ``spans`` an array of (kind, start, end) in code points."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches):
        for batch in batches:
            rows = [
                [{"kind": rules[rule].kind, "start": a, "end": b} for a, b, rule in text_spans(text.as_py(), rules)]
                for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    return doc_texts(docs).mapInArrow(find, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def scan_digests(docs: DataFrame) -> DataFrame:
    """The spans of ``scan`` as counts per base kind, a digest of the base spans, and one string of all spans."""

    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return scan(docs).select(
        "doc_id",
        *(number(r.kind).alias(f"n_{r.kind}") for r in BASE),
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of(F.col("spans")).alias("spans"),
    )


def redacted(text: str, rules: tuple[Rule, ...] = RULES) -> str:
    """The text with each span, overlapping ones together, replaced by ``[REDACTED]``."""
    out, at = [], 0
    for start, end, _ in text_spans(text, rules):
        if start >= at:
            out += [text[at:start], "[REDACTED]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns, with secrets taken out of ``text``; ``n_chars``, where there is one, follows the new text.

    A null text stays null. The columns keep their order and types.
    """
    schema = docs.select(col("text")).schema
    if schema["text"].dataType.simpleString() != "string":
        raise TypeError("text must be a string")

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: None if t is None else redacted(t, rules))

    out = docs.withColumn("text", clean(col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out
