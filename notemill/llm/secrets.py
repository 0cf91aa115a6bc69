"""Secrets in texts: a trigram index per block of texts picks the candidates of each rule.

Every rule's regular expression gives a Boolean query over trigrams that any match must hold. A block of texts
is inverted into posting lists for the trigrams that some rule asks for; the query intersects and unites the
lists, and only the texts that are left are searched. A rule without any mandatory trigram reads every text.
"""

import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _parser as regex_tree

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from notemill.llm.blocks import pieces, text_bytes

SPAN = "array<struct<kind string, start int, end int>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and what a match must fulfil besides (a failing match is dropped)."""
    kind: str
    pattern: str
    accepts: Callable[[re.Match], bool] = lambda match: True


#: The base kinds, in their order.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         lambda match: len(match.group(2)) >= 8),
    Rule("access", r"AKIA[A-Z0-9]+", lambda match: len(match.group()) >= 16),
    Rule("hex", r"[0-9a-f]+", lambda match: len(match.group()) >= 32),
)

#: Further kinds, known by the prefixes that their issuers publish.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE

#: A query is True (every text), a trigram, or ("and" | "or", queries).
ANY = True
MOST_STRINGS = 64


def _all(queries):
    parts = list(dict.fromkeys(q for q in queries if q is not ANY))
    return ANY if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _either(queries):
    parts = list(dict.fromkeys(queries))
    return ANY if not parts or ANY in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _held(strings: frozenset[str]):
    """Texts that hold one of these strings: all trigrams of at least one of them."""
    return _either([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _node(op, value):
    """The strings that a part can match when they are few (else None), and what a text must hold for it."""
    name = str(op)
    if name == "LITERAL":
        return frozenset([chr(value).lower()]), ANY
    if name == "IN":
        found = set()
        for kind, item in value:
            if str(kind) == "LITERAL":
                found.add(chr(item).lower())
            elif str(kind) == "RANGE" and item[1] - item[0] < 8:
                found |= {chr(c).lower() for c in range(item[0], item[1] + 1)}
            else:
                return None, ANY
        return (frozenset(found), ANY) if len(found) <= 8 else (None, ANY)
    if name == "SUBPATTERN":
        return _sequence(value[3])
    if name == "BRANCH":
        parts = [_sequence(p) for p in value[1]]
        if all(strings is not None for strings, _ in parts):
            return frozenset().union(*[strings for strings, _ in parts]), ANY
        return None, _either([_held(strings) if strings is not None else query for strings, query in parts])
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, part = value
        strings, query = _sequence(part)
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, ANY
        if strings is not None and least == most and len(strings) ** least <= MOST_STRINGS:
            return frozenset("".join(p) for p in _product([strings] * least)), ANY
        if not least:
            return None, ANY
        return None, _held(strings) if strings is not None else query
    if name == "AT":
        return frozenset([""]), ANY
    return None, ANY


def _product(sets):
    found = [()]
    for strings in sets:
        found = [f + (s,) for f in found for s in strings]
    return found


def _sequence(nodes):
    run, queries, exact = frozenset([""]), [], True
    for op, value in nodes:
        strings, query = _node(op, value)
        queries.append(query)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = frozenset(a + b for a in run for b in strings)
            continue
        exact = False
        queries.append(_held(run))
        run = frozenset([""]) if strings is None else strings
    if exact:
        return run, _all(queries)
    return None, _all([*queries, _held(run)])


def trigram_query(pattern: str):
    """What the lower-cased text of any match must hold; ``ANY`` when no trigram is mandatory."""
    strings, query = _sequence(regex_tree.parse(pattern))
    return _all([query, _held(strings)]) if strings is not None else query


def trigrams_of(query) -> set[str]:
    if query is ANY:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


class Scanner:
    """Compiled rules with their queries."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(rule, re.compile(rule.pattern, re.ASCII), trigram_query(rule.pattern)) for rule in rules]
        wanted = sorted(set().union(*[trigrams_of(q) for _, _, q in self.rules], set()))
        self.wanted = [w for w in wanted if w.isascii()]
        self.slot = np.zeros(1 << 24, dtype=np.uint16)
        for i, gram in enumerate(self.wanted, 1):
            a, b, c = gram.encode()
            self.slot[a << 16 | b << 8 | c] = i

    def postings(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """Of each wanted trigram, the positions of the texts that hold it."""
        raw, offsets = text_bytes(texts, lower=True)
        if len(raw) < 3:
            return {}
        codes = raw.astype(np.uint32)
        slots = self.slot[(codes[:-2] << 16) | (codes[1:-1] << 8) | codes[2:]]
        at = np.flatnonzero(slots)
        owner = np.searchsorted(offsets, at, side="right") - 1
        within = at + 3 <= offsets[owner + 1]
        pairs = np.unique(slots[at[within]].astype(np.int64) << 32 | owner[within])
        numbers, texts_of = pairs >> 32, pairs & 0xFFFFFFFF
        cuts = np.searchsorted(numbers, np.arange(1, len(self.wanted) + 2))
        return {gram: texts_of[cuts[i]:cuts[i + 1]] for i, gram in enumerate(self.wanted) if cuts[i] < cuts[i + 1]}

    def candidates(self, query, postings: dict[str, np.ndarray], count: int) -> np.ndarray:
        if query is ANY:
            return np.arange(count)
        if isinstance(query, str):
            return postings.get(query, np.zeros(0, dtype=np.int64)) if query.isascii() else np.arange(count)
        lists = [self.candidates(q, postings, count) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(lists))
        found = lists[0]
        for other in sorted(lists[1:], key=len):
            found = np.intersect1d(found, other, assume_unique=True)
        return found

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """Per text, (start, place of the rule, end) in order; code points, end exclusive."""
        postings = self.postings(texts)
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        for place, (rule, pattern, query) in enumerate(self.rules):
            for i in self.candidates(query, postings, len(texts)).tolist():
                for match in pattern.finditer(texts[i].as_py() or ""):
                    if rule.accepts(match):
                        found[i].append((match.start(), place, match.end()))
        return [sorted(row) for row in found]


_scanners: dict[tuple, Scanner] = {}


def _found(rules: tuple[Rule, ...], texts: pa.Array) -> pa.Array:
    """The spans of each text; one scanner per worker and set of rules."""
    kinds = tuple((r.kind, r.pattern) for r in rules)
    scanner = _scanners.get(kinds)
    if scanner is None:
        scanner = _scanners[kinds] = Scanner(rules)
    rows = []
    for piece in pieces(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
        for spans in scanner.spans(piece.column(0)):
            rows.append([{"kind": kinds[place][0], "start": start, "end": end} for start, place, end in spans])
    return pa.array(rows, type=pa.list_(_SPAN))


def finder(rules: tuple[Rule, ...] = RULES):
    """A function from a text column to its spans (kind, start, end), by start and then by the rules' order.

    Every rule's matches are leftmost and do not overlap each other; those of different rules may. A null text
    has no spans.
    """
    @F.arrow_udf(SPAN)
    def find(texts: pa.Array) -> pa.Array:
        return _found(rules, texts)

    return find


def _redact(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, found in zip(texts, spans):
        value, row = text.as_py(), found.as_py()
        if value is None or not row:
            out.append(value)
            continue
        parts, done, i = [], 0, 0
        while i < len(row):
            start, end, kind = row[i]["start"], row[i]["end"], row[i]["kind"]
            i += 1
            while i < len(row) and row[i]["start"] < end:
                end = max(end, row[i]["end"])
                i += 1
            parts += [value[done:start], f"[{kind.upper()}]"]
            done = end
        out.append("".join([*parts, value[done:]]))
    return pa.array(out, type=pa.string())


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap become one, named after the first."""
    return F.arrow_udf(_redact, "string")(text, spans)


def cleaner(rules: tuple[Rule, ...] = RULES):
    """A function from a text column to (n_spans, clean): finding and replacing one after the other in the same Python
    worker. A null text has no spans and stays null."""
    @F.arrow_udf("struct<n_spans:int,clean:string>")
    def both(texts: pa.Array) -> pa.Array:
        spans = _found(rules, texts)
        return pa.StructArray.from_arrays([spans.value_lengths(), _redact(texts, spans)], names=["n_spans", "clean"])

    return both


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, with commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
