"""Secrets in texts, found through a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived: a text can match only if
it satisfies the query. Texts are indexed segment by segment: a segment's postings say which of its
texts hold which trigram (ASCII letters in lower case), the queries are answered by intersecting and
uniting postings, and only the texts that remain are verified with the expression. A rule without a
mandatory trigram scans every text. A segment has a bounded size and is indexed and searched by one
task, so postings never grow with the corpus and nothing is shuffled.

Rows and edge cases: a NULL text counts as empty and has no spans; repeated rows give repeated results;
a NULL id stays NULL; an empty table gives an empty result; overlapping spans of different rules are
all reported. `redact` keeps NULL texts and texts without secrets as they are. Other columns are not
read by `scan` and pass through `redact`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as op  # the parse tree of an expression, as the compiler of `re` sees it
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose group `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The kinds of secret, in the order in which spans at one place are listed.
BASE_RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
RULES = (*BASE_RULES, Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"), Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,255}"))

#: Bytes of text in a segment; sets of strings larger than this are not followed further.
SEGMENT_BYTES, _MOST = 4 << 20, 32

# A query is True (any text), a trigram, or ("and" | "or", frozenset of queries).
Query = bool | str | tuple


def both(a: Query, b: Query) -> Query:
    if a is True or a == b:
        return b
    if b is True:
        return a
    parts = [q[1] if isinstance(q, tuple) and q[0] == "and" else {q} for q in (a, b)]
    return "and", frozenset(parts[0] | parts[1])


def either(a: Query, b: Query) -> Query:
    if a is True or b is True:
        return True
    if a == b:
        return a
    parts = [q[1] if isinstance(q, tuple) and q[0] == "or" else {q} for q in (a, b)]
    return "or", frozenset(parts[0] | parts[1])


def holds_one_of(strings: set[str]) -> Query:
    """The query of texts that hold one of the strings."""
    found = [reduce(both, [s[i : i + 3] for i in range(len(s) - 2)], True) for s in strings]
    return reduce(either, found) if found else True


@dataclass
class Shape:
    """What is known of the strings an expression matches, in lower case.

    `exact` is the set of all of them, if that is small. Otherwise each begins with a string of
    `starts`, ends with one of `ends`, and satisfies `query`.
    """

    exact: set[str] | None
    starts: set[str]
    ends: set[str]
    query: Query = True

    def settled(self) -> Query:
        return both(self.query, holds_one_of(self.exact)) if self.exact is not None else self.query

    def opened(self) -> Shape:
        """The same without an exact set."""
        if self.exact is None:
            return self
        return Shape(None, {s[:2] for s in self.exact}, {s[-2:] for s in self.exact}, self.settled())


ANY = Shape(None, {""}, {""})


def _then(a: Shape, b: Shape) -> Shape:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= _MOST:
        return Shape({x + y for x, y in product(a.exact, b.exact)}, set(), set(), both(a.query, b.query))
    query = both(a.settled(), b.settled())
    left, right = (a.exact if a.exact is not None else a.ends), (b.exact if b.exact is not None else b.starts)
    if len(left) * len(right) <= _MOST:
        query = both(query, holds_one_of({x[-2:] + y[:2] for x, y in product(left, right)}))
    starts, ends = a.opened().starts, b.opened().ends
    if a.exact is not None and len(a.exact) * len(right) <= _MOST:
        starts = {(x + y)[:2] for x, y in product(a.exact, right)}
    if b.exact is not None and len(left) * len(b.exact) <= _MOST:
        ends = {(x + y)[-2:] for x, y in product(left, b.exact)}
    return Shape(None, starts, ends, query)


def _or(a: Shape, b: Shape) -> Shape:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= _MOST and a.query is True and b.query is True:
        return Shape(a.exact | b.exact, set(), set())
    query, a, b = either(a.settled(), b.settled()), a.opened(), b.opened()
    return Shape(None, a.starts | b.starts, a.ends | b.ends, query)


def _one_of(items: list) -> Shape:
    chars: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            chars.add(chr(value))
        elif kind is op.RANGE and value[1] - value[0] < _MOST:
            chars |= {chr(c) for c in range(value[0], value[1] + 1)}
        else:
            return ANY
    folded = {c.lower() for c in chars}
    return Shape(folded, set(), set()) if len(folded) <= 8 and all(c.isascii() for c in folded) else ANY


def shape_of(tree) -> Shape:
    """The shape of a parsed expression; whatever is not understood counts as any string."""
    out = Shape({""}, set(), set())
    for kind, value in tree:
        if kind is op.LITERAL:
            part = _one_of([(kind, value)])
        elif kind is op.IN:
            part = _one_of(value)
        elif kind is op.BRANCH:
            part = reduce(_or, [shape_of(branch) for branch in value[1]])
        elif kind is op.SUBPATTERN:
            part = shape_of(value[3])
        elif kind is op.ATOMIC_GROUP:
            part = shape_of(value)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, inner = value
            once = shape_of(inner)
            part = reduce(_then, [once] * min(least, 8)) if least else Shape({""}, set(), set())
            if least == 0 and most == 1:
                part = _or(part, once)
            elif most != least or least > 8:
                part = ANY if least == 0 else Shape(None, part.opened().starts, {""}, part.settled())
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            continue
        else:
            part = ANY
        out = _then(out, part)
    return out


def trigram_query(pattern: str) -> Query:
    """What every text that matches the pattern satisfies, over trigrams with ASCII letters lowered."""
    return shape_of(parser.parse(pattern)).settled()


def trigrams_of(query: Query) -> set[str]:
    if isinstance(query, str):
        return {query}
    return set() if query is True else set().union(*map(trigrams_of, query[1]))


class TrigramIndex:
    """Postings of one segment: for each wanted trigram, the sorted numbers of the texts that hold it."""

    def __init__(self, texts: list[bytes], wanted: dict[str, int], numbers: np.ndarray) -> None:
        joined = np.frombuffer(b"\0\0".join(texts).lower() + b"\0\0\0", dtype=np.uint8)
        self.size, self.wanted = len(texts), wanted
        starts = np.cumsum([0, *(len(t) + 2 for t in texts[:-1])])
        codes = joined[:-2].astype(np.uint32)
        for shifted in (joined[1:-1], joined[2:]):
            codes <<= 8
            codes |= shifted
        found = numbers[codes]
        places = np.flatnonzero(found)
        owner = np.searchsorted(starts, places, side="right") - 1
        keys = np.unique(found[places].astype(np.int64) * len(texts) + owner)
        self.bounds = np.searchsorted(keys, np.arange(len(wanted) + 2) * len(texts))
        self.texts = keys % max(1, len(texts))

    def postings(self, trigram: str) -> np.ndarray:
        number = self.wanted[trigram]
        return self.texts[self.bounds[number] : self.bounds[number + 1]]

    def search(self, query: Query) -> np.ndarray:
        """Numbers of the texts that satisfy the query."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, str):
            return self.postings(query)
        found = sorted((self.search(q) for q in query[1]), key=len)
        if query[0] == "or":
            return reduce(np.union1d, found)
        return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), found)


class Scanner:
    """Compiled rules with their trigram queries."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = [(rule, re.compile(rule.pattern), trigram_query(rule.pattern)) for rule in rules]
        names = sorted(set().union(*(trigrams_of(q) for _, _, q in self.rules)))
        self.wanted = {t: i for i, t in enumerate(names, start=1)}
        self.numbers = np.zeros(1 << 24, dtype=np.uint16)
        for trigram, number in self.wanted.items():
            self.numbers[int.from_bytes(trigram.encode(), "big")] = number

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) in code points for each text of a segment, by start, then by rule."""
        index = TrigramIndex([t.encode() for t in texts], self.wanted, self.numbers)
        found: list[list] = [[] for _ in texts]
        for order, (rule, pattern, query) in enumerate(self.rules):
            for i in index.search(query).tolist():
                for match in pattern.finditer(texts[i]):
                    start, end = match.span(rule.group)
                    if end - start >= rule.least:
                        found[i].append((match.start(), order, match.end()))
        return [[(self.rules[order][0].kind, start, end) for start, order, end in sorted(own)] for own in found]


def _segments(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive runs of rows with bounded bytes."""
    first, held, size = 0, [], 0
    for i, value in enumerate(texts):
        text = value.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= SEGMENT_BYTES:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): spans is an array of (kind, start, end), the end exclusive, for every row."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            for first, texts in _segments(batch.column(1)):
                rows = [[{"kind": k, "start": s, "end": e} for k, s, e in own] for own in scanner.spans(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(rows, kind)], names=["id", "spans"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(per_batch, "id long, spans array<struct<kind: string, start: bigint, end: bigint>>")


def blanked(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with each run of overlapping spans replaced by the mark."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", size_col: str | None = None, mark: str = "[secret]") -> DataFrame:
    """`docs` with every secret replaced by a mark; `size_col` names a column with the text's length."""
    at = docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col else None

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            for first, texts in _segments(batch.column(at)):
                part = batch.slice(first, len(texts))
                known = part.column(at).is_valid().to_pylist()
                spans = scanner.spans(texts)
                clean = [blanked(t, own, mark) if own else t if ok else None for t, own, ok in zip(texts, spans, known)]
                columns = list(part.columns)
                columns[at] = pa.array(clean, part.schema.field(at).type)
                if size_at is not None:
                    sizes = [len(t) if own else n for t, own, n in zip(clean, spans, part.column(size_at).to_pylist())]
                    columns[size_at] = pa.array(sizes, part.schema.field(size_at).type)
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(per_batch, plain.schema).toDF(*docs.columns)
