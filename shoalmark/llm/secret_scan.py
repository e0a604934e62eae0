"""Secrets found through a trigram index, after Boolean trigram queries derived from the rules.

From each rule's pattern follows a query over trigrams that every match must satisfy. A segment
of documents (an Arrow batch of a task) is indexed once: for each trigram that some query names,
the documents that contain it. Queries intersect and unite these postings; only documents that
satisfy a rule's query are searched with its pattern. A rule without mandatory trigrams searches
every document. Segments lie with their texts, so neither texts nor postings are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalmark.llm.common import in_arrow


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (ASCII rules, leftmost, not overlapping) of which ``group`` has
    at least ``least`` characters; a match that fails this is dropped, not searched again."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)


# The three base rules, and public formats of credentials. Runs of sixteen and
# more are the runs of one and more that are long enough.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
FORMAT_RULES = (
    Rule("private_key", r"-----BEGIN\x20(?:[A-Z]+\x20)*PRIVATE\x20KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("login_url", r"[a-z]{2,12}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,64}@"),
)
RULES = BASE_RULES + FORMAT_RULES

# --- Boolean trigram queries ---------------------------------------------------------

Query = tuple  # ("all",), ("gram", bytes), ("and", queries) or ("or", queries)
ALL: Query = ("all",)
MOST_STRINGS = 32  # strings known of a part before they are turned into trigrams
MOST_SET = 8  # characters of a set that are told apart


def both(queries: Iterable[Query]) -> Query:
    parts = {q for query in queries for q in (query[1] if query[0] == "and" else (query,)) if q != ALL}
    return ALL if not parts else parts.pop() if len(parts) == 1 else ("and", frozenset(parts))


def either(queries: Iterable[Query]) -> Query:
    parts = {q for query in queries for q in (query[1] if query[0] == "or" else (query,))}
    if ALL in parts or not parts:
        return ALL
    needs = {q: q[1] if q[0] == "and" else frozenset({q}) for q in parts}
    parts = {q for q in parts if not any(needs[other] < needs[q] for other in parts)}
    return parts.pop() if len(parts) == 1 else ("or", frozenset(parts))


def grams_of(strings: Iterable[bytes]) -> Query:
    """Every text with one of ``strings`` has all trigrams of one of them."""
    return either(both(("gram", s[i:i + 3]) for i in range(len(s) - 2)) for s in strings)


def trigrams(query: Query) -> set[bytes]:
    if query[0] == "gram":
        return {query[1]}
    return set().union(*map(trigrams, query[1])) if len(query) > 1 else set()


@dataclass(frozen=True)
class Part:
    """What is known of a part of a pattern: the strings it can match (None if too many), what
    each match begins and ends with, and a query that each text with a match satisfies."""

    exact: frozenset[bytes] | None
    first: frozenset[bytes]
    last: frozenset[bytes]
    query: Query = ALL


EMPTY_SET = frozenset({b""})
NOTHING = Part(EMPTY_SET, EMPTY_SET, EMPTY_SET)  # matches the empty string
ANYTHING = Part(None, EMPTY_SET, EMPTY_SET)


def joined(left: frozenset[bytes], right: frozenset[bytes]) -> frozenset[bytes]:
    return frozenset(a + b for a, b in product(left, right))


def known(strings: frozenset[bytes]) -> Part:
    return settled(Part(strings, strings, strings))


def settled(part: Part) -> Part:
    """The same part with its strings kept few: what is forgotten goes into the query."""
    exact, query = part.exact, part.query
    if exact is not None and len(exact) > MOST_STRINGS:
        query, exact = both([query, grams_of(exact)]), None
    first, last = part.first, part.last
    if exact is None:
        query = both([query, grams_of(first), grams_of(last)])
        first, last = frozenset(s[:2] for s in first), frozenset(s[-2:] for s in last)
        first = first if len(first) <= MOST_STRINGS else EMPTY_SET
        last = last if len(last) <= MOST_STRINGS else EMPTY_SET
    return Part(exact, first, last, query)


def after(left: Part, right: Part) -> Part:
    query = both([left.query, right.query])
    if left.exact is not None and right.exact is not None and len(left.exact) * len(right.exact) <= MOST_STRINGS ** 2:
        exact = joined(left.exact, right.exact)
        return settled(Part(exact, exact, exact, query))
    query = both([query, grams_of(joined(left.last, right.first))])
    first = left.first if left.exact is None else joined(left.exact, right.first)
    last = right.last if right.exact is None else joined(left.last, right.exact)
    for strings in (left.exact, right.exact):
        if strings is not None:
            query = both([query, grams_of(strings)])
    return settled(Part(None, first, last, query))


def alternative(left: Part, right: Part) -> Part:
    exact = None if left.exact is None or right.exact is None else left.exact | right.exact
    sides = [left.query if left.exact is None else both([left.query, grams_of(left.exact)]),
             right.query if right.exact is None else both([right.query, grams_of(right.exact)])]
    query = either([left.query, right.query] if exact is not None else sides)
    return settled(Part(exact, left.first | right.first, left.last | right.last, query))


def characters(items: Sequence) -> Part:
    """A set of characters, if it is small and ASCII; in lower case, as texts are indexed so."""
    found: set[int] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            found.add(value)
        elif kind is sre.RANGE and value[1] < 128:
            found.update(range(value[0], value[1] + 1))
        else:
            return ANYTHING
    if any(c >= 128 for c in found):
        return ANYTHING
    strings = frozenset(bytes([c]).lower() for c in found)
    return known(strings) if len(strings) <= MOST_SET else ANYTHING


def analysed(pattern: Iterable) -> Part:
    """A parsed pattern, part after part. Assertions match the empty string, and whatever is
    not understood matches anything, so a query never asks for more than the pattern does."""
    return reduce(after, (_analysed_one(kind, value) for kind, value in pattern), NOTHING)


def _analysed_one(kind, value) -> Part:
    if kind is sre.LITERAL:
        return characters([(kind, value)])
    if kind is sre.IN:
        return characters(value)
    if kind is sre.SUBPATTERN:
        return analysed(value[3])
    if kind is sre.ATOMIC_GROUP:
        return analysed(value)
    if kind is sre.BRANCH:
        return reduce(alternative, map(analysed, value[1]))
    if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, repeated = value
        one = analysed(repeated)
        if least == 0:
            return alternative(NOTHING, one) if most == 1 else ANYTHING
        copies = reduce(after, [one] * min(least, 3))
        return copies if least == most <= 3 else after(after(copies, ANYTHING), one)
    if kind in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        return NOTHING
    return ANYTHING


def trigram_query(pattern: str) -> Query:
    """What the trigrams of a text (its A-Z in lower case) must satisfy if ``pattern`` matches
    in it; ALL if the pattern has no mandatory trigram."""
    part = analysed(_parser.parse(pattern, re.ASCII))
    return part.query if part.exact is None else both([part.query, grams_of(part.exact)])


# --- the index of a segment ----------------------------------------------------------

LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
WINDOW = 1 << 20  # bytes indexed at a time


class Dictionary:
    """The trigrams to index, with their numbers."""

    def __init__(self, grams: Iterable[bytes]) -> None:
        self.codes = np.array(sorted(int.from_bytes(g) for g in set(grams)), dtype=np.uint32)
        self.wanted = np.zeros(1 << 24, dtype=bool)
        self.wanted[self.codes] = True


class SegmentIndex:
    """Postings (ascending document numbers) of a segment's texts, by trigram.

    Texts come as one buffer of UTF-8 and the offsets of its texts. Trigrams are bytes with A-Z
    in lower case and do not cross texts. Beside the texts this takes memory for one window,
    and a pair of numbers for each trigram of the dictionary that a text contains.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, dictionary: Dictionary) -> None:
        self.n, self.dictionary = len(offsets) - 1, dictionary
        found = [self._window(data, offsets, at) for at in range(int(offsets[0]), int(offsets[-1]) - 2, WINDOW)]
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
        codes = pairs >> np.uint64(32)
        self.documents = (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.bounds = np.searchsorted(codes, np.append(dictionary.codes, 1 << 24).astype(np.uint64))

    def _window(self, data: np.ndarray, offsets: np.ndarray, at: int) -> np.ndarray:
        letters = LOWER[data[at:min(at + WINDOW + 2, int(offsets[-1]))]].astype(np.uint32)
        codes = letters[:-2] << 16 | letters[1:-1] << 8 | letters[2:]
        places = np.flatnonzero(self.dictionary.wanted[codes])
        documents = np.searchsorted(offsets, places + at, side="right") - 1
        inside = places + at + 3 <= offsets[documents + 1]
        return np.unique(codes[places[inside]].astype(np.uint64) << np.uint64(32) | documents[inside].astype(np.uint64))

    def postings(self, gram: bytes) -> np.ndarray:
        number = np.searchsorted(self.dictionary.codes, int.from_bytes(gram))
        return self.documents[self.bounds[number]:self.bounds[number + 1]]

    def candidates(self, query: Query) -> np.ndarray:
        """Numbers of the documents that satisfy a query, ascending."""
        if query == ALL:
            return np.arange(self.n)
        if query[0] == "gram":
            return self.postings(query[1])
        parts = [self.candidates(q) for q in query[1]]
        if query[0] == "or":
            return reduce(np.union1d, parts)
        return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(parts, key=len))


class Scanner:
    def __init__(self, rules: Sequence[Rule]) -> None:
        self.rules = rules
        self.patterns = [rule.compiled() for rule in rules]
        self.queries = [trigram_query(rule.pattern) for rule in rules]
        self.dictionary = Dictionary(set().union(*map(trigrams, self.queries)))

    def index(self, texts: pa.Array) -> SegmentIndex:
        texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        return SegmentIndex(np.frombuffer(data or b"", dtype=np.uint8), ends, self.dictionary)

    def spans(self, texts: pa.Array) -> list[list[dict]]:
        """The spans of each text, by start and then by the order of the rules."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        index = self.index(texts) if len(texts) else None
        for number, (rule, pattern, query) in enumerate(zip(self.rules, self.patterns, self.queries)):
            for place in index.candidates(query).tolist() if index else ():
                for match in pattern.finditer(texts[place].as_py()):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        found[place].append((match.start(), number, match.end()))
        return [[{"kind": self.rules[number].kind, "start": start, "end": end}
                 for start, number, end in sorted(one)] for one in found]


# --- the operator --------------------------------------------------------------------


def scan(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, spans) of every whole text; spans have kind, start and end in code points (end
    exclusive), by start and then by the order of the rules.

    A null text counts as empty and has no spans. Each row stands for itself, so repeated rows
    give equal rows, null ids need no rule and an empty table gives no rows; other columns are
    not read. A very long text is indexed window by window; its task holds the whole text.
    """
    rules = tuple(rules)
    state: list[Scanner] = []

    def rows(batch: pa.RecordBatch) -> dict:
        if not state:  # the dictionary is made once in each task
            state.append(Scanner(rules))
        return {"doc_id": batch["doc_id"], "spans": state[0].spans(batch["text"])}

    texts = documents.select(F.col("doc_id").cast("long"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return in_arrow(texts, rows, "doc_id long, spans array<struct<kind string, start int, end int>>")


def of_kinds(spans: Column, rules: Sequence[Rule]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin([rule.kind for rule in rules]))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
