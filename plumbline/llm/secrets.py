"""Secret scans through a trigram inverted index.

Each rule's regex gives a Boolean query over the trigrams that every match must hold. A task
indexes the trigrams of its texts that some rule asks for, portion by portion, evaluates
the queries by intersecting and uniting posting lists, and verifies the candidates with
the regex. A rule without mandatory trigrams is run over every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.portions import portions

#: Most strings that a part of a regex may stand for to be followed literally.
MOST_EXACT = 32


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    any_case: bool = False
    #: The group that must have at least so many characters; 0 is the whole match.
    group: int = 0
    least: int = 0

    @property
    def flags(self) -> int:
        return re.ASCII | (re.IGNORECASE if self.any_case else 0)


#: The rules that every scan applies.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]+", least=32),
)
#: Further rules; each has mandatory trigrams.
ADDED = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_password", r"[a-z]{2,8}://[A-Za-z0-9._-]{1,64}:[^\s:@/]{3,64}@[A-Za-z0-9.-]+"),
)

#: A query is True (no demand), a trigram, or ("and" | "or", queries).
Query = object


def both(parts: list[Query]) -> Query:
    kept = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not kept else kept[0] if len(kept) == 1 else ("and", tuple(kept))


def either(parts: list[Query]) -> Query:
    return True if any(p is True for p in parts) else parts[0] if len(set(parts)) == 1 else ("or", tuple(dict.fromkeys(parts)))


def of_strings(strings: set[str]) -> Query:
    """What a text must hold if it holds one of ``strings``."""
    return either([both([s[k : k + 3] for k in range(len(s) - 2)]) for s in sorted(strings)])


def exact_strings(node) -> set[str] | None:
    """All strings that one parsed node can match, lower case, if they are few."""
    kind, value = node
    if kind is sre.LITERAL:
        return {chr(value).lower()}
    if kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
        return {chr(c).lower() for _, c in value}
    if kind is sre.SUBPATTERN:
        return exact_sequence(value[3])
    if kind is sre.BRANCH:
        found = [exact_sequence(b) for b in value[1]]
        return set().union(*found) if all(f is not None for f in found) else None
    if kind is sre.MAX_REPEAT and value[1] <= 2:
        one = exact_sequence(value[2])
        if one is not None:
            return {"".join(p) for n in range(value[0], value[1] + 1) for p in product(one, repeat=n)}
    return None


def exact_sequence(nodes) -> set[str] | None:
    found = {""}
    for node in nodes:
        one = exact_strings(node)
        if one is None or len(found) * len(one) > MOST_EXACT:
            return None
        found = {a + b for a in found for b in one}
    return found


def sequence_query(nodes) -> Query:
    """The trigram query of a parsed sequence: literal stretches, cut where it becomes vague."""
    demands, stretch = [], {""}
    for node in nodes:
        one = exact_strings(node)
        if one is not None and len(stretch) * len(one) <= MOST_EXACT:
            stretch = {a + b for a in stretch for b in one}
            continue
        demands.append(of_strings(stretch))
        stretch = {""}
        kind, value = node
        if one is not None:
            stretch = one
        elif kind is sre.SUBPATTERN:
            demands.append(sequence_query(value[3]))
        elif kind is sre.BRANCH:
            demands.append(either([sequence_query(b) for b in value[1]]))
        elif kind is sre.MAX_REPEAT and value[0] > 0:
            demands.append(sequence_query(value[2]))
    return both([*demands, of_strings(stretch)])


def trigram_query(rule: Rule) -> Query:
    """Boolean query over lower-case trigrams that every match of the rule satisfies."""
    return sequence_query(sre_parser.parse(rule.pattern, rule.flags))


def trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams(q) for q in query[1]))


class Scanner:
    """Queries, regexes and the table of wanted trigrams, one per Python worker."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(rule, re.compile(rule.pattern, rule.flags), trigram_query(rule)) for rule in rules]
        self.wanted = sorted(set().union(*(trigrams(q) for _, _, q in self.rules)))
        self.wanted = [w for w in self.wanted if w.isascii()]
        self.number = np.zeros(1 << 24, dtype=np.uint16)
        for n, gram in enumerate(self.wanted, 1):
            a, b, c = gram.encode()
            self.number[a << 16 | b << 8 | c] = n

    def index(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Posting lists: trigram -> rows that hold it."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        ends = np.cumsum([len(r) + 3 for r in raw])
        codes = np.frombuffer(b"\x00\x00\x00".join(raw).lower() + b"\x00\x00\x00", dtype=np.uint8).astype(np.uint32)
        found = self.number[codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]]
        places = np.flatnonzero(found)
        pairs = np.unique(found[places].astype(np.int64) << 40 | np.searchsorted(ends, places, "right"))
        numbers, rows = pairs >> 40, pairs & ((1 << 40) - 1)
        bounds = np.searchsorted(numbers, np.arange(1, len(self.wanted) + 2))
        return {gram: rows[bounds[n] : bounds[n + 1]] for n, gram in enumerate(self.wanted)}

    def candidates(self, query: Query, lists: dict[str, np.ndarray], n: int) -> np.ndarray:
        if query is True:
            return np.arange(n)
        if isinstance(query, str):
            return lists.get(query, np.arange(n))
        found = [self.candidates(q, lists, n) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(found))
        found.sort(key=len)
        rows = found[0]
        for other in found[1:]:
            rows = np.intersect1d(rows, other, assume_unique=True)
        return rows

    def scan(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """Verified spans (kind, start, end) of each text, by start, then kind as listed."""
        lists, spans = self.index(texts), [[] for _ in texts]
        for n, (rule, regex, query) in enumerate(self.rules):
            for row in self.candidates(query, lists, len(texts)).tolist():
                for m in regex.finditer(texts[row]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        spans[row].append((m.start(), n, m.end()))
        return [[(self.rules[n][0].kind, start, end) for start, n, end in sorted(found)] for found in spans]


@lru_cache(maxsize=2)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


SPANS = "array<struct<kind:string,start:long,end:long>>"


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED) -> DataFrame:
    """(doc_id, spans) of each row; spans are (kind, start, end) in code points, end exclusive.

    One row per input row, repeated rows included; NULL counts as empty and an empty text
    has no spans. Of one kind, matches are leftmost and do not overlap; matches of different
    kinds may overlap. Spans that start together follow the order of the rules. Other
    columns are ignored.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = scanner(rules)
        for frame in frames:
            texts = ["" if t is None else t for t in frame["text"]]
            for start, end in portions(texts):
                found = own.scan(texts[start:end])
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in found]
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[start:end], "spans": spans})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, spans {SPANS}")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def span_digests(scanned: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as text."""
    spans = F.col("spans")
    counts = [F.size(of_kinds(spans, r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    base = of_kinds(spans, *[r.kind for r in BASE])
    return scanned.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))
