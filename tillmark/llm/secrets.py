"""Secret scan over a trigram inverted index.

Rules are regular expressions. From each a Boolean trigram query is derived:
what every match must hold, case folded. Every slice of documents gets an index
of its own, from trigram to the rows that hold it, for the trigrams that some
rule asks for. The queries are answered by intersecting and joining posting
lists; only the rows left are searched. A rule without mandatory trigrams
searches every row. Spans are code points, end exclusive.

Base rules are those with a fixed result; further rules add spans of their own.

Defined results: null text is empty; matches that fail a rule's length check
are dropped without another try; kinds may overlap; repeated rows are scanned
alike; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from re import _constants as op  # the parse tree of the standard library
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

# A query is None (anything), a trigram, or ("and" / "or", queries).


@dataclass(frozen=True)
class Rule:
    """A pattern, searched leftmost and without overlap, and the least length of one group."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0
    base: bool = False


RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I, 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 0, 16, True),
    # [0-9a-f]+ of 32 or more: runs are maximal, so shorter ones need no try
    Rule("hex", r"[0-9a-f]{32,}", 0, 0, 32, True),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
LITERAL_LIMIT = 64


def _both(queries):
    queries = [q for q in dict.fromkeys(queries) if q is not None]
    return None if not queries else queries[0] if len(queries) == 1 else ("and", tuple(queries))


def _either(queries):
    queries = list(dict.fromkeys(queries))
    return None if None in queries or not queries else queries[0] if len(queries) == 1 else ("or", tuple(queries))


def _of_strings(strings):
    """Any of the strings is there: its trigrams are."""
    return _either([_both([s[i : i + 3] for i in range(len(s) - 2)]) for s in strings])


def _walk(nodes) -> tuple[list[str] | None, object]:
    """(all strings the nodes can match, if few; query for what they must hold)."""
    queries, run, certain = [], [""], True
    for code, value in nodes:
        strings, query, ends = None, None, False
        if code is op.LITERAL:
            strings = [chr(value).lower()]
        elif code is op.SUBPATTERN:
            strings, query = _walk(value[3])
        elif code is op.BRANCH:
            parts = [_walk(p) for p in value[1]]
            strings = [s for p, _ in parts for s in p] if all(p is not None for p, _ in parts) else None
            query = _either([_of_strings(p) if p is not None else q for p, q in parts])
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            low, high, inner = value
            held, inside = _walk(inner)
            if held is not None and high == 1 and low == 0:
                strings = ["", *held]
            elif low:
                strings, query, ends = held, inside, high != 1  # one copy follows for sure, then more may
        elif code is op.IN and all(c is op.LITERAL for c, _ in value):
            strings = [chr(c).lower() for _, c in value]
        elif code in (op.AT, op.ASSERT, op.ASSERT_NOT):
            strings = [""]
        if strings is not None and len(run) * len(strings) <= LITERAL_LIMIT:
            run = list(dict.fromkeys(a + b for a in run for b in strings))
        else:
            queries += [_of_strings(run), query if strings is None else _of_strings(strings)]
            run, ends = [""], False
            certain = False
        if ends:
            queries.append(_of_strings(run))
            run, certain = [""], False
    if certain:
        return run, None
    return None, _both([*queries, _of_strings(run)])


def trigram_query(pattern: str):
    """What every match of the pattern holds, in case-folded trigrams; None if nothing is certain."""
    strings, query = _walk(parser.parse(pattern))
    return _of_strings(strings) if strings is not None else query


def trigrams_of(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


class TrigramIndex:
    """Posting lists of the wanted trigrams over one slice of texts."""

    def __init__(self, texts: list[str], wanted: Iterable[str]):
        folded = [t.lower() for t in texts]  # ASCII stays in place, so no trigram is lost
        self.rows = len(texts)
        self.postings = {g: np.array([i for i, t in enumerate(folded) if g in t], np.int64) for g in wanted}

    def answer(self, query) -> np.ndarray:
        """Rows that satisfy the query, in order."""
        if query is None:
            return np.arange(self.rows)
        if isinstance(query, str):
            return self.postings[query]
        lists = sorted(map(self.answer, query[1]), key=len)
        found = lists[0]
        for rows in lists[1:]:
            found = np.intersect1d(found, rows, assume_unique=True) if query[0] == "and" else np.union1d(found, rows)
        return found


class SecretScanner:
    """Rules with their trigram queries."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        # ASCII matching: letters in either case are the letters A-Z only.
        self.compiled = [re.compile(r.pattern, r.flags | re.A) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.wanted = sorted(set().union(*map(trigrams_of, self.queries)))

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text the spans (start, rule number, end), in order."""
        index = TrigramIndex(texts, self.wanted)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, compiled, query) in enumerate(zip(self.rules, self.compiled, self.queries)):
            for row in index.answer(query).tolist():
                for match in compiled.finditer(texts[row]):
                    if len(match.group(rule.group)) >= rule.least:
                        found[row].append((match.start(), number, match.end()))
        for spans in found:
            spans.sort()
        return found



def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and hash of the base spans and the list of all spans, per document (doc_id, text)."""
    base = [r.kind for r in rules if r.base]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = SecretScanner(rules)
        for batch in slices(batches, "text"):
            columns: list[list] = [[] for _ in range(len(base) + 2)]
            for spans in scanner.scan([t or "" for t in batch.column("text").to_pylist()]):
                named = [(rules[n], f"{rules[n].kind}:{start}:{end}") for start, n, end in spans]
                for column, kind in zip(columns, base):
                    column.append(sum(r.kind == kind for r, _ in named))
                columns[-2].append(hashlib.sha256(",".join(s for r, s in named if r.base).encode()).hexdigest())
                columns[-1].append(",".join(s for _, s in named))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:-2]), *(pa.array(c, pa.string()) for c in columns[-2:])],
                ["doc_id", *(f"n_{k}" for k in base), "base_sha256", "spans"],
            )

    counts = "".join(f", n_{k} bigint" for k in base)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id bigint{counts}, base_sha256 string, spans string")
