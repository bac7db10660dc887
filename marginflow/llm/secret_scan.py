"""Secret scan by a trigram index over blocks of documents.

From each rule's regular expression a Boolean query over trigrams is derived
that every match satisfies. Each block of documents gets an inverted index
(trigram -> documents) over the trigrams that some rule asks for; postings are
intersected and united as the query says, and only the candidates are read by
the regular expression. A rule without mandatory trigrams reads every text.

The index is local to a block, as a segment of a larger index is: building it
needs no shuffle, its memory is bounded by the block, and a lost task is run
again alone.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import blocks, utf8

BLOCK_BYTES = 2 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The three base rules, then those that this operator adds.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    # a token starts where its alphabet starts, so a run that fails is read once
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", 40),
    Rule("ghtoken", r"gh[pousr]_[A-Za-z0-9]+", 40),
)
RULES = BASE_RULES + MORE_RULES

# A query is None (nothing is mandatory), a trigram of lower-case bytes, or ("and" | "or", [queries]).


def _all_of(parts: list):
    parts = [p for p in parts if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _literals(run: str) -> list:
    raw = run.lower().encode()
    return [raw[i:i + 3] for i in range(len(raw) - 2)]


def _query(items) -> object:
    parts, run = [], ""
    for op, arg in items:
        if op is sre.LITERAL:
            run += chr(arg)
            continue
        if op is sre.AT:
            continue
        parts += _literals(run)
        run = ""
        if op is sre.SUBPATTERN:
            parts.append(_query(arg[3]))
        elif op is sre.BRANCH:
            each = [_query(x) for x in arg[1]]
            parts.append(None if any(x is None for x in each) else ("or", each))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and arg[0] > 0:
            parts.append(_query(arg[2]))
    return _all_of(parts + _literals(run))


def trigram_query(pattern: str):
    """The Boolean query over lower-case trigrams that any text with a match satisfies."""
    return _query(sre_parser.parse(pattern))


def trigrams(query) -> set[bytes]:
    """All trigrams that ``query`` asks for."""
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(trigrams(x) for x in query[1]))


class _Postings:
    """trigram -> sorted rows of one block that hold it (A-Z as a-z)."""

    def __init__(self, wanted: list[bytes]):
        codes = np.array([int.from_bytes(t, "big") for t in wanted], np.uint32)
        order = np.argsort(codes)
        self.codes, self.names = codes[order], [wanted[i] for i in order]
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.may = np.zeros(1 << 16, bool)
        self.may[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(0x9E3779B1)) >> np.uint32(16)

    def build(self, data: np.ndarray, offsets: np.ndarray) -> dict[bytes, np.ndarray]:
        base, to = int(offsets[0]), int(offsets[-1])
        none = np.zeros(0, np.int64)
        if to - base < 3 or not len(self.codes):
            return dict.fromkeys(self.names, none)
        x = self.lower[data[base:to]].astype(np.uint32)
        codes = x[:-2] << np.uint32(16)
        codes |= x[1:-1] << np.uint32(8)
        codes |= x[2:]
        at = np.flatnonzero(self.may[self._slot(codes)])
        which = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        real = self.codes[which] == codes[at]
        at, which = at[real] + base, which[real]
        rows = np.searchsorted(offsets, at, "right") - 1
        real = at + 3 <= offsets[rows + 1]  # not across two texts
        rows, which = rows[real], which[real]
        return {name: np.unique(rows[which == i]) for i, name in enumerate(self.names)}


def candidates(query, postings: dict[bytes, np.ndarray], n_rows: int) -> np.ndarray:
    """Rows of the block that satisfy ``query``."""
    if query is None:
        return np.arange(n_rows)
    if isinstance(query, bytes):
        return postings[query]
    parts = sorted((candidates(x, postings, n_rows) for x in query[1]), key=len)
    out = parts[0]
    for p in parts[1:]:
        out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
    return out


def find(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Spans of ``rule`` in a text (code points, end exclusive)."""
    return [m.span() for m in compiled.finditer(text) if len(m[rule.group]) >= rule.least]


_OUT = pa.schema([("doc_id", pa.int64()), ("kinds", pa.list_(pa.string())),
                  ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def _scanner(rules: tuple[Rule, ...]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [r.compiled() for r in rules]
        asked = [trigram_query(r.pattern) for r in rules]
        index = _Postings(sorted(set().union(*(trigrams(q) for q in asked))))
        for batch in batches:
            texts = batch.column("text")
            data, offsets = utf8(texts)
            for lo, hi in blocks(offsets, BLOCK_BYTES):
                postings = index.build(data, offsets[lo:hi + 1])
                found: list[list[tuple[int, int, int]]] = [[] for _ in range(lo, hi)]
                read: dict[int, str] = {}
                for k, (rule, pattern, query) in enumerate(zip(rules, compiled, asked)):
                    for row in candidates(query, postings, hi - lo).tolist():
                        if row not in read:
                            read[row] = data[offsets[lo + row]:offsets[lo + row + 1]].tobytes().decode()
                        found[row] += [(s, k, e) for s, e in find(rule, pattern, read[row])]
                for x in found:
                    x.sort()
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo).cast(pa.int64()),
                    pa.array([[rules[k].kind for _, k, _ in x] for x in found], pa.list_(pa.string())),
                    pa.array([[s for s, _, _ in x] for x in found], pa.list_(pa.int64())),
                    pa.array([[e for _, _, e in x] for x in found], pa.list_(pa.int64())),
                ], schema=_OUT)
    return scan


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id and the arrays kinds, starts, ends of its spans, by start, then rule.

    Null or empty text: empty arrays. Texts of any length are read whole.
    Repeated rows each give a row; an empty table gives none. Other columns
    are ignored.
    """
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(_scanner(tuple(rules)), "doc_id long, kinds array<string>, starts array<long>, ends array<long>")
