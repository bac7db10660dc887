"""Benchmark passages in documents, by q-gram lemma filtering and banded alignment.

Texts are compared as bytes: A-Z lower-cased, everything but letters and digits
a blank, running blanks one. Benchmark items longer than ``SEGMENT`` bytes are cut into
overlapping segments. If a document holds a segment of n bytes with at most e
edits, at least n - q + 1 - q * e of the segment's q-grams occur there, on
diagonals (document place minus segment place) that differ by 2 * e at most.

1. Places of a document whose q-gram is a benchmark q-gram are looked up; those in no stretch
   with enough of them go.
2. The others are counted by segment in overlapping bands of diagonals; bands
   with fewer distinct q-grams than the lemma asks for go.
3. What remains is aligned with the segment within the band; up to e edits match.

The benchmark goes to the tasks in blocks of ``BLOCK_BYTES`` of text, one pass
over the documents for each, so that neither driver nor tasks hold more than a block. Documents are
never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import U64, blocks, utf8

Q = 8
SEGMENT = 96
EDIT_RATE = 0.1
BLOCK_BYTES = 2 << 20
ROUGH = 1 << 18    # counters of a first, rough count
PIECE = 1 << 20    # common q-grams (of a text's place and a segment) held at once

_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[48:58] = np.arange(48, 58)
_PLAIN[97:123] = _PLAIN[65:91] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def plain_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The compared form of rows of UTF-8 text: bytes, offsets of rows, and each byte's place in ``data``."""
    base = int(offsets[0])
    x = _PLAIN[data[base:int(offsets[-1])]]
    solid = x != 32
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    starts = offsets[:-1] - base
    starts = starts[starts < len(x)]
    keep[starts] = solid[starts]  # no blank at the beginning of a row
    place = np.flatnonzero(keep)
    return x[place], np.searchsorted(place, offsets - base), place + base


def codes(x: np.ndarray) -> np.ndarray:
    """The ``Q`` bytes from each place on as a number."""
    if len(x) < Q:
        return np.zeros(0, U64)
    c2 = x[:-1].astype(np.uint16) << np.uint16(8) | x[1:]
    c4 = c2[:-2].astype(np.uint32) << np.uint32(16) | c2[2:]
    return c4[:-4].astype(U64) << U64(32) | c4[4:]


def _slot(c: np.ndarray) -> np.ndarray:
    return (c * U64(0x9E3779B97F4A7C15)) >> U64(44)


class Segments:
    """The segments of a block of benchmark items and the places of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item: list[int] = []
        self.text: list[np.ndarray] = []
        for item, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            x = plain_bytes(raw, np.array([0, len(raw)]))[0]
            x = x[:-1] if len(x) and x[-1] == 32 else x
            if len(x) < Q:
                continue
            cuts = list(range(0, max(1, len(x) - SEGMENT + 1), SEGMENT // 2))
            if len(x) > SEGMENT and cuts[-1] + SEGMENT < len(x):
                cuts.append(len(x) - SEGMENT)
            for at in cuts:
                self.item.append(item)
                self.text.append(x[at:at + SEGMENT])
        n = np.array([len(t) for t in self.text], np.int64)
        self.edits = np.minimum((n * EDIT_RATE).astype(np.int64), (n - Q) // Q)
        self.least = n - Q + 1 - Q * self.edits
        self.width = 2 * (2 * self.edits + 1)
        self.length = n
        grams = [codes(t) for t in self.text]
        code = np.concatenate(grams or [np.zeros(0, U64)])
        order = np.argsort(code, kind="stable")
        self.code, first = np.unique(code[order], return_index=True)
        self.first = np.concatenate([first, [len(code)]])  # of each code's places
        self.segment = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        self.at = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, np.int64)])[order]
        self.may = np.zeros(1 << 20, bool)
        self.may[_slot(self.code)] = True

    def bands(self, x: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, segment, first diagonal) of each band with enough q-grams; diagonals count from the row's start."""
        if not len(self.text) or len(x) < Q:
            return []
        c = codes(x)
        hit = self.may[_slot(c)]
        ends = bounds[1:, None] - np.arange(1, Q)
        ends = ends[(ends >= 0) & (ends < len(hit)) & (ends >= bounds[:-1, None])]
        hit[ends] = False  # q-grams across two rows
        place = np.flatnonzero(hit)
        known = np.minimum(np.searchsorted(self.code, c[place]), len(self.code) - 1)
        real = self.code[known] == c[place]
        place, known = place[real], known[real]
        if not len(place):
            return []
        # stretches that could hold a segment: enough places from one on
        reach = int((self.length + self.edits).max())
        enough = np.searchsorted(place, place + reach) - np.arange(len(place)) >= int(self.least.min())
        if not enough.any():
            return []
        first = np.flatnonzero(enough)
        last = np.searchsorted(place, place[first] + reach)
        cover = np.zeros(len(place) + 1, np.int64)
        np.add.at(cover, first, 1)
        np.add.at(cover, last, -1)
        stay = np.cumsum(cover[:-1]) > 0
        place, known = place[stay], known[stay]
        n_segments = len(self.text)
        row_of = np.searchsorted(bounds, place, "right") - 1
        times = self.first[known + 1] - self.first[known]
        if times.sum() > PIECE and len(bounds) > 2:  # halves of the rows, one after the other
            half = int(row_of[np.searchsorted(np.cumsum(times), times.sum() // 2)])
            half = min(max(half, 1), len(bounds) - 2)
            cut = bounds[half]
            return (self.bands(x[:cut], bounds[:half + 1])
                    + [(r + half, s, d) for r, s, d in self.bands(x[cut:], bounds[half:] - cut)])
        # of one long row, q-grams that many segments share meet them piece by piece
        before = np.cumsum(times) - times
        cuts = np.flatnonzero(np.diff(before // PIECE, prepend=-1))
        pieces = [slice(a, b) for a, b in zip(cuts, np.append(cuts[1:], len(place)))]

        def met(piece: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """place, place in the segment, and row and segment as one number, of each common q-gram."""
            t, low = times[piece], self.first[known[piece]]
            which = np.repeat(low - np.cumsum(t) + t, t) + np.arange(t.sum())
            return np.repeat(place[piece], t), self.at[which], np.repeat(row_of[piece], t) * n_segments + self.segment[which]

        # a row and segment with too few common q-grams on any diagonals need no bands: counts by a part of the
        # pair's bits, never too low, rule most out, exact counts the rest
        one = met(pieces[0]) if len(pieces) == 1 else None
        rough = np.zeros(ROUGH, np.int64)
        for p in pieces:
            rough += np.bincount((one or met(p))[2] % ROUGH, minlength=ROUGH)

        def kept(piece: slice) -> tuple[np.ndarray, ...]:
            found = one or met(piece)
            may = rough[found[2] % ROUGH] >= self.least[found[2] % n_segments]
            return tuple(x[may] for x in found)

        place, at, pair = (np.concatenate(x) for x in zip(*map(kept, pieces)))
        _, which, count = np.unique(pair, return_inverse=True, return_counts=True)
        rich = count[which] >= self.least[pair % n_segments]
        if not rich.any():
            return []
        place, at, pair = place[rich], at[rich], pair[rich]
        row, seg = np.divmod(pair, n_segments)
        diagonal = place - bounds[row] - at
        width = self.width[seg]
        out = []
        for shift in (0, 1):
            band = (diagonal + shift * (width // 2)) // width
            low_band, span = int(band.min()), int(band.max() - band.min()) + 1
            key = np.sort((pair * span + (band - low_band)) * SEGMENT + at)
            group = key[np.concatenate([[True], key[1:] != key[:-1]])] // SEGMENT
            heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            count = np.diff(np.concatenate([heads, [len(group)]]))
            group = group[heads]
            p, b = np.divmod(group, span)
            r, s = np.divmod(p, n_segments)
            for h in np.flatnonzero(count >= self.least[s]):
                w = int(self.width[s[h]])
                out.append((int(r[h]), int(s[h]), (int(b[h]) + low_band) * w - shift * (w // 2)))
        return out

    def align(self, seg: int, row: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
        """Edits, start and end in ``row`` of the best match on the band's diagonals; None beyond the budget."""
        text, n, budget = self.text[seg], int(self.length[seg]), int(self.edits[seg])
        margin = budget
        low, wide = diagonal - margin, int(self.width[seg]) + 2 * margin
        region = row[max(0, low):max(0, low + wide + n)]
        exact = region.tobytes().find(text.tobytes())
        if exact >= 0:
            return 0, max(0, low) + exact, max(0, low) + exact + n
        if not budget:
            return None
        padded = np.zeros(wide + n, np.int16) - 1  # places outside the row match nothing
        src = np.arange(low, low + wide + n)
        inside = (src >= 0) & (src < len(row))
        padded[inside] = row[src[inside]]
        steps = np.arange(wide)
        cost = np.zeros(wide, np.int64)  # per diagonal; the match may begin anywhere
        for i in range(n):
            change = cost + (padded[i:i + wide] != text[i])
            change[:-1] = np.minimum(change[:-1], cost[1:] + 1)
            cost = np.minimum.accumulate(change - steps) + steps
            if cost.min() > budget:
                return None
        best = int(cost.argmin())
        end = min(len(row), low + best + n)
        return int(cost[best]), max(0, end - n), end

    def search(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, start, end, edits) in bytes of each row, one per row and item: the span of its matches."""
        x, bounds, place = plain_bytes(data, offsets)
        found: dict[tuple[int, int], list[int]] = {}
        done: set[tuple[int, int]] = set()
        for r, s, d in sorted(self.bands(x, bounds)):
            if (r, s) in done:
                continue
            match = self.align(s, x[bounds[r]:bounds[r + 1]], d)
            if match:
                done.add((r, s))
                edits, start, end = match
                lo = int(place[bounds[r] + start]) - int(offsets[r])
                hi = int(place[bounds[r] + end - 1]) + 1 - int(offsets[r])
                old = found.setdefault((r, self.item[s]), [lo, hi, edits])
                old[:] = [min(old[0], lo), max(old[1], hi), min(old[2], edits)]
        return [(r, item, *v) for (r, item), v in sorted(found.items())]


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items, at most about ``BLOCK_BYTES`` of text at a time."""
    items = benchmark.selectExpr("cast(item_id as bigint) as item_id", "cast(text as string) as text").where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = total // BLOCK_BYTES + 1
    for i in range(n):
        rows = items if n == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i)
        yield sorted((r[0], r[1]) for r in rows.distinct().collect())


_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                    ("edits", pa.int64())])


def _finder(items: list[tuple[int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(items)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            data, offsets = utf8(batch.column("text"))
            for lo, hi in blocks(offsets):
                rows = []
                for r, item, start, end, edits in segments.search(data, offsets[lo:hi + 1]):
                    at = int(offsets[lo + r])
                    points = np.cumsum((data[at:at + end] & 0xC0) != 0x80)  # code points up to each byte
                    rows.append((ids[lo + r], item, int(points[start]) - 1, int(points[-1]), edits))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else
                                                 [pa.array([], pa.int64())] * 5, schema=_FOUND)
    return run


def find_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` and benchmark item that it holds: doc_id, item_id, start, end, edits.

    A document holds an item if it holds one of its segments. start and end
    (code points, end exclusive) span the segments found, edits is the least
    of theirs; with edits, start may be off by as many. Null and empty texts hold nothing, nor do they (or
    items of under ``Q`` compared bytes) occur in any. Repeated documents each
    give their rows, repeated items one. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    parts = [rows.mapInArrow(_finder(items), "doc_id long, item_id long, start long, end long, edits long")
             for items in _item_blocks(benchmark)]
    return reduce(DataFrame.unionAll, parts)


def _cleaner(items: list[tuple[int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(items)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            clean = np.ones(batch.num_rows, bool)
            for lo, hi in blocks(offsets):
                clean[[lo + r for r, *_ in segments.search(data, offsets[lo:hi + 1])]] = False
                yield batch.slice(lo, hi - lo).filter(pa.array(clean[lo:hi]))
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no passage of the benchmark."""
    out = docs.withColumn("text", F.col("text").cast("string"))
    for items in _item_blocks(benchmark):
        out = out.mapInArrow(_cleaner(items), out.schema)
    return out
