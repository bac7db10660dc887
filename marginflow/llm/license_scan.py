"""Licence notices in documents, by Dice coefficients over word bigrams.

Documents are cut into passages: each line, and each paragraph (lines between
blank lines) of several lines. Passages and licence templates are normalised
to lower-case words of letters and digits and compared as sets of word
bigrams. Dice is 2 * shared / (size + size); a passage of n bigrams can reach
the least coefficient d only with templates of n * d / (2 - d) to
n * (2 - d) / d bigrams, so size bounds choose the candidate templates, and
only bigrams that occur in a template are looked up at all.

A notice that shares its line or block with other words is found by word
windows over the whole text, whatever its line breaks: a window begins and ends
with a bigram of the template and holds at most the upper size bound of the
template's bigrams as they run. Each template and first word give the window
with the largest coefficient (ties: the longest); of overlapping windows the
largest coefficient stays (ties: the longest, the first, the first name). A
window that a matching line or paragraph already reports is left out.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import U64, blocks, mix, utf8, word_hashes, words

LEAST = 0.8

# Short notices of common licences (public texts), by identifier.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ],
    "ARR": [
        "All rights reserved.",
    ],
}

_WORD = re.compile(r"[^\W_]+")
_PASSAGE = re.compile(r"[^\n]+(?:\n[^\n]+)*")
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[48:58] = np.arange(48, 58)
_PLAIN[97:123] = _PLAIN[65:91] = np.arange(97, 123)


def bigrams(text: str) -> set[tuple[str, str]]:
    """The word bigrams of the normalised text; one word alone makes a bigram with nothing."""
    found = _WORD.findall(text.lower())
    return set(zip(found, found[1:])) if len(found) > 1 else {(w, "") for w in found}


class Matcher:
    """Templates by size and by bigram."""

    def __init__(self, templates: dict[str, list[str]], least: float):
        rows = sorted((len(b), name, b, len(_WORD.findall(t.lower())) - 1)
                      for name, texts in templates.items() for t in texts if (b := bigrams(t)))
        self.sizes = np.array([n for n, *_ in rows], np.int64)
        self.names = [name for _, name, *_ in rows]
        self.least = least
        self.holds: dict[tuple[str, str], list[int]] = {}
        self.of: dict[str, set[tuple[str, str]]] = {}
        for i, (_, name, grams, _) in enumerate(rows):
            self.of.setdefault(name, set()).update(grams)
            for g in grams:
                self.holds.setdefault(g, []).append(i)
        # A window shares ``need`` bigrams at least and runs over ``most`` at most.
        self.need = np.ceil(self.sizes * least / (2 - least) - 1e-9).astype(np.int64)
        self.most = np.array([int(run * (2 - least) / least + 1e-9) for *_, run in rows], np.int64)
        raw = [" ".join(g).encode() for g in self.holds]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        _, _, codes = self._grams(np.frombuffer(b"".join(raw), np.uint8), offsets)
        self.codes = np.unique(codes)
        # Templates by code, as runs; one code is one bigram only if all words are ASCII.
        self.ascii = all(r.isascii() for r in raw)
        pairs = sorted((c, i) for c, own in zip(codes.tolist(), self.holds.values()) for i in own) if self.ascii else []
        self.own = np.array([i for _, i in pairs], np.int64)
        self.runs = np.searchsorted(np.array([c for c, _ in pairs], U64), self.codes)
        self.runs = np.append(self.runs, len(pairs))

    @staticmethod
    def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places (start and end of the first word) and hashes of the word bigrams within rows; a row of one word gives it alone."""
        base = int(offsets[0])
        plain = _PLAIN[data[base:int(offsets[-1])]]
        starts, ends, rows = words(plain, offsets - base)
        h = word_hashes(plain, starts, ends)
        follows = np.zeros(len(h), bool)
        follows[:-1] = rows[1:] == rows[:-1]
        code = h * U64(3)
        code[:-1][follows[:-1]] += h[1:][follows[:-1]] * U64(5)
        alone = ~follows
        alone[1:] &= rows[1:] != rows[:-1]
        keep = follows | alone
        return starts[keep] + base, ends[keep] + base, mix(code[keep])

    def passages(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, start, end) in bytes of the lines and paragraphs whose bigrams could reach the least coefficient.

        Words with other than ASCII letters count as several here, so a passage that has such is kept
        if it shares anything; all others are kept if enough of their distinct bigrams are known.
        """
        base, to = int(offsets[0]), int(offsets[-1])
        x = data[base:to]
        if not len(x) or not len(self.codes):
            return []
        first = np.zeros(len(x) + 1, bool)
        first[offsets - base] = True
        new_line = np.concatenate([[False], x[:-1] == 10]) | first[:-1]
        empty_line = (x == 10) & new_line
        out: set[tuple[int, int, int]] = set()
        for cut in (new_line, empty_line | first[:-1]):
            heads = np.flatnonzero(cut)
            bounds = np.concatenate([heads, [len(x)]]).astype(np.int64)
            at, _, code = self._grams(x, bounds)
            known = self.codes[np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)] == code
            own = np.searchsorted(bounds, at, "right") - 1
            touched = np.unique(own[known])
            if not len(touched):
                continue
            stay = np.isin(own, touched)
            order = np.lexsort((code[stay], own[stay]))
            o, c, k = own[stay][order], code[stay][order], known[stay][order]
            fresh = np.concatenate([[True], (o[1:] != o[:-1]) | (c[1:] != c[:-1])])
            n = np.bincount(o[fresh], minlength=len(heads))
            shared = np.bincount(o[fresh], weights=k[fresh], minlength=len(heads))
            for p in touched:
                lo, hi = int(bounds[p]), int(bounds[p + 1])
                if shared[p] >= n[p] * self.least / (2 - self.least) - 1e-9 or (x[lo:hi] > 127).any():
                    row = int(np.searchsorted(offsets, base + lo, "right")) - 1
                    out.add((row, base + lo - int(offsets[row]), base + hi - int(offsets[row])))
        return sorted(out)

    def best(self, text: str) -> tuple[str, float] | None:
        """The template with the largest coefficient (ties: the first name) that reaches the least one."""
        grams = bigrams(text)
        n = len(grams)
        if not n:
            return None
        low = int(np.searchsorted(self.sizes, n * self.least / (2 - self.least) - 1e-9, "left"))
        high = int(np.searchsorted(self.sizes, n * (2 - self.least) / self.least + 1e-9, "right"))
        if low >= high:
            return None
        shared = np.zeros(len(self.sizes), np.int64)
        for g in grams:
            for i in self.holds.get(g, ()):
                shared[i] += 1
        dice = 2 * shared[low:high] / (n + self.sizes[low:high])
        top = dice.max()
        if top < self.least:
            return None
        return min(self.names[low + i] for i in np.flatnonzero(dice == top)), float(top)

    def hopeful(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """The rows in which enough known bigrams of one template stand close enough for a window.

        Words beside other than ASCII bytes may be parts of words, so they do not count as distance.
        """
        base, to = int(offsets[0]), int(offsets[-1])
        if not len(self.codes) or base == to:
            return []
        if not self.ascii:
            return np.flatnonzero(np.diff(offsets) > 0).tolist()
        at, end, code = self._grams(data, offsets)
        where = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hits = np.flatnonzero(self.codes[where] == code)
        if not len(hits):
            return []
        x = np.concatenate([[0], data[base:to], [0]]) > 127
        whole = ~(x[at - base] | x[end - base + 1])
        far = np.cumsum(whole) - whole
        n = np.diff(self.runs)[where[hits]]
        place = np.repeat(hits, n)
        first = np.repeat(self.runs[where[hits]] - np.cumsum(n) + n, n)
        template = self.own[first + np.arange(len(place))]
        order = np.lexsort((place, template))
        place, template = place[order], template[order]
        row = np.searchsorted(offsets, at[place], "right") - 1
        last = np.arange(len(place)) + self.need[template] - 1
        i = np.flatnonzero(last < len(place))
        j = last[i]
        near = (template[i] == template[j]) & (row[i] == row[j]) & (far[place[j]] - far[place[i]] < self.most[template[i]])
        return np.unique(row[i[near]]).tolist()

    def windows(self, text: str) -> list[tuple[str, int, int, float]]:
        """(licence, start, end, coefficient) of the word windows that match, none overlapping another."""
        found = [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(text)]
        grams = [(a[2], b[2]) for a, b in zip(found, found[1:])]
        places: dict[int, list[int]] = {}
        for k, g in enumerate(grams):
            for i in self.holds.get(g, ()):
                places.setdefault(i, []).append(k)
        hopes = []
        for i, at in places.items():
            size, need, most = int(self.sizes[i]), int(self.need[i]), int(self.most[i])
            inside: Counter = Counter()
            to = 0
            for k in at:
                while to < len(at) and at[to] < k + most:
                    inside[grams[at[to]]] += 1
                    to += 1
                if len(inside) >= need:
                    top = self._longest_best(grams, at, k, at[to - 1], i, size)
                    if top:
                        hopes.append((-top[0], k - top[1], k, self.names[i], top[1]))
                inside[grams[k]] -= 1
                if not inside[grams[k]]:
                    del inside[grams[k]]
        taken: list[tuple[int, int]] = []
        out = []
        for minus, _, k, name, last in sorted(hopes):
            here = bisect_left(taken, (k, 0))
            if (here and taken[here - 1][1] > k) or (here < len(taken) and taken[here][0] < last + 2):
                continue
            insort(taken, (k, last + 2))
            out.append((name, found[k][0], found[last + 1][1], -minus))
        return out

    def _longest_best(self, grams: list, at: list[int], k: int, to: int, i: int, size: int) -> tuple[float, int] | None:
        """The largest coefficient of windows from bigram ``k`` to one of template ``i`` up to ``to``, and its last bigram."""
        seen: set = set()
        shared, best = 0, None
        for p in range(k, to + 1):
            g = grams[p]
            own = i in self.holds.get(g, ())
            if g not in seen:
                seen.add(g)
                shared += own
            if own and 2 * shared >= self.least * (len(seen) + size) and (
                    best is None or 2 * shared / (len(seen) + size) >= best[0]):
                best = 2 * shared / (len(seen) + size), p
        return best

    def _reported(self, text: str, window: tuple[str, int, int, float], passages: list[tuple]) -> bool:
        """Whether a matching passage tells of a window: it holds it under the same licence, or as good a notice overlaps it."""
        name, lo, hi, dice = window
        for licence, a, b, other in passages:
            if licence == name and a <= lo and hi <= b:
                return True
            if lo < b and a < hi and dice <= other:
                found = [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(text, a, b)]
                own = [(u[0], v[1]) for u, v in zip(found, found[1:]) if (u[2], v[2]) in self.of[licence]]
                if not own or (lo < own[-1][1] and own[0][0] < hi):
                    return True
        return False

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, str, int, int, float]]:
        """(row, licence, start, end, coefficient) of each line, paragraph and further window that matches."""
        out: set[tuple] = set()
        for row, lo, hi in self.passages(data, offsets):
            at = int(offsets[row])
            before = int(((data[at:at + lo] & 0xC0) != 0x80).sum())  # code points
            text = data[at + lo:at + hi].tobytes().decode()
            for m in _PASSAGE.finditer(text):
                found = self.best(m[0])
                if found:
                    out.add((row, found[0], before + m.start(), before + m.end(), found[1]))
        by_row: dict[int, list[tuple]] = {}
        for row, *passage in out:
            by_row.setdefault(row, []).append(tuple(passage))
        for row in self.hopeful(data, offsets):
            text = data[int(offsets[row]):int(offsets[row + 1])].tobytes().decode()
            out.update((row, *w) for w in self.windows(text) if not self._reported(text, w, by_row.get(row, [])))
        return sorted(out, key=lambda x: (x[0], x[2], x[3], x[1]))


_OUT = pa.schema([("doc_id", pa.int64()), ("licence", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                  ("dice", pa.float64())])


def _scanner(templates: dict[str, list[str]], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, least)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            data, offsets = utf8(batch.column("text"))
            for lo, hi in blocks(offsets):
                rows = [(ids[lo + r], *found) for r, *found in matcher.scan(data, offsets[lo:hi + 1])]
                columns = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)
    return run


def scan_licences(docs: DataFrame, templates: dict[str, list[str]] | None = None, least: float = LEAST) -> DataFrame:
    """One row per matching passage: doc_id, licence, start, end (code points, end exclusive), dice.

    A passage is a line or a paragraph of several lines, or a word window (of two words or more) anywhere in
    the text that no such line or paragraph reports; its best template
    counts, of equal ones the first by name. Null, empty and blank texts match
    nothing. Repeated rows each give their rows; an empty table gives none. Other columns are ignored.
    """
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(_scanner(templates or TEMPLATES, least),
                           "doc_id long, licence string, start long, end long, dice double")
