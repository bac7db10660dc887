import random
import re

from marginflow.llm import license_scan as L
from marginflow.llm.queries import QUERIES
from tests.llm.conftest import ODD

TEMPLATES = [(n, L.bigrams(t)) for n, texts in L.TEMPLATES.items() for t in texts]


def brute(text):
    """Every line and every paragraph of several lines against every template."""
    spans = {m.span() for m in re.finditer(r"[^\n]+", text)} | {m.span() for m in re.finditer(r"[^\n]+(?:\n[^\n]+)+", text)}
    out = set()
    for a, b in spans:
        g = L.bigrams(text[a:b])
        best = max(((2 * len(g & t) / (len(g) + len(t)), n) for n, t in TEMPLATES), default=(0, "")) if g else (0, "")
        if best[0] >= L.LEAST:
            names = [n for n, t in TEMPLATES if 2 * len(g & t) / (len(g) + len(t)) == best[0]]
            out.add((min(names), a, b, best[0]))
    return out


def test_notices(make):
    texts = ["é intro\nLicensed under the Apache license, version 2.0\nrest",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated\n"
             "documentation files (the “Software”), to deal in the Software without restriction, including without\n"
             "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of\n"
             "the Software, and to permit persons to whom the Software is furnished to do so\n\nother text",
             "All rights reserved. " * 40, "All rights were reserved", "licensed"]
    got = {}
    for r in L.scan_licences(make([(i, t, None, None, None) for i, t in enumerate(texts)])).collect():
        got.setdefault(r.doc_id, set()).add((r.licence, r.start, r.end, r.dice))
    assert got == {i: brute(t) for i, t in enumerate(texts) if brute(t)}
    assert {n for n, *_ in got[0]} == {"Apache-2.0"} and {n for n, *_ in got[1]} == {"MIT"}


def test_odd_rows(make):
    assert L.scan_licences(make(ODD).withColumnRenamed("lang", "licence")).count() == 0
    assert L.scan_licences(make([])).count() == 0
    twice = make([(1, "All rights reserved.", None, None, None)] * 2)
    assert [tuple(r) for r in L.scan_licences(twice).collect()] == [(1, "ARR", 0, 20, 1.0)] * 2


def test_query_equals_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {(d, *x) for d, t in docs.items() for x in brute(t)}
    assert {tuple(r) for r in QUERIES["op9_license_scan"](spark, sf).collect()} == want and want


GPL = ("/*\n * Example tool, made by some people for other people.\n *\n"
       " * This program is free software: you can redistribute it and/or modify\n"
       " * it under the terms of the GNU General Public License as published by\n"
       " * the Free Software Foundation, either version 3 of the License, or\n"
       " * (at your option) any later version.\n *\n"
       " * This program is distributed in the hope that it will be useful, but\n"
       " * without even the implied warranty of merchantability or fitness.\n */\n")


def all_windows(text):
    """Every word window against every template; the best from each first word, then the best of overlapping ones."""
    found = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", text)]
    grams = [(a[2], b[2]) for a, b in zip(found, found[1:])]
    hopes = []
    for name, texts in L.TEMPLATES.items():
        for t in texts:
            want, most = L.bigrams(t), int((len(re.findall(r"[^\W_]+", t)) - 1) * (2 - L.LEAST) / L.LEAST + 1e-9)
            for a in range(len(grams)):
                ends = [b for b in range(a, min(a + most, len(grams))) if grams[a] in want and grams[b] in want]
                dice = [(2 * len(want & set(grams[a:b + 1])) / (len(want) + len(set(grams[a:b + 1]))), b) for b in ends]
                if dice and max(dice)[0] >= L.LEAST:
                    hopes.append((-max(dice)[0], a - max(dice)[1], a, name, max(dice)[1]))
    out, used = [], set()
    for d, _, a, name, b in sorted(hopes):
        if not used & set(range(a, b + 2)):
            used |= set(range(a, b + 2))
            out.append((name, found[a][0], found[b + 1][1], -d))
    return out


def scanned(texts):
    data, offsets = L.utf8(L.pa.array(texts, L.pa.string()))
    got = [[] for _ in texts]
    for row, *rest in L.Matcher(L.TEMPLATES, L.LEAST).scan(data, offsets):
        got[row].append(tuple(rest))
    return got


def test_notices_among_other_words(make):
    texts = {"ARR": "Copyright 2020 Example Corp. All rights reserved.", "GPL-3.0": GPL,
             "MIT": "The text below was released under the MIT License. See the site.",
             "Apache-2.0": "Some words.\r\n \r\nThis tool is licensed under the Apache\r\nLicense, Version 2.0, as told.\r\n \r\nMore."}
    rows = [(i, t, None, None, None) for i, t in enumerate([*texts.values(), "This package is licensed under the MIT License."])]
    got = {r.doc_id: r for r in L.scan_licences(make(rows)).collect()}
    assert [got[i].licence for i in range(5)] == [*texts, "MIT"]
    assert rows[0][1][got[0].start:got[0].end] == "All rights reserved" and got[0].dice == 1.0
    assert rows[2][1][got[2].start:got[2].end] == "released under the MIT License"
    assert rows[1][1][got[1].start:got[1].end].startswith("This program is free") and got[1].dice > 0.99


def test_a_second_notice_in_a_matching_line(make):
    text = "Licensed under the MIT License. Licensed under the Apache License, Version 2.0."
    assert {r[0] for r in scanned([text])[0]} == {"MIT", "Apache-2.0"}


def test_windows_equal_brute_force():
    rnd = random.Random(5)
    notices = [t for texts in L.TEMPLATES.values() for t in texts] + [GPL]
    filler = "the of and to license under rights naïve é “words” mit text this work is software all".split()
    texts = []
    for _ in range(150):
        words = []
        for _ in range(rnd.randint(1, 4)):
            words += rnd.choices(filler, k=rnd.randint(0, 12))
            part = rnd.choice(notices).split()
            words += [w for w in part if rnd.random() > 0.03 * rnd.randint(0, 3)]
        texts.append("".join(w + rnd.choice([" ", " ", " ", "\n", "\r\n", " * "]) for w in words))
    matcher = L.Matcher(L.TEMPLATES, L.LEAST)
    want = [all_windows(t) for t in texts]
    assert [matcher.windows(t) for t in texts] == want and sum(map(len, want)) > 150
    data, offsets = L.utf8(L.pa.array(texts, L.pa.string()))
    assert set(matcher.hopeful(data, offsets)) >= {i for i, w in enumerate(want) if w}
    for text, got in zip(texts, scanned(texts)):
        lines = brute(text)
        assert lines <= set(got)
        assert set(got) - lines <= set(all_windows(text))
        for name, a, b, d in all_windows(text):
            assert any(x < b and a < y for _, x, y, _ in got)
