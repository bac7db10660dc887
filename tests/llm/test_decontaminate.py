import random
import tracemalloc

import numpy as np

from marginflow.llm import decontaminate as D
from marginflow.llm.queries import QUERIES
from tests.llm.conftest import ODD


def words_of(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def plain(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return D.plain_bytes(raw, np.array([0, len(raw)]))[0].tobytes()


def distance(segment, text):
    """Least edits of ``segment`` against any part of ``text``."""
    row = np.zeros(len(text) + 1, int)
    steps = np.arange(len(text) + 1)
    t = np.frombuffer(text, np.uint8)
    for i, c in enumerate(segment):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (t != c))
        row = np.minimum.accumulate(new - steps) + steps
    return row.min()


def test_plain_bytes():
    assert plain(" Ab,  c\n\nÉ1!") == "ab c É1 ".encode()


def test_equals_brute_force_with_edits():
    rnd = random.Random(2)
    items = [(i, words_of(rnd, 30)) for i in range(8)]
    segments = D.Segments(items)
    texts = []
    for i in range(60):
        body = words_of(rnd, 60)
        if i % 2:
            passage = list(rnd.choice(items)[1])
            for _ in range(rnd.randint(0, 24)):
                at = rnd.randrange(len(passage))
                passage[at:at + rnd.randint(0, 1)] = rnd.choice(["", "x", "yz"])
            body = body[:100] + " " + "".join(passage) + " " + body[100:]
        texts.append(body)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    got = {(r, item): e for r, item, _, _, e in segments.search(data, np.cumsum([0, *map(len, texts)]))}
    want = {}
    for r, t in enumerate(texts):
        for s, item in enumerate(segments.item):
            d = distance(segments.text[s].tobytes(), plain(t))
            if d <= segments.edits[s]:
                want[r, item] = min(d, want.get((r, item), 99))
    assert set(got) == set(want) and len(want) > 15
    assert sum(got[k] == want[k] for k in want) == len(want)


def test_spans_in_code_points(make):
    passage = "The quick brown fox jumps over the lazy dog and runs away"
    docs = make([(1, "é— " * 50 + passage + " tail é", "en", "a", 0), (2, "nothing here", "en", "a", 0)])
    bench = make([(7, passage.upper())], "item_id long, text string")
    row, = D.find_passages(docs, bench).collect()
    assert (row.doc_id, row.item_id, row.edits) == (1, 7, 0)
    assert docs.first().text[row.start:row.end] == passage
    assert [r.doc_id for r in D.drop_contaminated(docs, bench).collect()] == [2]


def test_benchmark_in_blocks(spark, sf, monkeypatch):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {tuple(r) for r in D.find_passages(docs, bench).collect()}
    monkeypatch.setattr(D, "BLOCK_BYTES", 2000)
    assert {tuple(r) for r in D.find_passages(docs, bench).collect()} == whole


def test_odd_rows(make):
    bench = make([(1, None), (2, ""), (3, "abc"), (4, "one two three four five six seven eight nine"),
                  (4, "one two three four five six seven eight nine")], "item_id long, text string")
    docs = make(ODD).withColumnRenamed("lang", "item_id")
    got = sorted((r.doc_id, r.item_id) for r in D.find_passages(docs, bench).collect())
    assert got == [(5, 4), (5, 4), (6, 4)]
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, bench).collect()) == [1, 2, 3, 4, 7]
    assert D.find_passages(make([]), bench).count() == 0
    assert D.find_passages(docs, bench.limit(0)).count() == 0


def test_query_finds_whole_items(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, b in items.items() if b in t}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op6_decontaminate"](spark, sf).collect()} >= want and want


def test_many_short_rows_in_one_block_take_little_memory():
    """Thousands of rows that each hold a part of one item, against many segments that share q-grams."""
    rnd = random.Random(4)
    common = words_of(rnd, 8)
    items = [(i, f"{common} {words_of(rnd, 25)}") for i in range(40)]
    segments = D.Segments(items)
    rows = [f"{words_of(rnd, 2)} {items[i % 40][1][:100]}" for i in range(1_000)]
    data = np.frombuffer("".join(rows).encode(), np.uint8)
    tracemalloc.start()
    found = segments.bands(*D.plain_bytes(data, np.cumsum([0, *map(len, rows)]))[:2])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6 and isinstance(found, list)


def test_pieces_change_nothing(spark, sf, monkeypatch):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    texts = [r.text.encode() for r in docs if r.text]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    segments = D.Segments([(r.item_id, r.text) for r in bench])
    whole = segments.search(data, offsets)
    monkeypatch.setattr(D, "PIECE", 3000)
    assert segments.search(data, offsets) == whole and whole
