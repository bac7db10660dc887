import hashlib
from collections import Counter

import numpy as np

from marginflow.llm import fingerprint as P
from tests.llm.conftest import ODD


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_estimates_generalised_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(120):
        a = rng.zipf(1.5, 200) % 300
        b = np.concatenate([a[:rng.integers(0, 200)], rng.zipf(1.5, 100) % 300])
        ta, tb = (" ".join(f"w{x}" for x in v) for v in (a, b))
        x = P.samples([ta.encode(), tb.encode()])
        errors.append(P.likeness(x[:1], x[1:])[0] - jaccard(ta, tb))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.09


def test_same_in_any_block():
    texts = [f"alpha beta {i} gamma beta".encode() for i in range(50)]
    assert (P.samples(texts)[7] == P.samples(texts[7:8])[0]).all()


def test_chain_over_tasks(spark, make):
    texts = {i: f"doc {i} " + " ".join(f"w{i * j % 7}" for j in range(i % 11)) for i in range(97)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r for r in P.fingerprints(make([(i, t, None, None, None) for i, t in texts.items()])
                                                   .repartition(7)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 97
    for i, t in texts.items():
        follow = texts[(i + 1) % 97]
        n = len(t) // 4
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - n] + follow[:n]).encode()).hexdigest()
        own, then = (np.frombuffer(bytes.fromhex(got[k].fingerprint), np.uint16) for k in (i, (i + 1) % 97))
        assert got[i].near_next == (own == then).mean()


def test_odd_rows(make):
    got = P.fingerprints(make(ODD).withColumnRenamed("lang", "kind")).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].fingerprint == by[2][0].fingerprint == by[3][0].fingerprint == "" and by[1][0].near_next == 1.0
    assert by[5][0].fingerprint == by[5][1].fingerprint == by[6][0].fingerprint
    assert by[5][0].near_next == 1.0 and by[2][0].near_edited == 1.0
    assert by[7][0].n_chars == 3000
    assert P.fingerprints(make([])).count() == 0
    alone = P.fingerprints(make([(9, "only one here", None, None, None)])).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"only one honl").hexdigest()


def test_equal_texts_have_equal_fingerprints_whatever_the_blanks(spark):
    rows = [(i, t) for i, t in enumerate(["\u00a0", "\u00a0", "\u2003x", "\u2003x", " \t", " \t", "a", "a"])]
    got = P.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = {r.doc_id: (r.fingerprint, r.edited_fingerprint) for r in got}
    assert all(prints[i][0] == prints[i + 1][0] for i in (0, 2, 4, 6))
    assert prints[0][0] == prints[0][1] != "" and prints[4] == ("", "")
