import random
import re
from collections import Counter, defaultdict

import numpy as np

from marginflow.llm import _text as T
from marginflow.llm import near_dedup as N
from marginflow.llm.queries import QUERIES
from tests.llm.conftest import ODD

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingle_set(text, k):
    w = _WORD.findall((text or "").translate(_LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(docs, k=4, percent=80):
    """{doc_id: (n_shingles, component)} by counting shared shingles of all pairs that share one."""
    sets = {d: shingle_set(t, k) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sorted(sets.items()):
        shared = Counter(e for g in s for e in holders[g])
        for e, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                parent[b] = a
        for g in s:
            holders[g].append(d)
    return {d: (len(sets[d]), find(d)) for d in docs}


def check(rows, docs, k=4):
    want = brute(docs, k)
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_shingle_sets():
    texts = ["A b c d e", "a  b\tc D", "x y", "", "  ", "a b c d a b c d"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    starts, ends, rows = T.words(data, offsets)
    found, bounds = T.shingles(T.word_hashes(data, starts, ends), rows, len(texts), 4)
    sets = [set(found[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
    assert [len(s) for s in sets] == [len(shingle_set(t, 4)) for t in texts]
    assert len(sets[0] & sets[1]) == 1 and sets[1] < sets[5]


def test_estimate_is_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for n in (30, 200, 3000) * 60:
        u = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        keep = int(len(u) * rng.uniform(0.6, 1))
        v = np.unique(np.concatenate([u[rng.permutation(len(u))[:keep]], rng.integers(0, 2**63, len(u) - keep, dtype=np.uint64)]))
        true = len(np.intersect1d(u, v)) / len(np.union1d(u, v))
        est, filled = N.estimate(N.registers(u)[None], N.registers(v)[None], [len(u)], [len(v)])
        errors.append((est[0] - true) / N.deviation(true if true < 1 else 0.99, filled, [len(u)], [len(v)])[0])
    assert abs(np.mean(errors)) < 0.5 and np.max(np.abs(errors)) < 6


def family(seed, groups, size, words=60, changes=(0, 6)):
    rnd = random.Random(seed)
    docs, n = {}, 0
    for _ in range(groups):
        base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rnd.randint(*changes)):
                copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(10**6)}"
            docs[n] = " ".join(copy)
            n += 1
    return docs


def test_many_near_copies(spark, make):
    docs = family(5, 3, 120)
    rows = N.near_duplicates(make([(i, t, None, None, None) for i, t in docs.items()])).collect()
    check(rows, docs)


def test_blocks_of_large_buckets(spark, make, monkeypatch):
    """Buckets compared block by block find the same components."""
    monkeypatch.setattr(N, "BLOCK", 16)
    docs = family(9, 1, 150, changes=(2, 8))
    rows = N.near_duplicates(make([(i, t, None, None, None) for i, t in docs.items()])).collect()
    check(rows, docs)


def crowded(make, docs):
    """Sizes of the buckets of more than one node."""
    nodes = N.signatures(make([(i, t, None, None, None) for i, t in docs.items()])).where("node is not null").dropDuplicates(["node"])
    return sorted(r["count"] for r in N.meeting_keys(nodes, N.first_shingles(nodes, 80)).groupBy("key").count().where("count > 1").collect())


def test_unrelated_texts_do_not_meet_by_chance(make):
    """Short texts once met wherever one register of a band agreed, in numbers that grew with their square."""
    docs = family(3, 800, 1, words=40, changes=(0, 0)) | {1000 + i: t for i, t in family(4, 100, 1, words=190, changes=(0, 0)).items()}
    assert sum(crowded(make, docs)) < 20


def test_frequent_shingles_come_last(make):
    """A line that all texts share brings no two of them together."""
    shared = " ".join(f"s{i}" for i in range(8))
    docs = {i: f"{t} {shared}" for i, t in family(6, 200, 1, words=60, changes=(0, 0)).items()}
    assert sum(crowded(make, docs)) < 20


def test_a_pair_is_told_once(spark, make, monkeypatch):
    """Near copies that share many buckets and stay apart at first: no pair leaves the second search twice."""
    seen, write = [], N.materialize
    monkeypatch.setattr(N, "materialize", lambda df, *a, **k: seen.append(write(df, *a, **k)) or seen[-1])
    docs = family(12, 2, 60, words=60, changes=(1, 4))
    N.near_duplicates(make([(i, t, None, None, None) for i, t in docs.items()]))
    pairs = [sorted(tuple(sorted(r)) for r in df.collect()) for df in seen if df.columns == ["node_a", "node_b"]]
    assert len(pairs) == 4 and any(pairs) and all(len(set(p)) == len(p) for p in pairs)


def test_sizes_about_the_limit_of_small_sets(make):
    """Pairs of which one, both or none are small sets; the families are linked as all pairs say."""
    docs = {}
    for words in (30, 130, 164, 175, 200, 206, 230):
        docs |= {words * 1000 + i: t for i, t in family(words, 4, 8, words=words, changes=(0, max(3, words // 40))).items()}
        docs |= {words * 1000 + 500 + i: " ".join(t.split()[:words * 17 // 20]) for i, t in family(words, 4, 8, words=words, changes=(0, 1)).items()}
    check(N.near_duplicates(make([(i, t, None, None, None) for i, t in docs.items()])).collect(), docs)


def test_odd_rows(make):
    rows = N.near_duplicates(make(ODD).withColumnRenamed("lang", "node").withColumnRenamed("source", "label")).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert got[1] == [(0, 1, True)] and got[2] == [(0, 2, True)] and got[3] == [(0, 3, True)]
    assert got[4] == [(1, 4, True)] and got[5] == [(7, 5, True)] * 2 and got[6] == [(7, 5, False)] and got[7] == [(1, 7, True)]
    assert N.near_duplicates(make([])).count() == 0


def test_query_equals_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(QUERIES["op7_near_dedup"](spark, sf).collect(), docs)
