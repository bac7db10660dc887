import hashlib
import re
import time

import numpy as np

from marginflow.llm import secret_scan as S
from marginflow.llm.queries import QUERIES
from tests.llm.conftest import ODD

BASE = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                              re.I | re.A), 2, 8),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32)]


def brute(text):
    out = sorted((m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(BASE)
                 for m in p.finditer(text or "") if len(m[g]) >= least)
    return ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in out)


def test_queries_from_patterns():
    assert S.trigram_query("[0-9a-f]+") is None
    assert S.trigram_query("AKIA[A-Z0-9]+") == ("and", [b"aki", b"kia"])
    op, parts = S.trigram_query(S.BASE_RULES[0].pattern)
    assert op == "or" and len(parts) == 5 and ("and", [b"tok", b"oke", b"ken"]) in parts
    assert S.trigram_query("ab(cd)?ef") is None  # no run of three letters is mandatory


def test_postings_do_not_cross_texts():
    data = np.frombuffer(b"aktokakia", np.uint8)
    index = S._Postings([b"aki", b"tok"]).build(data, np.array([0, 3, 5, 9]))
    assert index[b"aki"].tolist() == [2] and index[b"tok"].tolist() == []


TEXTS = ["token = abcdefgh, TOKEN:'12345678' token=short", "é AKIA" + "Q" * 12 + " AKIASHORT", "f" * 31 + " " + "0" * 33 + "g",
         "api_key = x passwd=\"aaaaaaaaaaaa\" " + "deadbeef" * 5, "-----BEGIN RSA PRIVATE KEY-----"]


def test_spans(make):
    rows = [(i, t, None, None, None) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: r for r in S.scan_secrets(make(rows)).collect()}
    for i, t in enumerate(TEXTS):
        base = [(k, s, e) for k, s, e in zip(got[i].kinds, got[i].starts, got[i].ends) if k in ("assign", "access", "hex")]
        assert ",".join(f"{k}:{s}:{e}" for k, s, e in base) == brute(t)
    assert got[4].kinds == ["pem"]


def test_odd_rows(make):
    got = S.scan_secrets(make(ODD).withColumnRenamed("lang", "kinds")).collect()
    assert len(got) == len(ODD) and all(r.kinds == [] for r in got)
    assert S.scan_secrets(make([])).count() == 0


def test_query_equals_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op2_secret_scan"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(k + ":") for k in ("assign", "access", "hex"))


def test_hostile_tokens_take_linear_time():
    jwt = next(r for r in S.RULES if r.kind == "jwt")
    for text in ("eyJ" * 1_600_000 + ".eyJ", "eyJa.eyJ" * 600_000, "eyJ-" * 1_200_000):
        start = time.perf_counter()
        S.find(jwt, jwt.compiled(), text)
        assert time.perf_counter() - start < 5
    good = "eyJ" + "a" * 20 + ".eyJ" + "b" * 20 + ".c_-9"
    assert S.find(jwt, jwt.compiled(), f"x {good}, {good}") == [(2, 2 + len(good)), (4 + len(good), 4 + 2 * len(good))]
