import hashlib
import random
import re

import pytest

from marginflow.llm.conv_repair import TERMINAL, before, costs, damage, repair, report, walk

TURNS = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def scripts(letters):
    """Every edit script with at most four inserts in a row: (cost, audit, initials)."""
    out = [(0, "", "")]
    for x in letters + "$":
        out = [(c + 3 * n, a + "I" * n, r + w) for c, a, r in out
               for n in range(5) for w in {"ua" * 2, "au" * 2} for w in {w[:n]}]
        if x == "$":
            break
        more = 3 if x.isupper() else 0
        step = [(c + 4, a + "D", r) for c, a, r in out]
        if x not in "bd":
            step += [(c + more, a + "K", r + x.lower()) for c, a, r in out]
            step += [(c + 3 + more, a + "R", r + w) for c, a, r in out for w in "ua"]
        out = [s for s in set(step) if GOOD.fullmatch(s[2]) or any(GOOD.fullmatch(s[2] + t) for t in ("a", "ua"))]
    return min(s for s in out if GOOD.fullmatch(s[2]))


@pytest.mark.parametrize("seed", range(60))
def test_walk_equals_all_scripts(seed):
    r = random.Random(seed)
    letters = "".join(r.choice("uuaasoUASObd") for _ in range(r.randint(0, 5)))
    cost, audit, _ = scripts(letters)
    assert costs(letters, TERMINAL)[0][0] == cost
    done, state = walk(letters, TERMINAL, 0, True)
    assert "".join(e for edits in done for e, _ in edits) == audit
    assert state in (0, 3)


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_checkpoints_change_nothing(block):
    r = random.Random(block)
    letters = "".join(r.choice("uaauosUASbd") for _ in range(500))
    whole, _ = walk(letters, TERMINAL, 0, True)
    cut = [letters[i:i + block] for i in range(0, len(letters), block)]
    after = [TERMINAL]
    for x in reversed(cut[1:]):
        after.append(before(x, after[-1]))
    state, parts = 0, []
    for k, (x, v) in enumerate(zip(cut, reversed(after))):
        done, state = walk(x, v, state, k == len(cut) - 1)
        parts += done
    assert parts == whole


def plain(rows):
    """The report of one conversation's rows, by whole lists."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda v: (v[0] is not None, v[0] or 0, v[1], hashlib.sha256(v[2].encode()).digest()))
    seen, letters, faults = set(), "", []
    for _, role, text in rows:
        solid = text.rstrip(" \t\n\v\f\r")
        first = role[:1] if role[:1] in ("s", "u", "a") else "o"
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        letters += {"blank": "b", "duplicate": "d", "truncated": first.upper()}.get(fault, first)
    done, _ = walk(letters, TERMINAL, 0, True)
    out, state, audit = [], 0, ""
    for row, edits in zip([*rows, None], done):
        for e, to in edits:
            audit += e
            role = {2: "user", 3: "assistant"}.get(to)
            if e != "D":
                out.append(f"{role}:" if e == "I" else f"{role if e == 'R' else row[1]}:{row[2]}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, costs(letters, TERMINAL)[0][0], audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def told(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("block", [3, 4096])
def test_random_conversations(spark, block):
    r = random.Random(5)
    rows = [(c, r.choice([None, *range(12)]), r.choice(["user", "assistant", "system", "tool", "", None]),
             r.choice(["Yes.", "No!", "cut", "", " \n", None, "Why? ", "é"])) for c in [None, *range(40)] for _ in range(r.randint(1, 15))]
    got = told(report(spark.createDataFrame(rows, TURNS), spark.createDataFrame(rows, TURNS), block))
    assert got == {c: plain([x[1:] for x in rows if x[0] == c]) for c in {x[0] for x in rows}}


def test_one_long_conversation(spark):
    rows = [(7, i // 2, "user" if i % 3 else "assistant", f"line {i % 4000}." if i % 5 else "same.") for i in range(20_000)]
    df = spark.createDataFrame(rows, TURNS)
    assert told(report(df, df, 256)) == {7: plain([x[1:] for x in rows])}


def test_script_holds_texts(spark):
    rows = [(1, 0, "system", "Hello."), (1, 1, "user", "cut"), (1, 1, "user", "cut"), (1, 3, "user", ""), (1, 4, "user", "So?")]
    got = [tuple(r)[1:] for r in repair(spark.createDataFrame(rows, TURNS)).collect()]
    assert got == [(0, "K", "system", "Hello.", "system", None, 0), (1, "K", "user", "cut", "user", "truncated", 3),
                   (1, "D", "user", "cut", "user", "duplicate", 4), (3, "D", "user", "", "user", "blank", 4),
                   (4, "R", "assistant", "So?", "user", None, 3)]


def test_odd_rows(spark):
    empty = hashlib.sha256(b"").hexdigest()
    none = spark.createDataFrame([], TURNS)
    assert repair(none).count() == 0 and report(none, none).count() == 0
    ids = spark.createDataFrame([(1,), (None,), (1,)], "conv_id long")
    assert told(report(none, ids)) == {1: (0, 0, 0, 0, 0, 0, "", empty), None: (0, 0, 0, 0, 0, 0, "", empty)}
    long = "word " * 400_000 + "end."
    big = [(1 << 62, 0, "user", long), ((1 << 62) + 1, 0, "user", "a."), (None, None, None, None)]
    got = told(report(spark.createDataFrame(big, TURNS), spark.createDataFrame(big, TURNS)))
    assert got == {c: plain([(t, r, x)]) for c, t, r, x in big}
    more = spark.createDataFrame([("u", 1, "z", "user", 0, "Hi.", "k")],
                                 "letter string, conv_id int, digest string, role string, turn int, text string, edit string")
    assert told(report(more, more)) == {1: plain([(0, "user", "Hi.")])}


def test_damage(spark):
    import zlib
    rows = [(c, t, "assistant", "A. b! c?") for c in range(30) for t in [None, 0, 1, 2]]
    expected = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else "A b c" if kind == 2 else text)
        expected += [row] * {0: 0, 3: 2}.get(kind, 1)
    got = [tuple(r) for r in damage(spark.createDataFrame(rows, TURNS)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
