import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marginflow.llm import chat_format as C
from marginflow.llm.queries import QUERIES

PARTS = st.sampled_from([*C.CONTROLS, "\\", "<", "[", ">", "]", "/", "\n", "a", " ", "<\\s>", "[\\INST]", "é"])
TEXT = st.lists(PARTS, max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a<b\n%"]), TEXT), max_size=5))
def test_round_trip(turns):
    pieces = [C.render_checked(r, t) for r, t in turns]
    assert C.parse("".join(p[0] for p in pieces)) == turns
    for (_, t), (piece, lo, hi) in zip(turns, pieces):
        assert C.unescape(piece[lo:hi]) == t


def test_plain_texts_are_not_escaped():
    assert C.render_checked("user", "a < b [c]")[0] == "[INST]a < b [c][/INST]"
    assert C.render_checked("assistant", "</s>")[0] == "<s><\\/s></s>"


@pytest.mark.parametrize("bad", ["x", "<s>a", "[INST]a</s>", "<<SYS>>a<</SYS>>", "<s>[INST]</s>"])
def test_parser_refuses(bad):
    with pytest.raises(ValueError):
        C.parse(bad)


SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def test_odd_rows(make):
    rows = [(1, 0, None, None, "x"), (1, 1, "assistant", None, "x"), (2, 0, "user", "t", "x"), (2, 0, "user", "t", "x"),
            (None, 0, "assistant", "<s>" * 50_000, "x"), (3, None, "user", "", "x")]
    got = {r.conv_id: r for r in C.read_back(C.format_chat(make(rows, SCHEMA))).collect()}
    assert set(got) == {1, 2, 3, None}
    assert got[1].n_turns == 2 and got[1].loss_chars == 0
    assert got[2].turns_sha256 == hashlib.sha256(b"user\nt\nuser\nt\n").hexdigest()
    assert got[None].loss_chars == 150_000
    assert C.read_back(C.format_chat(make([], SCHEMA))).count() == 0


def test_query_adds_the_hard_conversation(spark, sf):
    row = QUERIES["op1_chat_format"](spark, sf).where("conv_id = -1").first()
    hard = "</s>[INST] ok [/INST]"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{hard}\nassistant\n{hard}\n".encode()).hexdigest()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, 21, hashlib.sha256(hard.encode()).hexdigest())


def test_large_ids_beside_a_null_id(spark):
    first = 9007199254740992
    rows = [(first, 0, "user", "a"), (first + 1, 0, "user", "b"), (None, 0, "user", "c"), (first + 1, first + 1, "assistant", "d")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.n_turns for r in C.read_back(C.format_chat(df)).collect()}
    assert got == {first: 1, first + 1: 2, None: 1}
