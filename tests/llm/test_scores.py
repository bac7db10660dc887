import numpy as np
import pytest

from marginflow.llm import _text, quality_rules, toxicity
from marginflow.llm.queries import QUERIES
from tests.llm.conftest import ODD

LABELS = "doc_id long, quality int, toxic int"


def held_out_auc(spark, sf, name, label):
    rows = QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    rows = rows[rows.held_out]
    a, b = rows[rows[label] == 1].score.values, rows[rows[label] == 0].score.values
    return (np.sign(a[:, None] - b[None, :]) / 2 + 0.5).mean()


@pytest.mark.parametrize("name,label", [("op4_quality", "quality"), ("op10_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    assert held_out_auc(spark, "/root/testdata/sf0.01", name, label) > 0.8


def test_text_statistics():
    texts = ["", "Ab c!!\nd.", "aaaa", "É #1"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    got = quality_rules.text_statistics(data, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    assert got["chars"].tolist() == [0, 9, 4, 4] and got["words"].tolist() == [0, 3, 1, 2]
    assert got["caps_share"][1] == 1 / 9 and got["caps_share"][3] == 1 / 4
    assert got["shout_share"].tolist() == [0, 1 / 3, 0, 0] and got["closed_share"].tolist() == [0, 1, 0, 0]
    assert got["repeat_share"].tolist() == [0, 1 / 9, 3 / 4, 0] and got["mark_share"][3] == 1 / 4


def test_rules_compile_to_columns(make):
    model = quality_rules.Model(-1.0, [((("chars", "<=", 5.0),), 3.0), ((("chars", ">", 5.0), ("words", "<=", 1.0)), 1.0)])
    got = {r.doc_id: r.score for r in quality_rules.score(make([(1, "a", "", "", 0), (2, "long words", "", "", 0),
                                                                (3, "longword", "", "", 0)]), model).collect()}
    assert [round(got[i], 6) for i in (1, 2, 3)] == [round(1 / (1 + np.exp(-x)), 6) for x in (2, -1, 0)]


@pytest.mark.parametrize("module", [quality_rules, toxicity])
def test_odd_rows_and_missing_labels(make, module):
    docs = make(ODD).withColumnRenamed("lang", "score").withColumnRenamed("source", "q_chars")
    none = make([], LABELS)
    one = make([(4, 1, 0), (4, 1, 0), (None, 0, 1), (5, None, None)], LABELS)
    both = make([(4, 0, 1), (5, 1, 0), (6, 1, 0), (7, 0, 1), (2, 1, 0)], LABELS)
    for labels in (none, one, both):
        model = module.fit(docs, labels)
        rows = module.score(docs, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        by = {}
        for r in rows:
            by.setdefault(r.text, set()).add(r.score)
        assert all(len(v) == 1 for v in by.values())
        assert module.score(docs.limit(0), model).count() == 0


def test_windows_hold_every_word():
    text = toxicity.normalise("Some words  here\n" * 40 + "x" * 300 + " end")
    pieces = toxicity.windows(text)
    assert max(map(len, pieces)) <= toxicity.WINDOW
    assert b"".join(pieces).replace(b" ", b"") == text.replace(b" ", b"")
    assert toxicity.windows(toxicity.normalise("")) == [b"  "] or toxicity.windows(toxicity.normalise("")) == []


def test_dictionaries_tell_toxic_words():
    rng = np.random.default_rng(0)
    stock = ["".join(rng.choice(list("abcdeilnorst"), 6)) for _ in range(400)]
    rows = []
    for i in range(400):
        words = [stock[j] for j in rng.integers(0, 400, 80)]
        if i % 4 == 0:
            words[10:40:10] = ["villainous", "wretched", "scoundrel"]
        rows.append((" ".join(words), int(i % 4 == 0), 1.0))
    model = toxicity.fit_rows(rows[:300])
    compress = model.compressors()
    p = model.probability(np.array([model.statistics(toxicity.gains(compress, toxicity.windows(toxicity.normalise(t))))
                                    for t, _, _ in rows[300:]]))
    y = np.array([v for _, v, _ in rows[300:]])
    assert p[y == 1].min() > p[y == 0].max()


def test_utf8_of_slices():
    import pyarrow as pa
    data, offsets = _text.utf8(pa.array(["ab", None, "", "é"]).slice(1))
    assert [data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])] == [b"", b"", "é".encode()]


def plain_statistics(text):
    """The statistics of ``quality_rules``, character by character."""
    letters = lambda c: c.isascii() and c.islower() or ord(c) > 127
    # a capital of the Latin-1 letters (two bytes from C3 80 to C3 9E) counts as one
    capital = lambda c: "A" <= c <= "Z" or "\u00c0" <= c <= "\u00de"
    chars = len(text)
    words = len(text.encode().split())
    lines = text.count("\n") + (chars > 0)
    raw = text.encode()
    c, w, n = max(chars, 1), max(words, 1), max(lines, 1)
    runs = sum(letters(x) and (i == 0 or not letters(text[i - 1])) for i, x in enumerate(text))
    return dict(zip(quality_rules.STATISTICS, (
        chars, words, chars / w, sum(map(capital, text)) / c, sum("0" <= x <= "9" for x in text) / c,
        sum(x in "#$%&*@^~_=+<>{}[]\\|" for x in text) / c, sum(a == b == "!" for a, b in zip(text, text[1:])) / w,
        sum(x in ".,;:?" for x in text) / w, words / n,
        sum(x in ".!?" and (i + 1 == chars or text[i + 1] == "\n") for i, x in enumerate(text)) / n,
        sum(a == b and b > 32 for a, b in zip(raw, raw[1:])) / c, runs / w)))


def test_quality_scores_equal_plain_rules(spark, sf):
    """Every text's score, from its characters and the fitted rules one by one."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality_rules.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert len(model.rules) > 2
    for r in quality_rules.score(docs, model).collect():
        s = plain_statistics(r.text or "")
        z = model.intercept + sum(w for rule, w in model.rules
                                  if all(s[n] <= b if op == "<=" else s[n] > b for n, op, b in rule))
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9), r.doc_id


def test_toxicity_scores_equal_plain_compression(spark, sf):
    """Every text's score, from each window's two compressed lengths."""
    import zstandard
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))

    def length(window, dictionary):
        given = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        given.precompute_compress(level=toxicity.LEVEL)
        made = zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=given, write_content_size=False, write_checksum=False,
                                        write_dict_id=False)
        return len(made.compress(window))

    known = {}
    rows = sorted(toxicity.score(docs, model).collect(), key=lambda r: len(r.text or ""))[:60]
    for r in rows:
        saved = []
        for w in toxicity.windows((" " + " ".join((r.text or "").lower().split()) + " ").encode()):
            if w not in known:
                known[w] = length(w, model.ordinary) - length(w, model.toxic + model.ordinary)
            saved.append(known[w])
        top = sorted(saved)[-3:] or [0]
        n = max(1, len(saved))
        high = sum(g >= model.threshold for g in saved)
        x = [top[-1], sum(top) / len(top), sum(max(g, 0) for g in saved) / n, sum(g >= model.threshold - 1 for g in saved) / n,
             high / n, np.log1p(high)]
        z = model.weights[0] + sum((v - m) / s * b for v, m, s, b in zip(x, model.mean, model.spread, model.weights[1:]))
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(z, -40, 40))), abs=1e-9), r.doc_id
