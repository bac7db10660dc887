"""Each stage against a plain version of its rule, on the small documents and on planted rows."""
import pytest

import corpus_pipeline as P
from tests.llm.conftest import ODD
from tests.llm.test_near_dedup import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def chain(spark, sf):
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for _, stage in P.STAGES:
        out.append(P.materialize(stage(spark, out[-1], sf)))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(chain):
    assert [name for name, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    for df in chain[:-1]:
        assert df.columns == COLUMNS
    sets = [set(rows(d)) for d in chain]
    assert all(b <= a for a, b in zip(sets, sets[1:])) and all(sets)


def test_near_copies_leave_one(chain):
    before, after = rows(chain[2]), rows(chain[3])
    want = brute({d: r.text for d, r in before.items()}, P.SHINGLE_WORDS, P.LINK_PERCENT)
    assert set(after) == {d for d, (_, c) in want.items() if c == d}


def test_no_passage_is_left(chain, spark, sf):
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before, after = rows(chain[3]), rows(chain[4])
    assert not any(b in r.text for r in after.values() for b in items)
    assert all(any(b in before[d].text for b in items) for d in set(before) - set(after))


def test_run_is_the_chain(chain, spark, sf):
    assert {r.doc_id for r in P.run(spark, sf).collect()} == set(rows(chain[-1]))


def test_planted_lines_and_odd_rows(spark, sf, make):
    page = [(100 + i, f"Own text {i}\nPlease share this page\nmore {i}", "en", f"s{i}", 40) for i in range(8)]
    page += [(200 + i, "Please share this page", "en", f"s{i}", 22) for i in range(2)]
    docs = make([*ODD, *page])
    got = [tuple(r) for r in P.drop_boilerplate(spark, docs, sf).collect()]
    kept = {r[0]: r for r in got}
    assert all(kept[100 + i][1] == f"Own text {i}\nmore {i}" and kept[100 + i][4] == len(f"Own text {i}\nmore {i}")
               for i in range(8))
    assert not {200, 201} & set(kept) and len(got) == len(ODD) + 8
    assert [kept[d][1] for d in (1, 2, 3)] == [None, "", " \n\t "]
    assert sorted(r.doc_id for r in P.drop_near_copies(spark, make(ODD), sf).collect()) == [1, 2, 3, 4, 5, 7]


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_empty_table(spark, sf, make, name, stage):
    assert stage(spark, make([]), sf).count() == 0


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_extra_columns_stay(spark, sf, make, name, stage):
    docs = make(ODD).withColumn("key", P.F.lit(1)).withColumn("score", P.F.lit("s")).withColumn("node", P.F.lit(2.0))
    out = stage(spark, docs, sf)
    assert out.columns[:len(docs.columns)] == docs.columns and out.count() >= 0


def test_one_odd_document_does_not_shrink_the_mixture(spark, sf, make):
    plain = [(i, f"some words of document {i}", "en", f"s{i % 5}", 9) for i in range(3000)]
    got = P.mix_sources(spark, make([*plain, (-1, "other words", "new language", "new source", 9)]), sf).collect()
    assert -1 in {r.doc_id for r in got} and len(got) == pytest.approx(3000 * P.MIX_BUDGET, rel=0.1)


def test_repeated_ids_with_other_texts(spark, sf, make):
    a, b, c = ("one two three four five six seven", "eight nine ten eleven twelve thirteen", "red green blue cyan black white")
    docs = make([(i, t, "en", "s", len(t)) for i, t in ((1, a), (2, a), (2, b), (3, c), (3, c), (None, a), (None, b))])
    got = sorted(((r.doc_id, r.text) for r in P.drop_near_copies(spark, docs, sf).collect()), key=str)
    assert got == sorted([(None, a), (None, b), (3, c)], key=str)
    docs = docs.where("doc_id is not null")
    assert sorted((r.doc_id, r.text) for r in P.drop_near_copies(spark, docs, sf).collect()) == [(1, a), (2, b), (3, c)]
