import duckdb
import pytest

from marginflow.llm import mixing as M
from tests.llm.conftest import ODD
from tools.check_oracle import frame_key


def test_margins_meet_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cells = M.fit_mixture(docs, 0.01).toPandas()
    cells["w"] = cells.m_tokens * cells.factor
    for dim in M.DIMS:
        got = cells.groupby(f"m_{dim}").w.sum() / cells.w.sum()
        raw = cells.groupby(f"m_{dim}").m_tokens.sum() ** M.TEMPER
        assert (got - raw / raw.sum()).abs().max() < 0.01
    used = cells[cells.m_tokens > 0]
    assert used.probability.max() <= 1.0 and (used.probability > 0).all()
    used = used[used.probability < 1]
    ratio = used.probability / used.factor
    assert ratio.max() == pytest.approx(ratio.min())


def test_given_targets(make):
    docs = make([(i, "a b c d", "en" if i % 4 else "fr", "x", 7) for i in range(400)])
    want = make([("en", 0.5), ("fr", 0.5)], "m_lang string, target double")
    rows = M.weigh(docs, M.fit_mixture(docs, 0.45, targets={"m_lang": want})).collect()
    p = {r.lang: r.probability for r in rows}
    assert p["fr"] == pytest.approx(0.9) and p["fr"] == pytest.approx(3 * p["en"])
    drawn = [r.lang for r in rows if r.selected]
    assert 0.35 < drawn.count("fr") / len(drawn) < 0.65


def test_no_python_in_the_plan(spark, sf, capsys):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    M.weigh(docs, M.fit_mixture(docs, 0.3)).explain("extended")
    assert "Python" not in capsys.readouterr().out


def test_odd_rows(make):
    docs = make(ODD).withColumn("topic", M.F.lit(3)).withColumn("factor", M.F.lit("x"))
    rows = M.weigh(docs, M.fit_mixture(docs, 0.3)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.probability <= 1 for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows} == {1: 0, 2: 0, 3: 4, 4: 40_001, 5: 10, 6: 10, 7: 1}
    empty = make([])
    assert M.weigh(empty, M.fit_mixture(empty, 0.3)).count() == 0


def test_sql_equals_spark_on_odd_rows(make, spark):
    docs = make(ODD)
    got = M.weigh(docs, M.fit_mixture(docs, 0.3)).selectExpr("doc_id", "topic", "n_tokens", "round(weight, 6) as weight",
                                                        "round(probability, 6) as probability", "selected").toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert frame_key(got) == frame_key(con.execute(M.oracle_sql(0.3)).df())


@pytest.mark.parametrize("budget", [0.05])
def test_sql_solves_the_same_rate(spark, sf, budget):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.probability for r in M.weigh(docs, M.fit_mixture(docs, budget)).collect()}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    want = dict(con.execute(M.oracle_sql(budget)).df()[["doc_id", "probability"]].itertuples(index=False, name=None))
    assert got == pytest.approx(want, abs=2e-6)


def expected(cells):
    return (cells.m_tokens * cells.probability).sum() / cells.m_tokens.sum()


@pytest.mark.parametrize("budget", [0.1, 0.5, 0.9, 1.0])
def test_budget_is_met(spark, sf, budget):
    cells = M.fit_mixture(spark.read.parquet(f"{sf}/documents.parquet"), budget=budget).toPandas()
    assert expected(cells) == pytest.approx(budget)
    used = cells[cells.m_tokens > 0]
    open_, full = used[used.wanted < 1], used[used.wanted >= 1]
    assert (full.probability == 1).all() and (open_.probability == open_.wanted).all()
    ratio = used.wanted / used.factor
    assert ratio.max() == pytest.approx(ratio.min())
    assert (used.shortfall - used.m_tokens * (used.wanted - used.probability)).abs().max() < 1e-6


def test_one_odd_document_does_not_shrink_the_rest(make):
    plain = [(i, f"some words of document {i}", f"l{i % 2}", f"s{i % 5}", 9) for i in range(3000)]
    odd = (-1, "other words", "new language", "new source", 9)
    share = {}
    for name, rows in (("plain", plain), ("odd", [*plain, odd])):
        got = [r.selected for r in M.weigh(make(rows), M.fit_mixture(make(rows), budget=0.3)).where("doc_id >= 0").collect()]
        share[name] = sum(got) / len(got)
    assert share["plain"] == pytest.approx(0.3, abs=0.03) and share["odd"] == pytest.approx(share["plain"], abs=0.01)
    cells = M.fit_mixture(make([*plain, odd]), budget=0.3).where("m_source = 'new source'").collect()
    assert [(c.probability, c.shortfall > 0) for c in cells] == [(1.0, True)]


def test_budget_of_an_empty_table(make):
    assert M.weigh(make([]), M.fit_mixture(make([]), budget=0.3)).count() == 0
