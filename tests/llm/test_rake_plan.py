from pyspark.sql import functions as F

from marginflow.llm import mixing


def test_rake_plan_does_not_grow(spark, monkeypatch):
    """Each step reads a written table: one aggregate a step, however many margins there are."""
    cells = spark.createDataFrame([(f"s{i % 3}", f"l{i % 2}", f"t{i % 4}", float(i + 1)) for i in range(24)],
                                  "m_source string, m_lang string, m_topic string, m_tokens double")
    cells = cells.groupBy("m_source", "m_lang", "m_topic").agg(F.sum("m_tokens").alias("m_tokens"))
    targets = {k: mixing.tempered_targets(cells, k) for k in ("m_source", "m_lang", "m_topic")}
    plans, write = [], mixing.materialize

    def seen(df, **how):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate ["))
        return write(df, **how)

    monkeypatch.setattr(mixing, "materialize", seen)
    fitted = mixing.rake(cells, targets, sweeps=2)
    assert max(plans[1:]) <= 1 and len(plans) == 7
    total = cells.agg(F.sum("m_tokens")).first()[0]
    got = {r.m_topic: r.share for r in fitted.groupBy("m_topic").agg((F.sum(F.col("m_tokens") * F.col("factor")) / total).alias("share")).collect()}
    want = {r.m_topic: r.target for r in targets["m_topic"].collect()}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want) and "to_m_topic" not in fitted.columns
