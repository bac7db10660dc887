"""Feeds at size: what goes before the shuffles, one shuffle by trade, partitions that grow with the input."""


from marginflow import session
from marginflow.operators import joins

def _sens(spark):
    return spark.createDataFrame([("T1", "P1", "C1", "0182", 5), ("T1", "P1", "C2", "0182", 6), (None, "P1", None, "0182", 7),
                                  ("T1", None, "C1", "0182", 8), ("T9", "P1", "C1", "0182", 9)],
                                 "trade_id string, portfolio string, counterparty string, entity string, amount int")


def test_trade_key_is_null_safe(spark):
    rows = [(a, b) for a in (None, "", "T", "T+", "T|1", "+") for b in (None, "", "P", "+P", "|1")]
    keyed = joins.with_trade_key(spark.createDataFrame(rows, "trade_id string, portfolio string"))
    keys = [r[joins.TRADE_KEY] for r in keyed.collect()]
    assert len(set(keys)) == len(rows) and None not in keys


def test_keyed_joins_equal_the_plain_ones(spark):
    sens = _sens(spark)
    trades = spark.createDataFrame([("T1", "P1", "a"), (None, "P1", "b"), ("T1", None, "c"), ("T2", "P1", "d")],
                                   "trade_id string, portfolio string, booked_text string")
    pl = spark.createDataFrame([("T1", "P1", 1), ("T1", "P1", 2), (None, "P1", 3), ("T1", None, 4)],
                               "trade_id string, portfolio string, market_value int")
    for join, right, extra in ((joins.join_trades, trades, {"trade_cols": {"booked_text": "booked_text"}}), (joins.join_pl, pl, {})):
        plain = join(sens, right, **extra)
        keyed = join(joins.with_trade_key(sens), right, **extra).select(*plain.columns)
        assert sorted(map(str, keyed.collect())) == sorted(map(str, plain.collect())) != []


def test_reach(spark, monkeypatch):
    cpty = spark.createDataFrame([("C1",), (None,)], "counterparty string")
    reach = joins.counterparty_reach(cpty)
    assert sorted(r.amount for r in joins.within_reach(_sens(spark), reach).collect()) == [5, 7, 8, 9]
    rows = {r.trade_id: r for r in joins.blank_beyond_reach(_sens(spark), reach, ("trade_id", "portfolio", "entity")).where("not _reached").collect()}
    assert rows["T1"].amount is None and rows["T1"].counterparty == "" and len(rows) == 1
    monkeypatch.setattr(joins, "REACH_ROWS", 1)
    assert joins.counterparty_reach(cpty) is None and joins.within_reach(_sens(spark), None).count() == 5


def test_shuffles_follow_the_input(spark, monkeypatch):
    before = spark.conf.get(session.INITIAL, None)
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 10)
    try:
        session.fit_shuffles(spark.range(1000))
        assert int(spark.conf.get(session.INITIAL)) >= 100
        session.fit_shuffles(spark.range(5))
        assert int(spark.conf.get(session.INITIAL)) >= 100
    finally:
        spark.conf.unset(session.INITIAL) if before is None else spark.conf.set(session.INITIAL, before)
