"""The margin job in steps: shuffles and tables of a step go with it, parts count together."""

import glob
import os

from pyspark.sql import functions as F

from marginflow import session
from marginflow.operators.observe import observe_counts, read_counters
from marginflow.plans import feeds
from marginflow.plans.pipeline import margin_table
from marginflow.plans.queries_pipeline import margin_inputs
from tests.conftest import SF_SMALL


def _live_shuffles(spark):
    """Shuffles that have files: the block manager's, on this one machine."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    blocks = manager.getAllBlocks()
    return {blocks.apply(i).name().split("_")[1] for i in range(blocks.size()) if blocks.apply(i).name().startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, kept = _live_shuffles(spark), spark.conf.get(session.CLEANUP, None)
    session.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert _live_shuffles(spark) <= before and spark.conf.get(session.CLEANUP, None) == kept


def test_settle_removes_what_was_made_on_the_way(spark):
    root = session.ensure_checkpoint_dir(spark)
    before = set(glob.glob(f"{root}/*/*"))
    path = session.shared_path(spark)
    with session.scratch_tables(spark):
        first = session.settle(spark, lambda: session.materialize(spark.range(5)).selectExpr("id + 1 as id"))
        assert len(set(glob.glob(f"{root}/*/*")) - before) == 1
        kept = session.settle(spark, lambda: first, path=path)
    assert len(set(glob.glob(f"{root}/*/*")) - before) == 1 and os.path.isdir(path.removeprefix("file:"))
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3, 4, 5]


def test_margin_table_leaves_the_resolved_rows_alone(spark):
    """Four tables stay, one per feed: the feeds, their shuffles and the rows with products are gone."""
    root, inputs = session.ensure_checkpoint_dir(spark), margin_inputs(spark, SF_SMALL)
    before, shuffles = set(glob.glob(f"{root}/*/*")), _live_shuffles(spark)
    assert margin_table(inputs).count() > 0
    assert len(set(glob.glob(f"{root}/*/*")) - before) == 4
    assert len(_live_shuffles(spark) - shuffles) < 20   # of the last query and of counts that came to the driver


def test_every_traded_row_is_counted(spark):
    """P&L that ends before the trades do does not cut the count of the rows before its join."""
    n = 200
    sens = spark.createDataFrame([(f"T{i:03}", "P", "C", "0182", "front3") for i in range(n)],
                                 "trade_id string, portfolio string, counterparty string, entity string, source_system string")
    trades = spark.createDataFrame([(f"T{i:03}", "P", "01/02/2020", "", "1,0", "0,0", "EUR", "EUR") for i in range(n)],
                                   "trade_id string, portfolio string, booked_text string, maturity_text string, pay_text string, "
                                   "receive_text string, pay_ccy string, receive_ccy string")
    cpty = spark.sql("select 'C' counterparty, '0182' entity, 'K' short_name, 'X' contract, date'2019-01-01' filter_date")
    pl = spark.sql("select 'T000' trade_id, 'P' portfolio, cast(1 as decimal(23,8)) market_value, date'2020-01-01' trade_date")
    counters, before = {}, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        session.materialize(feeds._prefix(sens, trades, cpty, pl, name="v", counters=counters, step=session.materialize))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = {name: rows for name, rows, _ in read_counters(counters)}
    assert got == {"v.input": n, "v.in_scope": n, "v.traded": n, "v.priced": 1, "v.in_perimeter": 1}


def test_parts_of_a_point_count_together(spark):
    counters = {}
    for rows in ([(1,), (None,)], [(2,)], []):
        observe_counts(spark.createDataFrame(rows, "k int"), "p", counters, ("k",)).collect()
    assert read_counters(counters) == [("p", 3, 1)]
