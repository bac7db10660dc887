"""The gated run: only due loads are built, and nothing is recorded where nothing is."""
import datetime as dt
import glob
import os

import pytest

from marginflow import session
from marginflow.operators import arrival
from marginflow.plans import queries_run as run
from marginflow.plans import queries_pipeline as pipe
from marginflow.plans.queries_arrival import APP_ID, NOW, _tagged
from marginflow.plans.runner import commit_run, due_days, due_loads, gated_margin, gated_run, load_only, on_day, on_days, run_due
from marginflow.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_due_and_undue_periods(spark):
    tagged = _tagged(spark, SF_SMALL)
    ready = arrival.load_readiness(tagged, fx.MASKS, APP_ID).toPandas()
    due = ready[ready.common_complete & ready.load_complete & ((ready.new_common_files > 0) | (ready.new_load_files > 0))]
    idle = ready[ready.common_complete & ~ready.period_start.isin(due.period_start)].period_start
    assert len(due) and len(idle)   # a complete common set without a complete load
    inputs = pipe.margin_inputs(spark, SF_SMALL)
    assert gated_run(tagged, fx.MASKS, inputs, idle.min().to_pydatetime(), APP_ID, NOW) == {}
    start = due.period_start.min().to_pydatetime()
    assert due_loads(tagged, fx.MASKS, APP_ID, start) == sorted(due[due.period_start == due.period_start.min()].load)
    out = gated_run(tagged, fx.MASKS, inputs, start, APP_ID, NOW)
    assert {r.source_name for r in out["margin"].select("source_name").distinct().collect()} <= {
        "DeltaIR", "DeltaInfl", "VegaIR", "PV", "Notional"}
    recorded = arrival.files_to_record(tagged, fx.MASKS, APP_ID, NOW)
    assert not out["file_log"].isEmpty() and out["file_log"].exceptAll(recorded).isEmpty()


def test_on_day(spark):
    days = spark.createDataFrame([(1, 2024, 1, 5), (2, 2024, 1, 6)], "v int, year int, month int, day int")
    inputs = pipe.margin_inputs(spark, SF_SMALL)
    inputs.fx = days
    got = on_day(inputs, dt.date(2024, 1, 6))
    assert [r.v for r in got.fx.collect()] == [2] and got.trades is inputs.trades


@pytest.fixture(scope="module")
def gate(spark):
    return session.materialize(arrival.tag_file_sets(run.gate_log(spark, SF_SMALL), run.GATE_MASKS))


def test_loads_are_due_in_different_periods(gate):
    days = due_days(gate, run.GATE_MASKS, APP_ID).collect()
    of = {load: {(r.month, r.day) for r in days if r.load == load} for load in ("rates", "credit", "fx")}
    assert all(of.values()) and of["rates"] != of["credit"] != of["fx"] != of["rates"]


def test_all_periods_equal_one_run_per_period(spark, gate):
    """Each due period alone, by its own day's partitions, gives what the one plan gives for it."""
    inputs = run.daily_inputs(spark, SF_SMALL)
    columns = ["trade_id", "portfolio", "match_id", "source_name", "im_model", "risk_type", "bucket", "amount", "dominant_product"]
    whole = gated_margin(gate, run.GATE_MASKS, inputs, APP_ID).select("period_day", *columns).collect()
    starts = sorted({r.period_start for r in arrival.feeds_to_build(
        arrival.load_readiness(gate, run.GATE_MASKS, APP_ID)).select("period_start").collect()})
    assert len(starts) > 5
    for start in (starts[0], starts[len(starts) // 2]):
        one = gated_run(gate, run.GATE_MASKS, inputs, start, APP_ID, NOW, start.date())
        want = sorted((tuple(r) for r in one["margin"].select(*columns).collect()), key=str)
        assert sorted((tuple(r)[1:] for r in whole if r.period_day == start.date()), key=str) == want


def test_nothing_due_and_missing_days(spark, gate):
    inputs = run.daily_inputs(spark, SF_SMALL)
    assert gated_margin(gate.limit(0), run.GATE_MASKS, inputs, APP_ID).count() == 0
    with pytest.raises(ValueError, match="trades"):
        gated_margin(gate, run.GATE_MASKS, pipe.margin_inputs(spark, SF_SMALL), APP_ID)


def test_due_days_prune_partitions(spark, gate, scratch):
    feed = run.daily_inputs(spark, SF_SMALL).credit_delta
    feed.where("day <= 9").write.partitionBy("year", "month", "day").parquet(f"{scratch}/feed")
    days = session.materialize(due_days(gate, run.GATE_MASKS, APP_ID)).where("load = 'credit'")
    plan = on_days(spark.read.parquet(f"{scratch}/feed"), days)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "dynamicpruning" in plan.split("== Physical Plan ==")[1]


def _outputs(spark, names, log):
    margin = spark.createDataFrame([(n, 2024, 1, d) for n in names for d in (2, 3)], "name string, year int, month int, day int")
    return {"margin": margin, "file_log": spark.createDataFrame([(f,) for f in log], "path string")}


def test_failure_between_the_sinks(spark, scratch):
    """A run that fails after the margin leaves its files new; the next run replaces the days and records each file once."""
    margin, log = f"{scratch}/margin", f"{scratch}/log"
    spark.createDataFrame([("old", 2024, 1, d) for d in (1, 2)], "name string, year int, month int, day int") \
        .write.partitionBy("year", "month", "day").parquet(margin)

    def fail():
        raise OSError("lost")

    with pytest.raises(OSError):
        commit_run(_outputs(spark, ["a", "b"], ["f1", "f2"]), margin, log, fail)
    assert not os.path.exists(log) or not glob.glob(f"{log}/*.parquet")
    commit_run(_outputs(spark, ["a", "c"], ["f1", "f2"]), margin, log)
    rows = sorted((r.name, r.day) for r in spark.read.parquet(margin).collect())
    assert rows == [("a", 2), ("a", 3), ("c", 2), ("c", 3), ("old", 1)]
    assert sorted(r.path for r in spark.read.parquet(log).collect()) == ["f1", "f2"]
    commit_run({"file_log": _outputs(spark, [], ["f3"])["file_log"]}, margin, log)
    assert sorted(r.path for r in spark.read.parquet(log).collect()) == ["f1", "f2", "f3"]


def test_failure_while_computing_publishes_nothing(spark, scratch):
    out = _outputs(spark, ["a"], ["f1"])
    out["file_log"] = out["file_log"].selectExpr("raise_error('lost') as path")
    with pytest.raises(Exception, match="lost"):
        commit_run(out, f"{scratch}/margin", f"{scratch}/log")
    assert not os.path.exists(f"{scratch}/margin") and not os.path.exists(f"{scratch}/log")


def test_recorded_files_are_not_new_again(spark, gate):
    log = load_only(gate, run.GATE_MASKS, APP_ID, NOW)["file_log"]
    assert not log.isEmpty()
    columns = ["path", "app_id", "loaded_at", "status"]
    after = arrival.tag_file_sets(run.gate_log(spark, SF_SMALL).select(*columns).unionByName(log.select(*columns)), run.GATE_MASKS)
    again = load_only(session.materialize(after), run.GATE_MASKS, APP_ID, NOW)["file_log"]
    assert again.join(log, ["path", "loaded_at", "load"], "left_semi").isEmpty()


def test_scratch_tables_go(spark):
    root = session.ensure_checkpoint_dir(spark)
    before = set(glob.glob(f"{root}/*/*"))
    with session.scratch_tables(spark):
        assert session.materialize(spark.range(5)).count() == 5
        assert set(glob.glob(f"{root}/*/*")) - before
    assert set(glob.glob(f"{root}/*/*")) == before


def test_the_job_runs_once_and_leaves_no_scratch(spark, gate, scratch):
    """The first run publishes margin partitions and log; the second, with that log, finds nothing due and changes nothing."""
    root = session.ensure_checkpoint_dir(spark)
    margin, log, columns = f"{scratch}/margin", f"{scratch}/log", ["path", "app_id", "loaded_at", "status"]
    inputs = run.daily_inputs(spark, SF_SMALL)
    before = set(glob.glob(f"{root}/*/*"))
    run_due(gate, run.GATE_MASKS, inputs, APP_ID, NOW, margin, log)
    assert set(glob.glob(f"{root}/*/*")) == before
    days = {(r.year, r.month, r.day) for r in spark.read.parquet(margin).select("year", "month", "day").distinct().collect()}
    due = {(r.year, r.month, r.day) for r in due_days(gate, run.GATE_MASKS, APP_ID).collect()}
    assert days and days <= due
    recorded = spark.read.parquet(log)
    assert recorded.count() == load_only(gate, run.GATE_MASKS, APP_ID, NOW)["file_log"].count()
    files = set(glob.glob(f"{scratch}/**/*.parquet", recursive=True))
    after = session.materialize(arrival.tag_file_sets(
        run.gate_log(spark, SF_SMALL).select(*columns).unionByName(recorded.select(*columns)), run.GATE_MASKS))
    run_due(after, run.GATE_MASKS, inputs, APP_ID, NOW, margin, log)
    assert set(glob.glob(f"{scratch}/**/*.parquet", recursive=True)) == files
    run_due(gate, run.GATE_MASKS, None, APP_ID, NOW, f"{scratch}/none", f"{scratch}/only")
    assert not os.path.exists(f"{scratch}/none") and spark.read.parquet(f"{scratch}/only").count() == recorded.count()
