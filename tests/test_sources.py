"""Scans (S1-S4) and simple predicates (F12, F17) on a partitioned table."""
import datetime as dt
import os

from pyspark.sql import functions as F

from marginflow.operators import filters
from marginflow.sources import fixtures as fx
from marginflow.sources.scan import load_day, load_latest, load_xml, newest_partition, read_table, scan
from tests.conftest import SF_SMALL


def _partitioned_orders(spark, scratch):
    path = os.path.join(scratch, "orders_by_day")
    o = read_table(spark, SF_SMALL, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("day"))
    o.write.partitionBy("year", "month", "day").parquet(path)
    return path, o


def test_scan_prunes_and_pushes(spark, scratch):
    path, o = _partitioned_orders(spark, scratch)
    day = o.select("year", "month", "day").orderBy("year", "month", "day").first()
    d = dt.date(day.year, day.month, day.day)
    df = scan(spark, path, fields=["o_orderkey", "o_totalprice"], day=d, where=F.col("o_totalprice") > 0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "o_totalprice" in plan
    want = o.where((F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day)
                   & (F.col("o_totalprice") > 0)).count()
    assert df.count() == want
    assert df.columns == ["o_orderkey", "o_totalprice"]


def test_load_latest_and_day(spark, scratch):
    path, o = _partitioned_orders(spark, scratch)
    t = spark.read.parquet(path)
    newest = o.agg(F.max(F.struct("year", "month", "day")).alias("m")).first().m
    got = load_latest(t).select("year", "month", "day").distinct().collect()
    assert [tuple(r) for r in got] == [tuple(newest)]
    import io
    from contextlib import redirect_stdout
    with redirect_stdout(io.StringIO()) as plan:
        load_latest(t).explain()
    assert "PartitionFilters" in plan.getvalue() and "NestedLoop" not in plan.getvalue()
    assert load_latest(t.limit(0)).isEmpty()
    assert load_latest(t.drop("year")).count() == t.count()   # no partition triple: whole table
    assert load_day(t, dt.date(1900, 1, 1)).count() == 0


def test_load_xml_and_period_and_has_rows(spark):
    x = fx.cpty_xml(spark, SF_SMALL)
    assert load_xml(x, "doc").count() == x.count()
    assert load_xml(x, "doc", "<NOPE>").count() == 0
    log = fx.file_log(spark, SF_SMALL)
    a, b = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
    half = filters.in_period(log, "loaded_at", a, b).count()
    closed = filters.in_period(log, "loaded_at", a, b, inclusive_end=True).count()
    assert 0 < half <= closed
    assert filters.has_rows(log) and not filters.has_rows(log.where("false"))


def test_newest_partition_is_listed_not_read(spark, scratch):
    rows = [(v, 2023, 12, 31) for v in range(3)] + [(9, 2024, 2, 9), (10, 2024, 2, 10), (11, 2024, 1, 31)]
    path = f"{scratch}/t"
    spark.createDataFrame(rows, "v int, year int, month int, day int").write.partitionBy("year", "month", "day").parquet(path)
    os.makedirs(f"{path}/year=2025/month=1/day=1")  # empty
    assert newest_partition(spark, path) == (2024, 2, 10)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("newest")
    spark.sparkContext.setJobGroup("newest", "")
    latest = load_latest(spark.read.schema("v int, year int, month int, day int").parquet(path), path=path)
    assert tuple(spark.sparkContext.statusTracker().getJobIdsForGroup("newest")) == tuple(jobs)  # no job ran
    assert [tuple(r) for r in latest.collect()] == [(10, 2024, 2, 10)]
    plan = latest._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "(year" in plan.split("PartitionFilters:")[1]
    assert newest_partition(spark, f"{scratch}") is None
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
