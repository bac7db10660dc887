"""Sinks (rerun-safe) and the incremental readiness stream."""
import os

from pyspark.sql import functions as F

from marginflow.operators import arrival
from marginflow.sources import fixtures as fx
from marginflow.sources.sinks import write_append, write_partitions
from marginflow.streaming.readiness import start_readiness_stream
from tests.conftest import SF_SMALL


def test_partition_overwrite_is_rerun_safe(spark, scratch):
    path = os.path.join(scratch, "margin")
    df = spark.range(40).select((F.col("id") % 2 + 1).cast("int").alias("day"), F.lit(2024).alias("year"),
                                F.lit(1).alias("month"), F.col("id").alias("v"))
    write_partitions(df, path, files=3)
    write_partitions(df.where("day = 1"), path, files=3)   # rerun one day
    back = spark.read.parquet(path)
    assert back.count() == 40
    assert sorted(r.v for r in back.collect()) == list(range(40))


def test_append_log(spark, scratch):
    path = os.path.join(scratch, "log")
    df = spark.range(10)
    write_append(df, path, files=2)
    write_append(df, path, files=2)
    assert spark.read.parquet(path).count() == 20


def test_readiness_stream_equals_batch(spark, scratch):
    log = fx.file_log(spark, SF_SMALL)
    log_dir, out_dir, ck = (os.path.join(scratch, x) for x in ("log", "out", "ck"))
    halves = log.randomSplit([0.5, 0.5], seed=1)
    halves[0].write.parquet(log_dir)
    q = start_readiness_stream(spark, log_dir, log.schema, out_dir, ck, fx.MASKS, "margin", available_now=True)
    q.awaitTermination(300)
    halves[1].write.mode("append").parquet(log_dir)
    q = start_readiness_stream(spark, log_dir, log.schema, out_dir, ck, fx.MASKS, "margin", available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(out_dir).drop("period")
    full = spark.read.parquet(log_dir)
    want = arrival.load_readiness(arrival.tag_file_sets(full, fx.MASKS), fx.MASKS, "margin")
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_margin_table_write_rerun_read_back(spark, scratch):
    from marginflow.plans.pipeline import margin_table
    from marginflow.plans.queries_pipeline import margin_inputs
    path = os.path.join(scratch, "margin_table")
    m = margin_table(margin_inputs(spark, SF_SMALL))
    write_partitions(m, path, files=4)
    cols = ["trade_id", "im_model", "risk_type", "bucket", "amount"]
    first = sorted(map(tuple, spark.read.parquet(path).select(*cols).collect()), key=str)
    write_partitions(margin_table(margin_inputs(spark, SF_SMALL)), path, files=4)   # rerun the same day
    again = spark.read.parquet(path)
    assert sorted(map(tuple, again.select(*cols).collect()), key=str) == first
    assert set(again.columns) >= {"year", "month", "day", "pnlvar_delta_fx"}
