"""The gated run: arrivals -> loads that are due -> margin table and file log.

``gated_run`` serves one period, as a daily job does. ``gated_margin`` builds
every due period of a log in one plan: each feed meets the (day, load) pairs
that are due in a semi join, and the day becomes part of the keys that the
margin table joins and groups by, so each day sees its own partition of every
daily input. Neither brings periods to the driver. ``run_due`` is the
job around it: ``commit_run`` publishes both sinks, and scratch tables go.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import arrival
from ..session import materialize, scratch_tables, shared_path
from ..sources.scan import PARTITION_KEYS, load_day
from ..sources.sinks import publish, stage_append, stage_partitions
from .pipeline import MarginInputs, margin_table

# The feeds that a load's files bring.
LOAD_FEEDS: dict[str, tuple[str, ...]] = {
    "rates": ("rates_delta", "rates_vega"), "credit": ("credit_delta",), "fx": ("fx",)}


def on_day(inputs: MarginInputs, day: dt.date) -> MarginInputs:
    """S2 on every input that is partitioned by year/month/day; the others stay whole."""
    frames = {f.name: getattr(inputs, f.name) for f in fields(inputs)}
    return replace(inputs, **{n: load_day(df, day) for n, df in frames.items()
                              if df is not None and set(PARTITION_KEYS) <= set(df.columns)})


def due_loads(tagged: DataFrame, masks: Mapping[str, Sequence[str]], app_id: str, period_start) -> list[str]:
    """A3 for one period: the loads to (re)build. One row per configured load at most comes to the driver."""
    of_period = tagged.where(F.col("period_start") == F.lit(period_start))
    rows = arrival.feeds_to_build(arrival.load_readiness(of_period, masks, app_id)).select("load").collect()
    return sorted(r["load"] for r in rows)


def gated_run(tagged: DataFrame, masks: Mapping[str, Sequence[str]], inputs: MarginInputs, period_start,
              app_id: str, now: dt.datetime, day: dt.date | None = None,
              load_feeds: Mapping[str, Sequence[str]] = LOAD_FEEDS, **options) -> dict[str, DataFrame]:
    """What a run for one period writes: ``margin`` (E9, from the feeds of the loads that are due) and
    ``file_log`` (A4). Nothing due: nothing, and the files stay new.

    ``tagged``: the log with working periods and file sets; ``day`` restricts
    partitioned inputs; ``options`` go to ``margin_table``.
    """
    due = due_loads(tagged, masks, app_id, period_start)
    wanted = {feed for load in due for feed in load_feeds.get(load, ())}
    every = {feed for feeds in load_feeds.values() for feed in feeds}
    chosen = replace(inputs, **{feed: None for feed in every - wanted})
    if not any(getattr(chosen, feed) is not None for feed in wanted):
        return {}
    chosen = on_day(chosen, day) if day else chosen
    of_period = tagged.where(F.col("period_start") == F.lit(period_start))
    return {"margin": margin_table(chosen, **options),
            "file_log": arrival.files_to_record(of_period, masks, app_id, now)}


# ---------------------------------------------------------------- all due periods

#: Inputs besides the feeds that are read by day, and the key that the day becomes part of.
DAILY = ("trades", "pl", "trade_product", "match_ids")
_DAY = 9  # characters of "@yyyyMMdd"


def _day_text() -> Column:
    y, m, d = PARTITION_KEYS
    return F.concat(F.lpad(F.col(y).cast("string"), 4, "0"), F.lpad(F.col(m).cast("string"), 2, "0"),
                    F.lpad(F.col(d).cast("string"), 2, "0"))


def due_days(tagged: DataFrame, masks: Mapping[str, Sequence[str]], app_id: str) -> DataFrame:
    """A3 for all periods: load and the year, month, day on which the period starts. A row per period and load
    of the configuration, so small whatever the log's size."""
    due = arrival.feeds_to_build(arrival.load_readiness(tagged, masks, app_id))
    start = F.col("period_start")
    return due.select("load", F.year(start).alias("year"), F.month(start).alias("month"),
                      F.dayofmonth(start).alias("day")).distinct()


def on_days(df: DataFrame, days: DataFrame) -> DataFrame:
    """S2 for many days: the partitions of ``df`` that ``days`` (year, month, day) names, by a semi join
    (dynamic partition pruning where ``df`` is a partitioned table and ``days`` is filtered)."""
    return df.join(F.broadcast(days.select(*PARTITION_KEYS).distinct()), list(PARTITION_KEYS), "left_semi")


def _keyed_by_day(df: DataFrame) -> DataFrame:
    """The day as part of trade and strategy; a null trade stays null beside its day, a null strategy null."""
    keys = {"trade_id": F.concat(F.coalesce("trade_id", F.lit("")), F.lit("@"), _day_text())}
    if "strategy" in df.columns:
        keys["strategy"] = F.concat("strategy", F.lit("@"), _day_text())
    return df.withColumns(keys).drop(*PARTITION_KEYS)


def gated_margin(tagged: DataFrame, masks: Mapping[str, Sequence[str]], inputs: MarginInputs, app_id: str,
                 load_feeds: Mapping[str, Sequence[str]] = LOAD_FEEDS, **options) -> DataFrame:
    """E9 of every due period at once, with ``period_day``, the day its period starts.

    The feeds and the ``DAILY`` inputs carry year, month, day; a feed's rows count on the days on which its load
    is due, and meet the daily inputs of the same day alone. The other inputs serve all days. Nothing due: no rows.
    """
    of_load = {feed: load for load, feeds in load_feeds.items() for feed in feeds if getattr(inputs, feed) is not None}
    missing = [n for n in (*DAILY, *of_load) if not set(PARTITION_KEYS) <= set(getattr(inputs, n).columns)]
    if missing:
        raise ValueError(f"without year, month, day: {', '.join(missing)}")
    days = materialize(due_days(tagged, masks, app_id)).where(F.col("load").isin(*set(of_load.values())))
    chosen = {feed: _keyed_by_day(on_days(getattr(inputs, feed), days.where(F.col("load") == load)))
              for feed, load in of_load.items()}
    daily = {n: _keyed_by_day(on_days(getattr(inputs, n), days)) for n in DAILY}
    out = margin_table(replace(inputs, **daily, **chosen), **options)
    trade = F.substring("trade_id", F.lit(1), F.length("trade_id") - _DAY)
    return out.withColumns({"period_day": F.to_date(F.right("trade_id", F.lit(_DAY - 1)), "yyyyMMdd"),
                            "trade_id": F.when(trade != "", trade)})


# ---------------------------------------------------------------- sinks

def load_only(tagged: DataFrame, masks: Mapping[str, Sequence[str]], app_id: str, now: dt.datetime) -> dict[str, DataFrame]:
    """The run that builds nothing: the files of due loads are recorded as processed (A4), no margin is made."""
    return {"file_log": arrival.files_to_record(tagged, masks, app_id, now)}


def commit_run(out: Mapping[str, DataFrame], margin_path: str, log_path: str, fail_after_margin=None) -> None:
    """Publish a run's outputs: margin partitions are replaced first, the file log is appended to after them.

    Both are computed and written in staging folders beside ``spark.checkpoint.dir`` first, so a failure while computing
    publishes nothing. Publishing moves finished files. A failure between the two leaves files
    unrecorded, so the next run finds them new, builds their days again and replaces the same partitions; and a
    rerun after the log was published finds nothing new: files are neither lost nor recorded twice.
    ``fail_after_margin`` is called between the two (tests).
    """
    spark = next(iter(out.values())).sparkSession
    staged = []
    if "margin" in out:
        staged.append((stage_partitions(out["margin"], shared_path(spark, "staging")), margin_path, True))
    if "file_log" in out:
        staged.append((stage_append(out["file_log"], shared_path(spark, "staging")), log_path, False))
    for k, (source, target, partitions) in enumerate(staged):
        if k and fail_after_margin:
            fail_after_margin()
        if partitions or not spark.read.parquet(source).isEmpty():
            publish(spark, source, target, replace_partitions=partitions)


def run_due(tagged: DataFrame, masks: Mapping[str, Sequence[str]], inputs: MarginInputs | None, app_id: str, now: dt.datetime,
            margin_path: str, log_path: str, **options) -> None:
    """The whole job: build every due period, publish the margin partitions, then record the files (A2 -> A3 -> E9 -> A4).

    ``inputs`` None: the load-only run, which records the files of due loads and builds nothing. Nothing due: nothing
    is published. Tables and staging folders made on the way are removed, also after a failure. ``options`` go to ``gated_margin``.
    """
    with scratch_tables(tagged.sparkSession):
        out = load_only(tagged, masks, app_id, now)
        if inputs is not None:
            out["margin"] = gated_margin(tagged, masks, inputs, app_id, **options)
        commit_run(out, margin_path, log_path)
