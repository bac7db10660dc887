"""File-arrival control (A1-A4, D16, F11, G9, G10, S7) as table operators.

The reference decides, for one run, whether a day's files are complete and
which are new (one Spark job per mask, driver recursion for the calendar).
Here the same rules run over the whole file log at once:

* A1 gives every log row its working period with column expressions only
  (no calendar table, no window, no join): the previous / next working day
  is the first of a bounded number of candidate days that is a working day.
* D16 + F11 date each configured mask with the row's period and keep the
  (load, mask) pairs whose regex matches the path.
* G9 / G10 / A2 are grouped aggregates per (period, load), pre-aggregated on
  every task before the shuffle, so a period holding a third of the log
  never sits whole in one task.

Masks are configuration (a dict of load -> regex list, as in the reference's
settings), so they are literals inside the expressions, not a joined table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Non-working (day, month) dates besides Saturdays and Sundays.
HOLIDAYS = ((1, 1), (1, 5), (25, 12))
DEFAULT_CUTOFF = "18:00:00"
COMMON = "common"
PERIOD = ("period_start", "period_end")


def is_working_day(d: Column, holidays: Sequence[tuple[int, int]] = HOLIDAYS) -> Column:
    """Monday-Friday and not one of the (day, month) holidays."""
    weekend = F.dayofweek(d).isin(1, 7)
    hol = reduce(lambda a, b: a | b,
                 [(F.dayofmonth(d) == dd) & (F.month(d) == mm) for dd, mm in holidays], F.lit(False))
    return ~(weekend | hol)


def _max_gap(holidays: Sequence) -> int:
    # a run of non-working days holds every holiday at most once plus the weekends
    # between them: at most H + 2 * (H // 5 + 2) days; the answer is one step further
    h = len(holidays)
    return h + 2 * (h // 5 + 2) + 1


def _nearest_working(d: Column, step: int, holidays) -> Column:
    shift = F.date_sub if step < 0 else F.date_add
    cands = [shift(d, k) for k in range(1, _max_gap(holidays) + 1)]
    return F.coalesce(*[F.when(is_working_day(c, holidays), c) for c in cands])


def _at(d: Column, cutoff: str) -> Column:
    h, m, s = (int(x) for x in cutoff.split(":"))
    return d.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(h), F.lit(m), F.lit(s))


def working_period(df: DataFrame, ts_col: str = "loaded_at", cutoff: str = DEFAULT_CUTOFF,
                   holidays: Sequence[tuple[int, int]] = HOLIDAYS,
                   start_col: str = "period_start", end_col: str = "period_end") -> DataFrame:
    """A1: start = latest working-day cut-off <= ts; end = first working-day cut-off > ts."""
    ts = F.col(ts_col).cast("timestamp_ntz")
    day = F.to_date(ts)
    working = is_working_day(day, holidays)
    after = ts >= _at(day, cutoff)
    start_day = F.when(working & after, day).otherwise(_nearest_working(day, -1, holidays))
    end_day = F.when(working & ~after, day).otherwise(_nearest_working(day, +1, holidays))
    return df.withColumns({start_col: _at(start_day, cutoff), end_col: _at(end_day, cutoff)})


def dated_mask(mask: Column, start: Column, end: Column) -> Column:
    """Substitute ``{FI}`` / ``{FF}`` with the period's start / end as ``yyyyMMdd``."""
    fi = F.date_format(start, "yyyyMMdd")
    ff = F.date_format(end, "yyyyMMdd")
    return F.replace(F.replace(mask, F.lit("{FI}"), fi), F.lit("{FF}"), ff)


def tag_file_sets(df: DataFrame, masks: Mapping[str, Sequence[str]], path_col: str = "path",
                  ts_col: str = "loaded_at", cutoff: str = DEFAULT_CUTOFF,
                  holidays=HOLIDAYS) -> DataFrame:
    """A1 + D16 + F11: log rows that match at least one mask, with their period and
    ``mask_hits ARRAY<STRUCT<load, mask>>`` (every configured pair whose dated
    regex matches the path)."""
    p = working_period(df, ts_col, cutoff, holidays)
    start, end = F.col(PERIOD[0]), F.col(PERIOD[1])
    # one regex expression per configured mask: each keeps its compiled pattern until the
    # period changes (log rows arrive in time order), instead of recompiling on every row
    checks = [F.when(F.regexp(F.col(path_col), dated_mask(F.lit(m), start, end)),
                     F.struct(F.lit(load).alias("load"), F.lit(m).alias("mask")))
              for load, ms in masks.items() for m in ms]
    hits = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return p.withColumn("mask_hits", hits).where(F.size("mask_hits") > 0)


def match_masks(tagged: DataFrame) -> DataFrame:
    """F11 as rows: one row per (log row, matching load/mask)."""
    base = [c for c in tagged.columns if c != "mask_hits"]
    return tagged.select(*base, F.inline("mask_hits"))


def file_sets(tagged: DataFrame) -> DataFrame:
    """Each log row once per load (file set) it belongs to."""
    base = [c for c in tagged.columns if c != "mask_hits"]
    return tagged.select(*base, F.explode(F.array_distinct(
        F.transform("mask_hits", lambda x: x["load"]))).alias("load"))


def _expected(masks: Mapping[str, Sequence[str]]) -> Column:
    return F.create_map(*[x for load, ms in masks.items() for x in (F.lit(load), F.lit(len(set(ms))))])


def arrivals_complete(tagged: DataFrame, masks: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per (period, load), whether every mask of the load has at least one file.

    One row per configured load for every period that has any matching file
    (a period with no matching file has nothing to load, as in the reference).
    """
    found = match_masks(tagged).groupBy(*PERIOD, "load").agg(F.count_distinct("mask").alias("n_found"))
    periods = tagged.select(*PERIOD).distinct()
    grid = periods.select(*PERIOD, F.explode(F.array(*[F.lit(load) for load in masks])).alias("load"))
    out = grid.join(found, [*PERIOD, "load"], "left")
    return out.select(*PERIOD, "load",
                      (F.coalesce(F.col("n_found"), F.lit(0)) == _expected(masks)[F.col("load")]).alias("complete"))


def high_water(sets: DataFrame, app_id: str, ts_col: str = "loaded_at",
               app_col: str = "app_id") -> DataFrame:
    """Per (period, file set), the newest load time already recorded by ``app_id``
    (null when the app has no row in that set)."""
    return sets.groupBy(*PERIOD, "load").agg(
        F.max(F.when(F.col(app_col) == app_id, F.col(ts_col))).alias("high_water"),
        F.count(F.lit(1)).alias("n_files"))


def new_files(sets: DataFrame, app_id: str, ts_col: str = "loaded_at", app_col: str = "app_id") -> DataFrame:
    """Rows of each (period, file set) later than that set's high-water mark
    (all rows when the app has none). The mark table has one row per
    (period, set), so the join back is broadcast by AQE at run time."""
    hw = high_water(sets, app_id, ts_col, app_col).drop("n_files")
    j = sets.join(hw, [*PERIOD, "load"], "inner")
    return j.where(F.col("high_water").isNull() | (F.col(ts_col) > F.col("high_water"))).drop("high_water")


def load_readiness(tagged: DataFrame, masks: Mapping[str, Sequence[str]], app_id: str,
                   ts_col: str = "loaded_at", app_col: str = "app_id", common: str = COMMON) -> DataFrame:
    """A2: one row per (period, load other than ``common``):
    ``common_complete, load_complete, new_common_files, new_load_files, all_loads_complete``."""
    comp = arrivals_complete(tagged, masks)
    n_new = new_files(file_sets(tagged), app_id, ts_col, app_col) \
        .groupBy(*PERIOD, "load").agg(F.count(F.lit(1)).alias("n_new"))
    per = comp.join(n_new, [*PERIOD, "load"], "left") \
        .withColumn("n_new", F.coalesce(F.col("n_new"), F.lit(0)))
    cm = per.where(F.col("load") == common).select(
        *PERIOD, F.col("complete").alias("common_complete"), F.col("n_new").alias("new_common_files"))
    loads = per.where(F.col("load") != common)
    every = loads.groupBy(*PERIOD).agg(F.bool_and("complete").alias("all_loads_complete"))
    return loads.join(cm, list(PERIOD)).join(every, list(PERIOD)).select(
        *PERIOD, "load", "common_complete", F.col("complete").alias("load_complete"),
        "new_common_files", F.col("n_new").alias("new_load_files"), "all_loads_complete")


def feeds_to_build(readiness: DataFrame) -> DataFrame:
    """A3: loads to (re)build: complete, with the common set complete, and something new."""
    return readiness.where(
        F.col("common_complete") & F.col("load_complete")
        & ((F.col("new_common_files") > 0) | (F.col("new_load_files") > 0))
    ).select(*PERIOD, "load")


def stamp_processed(df: DataFrame, app_id: str, now: dt.datetime, app_col: str = "app_id",
                    created_col: str = "created_at", process_col: str = "process_date") -> DataFrame:
    """Mark files as consumed by ``app_id`` at ``now`` (text stamp
    ``yyyy-MM-dd HH:mm:ss:SSS`` and a ``yyyyMMdd`` process partition)."""
    stamp = now.strftime("%Y-%m-%d %H:%M:%S:") + f"{now.microsecond // 1000:03d}"
    return df.withColumns({app_col: F.lit(app_id), created_col: F.lit(stamp),
                           process_col: F.lit(now.strftime("%Y%m%d"))})


def files_to_record(tagged: DataFrame, masks: Mapping[str, Sequence[str]], app_id: str,
                    now: dt.datetime, ts_col: str = "loaded_at", app_col: str = "app_id",
                    common: str = COMMON) -> DataFrame:
    """A4: in periods of which some load is (re)built, the new common files and the new
    files of every complete load (union all), stamped by S7. Where nothing is built
    nothing is recorded, so the files stay new for the next run."""
    readiness = load_readiness(tagged, masks, app_id, ts_col, app_col, common)
    built = feeds_to_build(readiness).select(*PERIOD).distinct()
    loads_ok = readiness.where(F.col("common_complete") & F.col("load_complete")).select(*PERIOD, "load") \
        .join(built, list(PERIOD), "left_semi")
    wanted = built.select(*PERIOD, F.lit(common).alias("load")).unionByName(loads_ok)
    fresh = new_files(file_sets(tagged), app_id, ts_col, app_col)
    out = fresh.join(wanted, [*PERIOD, "load"], "left_semi")
    keep = [c for c in out.columns if c not in (*PERIOD,)]
    return stamp_processed(out.select(*keep), app_id, now, app_col)

