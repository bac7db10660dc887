"""Queries for file-arrival control over the whole file log (each with its oracle)."""

from __future__ import annotations

import datetime as dt

from ..operators import arrival
from ..sources import fixtures as fx
from ..session import materialize
from .registry import query, ymdhms

APP_ID = "margin"
NOW = dt.datetime(2024, 2, 1, 9, 30, 0)

# Oracle: working periods through an explicit calendar (independent of the Spark rule)
_WP_SQL = """
bounds as (select cast(min(loaded_at) as date) - 20 as lo, cast(max(loaded_at) as date) + 20 as hi from file_log),
cal as (select cast(t.d as date) as d from bounds, range(bounds.lo, bounds.hi + 1, interval 1 day) t(d)),
cal2 as (select d, not (dayofweek(d) in (0, 6) or (day(d) = 1 and month(d) = 1) or (day(d) = 1 and month(d) = 5)
                        or (day(d) = 25 and month(d) = 12)) as working from cal),
cal3 as (select d, working,
   max(case when working then d end) over (order by d rows between unbounded preceding and 1 preceding) as prev_w,
   min(case when working then d end) over (order by d rows between 1 following and unbounded following) as next_w
   from cal2),
wp as (select l.*, row_number() over () as rid,
   case when c.working and l.loaded_at >= c.d + interval 18 hour then c.d + interval 18 hour
        else c.prev_w + interval 18 hour end as period_start,
   case when c.working and l.loaded_at < c.d + interval 18 hour then c.d + interval 18 hour
        else c.next_w + interval 18 hour end as period_end
   from file_log l join cal3 c on cast(l.loaded_at as date) = c.d),
tagged as (select w.*, m.load, m.mask from wp w join masks m on regexp_matches(w.path,
   replace(replace(m.mask, '{FI}', strftime(w.period_start, '%Y%m%d')), '{FF}', strftime(w.period_end, '%Y%m%d')))),
sets as (select distinct rid, period_start, period_end, loaded_at, app_id, path, status, load from tagged),
periods as (select distinct period_start, period_end from tagged),
cfg as (select load, count(distinct mask) as n_cfg from masks group by load),
found as (select period_start, period_end, load, count(distinct mask) as n_found from tagged group by all),
comp as (select p.period_start, p.period_end, c.load, coalesce(f.n_found, 0) = c.n_cfg as complete
         from periods p cross join cfg c left join found f using (period_start, period_end, load)),
hw as (select period_start, period_end, load, max(loaded_at) filter (where app_id = 'margin') as high_water,
              count(*) as n_files from sets group by all),
fresh as (select s.* from sets s join hw using (period_start, period_end, load)
          where hw.high_water is null or s.loaded_at > hw.high_water),
per as (select c.*, coalesce(n.n_new, 0) as n_new from comp c left join
        (select period_start, period_end, load, count(*) as n_new from fresh group by all) n
        using (period_start, period_end, load)),
ready as (select l.period_start, l.period_end, l.load, cm.complete as common_complete, l.complete as load_complete,
   cm.n_new as new_common_files, l.n_new as new_load_files,
   bool_and(l.complete) over (partition by l.period_start, l.period_end) as all_loads_complete
   from per l join per cm on cm.period_start = l.period_start and cm.period_end = l.period_end and cm.load = 'common'
   where l.load <> 'common')"""

_TS = "'%Y-%m-%d %H:%M:%S'"


def _tagged(spark, d):
    # the tagged log feeds several aggregates: tag (regex) once, read it back
    return materialize(arrival.tag_file_sets(fx.file_log(spark, d), fx.MASKS))


@query("working_period", f"""
with {_WP_SQL}
select path, strftime(loaded_at, {_TS}) as loaded_at, strftime(period_start, {_TS}) as period_start,
       strftime(period_end, {_TS}) as period_end from wp""")
def q_working_period(spark, d):
    w = arrival.working_period(fx.file_log(spark, d), "loaded_at")
    return w.select("path", ymdhms("loaded_at").alias("loaded_at"), ymdhms("period_start").alias("period_start"),
                    ymdhms("period_end").alias("period_end"))


@query("match_masks", f"""
with {_WP_SQL}
select path, app_id, strftime(loaded_at, {_TS}) as loaded_at, status, strftime(period_start, {_TS}) as period_start,
       load, mask from tagged""")
def q_match_masks(spark, d):
    m = arrival.match_masks(_tagged(spark, d))
    return m.select("path", "app_id", ymdhms("loaded_at").alias("loaded_at"), "status",
                    ymdhms("period_start").alias("period_start"), "load", "mask")


@query("arrivals_complete", f"""
with {_WP_SQL}
select strftime(period_start, {_TS}) as period_start, strftime(period_end, {_TS}) as period_end, load, complete from comp""")
def q_arrivals_complete(spark, d):
    c = arrival.arrivals_complete(_tagged(spark, d), fx.MASKS)
    return c.select(ymdhms("period_start").alias("period_start"), ymdhms("period_end").alias("period_end"),
                    "load", "complete")


@query("high_water", f"""
with {_WP_SQL}
select strftime(period_start, {_TS}) as period_start, load, strftime(high_water, {_TS}) as high_water, n_files from hw""")
def q_high_water(spark, d):
    h = arrival.high_water(arrival.file_sets(_tagged(spark, d)), APP_ID)
    return h.select(ymdhms("period_start").alias("period_start"), "load",
                    ymdhms("high_water").alias("high_water"), "n_files")


@query("load_readiness", f"""
with {_WP_SQL}
select strftime(period_start, {_TS}) as period_start, strftime(period_end, {_TS}) as period_end, load,
       common_complete, load_complete, new_common_files, new_load_files, all_loads_complete from ready""")
def q_load_readiness(spark, d):
    r = arrival.load_readiness(_tagged(spark, d), fx.MASKS, APP_ID)
    return r.select(ymdhms("period_start").alias("period_start"), ymdhms("period_end").alias("period_end"),
                    "load", "common_complete", "load_complete", "new_common_files", "new_load_files",
                    "all_loads_complete")


@query("feeds_to_build", f"""
with {_WP_SQL}
select strftime(period_start, {_TS}) as period_start, load from ready
where common_complete and load_complete and (new_common_files > 0 or new_load_files > 0)""")
def q_feeds_to_build(spark, d):
    r = arrival.load_readiness(_tagged(spark, d), fx.MASKS, APP_ID)
    f = arrival.feeds_to_build(r)
    return f.select(ymdhms("period_start").alias("period_start"), "load")


@query("files_to_record", f"""
with {_WP_SQL},
built as (select distinct period_start, period_end from ready
          where common_complete and load_complete and (new_common_files > 0 or new_load_files > 0)),
wanted as (select period_start, period_end, 'common' as load from built
           union all select period_start, period_end, load from ready join built using (period_start, period_end)
           where common_complete and load_complete)
select f.path, 'margin' as app_id, strftime(f.loaded_at, {_TS}) as loaded_at, f.status, f.load,
       '2024-02-01 09:30:00:000' as created_at, '20240201' as process_date
from fresh f join wanted w using (period_start, period_end, load)""")
def q_files_to_record(spark, d):
    r = arrival.files_to_record(_tagged(spark, d), fx.MASKS, APP_ID, NOW)
    return r.select("path", "app_id", ymdhms("loaded_at").alias("loaded_at"), "status", "load",
                    "created_at", "process_date")

