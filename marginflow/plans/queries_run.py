"""The gated run as registered queries: every due period's margin table, and the run that records files only."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import arrival
from ..session import materialize
from ..sources import fixtures as fx
from . import queries_pipeline as pipe
from .pipeline import MarginInputs
from .queries_arrival import _TS, _WP_SQL, APP_ID, NOW
from .registry import query, r4, ymd, ymdhms
from .runner import gated_margin, load_only

# File masks per load; with the log below, rates, credit and fx are due in different periods.
GATE_MASKS = {
    "common": [r".*sta/view_{FI}[.]txt$", r".*sta/click_{FI}[.]txt$"],
    "rates": [r".*sta/error_{FI}[.]txt$"],
    "credit": [r".*sta/signup_{FI}[.]txt$"],
    "fx": [r".*sta/purchase_{FI}[.]txt$"],
}
FIRST_DAY, DAYS = "2024-01-01", 30   # the days that the feeds are spread over
SHIFT = 9400                         # days from the maturities of the fixtures to those of these feeds


def gate_log(spark, d):
    """The file log without the credit files of every third day and the FX files of every fourth."""
    day = F.dayofmonth("loaded_at")
    return fx.file_log(spark, d).where(~(F.col("path").startswith("sta/signup") & (day % 3 == 0))
                                       & ~(F.col("path").startswith("sta/purchase") & (day % 4 == 1)))


# ---------------------------------------------------------------- inputs by day (both sides)

def _on_day(df, offset):
    """Rows of trade T<n> come on day (n + offset) % DAYS, as partition columns."""
    n = F.expr("cast(substring(trade_id, 2) as bigint)")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), ((n + offset) % DAYS).cast("int"))
    return df.withColumn("_day", day).withColumns(
        {"year": F.year("_day"), "month": F.month("_day"), "day": F.dayofmonth("_day")})


def _feed(df):
    """A feed whose lines come on three days, the horizon being the day of delivery."""
    out = _on_day(df, F.col("line_no") % 3).withColumn("as_of", F.col("_day")).drop("_day")
    if "maturity_text" not in df.columns:
        return out
    later = F.date_add(F.to_date("maturity_text", "dd/MM/yyyy"), SHIFT)
    return out.withColumn("maturity_text", F.date_format(later, "dd/MM/yyyy"))


def _snapshots(df, n, **changed):
    """``df`` on ``n`` days running, with columns that change by day (``off``)."""
    each = _on_day(df.withColumn("off", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))), F.col("off"))
    return each.withColumns(changed).drop("_day", "off")


def daily_inputs(spark, d) -> MarginInputs:
    """The margin inputs as day partitions: feeds over three days, snapshots that differ from day to day."""
    inp = pipe.margin_inputs(spark, d)
    off = F.col("off")
    inp.trades = _snapshots(inp.trades, 3, pay_text=F.when(off == 1, "0,00").otherwise(F.col("pay_text")))
    inp.pl = _snapshots(inp.pl, 3, market_value=(F.col("market_value") + off).cast("decimal(23,8)"))
    inp.trade_product, inp.match_ids = _snapshots(inp.trade_product, 3), _snapshots(inp.match_ids, 2)
    for feed in ("rates_delta", "credit_delta", "fx", "rates_vega"):
        setattr(inp, feed, _feed(getattr(inp, feed)))
    return inp


_DUE = "common_complete and load_complete and (new_common_files > 0 or new_load_files > 0)"
_MASK_ROWS = ", ".join(f"('{load}', '{m}')" for load, ms in GATE_MASKS.items() for m in ms)
_GATE = (f"gate_log as (select * from file_log where not (path like 'sta/signup%' and day(loaded_at) % 3 = 0) "
         f"and not (path like 'sta/purchase%' and day(loaded_at) % 4 = 1)),\n"
         f"gate_masks as (select * from (values {_MASK_ROWS}) m(load, mask)),"
         + re.sub(r"\bmasks\b", "gate_masks", re.sub(r"\bfile_log\b", "gate_log", _WP_SQL)))


def _gated_sql() -> str:
    """The margin SQL over feeds and snapshots by day; the day is part of each trade's and strategy's name."""
    def by_day(src: str, offset: str) -> str:
        return (f"(select *, cast(date '{FIRST_DAY}' + cast((cast(substr(trade_id, 2) as bigint) + {offset}) % {DAYS} as int) as date) as pday "
                f"from {src})")

    def feed(src: str, load: str, has: str) -> str:
        change = ["s.trade_id||'@'||strftime(s.pday, '%Y%m%d') as trade_id", "s.strategy||'@'||strftime(s.pday, '%Y%m%d') as strategy",
                  "s.pday as as_of"]
        if "maturity" in has:
            change.append(f"strftime(strptime(s.maturity_text, '%d/%m/%Y') + interval {SHIFT} day, '%d/%m/%Y') as maturity_text")
        return (f"(select * replace ({', '.join(change)}) from {by_day(src, 'line_no % 3')} s "
                f"where exists (select 1 from due where due.load = '{load}' and due.pday = s.pday))")

    def snapshot(src: str, n: int, change: str = "") -> str:
        return (f"(select * replace (s.trade_id||'@'||strftime(s.pday, '%Y%m%d') as trade_id{change}) "
                f"from {by_day(f'(select t.*, o.off from {src} t, range({n}) o(off))', 'off')} s)")

    body = pipe._MARGIN_SQL
    for old, new in (
            ("rates_in as (select * from rates_0),\n", ""), ("credit_in as (", "credit_0 as ("), ("fx_in as (", "fx_0 as ("), ("vega_in as (", "vega_0 as ("),
            ("pl_s as (select * from pl where market_value <> 0)", f"""pl_0 as (select * from pl where market_value <> 0),
pl_s as {snapshot('pl_0', 3, ", cast(s.market_value + s.off as decimal(23,8)) as market_value")},
trades_d as {snapshot('trades_s', 3, ", case when s.off = 1 then '0,00' else s.pay_text end as pay_text")},
product_d as {snapshot('trade_product', 3)}, match_d as {snapshot('match_ids', 2)},
rates_in as {feed('rates_0', 'rates', 'maturity')}, credit_in as {feed('credit_0', 'credit', 'maturity')},
fx_in as {feed('fx_0', 'fx', '')}, vega_in as {feed('vega_0', 'rates', '')}"""),
            ("join trades_s t on", "join trades_d t on"),
            ("join trade_product tp on u.", "join product_d tp on u."), ("join match_ids m on u2.", "join match_d m on u2."),
            ("select source_name, im_model, risk_type, bucket, count(*) as n_rows,",
             "select strftime(strptime(right(trade_id, 8), '%Y%m%d'), '%Y-%m-%d') as period_day, source_name, im_model, risk_type, bucket, count(*) as n_rows,"),
            ("from all_out group by source_name,", "from all_out group by right(trade_id, 8), source_name,")):
        assert old in body, old
        body = body.replace(old, new)
    due = f"due as (select load, cast(period_start as date) as pday from ready where {_DUE})"
    return f"with {_GATE},\n{due},\n{body.removeprefix('with ')}"


def _gate_tagged(spark, d):
    return materialize(arrival.tag_file_sets(gate_log(spark, d), GATE_MASKS))


@query("gated_run", _gated_sql())
def q_gated_run(spark, d):
    """A2 -> A3 -> E9: the margin table of every due period, summarised by period, feed, model, risk type, bucket."""
    out = gated_margin(_gate_tagged(spark, d), GATE_MASKS, daily_inputs(spark, d), APP_ID)
    return out.groupBy(ymd("period_day").alias("period_day"), "source_name", "im_model", "risk_type", "bucket").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(r4(F.sum(c)).alias(c) for c in ("amount", "amount_cup0", "pnlvar_delta_ir", "pnlvar_vega_ir")))


@query("load_only", f"""
with {_GATE},
built as (select distinct period_start, period_end from ready where {_DUE}),
wanted as (select period_start, period_end, 'common' as load from built
           union all select period_start, period_end, load from ready join built using (period_start, period_end)
           where common_complete and load_complete)
select f.load, strftime(f.period_start, {_TS}) as period_start, f.path, count(*) as n_files,
       strftime(max(f.loaded_at), {_TS}) as newest
from fresh f join wanted w using (period_start, period_end, load) group by f.load, f.period_start, f.path""")
def q_load_only(spark, d):
    """A4 alone: the files that a run records when it builds no margin, by load, period and path."""
    tagged = _gate_tagged(spark, d)
    log = load_only(tagged, GATE_MASKS, APP_ID, NOW)["file_log"]
    return (arrival.working_period(log).groupBy("load", ymdhms("period_start").alias("period_start"), "path")
            .agg(F.count(F.lit(1)).alias("n_files"), ymdhms(F.max("loaded_at")).alias("newest")))
