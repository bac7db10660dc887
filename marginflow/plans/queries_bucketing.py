"""Queries for reshaping, bucketing, gap fill and volatility (each with its oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tenor_days, vol_currency
from ..functions.amounts import AMOUNT
from ..operators import bucketing, reshape
from ..operators.fill import fill_nearest
from ..operators.volatility import (bucket_fx_vol, complete_surface, route_vol, vega_cv, vega_fx,
                                    vega_sv)
from ..sources import fixtures as fx
from ..sources.scan import read_table
from .registry import query, r4
from .sqlfrag import (INTERVALS_CTE, allocate_sql, fill_sql, nearest_sql, surface_cv_sql,
                      surface_sv_sql, tenor_days_sql, vol_ccy_sql)

AS_OF_SQL = "date '1998-06-01'"


def _intervals(spark):
    return bucketing.tenor_grid(fx.grid(spark))


# ---------------------------------------------------------------- reshaping

@query("schedule_rows", """
with x as (select s.trade_id, s.line_no, p.market_value,
  try_cast(replace(t.pay_text, ',', '.') as decimal(38,18)) as pa, try_cast(replace(t.receive_text, ',', '.') as decimal(38,18)) as re,
  t.pay_ccy, t.receive_ccy
  from sens_ir s join trades t on s.trade_id = t.trade_id and s.portfolio = t.portfolio
  join pl p on s.trade_id = p.trade_id and s.portfolio = p.portfolio where p.market_value <> 0),
n as (select *, case when re = 0 and pa <> 0 then pa when re <> 0 and pa <> 0 then case
    when pay_ccy is distinct from 'EUR' and receive_ccy is not distinct from 'EUR' then pa
    when pay_ccy is not distinct from 'EUR' and receive_ccy is distinct from 'EUR' then re
    when pay_ccy is distinct from 'EUR' and receive_ccy is distinct from 'EUR' then re else 0 end else 0 end as nominal from x)
select trade_id, line_no, 'PV' as risk_type, cast(round(market_value, 4) as double) as amount from n
union all select trade_id, line_no, 'Notional', cast(round(cast(nominal as decimal(23,8)), 4) as double) from n""")
def q_schedule_rows(spark, d):
    from ..functions import comma_decimal, nominal
    from ..operators import filters, joins
    s = joins.join_trades(fx.sens_ir(spark, d), fx.trades(spark, d))
    s = joins.join_pl(s, filters.pl_snapshot(fx.pl(spark, d)))
    s = s.withColumn("nominal", nominal(comma_decimal("pay_text"), comma_decimal("receive_text"),
                                        "pay_ccy", "receive_ccy"))
    out = reshape.schedule_rows(s.select("trade_id", "line_no", "market_value", "nominal"))
    return out.select("trade_id", "line_no", "risk_type", r4("amount").alias("amount"))


@query("fx_legs", """
select trade_id, line_no, 'Risk_FX' as risk_type, 'DeltaFx' as source_name, cast(round(delta, 4) as double) as amount
from sens_fx where delta <> 0
union all
select trade_id, line_no, 'Risk_FXVol', 'VegaFX', cast(round(vega, 4) as double) from sens_fx where vega <> 0""")
def q_fx_legs(spark, d):
    s = fx.sens_fx(spark, d).select("trade_id", "line_no", "delta", "vega")
    out = reshape.fx_legs(s)
    return out.select("trade_id", "line_no", "risk_type", "source_name", r4("amount").alias("amount"))


# ---------------------------------------------------------------- bucketing

def _ir_amounts(spark, d):
    s = fx.sens_ir(spark, d)
    return s.select("trade_id", "line_no", "curve",
                    (F.col("dv01_par") + F.col("inflation_par")).cast(AMOUNT).alias("amount"),
                    F.col("dv01_par").alias("amount_cup0"), F.col("inflation_par").alias("pnlvar_delta_ir"),
                    F.lit(0).cast(AMOUNT).alias("pnlvar_vega_ir"),
                    tenor_days("maturity_text", F.col("as_of")).alias("days"))


@query("allocate", f"""
with {INTERVALS_CTE},
x as (select trade_id, line_no, {tenor_days_sql('maturity_text', 'as_of')} as d,
             cast(dv01_par + inflation_par as decimal(23,8)) as amt from sens_ir)
select trade_id, line_no, bucket, cast(round(value, 4) as double) as value
from {allocate_sql('x', 'trade_id, line_no')} a""")
def q_allocate(spark, d):
    x = _ir_amounts(spark, d).select("trade_id", "line_no", "days", "amount")
    out = bucketing.allocate(x, "days", "amount", _intervals(spark), "ir")
    return out.select("trade_id", "line_no", "bucket", r4("value").alias("value"))


_RISK_ROWS_SQL = f"""rr as (
  select trade_id, line_no, case when curve <> '' then 'Risk_IRCurve' else 'Risk_Inflation' end as risk_type,
         {tenor_days_sql('maturity_text', 'as_of')} as d, cast(dv01_par + inflation_par as decimal(23,8)) as amt
  from sens_ir
  union all
  select trade_id, line_no, 'Risk_CreditQ', {tenor_days_sql('maturity_text', 'as_of')}, cast(cr01_par as decimal(23,8))
  from sens_credit)"""
_GRID_OF_RISK = ("case when risk_type in ('Risk_IRCurve', 'Risk_IRVol', 'Risk_FXVol') then 'ir' "
                 "when risk_type = 'Risk_CreditQ' then 'cred' end")


def _risk_rows(spark, d):
    ir = fx.sens_ir(spark, d).select(
        "trade_id", "line_no",
        F.when(F.col("curve") != "", "Risk_IRCurve").otherwise("Risk_Inflation").alias("risk_type"),
        tenor_days("maturity_text", F.col("as_of")).alias("days"),
        (F.col("dv01_par") + F.col("inflation_par")).cast(AMOUNT).alias("amount"))
    cr = fx.sens_credit(spark, d).select(
        "trade_id", "line_no", F.lit("Risk_CreditQ").alias("risk_type"),
        tenor_days("maturity_text", F.col("as_of")).alias("days"), F.col("cr01_par").cast(AMOUNT).alias("amount"))
    return ir.unionByName(cr)


@query("allocate_by_risk_type", f"""
with {INTERVALS_CTE}, {_RISK_ROWS_SQL}
select trade_id, line_no, risk_type, bucket, cast(round(value, 4) as double) as value
from {allocate_sql('rr', 'trade_id, line_no, risk_type', _GRID_OF_RISK, passthrough=True)} a""")
def q_allocate_by_risk_type(spark, d):
    out = bucketing.allocate_by_risk_type(_risk_rows(spark, d), "days", "amount", _intervals(spark))
    return out.select("trade_id", "line_no", "risk_type", "bucket", r4("value").alias("value"))


@query("rescale", f"""
with {INTERVALS_CTE},
x as (select trade_id, line_no, case when curve <> '' then 'Risk_IRCurve' else 'Risk_Inflation' end as risk_type,
        case when curve <> '' then 'DeltaIR' else 'DeltaInfl' end as source_name,
        cast(dv01_par + inflation_par as decimal(23,8)) as amt, dv01_par as cup0, inflation_par as pnl,
        {tenor_days_sql('maturity_text', 'as_of')} as d from sens_ir where dv01_par + inflation_par <> 0),
a as (select * from {allocate_sql('x', 'trade_id, line_no, risk_type, source_name, amt, cup0, pnl', _GRID_OF_RISK, passthrough=True)})
select trade_id, line_no, bucket,
  cast(round(case when bucket = '' then amt else value end, 4) as double) as amount,
  cast(round(case when bucket = '' or source_name <> 'DeltaIR' then cup0
       else cast(cast(value as double) / cast(amt as double) * cast(cup0 as double) as decimal(23,8)) end, 4) as double) as amount_cup0,
  cast(round(case when bucket = '' then pnl
       else round(pnl * cast(cast(value as double) / cast(amt as double) as decimal(23,8)), 7) end, 4) as double) as pnlvar_delta_ir
from a""")
def q_rescale(spark, d):
    x = _ir_amounts(spark, d).where(F.col("amount") != 0).withColumns({
        "risk_type": F.when(F.col("curve") != "", "Risk_IRCurve").otherwise("Risk_Inflation"),
        "source_name": F.when(F.col("curve") != "", "DeltaIR").otherwise("DeltaInfl")})
    a = bucketing.allocate_by_risk_type(x, "days", "amount", _intervals(spark))
    out = bucketing.rescale_by_allocation(a)
    return out.select("trade_id", "line_no", "bucket", r4("amount").alias("amount"),
                      r4("amount_cup0").alias("amount_cup0"), r4("pnlvar_delta_ir").alias("pnlvar_delta_ir"))


@query("nearest_tenor", f"""
with {INTERVALS_CTE},
x as (select l_orderkey, l_linenumber, tenor, {tenor_days_sql('tenor', "date '2019-05-20'")} as d from tenor_text)
select * from {nearest_sql('x', 'l_orderkey, l_linenumber, tenor', 'd')} n""")
def q_nearest_tenor(spark, d):
    import datetime as dt
    t = fx.tenor_text(spark, d).withColumn("days", tenor_days("tenor", dt.date(2019, 5, 20)))
    out = bucketing.nearest_tenor(t, "days", _intervals(spark))
    return out.select("l_orderkey", "l_linenumber", "tenor", "snapped")


# ---------------------------------------------------------------- gap fill

@query("fill_nearest", f"""
with src as (select o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority,
                    case when o_orderkey % 3 = 0 then null else o_totalprice end as price from orders)
select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, cast(round(filled, 4) as double) as filled
from {fill_sql('src', 'price', 'o_custkey', 'o_orderdate, o_orderkey', 'filled')} f""")
def q_fill_nearest(spark, d):
    o = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("price"))
    # a customer may own a third of all orders: the balanced form never fills one key in one task
    out = fill_nearest(o, "price", ["o_custkey"], ["o_orderdate", "o_orderkey"], out_col="filled",
                       balanced=True)
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", r4("filled").alias("filled"))


# ---------------------------------------------------------------- volatility

def _vega_rows(spark, d, group: str):
    v = fx.sens_vega(spark, d).where(F.col("vol_group") == group).select(
        "trade_id", "line_no", F.col("vega").cast(AMOUNT).alias("amount"),
        vol_currency("risk_factor").alias("vol_currency"),
        tenor_days("option_tenor", fx.AS_OF).alias("days"),
        tenor_days("underlying_tenor", fx.AS_OF).alias("und_days"))
    return bucketing.allocate(v, "days", "amount", _intervals(spark), "ir") \
        .withColumn("amount", F.col("value")).drop("value")


_VEGA_ROWS_SQL = """v0_{g} as (select trade_id, line_no, {ccy} as vol_currency, {od} as d, {ud} as und_days,
   cast(vega as decimal(23,8)) as amt from sens_vega where vol_group = '{g}'),
v1_{g} as (select * from {alloc})"""


def _vega_rows_sql(g: str) -> str:
    return _VEGA_ROWS_SQL.format(
        g=g, ccy=vol_ccy_sql("risk_factor"), od=tenor_days_sql("option_tenor", AS_OF_SQL),
        ud=tenor_days_sql("underlying_tenor", AS_OF_SQL),
        alloc=allocate_sql(f"v0_{g}", "trade_id, line_no, vol_currency, und_days"))


_CV_SURFACE_SQL = surface_cv_sql()

_SV_SURFACE_SQL = f"""
sn_SV as (select trade_id, line_no, vol_currency, bucket, value, snapped as underlying_snapped from
          {nearest_sql('v1_SV', 'trade_id, line_no, vol_currency, bucket, value', 'und_days')} q),{surface_sv_sql()}"""


@query("complete_surface_cv", f"""
with {INTERVALS_CTE}, {_vega_rows_sql('CV')}, {_CV_SURFACE_SQL}
select currency, tenor, days, cast(round(vol, 4) as double) as vol, vol is null as unfillable from f_cv""")
def q_complete_surface_cv(spark, d):
    rows = _vega_rows(spark, d, "CV")
    req = rows.select(F.col("vol_currency").alias("currency"), F.col("bucket").alias("tenor"))
    out = complete_surface(req, fx.vol_cv(spark))
    return out.select("currency", "tenor", "days", r4("vol").alias("vol"), "unfillable")


@query("complete_surface_sv", f"""
with {INTERVALS_CTE}, {_vega_rows_sql('SV')}, {_SV_SURFACE_SQL}
select currency, tenor, underlying, days, underlying_days, cast(round(vol, 4) as double) as vol,
       vol is null as unfillable from f_sv""")
def q_complete_surface_sv(spark, d):
    rows = bucketing.nearest_tenor(_vega_rows(spark, d, "SV"), "und_days", _intervals(spark),
                                   out_col="underlying_snapped")
    req = rows.select(F.col("vol_currency").alias("currency"), F.col("bucket").alias("tenor"),
                      F.col("underlying_snapped").alias("underlying"))
    out = complete_surface(req, fx.vol_sv(spark), with_underlying=True)
    return out.select("currency", "tenor", "underlying", "days", "underlying_days", r4("vol").alias("vol"),
                      "unfillable")


@query("vega_cv", f"""
with {INTERVALS_CTE}, {_vega_rows_sql('CV')}, {_CV_SURFACE_SQL}
select r.trade_id, r.line_no, r.bucket, r.vol_currency,
       cast(round(cast(round(r.value * f.vol, 7) as decimal(23,8)), 4) as double) as amount,
       'N/A' as underlying_maturity
from v1_CV r join f_cv f on r.vol_currency = f.currency and r.bucket = f.tenor""")
def q_vega_cv(spark, d):
    out = vega_cv(_vega_rows(spark, d, "CV"), fx.vol_cv(spark))
    return out.select("trade_id", "line_no", "bucket", "vol_currency", r4("amount").alias("amount"),
                      "underlying_maturity")


@query("vega_sv", f"""
with {INTERVALS_CTE}, {_vega_rows_sql('SV')}, {_SV_SURFACE_SQL}
select r.trade_id, r.line_no, r.bucket, r.underlying_snapped,
       cast(round(cast(round(r.value * f.vol, 7) as decimal(23,8)), 4) as double) as amount
from sn_SV r join f_sv f on r.vol_currency = f.currency and r.bucket = f.tenor and r.underlying_snapped = f.underlying""")
def q_vega_sv(spark, d):
    rows = bucketing.nearest_tenor(_vega_rows(spark, d, "SV"), "und_days", _intervals(spark),
                                   out_col="underlying_snapped")
    out = vega_sv(rows, fx.vol_sv(spark))
    return out.select("trade_id", "line_no", "bucket", "underlying_snapped", r4("amount").alias("amount"))


@query("vega_fx", f"""
with {INTERVALS_CTE},
legs as (select trade_id, line_no, grp, pair, -1 as d, cast(vega as decimal(23,8)) as amt from sens_fx where vega <> 0),
lb as (select * from {allocate_sql('legs', 'trade_id, line_no, grp, pair')}),
vq as (select pair, vol_type, {tenor_days_sql('tenor', 'as_of')} as d, vol as amt from vol_fx),
vb as (select * from {allocate_sql('vq', 'pair, vol_type')})
select lb.trade_id, lb.line_no, lb.bucket, cast(round(cast(round(lb.value * vb.value, 7) as decimal(23,8)), 4) as double) as amount
from lb join vb on lb.grp = vb.vol_type and lb.pair = vb.pair and lb.bucket = vb.bucket""")
def q_vega_fx(spark, d):
    iv = _intervals(spark)
    legs = reshape.fx_legs(fx.sens_fx(spark, d).select("trade_id", "line_no", "grp", "pair", "delta", "vega"))
    legs = legs.where(F.col("risk_type") == "Risk_FXVol").withColumnRenamed("pair", "currency_pair")
    legs = bucketing.allocate(legs.withColumn("days", F.lit(-1)), "days", "amount", iv, "ir") \
        .withColumn("amount", F.col("value")).drop("value")
    out = vega_fx(legs, bucket_fx_vol(fx.vol_fx(spark), iv))
    return out.select("trade_id", "line_no", "bucket", r4("amount").alias("amount"))


@query("route_vol", """
select trade_id, line_no, source_name, case when source_name = 'VegaFX' and grp = 'FX' then 'FX' else 'none' end as vol_branch
from (select trade_id, line_no, grp, 'DeltaFx' as source_name from sens_fx where delta <> 0
      union all select trade_id, line_no, grp, 'VegaFX' from sens_fx where vega <> 0)
union all
select trade_id, line_no, 'VegaIR', case when vol_group = 'SV' then 'SV' when vol_group = 'CV' then 'CV' else 'none' end
from sens_vega""")
def q_route_vol(spark, d):
    f = reshape.fx_legs(fx.sens_fx(spark, d).select("trade_id", "line_no", "grp", "delta", "vega")) \
        .select("trade_id", "line_no", "grp", "source_name", F.lit("").alias("vol_group_agg"))
    v = fx.sens_vega(spark, d).select("trade_id", "line_no", F.lit("").alias("grp"),
                                      F.lit("VegaIR").alias("source_name"),
                                      F.col("vol_group").alias("vol_group_agg"))
    out = route_vol(f.unionByName(v))
    return out.select("trade_id", "line_no", "source_name", "vol_branch")

