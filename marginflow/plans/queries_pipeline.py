"""Queries for products, canonical dedup, the four feeds and the margin table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, filters, products
from ..operators.observe import read_counters
from ..session import materialize
from ..sources import fixtures as fx
from ..sources.scan import read_table
from . import feeds
from .pipeline import MarginInputs, margin_table
from .queries_basic import _SCOPE_SQL, _cpty_scope
from .registry import query, r4, ymd
from .sqlfrag import (INTERVALS_CTE, allocate_sql, nearest_sql, surface_cv_sql, surface_sv_sql,
                      tenor_days_sql, vol_ccy_sql)

AS_OF_SQL = "date '1998-06-01'"


# ---------------------------------------------------------------- feed adapters (shared by both sides)

def _orders_keys(spark, d):
    o = read_table(spark, d, "orders")
    return o.select(F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("trade_id"),
                    F.concat(F.lit("PF"), (F.col("o_custkey") % 20).cast("string")).alias("portfolio"),
                    F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("counterparty"))


def rates_in(spark, d):
    """Rates delta with zero-curve amounts, direct and cross sensitivities, and inflation-linked currency."""
    s = fx.sens_ir(spark, d)
    ln = F.col("line_no")
    return s.withColumns({
        "dv01_zero": (F.col("dv01_par") * 2 + ln).cast("decimal(23,8)"),
        "inflation_zero": (F.col("inflation_par") + 1).cast("decimal(23,8)"),
        "sensi_cross": F.when(ln % 2 == 0, "Direct sensi").when(ln % 3 == 0, F.lit(None)).otherwise("Cross sensi"),
        "currency": F.when((F.col("currency") == "MXN") & (ln % 3 == 0), "UDI").otherwise(F.col("currency"))})


def credit_in(spark, d):
    return fx.sens_credit(spark, d).withColumn("strategy", F.lit("NS"))


def fx_in(spark, d):
    return fx.sens_fx(spark, d).withColumns({"as_of": F.lit(fx.AS_OF), "strategy": F.lit("NS")})


def vega_in(spark, d):
    v = fx.sens_vega(spark, d).join(_orders_keys(spark, d), "trade_id")
    ln, vega = F.col("line_no"), F.col("vega")
    parts = {"normal_vega": vega, "inflation_vega": F.when(ln % 4 == 0, -vega - ln).otherwise(ln * 3), "yield_vega": ln,
             "normal_vega_pnl": vega * 2, "yield_vega_pnl": ln}   # the vegas of every fourth line cancel
    v = v.withColumns({n: c.cast("decimal(23,8)") for n, c in parts.items()}).drop("vega")
    return v.withColumns({"entity": F.lit("0182"), "source_system": F.lit("front3"),
                          "as_of": F.lit(fx.AS_OF), "strategy": F.lit("NS")})


_ADAPT_SQL = f"""
rates_0 as (select * replace (case when currency = 'MXN' and line_no % 3 = 0 then 'UDI' else currency end as currency),
            cast(dv01_par * 2 + line_no as decimal(23,8)) as dv01_zero, cast(inflation_par + 1 as decimal(23,8)) as inflation_zero,
            case when line_no % 2 = 0 then 'Direct sensi' when line_no % 3 = 0 then null else 'Cross sensi' end as sensi_cross
            from sens_ir),
rates_in as (select * from rates_0),
vega_3 as (select * exclude (vega), vega as normal_vega, line_no as yield_vega, vega * 2 as normal_vega_pnl, line_no as yield_vega_pnl,
            case when line_no % 4 = 0 then -vega - line_no else line_no * 3 end as inflation_vega from sens_vega),
credit_in as (select *, 'NS' as strategy from sens_credit),
fx_in as (select *, {AS_OF_SQL} as as_of, 'NS' as strategy from sens_fx),
vega_in as (select v.*, 'PF'||cast(o.o_custkey%20 as string) as portfolio, 'C'||cast(o.o_custkey as string) as counterparty,
            '0182' as entity, 'front3' as source_system, {AS_OF_SQL} as as_of, 'NS' as strategy
            from vega_3 v join orders o on v.trade_id = 'T'||cast(o.o_orderkey as string)),
trades_s as (select * replace (case when cast(substr(trade_id, 2) as bigint) % 17 = 0 then '' else booked_text end as booked_text)
            from trades where source_app = 'FRONT'),
pl_s as (select * from pl where market_value <> 0)"""


def _trades_snapshot(spark, d):
    t = filters.trade_snapshot(fx.trades(spark, d))
    # every seventeenth trade has no booking date
    unbooked = F.expr("cast(substring(trade_id, 2) as bigint) % 17 = 0")
    t = t.withColumn("booked_text", F.when(unbooked, "").otherwise(F.col("booked_text")))
    return dedup.dedup_by(t, ["trade_id", "portfolio"])


def _pl_snapshot(spark, d):
    return filters.pl_snapshot(fx.pl(spark, d))


def _prefix_sql(name: str, src: str, with_pl: bool = False) -> str:
    """F1 -> J1 -> dates / nominal -> (J4) -> J2 of one feed, as CTE ``{name}_p``."""
    pl_cols = ", p.market_value, cast(p.trade_date as date) as trade_date" if with_pl else ""
    pl_join = ("join pl_s p on s.trade_id = p.trade_id and s.portfolio = p.portfolio" if with_pl else "")
    return f"""
{name}_t as (select s.*, t.booked_text, t.pay_ccy, t.receive_ccy,
    cast(try_strptime(t.booked_text, '%d/%m/%Y') as date) as booked_date,
    cast(try_strptime(t.maturity_text, '%d/%m/%Y') as date) as maturity_date,
    try_cast(replace(t.pay_text, ',', '.') as decimal(38,18)) as pa,
    try_cast(replace(t.receive_text, ',', '.') as decimal(38,18)) as re
  from {src} s join trades_s t on s.trade_id is not distinct from t.trade_id and s.portfolio is not distinct from t.portfolio
  where s.entity = '0182' and s.source_system = 'front3'),
{name}_p as (select s.* exclude (pa, re), cast(case when re = 0 and pa <> 0 then pa when re <> 0 and pa <> 0 then case
    when pay_ccy is distinct from 'EUR' and receive_ccy is not distinct from 'EUR' then pa
    when pay_ccy is not distinct from 'EUR' and receive_ccy is distinct from 'EUR' then re
    when pay_ccy is distinct from 'EUR' and receive_ccy is distinct from 'EUR' then re else 0 end else 0 end as decimal(38,18)) as nominal,
    c.short_name, c.contract, c.filter_date{pl_cols}
  from {name}_t s {pl_join}
  join cpty_scope c on s.counterparty is not distinct from c.counterparty and s.entity is not distinct from c.entity
   and s.booked_date >= c.filter_date)"""


def _canon_sql(src: str, over: dict[str, str], where: str = "true", kept: str = "") -> str:
    """Distinct canonical rows (G5) of ``src`` with per-column SQL overrides; ``kept``: an aggregate of equal rows."""
    base = {
        "entity": "entity", "portfolio": "portfolio", "trade_id": "trade_id",
        "trade_date": "cast(null as date)", "vol_group_agg": "''", "short_name": "short_name",
        "issuer_code": "''", "family": "cast(null as varchar)", "grp": "cast(null as varchar)",
        "currency_pair": "''", "typ": "cast(null as varchar)", "risk_type": None, "qualifier": None,
        "sector": "''", "risk_factor": None, "label2": "''", "amount_currency": "'EUR'",
        "source_name": None, "amount": None, "amount_cup0": "cast(0 as decimal(23,8))",
        "source_system": "source_system", "counterparty": "counterparty", "sens_maturity": None,
        "horizon_date": "as_of", "strategy": "strategy", "underlying_maturity": "''",
        "contract": "contract", "filter_date": "filter_date", "maturity_date": "maturity_date",
        "booked_date": "booked_date", "im_model": None, "direction": "cast(null as varchar)",
        "skeleton": "cast(null as varchar)", "pnlvar_delta_ir": "cast(0 as decimal(23,8))",
        "pnlvar_vega_ir": "cast(0 as decimal(23,8))", "year": "cast(year(as_of) as int)", "month": "cast(month(as_of) as int)",
        "day": "cast(day(as_of) as int)",
    }
    base.update(over)
    cols = ", ".join(f"{v} as {k}" for k, v in base.items())
    if kept:
        return f"(select {cols}, {kept} from {src} where {where} group by all)"
    return f"(select distinct {cols} from {src} where {where})"


def _sched_sql(src: str, over: dict[str, str], where: str = "true") -> str:
    """Schedule branch: PV and Notional rows (U3), then distinct."""
    pv = dict(over, risk_type="'PV'", amount="cast(market_value as decimal(23,8))", im_model="'Schedule'")
    no = dict(over, risk_type="'Notional'", amount="cast(nominal as decimal(23,8))", im_model="'Schedule'")
    return f"{_canon_sql(src, pv, where)} union all {_canon_sql(src, no, where)}"


_RD_OVER = {
    "family": "family", "grp": "grp", "typ": "typ", "qualifier": "currency",
    "risk_factor": "case when curve <> '' then curve else inflation_curve end",
    "sens_maturity": "maturity_text", "source_name": "'DeltaIR'",
    "amount_cup0": "cast(dv01_zero + inflation_zero as decimal(23,8))",
}
_RD_SQL = f"""{_prefix_sql('rd', 'rates_in')},
rd_v as (select * from rd_p where (family||'-'||grp||'-'||typ is not distinct from 'IRD-CS-' and version is not distinct from '07')
   or family||'-'||grp||'-'||typ <> 'IRD-CS-'),
rd_pl as (select v.*, p.market_value from rd_v v join pl_s p on v.trade_id = p.trade_id and v.portfolio = p.portfolio),
rd_out as ({_canon_sql('rd_v', dict(_RD_OVER, im_model="'SIMM'",
            risk_type="case when curve <> '' then 'Risk_IRCurve' else 'Risk_Inflation' end",
            sector="case when curve <> '' then '1' else '' end", label2="case when curve <> '' then 'OIS' else '' end",
            pnlvar_delta_ir="case when sensi_cross is not distinct from 'Direct sensi' then dv01_zero else 0 end",
            amount="cast(dv01_par + inflation_par as decimal(23,8))"), "dv01_par + inflation_par <> 0")}
  union all {_sched_sql('rd_pl', _RD_OVER, "dv01_par + inflation_par <> 0")})"""

_CR_OVER = {"qualifier": "'ISIN:'||security", "risk_factor": "curve", "sens_maturity": "maturity_text",
            "source_name": "'DeltaCred'"}
_CR_SQL = f"""{_prefix_sql('cr', 'credit_in')},
cr_pl as (select v.*, p.market_value from cr_p v join pl_s p on v.trade_id = p.trade_id and v.portfolio = p.portfolio),
cr_out as ({_canon_sql('cr_p', dict(_CR_OVER, im_model="'SIMM'", risk_type="'Risk_CreditQ'", sector="'1'",
            label2="pay_ccy", amount="cast(cr01_par as decimal(23,8))"), "cr01_par <> 0")}
  union all {_sched_sql('cr_pl', _CR_OVER, "cr01_par <> 0")})"""

_FX_OVER = {"currency_pair": "pair", "qualifier": "c1", "risk_factor": "c1", "sens_maturity": "''",
            "source_name": "source_name", "grp": "grp"}
_FX_SQL = f"""{_prefix_sql('fx', 'fx_in')},
fx_v as (select * from fx_p where delta <> 0 or vega <> 0),
fx_l as (select *, 'Risk_FX' as risk_type, 'DeltaFx' as source_name, cast(delta as decimal(23,8)) as amount from fx_v where delta <> 0
         union all select *, 'Risk_FXVol', 'VegaFX', cast(vega as decimal(23,8)) from fx_v where vega <> 0),
fx_pl as (select v.*, p.market_value from fx_l v join pl_s p on v.trade_id = p.trade_id and v.portfolio = p.portfolio),
fx_out as ({_canon_sql('fx_l', dict(_FX_OVER, im_model="'SIMM'", risk_type="risk_type", amount="amount"))}
  union all {_sched_sql('fx_pl', _FX_OVER)})"""

_VG_OVER = {"trade_date": "trade_date", "vol_group_agg": "vol_group", "qualifier": "cast(null as varchar)",
            "risk_factor": "risk_factor", "sens_maturity": "option_tenor",
            "underlying_maturity": "underlying_tenor", "source_name": "'VegaIR'"}
_VG_SQL = f"""{_prefix_sql('vg', 'vega_in', with_pl=True)},
vg_out as ({_canon_sql('vg_p', dict(_VG_OVER, im_model="'SIMM'", risk_type="'Risk_IRVol'",
            amount="cast(normal_vega + inflation_vega + yield_vega as decimal(23,8))",
            pnlvar_vega_ir="cast(normal_vega_pnl + yield_vega_pnl as decimal(23,8))"), "normal_vega + inflation_vega + yield_vega <> 0")}
  union all {_sched_sql('vg_p', _VG_OVER, "normal_vega + inflation_vega + yield_vega <> 0")})"""


def _feed_query_sql(out: str, body: str) -> str:
    return f"""with {_SCOPE_SQL}, {_ADAPT_SQL}, {body}
select trade_id, portfolio, counterparty, short_name, contract, im_model, risk_type, source_name, qualifier,
       risk_factor, sector, label2, sens_maturity, underlying_maturity, vol_group_agg, currency_pair,
       cast(round(amount, 4) as double) as amount, cast(round(amount_cup0, 4) as double) as amount_cup0,
       cast(round(pnlvar_delta_ir, 4) as double) as pnlvar_delta_ir, cast(round(pnlvar_vega_ir, 4) as double) as pnlvar_vega_ir,
       strftime(filter_date, '%Y-%m-%d') as filter_date, strftime(booked_date, '%Y-%m-%d') as booked_date,
       strftime(trade_date, '%Y-%m-%d') as trade_date, year, month, day
from {out}"""


def _feed_query_cols(df):
    return df.select(
        "trade_id", "portfolio", "counterparty", "short_name", "contract", "im_model", "risk_type",
        "source_name", "qualifier", "risk_factor", "sector", "label2", "sens_maturity",
        "underlying_maturity", "vol_group_agg", "currency_pair", r4("amount").alias("amount"),
        r4("amount_cup0").alias("amount_cup0"), r4("pnlvar_delta_ir").alias("pnlvar_delta_ir"),
        r4("pnlvar_vega_ir").alias("pnlvar_vega_ir"), ymd("filter_date").alias("filter_date"),
        ymd("booked_date").alias("booked_date"), ymd("trade_date").alias("trade_date"),
        "year", "month", "day")


def _args(spark, d):
    return _trades_snapshot(spark, d), _cpty_scope(spark, d), _pl_snapshot(spark, d)


@query("rates_delta", _feed_query_sql("rd_out", _RD_SQL))
def q_rates_delta(spark, d):
    return _feed_query_cols(feeds.rates_delta(rates_in(spark, d), *_args(spark, d)))


@query("credit_delta", _feed_query_sql("cr_out", _CR_SQL))
def q_credit_delta(spark, d):
    return _feed_query_cols(feeds.credit_delta(credit_in(spark, d), *_args(spark, d)))


@query("fx_risk", _feed_query_sql("fx_out", _FX_SQL))
def q_fx_risk(spark, d):
    return _feed_query_cols(feeds.fx_risk(fx_in(spark, d), *_args(spark, d)))


_EXPOSURE_SQL = f"""with {_SCOPE_SQL}, {_ADAPT_SQL}, {_FX_SQL},
entered as (select *, case when c1 is null and c2 is null then [{{'currency': '', 'amount': cast(0 as decimal(38,18))}}]
    when c2 is null then [{{'currency': c1, 'amount': cast(exposure_pl as decimal(38,18))}}]
    when c1 is null or c1 = c2 then [{{'currency': c2, 'amount': cast(exposure_opt as decimal(38,18))}}]
    else [{{'currency': c1, 'amount': cast(exposure_pl as decimal(38,18))}}, {{'currency': c2, 'amount': cast(exposure_opt as decimal(38,18))}}]
    end as entries from fx_l where risk_type = 'Risk_FX'),
named as (select *, list_aggregate(list_transform(entries, lambda e: '"' || e.currency || '":' || cast(e.amount as varchar)),
    'string_agg', ',') as js from entered),
exposed as {_canon_sql('named', dict(_FX_OVER, im_model="'SIMM'", risk_type="risk_type", amount="amount"), kept="arg_min(entries, js) as entries")},
flat as (select trade_id, portfolio, counterparty, qualifier, amount, unnest(entries) as e from exposed)
select trade_id, portfolio, counterparty, qualifier, cast(round(amount, 4) as double) as amount,
       e.currency as currency, cast(round(e.amount, 4) as double) as exposure from flat"""


@query("fx_exposures", _EXPOSURE_SQL)
def q_fx_exposures(spark, d):
    """The exposure map of the FX delta rows, one row per currency; of equal rows the map that sorts first."""
    rows = feeds.fx_risk(fx_in(spark, d), *_args(spark, d)).where("im_model = 'SIMM' and risk_type = 'Risk_FX'")
    return rows.select("trade_id", "portfolio", "counterparty", "qualifier", r4("amount").alias("amount"),
                       F.explode("pnlvar_delta_fx").alias("currency", "exposure")).withColumn("exposure", r4("exposure"))


@query("rates_vega", _feed_query_sql("vg_out", _VG_SQL))
def q_rates_vega(spark, d):
    return _feed_query_cols(feeds.rates_vega(vega_in(spark, d), *_args(spark, d)))


@query("dedup_canonical", f"""with {_SCOPE_SQL}, {_ADAPT_SQL}, {_FX_SQL}
select source_name, im_model, count(*) as n_rows, cast(round(sum(amount), 4) as double) as amount
from fx_out group by source_name, im_model""")
def q_dedup_canonical(spark, d):
    f = feeds.fx_risk(fx_in(spark, d), *_args(spark, d))
    return dedup.dedup_canonical(f).groupBy("source_name", "im_model").agg(
        F.count(F.lit(1)).alias("n_rows"), r4(F.sum("amount")).alias("amount"))


# ---------------------------------------------------------------- products

_PROD_SQL = """
st as (select s.strategy, tp.product_id from sens_ir s join trade_product tp on s.trade_id = tp.trade_id
       where s.strategy like 'ST-%'),
dom as (select strategy, weight, credit_risk, eligible, product_class, schedule_class, product_id as dominant_product from (
   select st.strategy, p.*, row_number() over (partition by st.strategy order by p.weight desc nulls last,
     p.credit_risk desc nulls last, p.eligible desc nulls last, p.product_class desc nulls last,
     p.schedule_class desc nulls last, p.product_id desc nulls last) as rn
   from st join products p on st.product_id = p.product_id) where rn = 1)"""


def _with_products(spark, d):
    return fx.sens_ir(spark, d).join(fx.trade_product(spark, d), "trade_id")


@query("dominant_product", f"""with {_PROD_SQL}
select strategy, weight, credit_risk, eligible, product_class, schedule_class, dominant_product from dom""")
def q_dominant_product(spark, d):
    s, _ = filters.split_strategy(_with_products(spark, d))
    return products.dominant_product(s, fx.products(spark, d))


@query("products_strategy", f"""with {_PROD_SQL}
select s.trade_id, s.line_no, s.strategy, d.product_class, d.schedule_class, d.dominant_product
from sens_ir s join trade_product tp on s.trade_id = tp.trade_id join dom d on s.strategy = d.strategy
where s.strategy like 'ST-%' and d.eligible = 'Y' and d.credit_risk = 'Y'""")
def q_products_strategy(spark, d):
    s, _ = filters.split_strategy(_with_products(spark, d))
    out = products.products_strategy(s, fx.products(spark, d))
    return out.select("trade_id", "line_no", "strategy", "product_class", "schedule_class", "dominant_product")


@query("products_plain", """
select s.trade_id, s.line_no, s.strategy, p.product_class, p.schedule_class, p.product_id as dominant_product
from sens_ir s join trade_product tp on s.trade_id = tp.trade_id join products p on tp.product_id = p.product_id
where not (s.strategy like 'ST-%') and p.eligible = 'Y'""")
def q_products_plain(spark, d):
    _, s = filters.split_strategy(_with_products(spark, d))
    out = products.products_plain(s, fx.products(spark, d))
    return out.select("trade_id", "line_no", "strategy", "product_class", "schedule_class", "dominant_product")


# ---------------------------------------------------------------- E9 margin table

def margin_inputs(spark, d) -> MarginInputs:
    return MarginInputs(
        trades=_trades_snapshot(spark, d), pl=_pl_snapshot(spark, d), counterparties=_cpty_scope(spark, d),
        trade_product=fx.trade_product(spark, d), products=fx.products(spark, d),
        portfolios=filters.portfolio_perimeter(fx.portfolios(spark, d)), match_ids=fx.match_ids(spark, d),
        grid=fx.grid(spark), vol_fx=fx.vol_fx(spark), vol_cv=fx.vol_cv(spark), vol_sv=fx.vol_sv(spark),
        rates_delta=rates_in(spark, d), credit_delta=credit_in(spark, d), fx=fx_in(spark, d),
        rates_vega=vega_in(spark, d))


_GRID_OF_RISK = ("case when risk_type in ('Risk_IRCurve', 'Risk_IRVol', 'Risk_FXVol') then 'ir' "
                 "when risk_type = 'Risk_CreditQ' then 'cred' end")
_CARRY = ("source_name, im_model, risk_type, grp, currency_pair, vol_group_agg, risk_factor, underlying_maturity, "
          "horizon_date, trade_id, portfolio, counterparty, qualifier, product_class, dominant_product, match_id, "
          "amt, cup0, pir, pvg")
_ROW_COLS = ("trade_id, portfolio, counterparty, match_id, source_name, im_model, risk_type, qualifier, bucket, "
             "underlying_maturity, product_class, dominant_product, amount, amount_cup0, pnlvar_delta_ir, pnlvar_vega_ir")

_MARGIN_BODY = f"""with {_SCOPE_SQL}, {_ADAPT_SQL}, {INTERVALS_CTE}, {_RD_SQL}, {_CR_SQL}, {_FX_SQL}, {_VG_SQL},
unified as (select * from rd_out union all select * from cr_out union all select * from fx_out union all select * from vg_out),
u1 as (select u.*, tp.product_id from unified u join trade_product tp on u.trade_id = tp.trade_id
       where u.entity = '0182' and u.source_system = 'front3'),
dom as (select strategy, credit_risk, eligible, product_class, schedule_class, product_id as dominant_product from (
   select st.strategy, p.*, row_number() over (partition by st.strategy order by p.weight desc nulls last,
     p.credit_risk desc nulls last, p.eligible desc nulls last, p.product_class desc nulls last,
     p.schedule_class desc nulls last, p.product_id desc nulls last) as rn
   from (select distinct strategy, product_id from u1 where strategy like 'ST-%') st
   join products p on st.product_id = p.product_id) where rn = 1),
u2 as (select u1.*, d.product_class, d.schedule_class, d.dominant_product from u1 join dom d on u1.strategy = d.strategy
       where u1.strategy like 'ST-%' and d.eligible = 'Y' and d.credit_risk = 'Y'
       union all
       select u1.*, p.product_class, p.schedule_class, u1.product_id from u1 join products p on u1.product_id = p.product_id
       where not (u1.strategy like 'ST-%') and p.eligible = 'Y'),
u3 as (select u2.*, m.match_id from u2 join match_ids m on u2.trade_id = m.trade_id
       where u2.portfolio in (select portfolio from portfolios where excluded = '0')),
s0 as (select *, {tenor_days_sql('sens_maturity', 'horizon_date')} as d, amount as amt, amount_cup0 as cup0,
              pnlvar_delta_ir as pir, pnlvar_vega_ir as pvg from u3 where im_model is not distinct from 'SIMM'),
s1 as (select * from {allocate_sql('s0', _CARRY, _GRID_OF_RISK, passthrough=True)}),
s2 as (select * exclude (value, amt, cup0, pir, pvg),
    case when bucket = '' then amt else value end as amount,
    case when bucket = '' or source_name <> 'DeltaIR' then cup0
         else cast(cast(value as double) / cast(amt as double) * cast(cup0 as double) as decimal(23,8)) end as amount_cup0,
    case when bucket = '' then pir else round(pir * cast(cast(value as double) / cast(amt as double) as decimal(23,8)), 7) end as pnlvar_delta_ir,
    case when bucket = '' then pvg else round(pvg * cast(cast(value as double) / cast(amt as double) as decimal(23,8)), 7) end as pnlvar_vega_ir,
    row_number() over () as rid from s1),
s3 as (select s2.*, case when underlying_maturity <> '' then n.snapped else '' end as underlying_snapped from s2 join
       {nearest_sql('(select rid, ' + tenor_days_sql('underlying_maturity', 'horizon_date') + ' as ud from s2)', 'rid', 'ud')} n
       using (rid)),
s4 as (select *, case when source_name = 'VegaFX' and grp = 'FX' then 'FX'
                      when source_name = 'VegaIR' and vol_group_agg = 'SV' then 'SV'
                      when source_name = 'VegaIR' and vol_group_agg = 'CV' then 'CV' else 'none' end as branch,
              {vol_ccy_sql('risk_factor')} as vol_currency from s3),
vq as (select pair, vol_type, {tenor_days_sql('tenor', 'as_of')} as d, vol as amt from vol_fx),
vb as (select * from {allocate_sql('vq', 'pair, vol_type')}),
v_fx as (select s.* exclude (amount), cast(round(s.amount * vb.value, 7) as decimal(23,8)) as amount
         from s4 s join vb on s.grp = vb.vol_type and s.currency_pair = vb.pair and s.bucket = vb.bucket where s.branch = 'FX'),
v1_CV as (select * from s4 where branch = 'CV'),
{surface_cv_sql()},
v_cv as (select r.* exclude (amount, underlying_maturity), cast(round(r.amount * f.vol, 7) as decimal(23,8)) as amount,
                'N/A' as underlying_maturity
         from v1_CV r join f_cv f on r.vol_currency = f.currency and r.bucket = f.tenor),
sn_SV as (select * from s4 where branch = 'SV'),
{surface_sv_sql()},
v_sv as (select r.* exclude (amount), cast(round(r.amount * f.vol, 7) as decimal(23,8)) as amount
         from sn_SV r join f_sv f on r.vol_currency = f.currency and r.bucket = f.tenor and r.underlying_snapped = f.underlying),
simm_rows as (select {_ROW_COLS} from v_fx union all select {_ROW_COLS} from v_cv
   union all select {_ROW_COLS} from v_sv union all select {_ROW_COLS} from s4 where branch = 'none'),
all_out as (select * replace (case when qualifier = 'UDI' then 'MXV' else qualifier end as qualifier) from simm_rows
   union all
   select trade_id, portfolio, counterparty, match_id, source_name, im_model, risk_type,
          family || '-' || grp || '-' || typ as qualifier, '' as bucket, underlying_maturity,
          schedule_class as product_class, dominant_product, amount, amount_cup0, pnlvar_delta_ir, pnlvar_vega_ir
   from u3 where im_model is not distinct from 'Schedule')"""

_MARGIN_SQL = f"""{_MARGIN_BODY}
select source_name, im_model, risk_type, bucket, count(*) as n_rows,
  cast(round(sum(amount), 4) as double) as amount, cast(round(sum(amount_cup0), 4) as double) as amount_cup0,
  cast(round(sum(pnlvar_delta_ir), 4) as double) as pnlvar_delta_ir, cast(round(sum(pnlvar_vega_ir), 4) as double) as pnlvar_vega_ir
from all_out group by source_name, im_model, risk_type, bucket"""

_MARGIN_ROWS_SQL = f"""{_MARGIN_BODY}
select trade_id, portfolio, counterparty as counterparty_mx, match_id, source_name, im_model, risk_type, qualifier,
  bucket, underlying_maturity, product_class, dominant_product,
  cast(round(amount, 4) as double) as amount, cast(round(amount_cup0, 4) as double) as amount_cup0,
  cast(round(pnlvar_delta_ir, 4) as double) as pnlvar_delta_ir, cast(round(pnlvar_vega_ir, 4) as double) as pnlvar_vega_ir
from all_out"""


def summarise_margin(m):
    return m.groupBy("source_name", "im_model", "risk_type", "bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), r4(F.sum("amount")).alias("amount"),
        r4(F.sum("amount_cup0")).alias("amount_cup0"), r4(F.sum("pnlvar_delta_ir")).alias("pnlvar_delta_ir"),
        r4(F.sum("pnlvar_vega_ir")).alias("pnlvar_vega_ir"))


@query("margin_table", _MARGIN_SQL)
def q_margin_table(spark, d):
    """E9 flagship: the 40-column margin table, summarised by feed x model x risk type x bucket."""
    return summarise_margin(margin_table(margin_inputs(spark, d)))


@query("margin_rows", _MARGIN_ROWS_SQL)
def q_margin_rows(spark, d):
    """E9 row by row: the margin table's identifying columns, classes and amounts."""
    m = margin_table(margin_inputs(spark, d))
    return m.select("trade_id", "portfolio", "counterparty_mx", "match_id", "source_name", "im_model",
                    "risk_type", "qualifier", "bucket", "underlying_maturity", "product_class",
                    "dominant_product", r4("amount").alias("amount"), r4("amount_cup0").alias("amount_cup0"),
                    r4("pnlvar_delta_ir").alias("pnlvar_delta_ir"), r4("pnlvar_vega_ir").alias("pnlvar_vega_ir"))


# ---------------------------------------------------------------- counters

def _counters_sql() -> str:
    def point(name: str, rows: str, null: str = "false") -> str:
        return f"select '{name}' as point, count(*) as n_rows, count(*) filter (where {null}) as n_null_keys from {rows}"

    unpaired = "counterparty is null or entity is null or booked_date is null"
    parts = []
    for feed, src, cte in (("rates_delta", "rates_in", "rd"), ("credit_delta", "credit_in", "cr"), ("fx_risk", "fx_in", "fx"),
                           ("rates_vega", "vega_in", "vg")):
        parts += [point(f"{feed}.input", src, "entity is null or source_system is null"),
                  point(f"{feed}.in_scope", f"(select * from {src} where entity = '0182' and source_system = 'front3')",
                        "trade_id is null or portfolio is null"),
                  point(f"{feed}.traded", f"{cte}_t", unpaired), point(f"{feed}.in_perimeter", f"{cte}_p")]
    parts += [
        point("rates_vega.priced", "(select t.* from vg_t t join pl_s p on t.trade_id = p.trade_id and t.portfolio = p.portfolio)", unpaired),
        point("unified_feeds", "unified", "trade_id is null"), point("with_product", "u1", "strategy is null"),
        point("strategy_rows", "(select * from u2 where strategy like 'ST-%')"),
        point("plain_rows", "(select * from u2 where not (strategy like 'ST-%'))"),
        point("in_portfolios", "(select * from u2 where portfolio in (select portfolio from portfolios where excluded = '0'))", "trade_id is null"),
        point("resolved", "u3"), point("simm_rows", "(select * from all_out where im_model = 'SIMM')"),
        point("schedule_rows", "(select * from all_out where im_model = 'Schedule')"), point("output", "all_out")]
    return _MARGIN_BODY + "\n" + " union all ".join(parts)


@query("run_counters", _counters_sql())
def q_run_counters(spark, d):
    """Rows and null keys at 26 points of a run, counted by the jobs that write its tables."""
    counters: dict = {}
    materialize(margin_table(margin_inputs(spark, d), counters=counters))
    return spark.createDataFrame(read_counters(counters), "point string, n_rows long, n_null_keys long")
