"""Queries for scans, filters, scalar functions, joins and dedup (each with its oracle)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import (business_date_key, comma_decimal, fx_exposure_entries, iso_date_text,
                         nominal, parse_business_date, pillar_days, product_key, tenor_code_days,
                         tenor_days, vol_currency)
from ..operators import dedup, filters, joins
from ..operators.xml import counterparty_scope, extract_roles, parse_roles
from ..session import shared_path
from ..sources import fixtures as fx
from ..sources.scan import load_day, load_latest, read_table
from .registry import query, r4, ymd

TENOR_AS_OF = dt.date(2019, 5, 20)
CPTY_FLOOR = dt.date(1996, 6, 30)
LOAD_DAY = dt.date(1995, 3, 15)


# ---------------------------------------------------------------- filters

@query("scope_filter", """
select trade_id, line_no, portfolio, counterparty, entity, currency,
       cast(round(dv01_par, 4) as double) as dv01_par
from sens_ir where entity = '0182' and source_system = 'front3'""")
def q_scope_filter(spark, d):
    s = filters.in_scope(fx.sens_ir(spark, d))
    return s.select("trade_id", "line_no", "portfolio", "counterparty", "entity", "currency",
                    r4("dv01_par").alias("dv01_par"))


@query("nonzero_filter", """
select trade_id, line_no, cast(round(dv01_par + inflation_par, 4) as double) as amount
from sens_ir where dv01_par + inflation_par <> 0""")
def q_nonzero_filter(spark, d):
    s = filters.nonzero(fx.sens_ir(spark, d), "dv01_par", "inflation_par")
    return s.select("trade_id", "line_no", r4(F.col("dv01_par") + F.col("inflation_par")).alias("amount"))


@query("version_rule", """
select trade_id, line_no, family, typ, version from sens_ir
where (family||'-'||grp||'-'||typ is not distinct from 'IRD-CS-' and version is not distinct from '07')
   or family||'-'||grp||'-'||typ <> 'IRD-CS-'""")
def q_version_rule(spark, d):
    s = fx.sens_ir(spark, d)
    out = filters.version_rule(s, product_key("family", "grp", "typ"))
    return out.select("trade_id", "line_no", "family", "typ", "version")


@query("strategy_split", """
select trade_id, line_no, strategy, 'with' as side from sens_ir where strategy like 'ST-%'
union all
select trade_id, line_no, strategy, 'without' as side from sens_ir where not (strategy like 'ST-%')""")
def q_strategy_split(spark, d):
    with_s, without_s = filters.split_strategy(fx.sens_ir(spark, d))
    cols = ["trade_id", "line_no", "strategy"]
    return with_s.select(*cols, F.lit("with").alias("side")).unionByName(
        without_s.select(*cols, F.lit("without").alias("side")))


# ---------------------------------------------------------------- scans

def _orders_by_day(spark, d):
    o = read_table(spark, d, "orders")
    return o.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"),
                    F.month("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("day"))


_ORDERS_BY_DAY = """(select o_orderkey, o_custkey, cast(extract(year from o_orderdate) as int) as year,
  cast(extract(month from o_orderdate) as int) as month, cast(extract(day from o_orderdate) as int) as day from orders)"""


@query("load_latest", f"""
with t as {_ORDERS_BY_DAY}
select * from t where year*10000 + month*100 + day = (select max(year*10000 + month*100 + day) from t)""")
def q_load_latest(spark, d):
    return load_latest(_orders_by_day(spark, d))


_MONTHS = ("year", "month")


@query("load_newest", f"""
with t as {_ORDERS_BY_DAY}
select * from t where year*100 + month = (select max(year*100 + month) from t)""")
def q_load_newest(spark, d):
    """S3 / T2 on a partitioned table: the newest partition is told by a folder listing."""
    path = shared_path(spark)
    _orders_by_day(spark, d).repartition(*_MONTHS).write.partitionBy(*_MONTHS).parquet(path)
    return load_latest(spark.read.parquet(path), _MONTHS, path).select("o_orderkey", "o_custkey", "year", "month", "day")


@query("load_day", f"""
with t as {_ORDERS_BY_DAY}
select * from t where year = {LOAD_DAY.year} and month = {LOAD_DAY.month} and day = {LOAD_DAY.day}""")
def q_load_day(spark, d):
    return load_day(_orders_by_day(spark, d), LOAD_DAY)


# ---------------------------------------------------------------- dates and tenors

@query("business_dates", """
select trade_id,
  strftime(try_strptime(booked_text, '%d/%m/%Y'), '%Y-%m-%d') as booked_date,
  strftime(try_strptime(maturity_text, '%d/%m/%Y'), '%Y-%m-%d') as maturity_date,
  strftime(try_strptime(booked_text, '%d/%m/%Y'), '%Y%m%d') as booked_key,
  strftime(try_strptime(maturity_text, '%d/%m/%Y'), '%Y-%m-%d') as maturity_iso
from trades""")
def q_business_dates(spark, d):
    t = fx.trades(spark, d)
    return t.select("trade_id",
                    ymd(parse_business_date("booked_text")).alias("booked_date"),
                    ymd(parse_business_date("maturity_text")).alias("maturity_date"),
                    business_date_key("booked_text").alias("booked_key"),
                    iso_date_text("maturity_text").alias("maturity_iso"))


_PILLAR_SQL = """(case
  when regexp_full_match(tenor, '(\\d+)([dwsmyaDWSMYA])')
    then cast(regexp_extract(tenor, '^(\\d+)', 1) as int) * (case lower(right(tenor, 1))
         when 'd' then 1 when 'w' then 7 when 's' then 7 when 'm' then 30 else 365 end)
  when regexp_full_match(tenor, '([dwsmyaDWSMYA])(\\d+)')
    then cast(regexp_extract(tenor, '(\\d+)$', 1) as int) * (case lower(left(tenor, 1))
         when 'd' then 1 when 'w' then 7 when 's' then 7 when 'm' then 30 else 365 end)
end)"""


@query("pillar_days", f"""
select l_orderkey, l_linenumber, tenor, {_PILLAR_SQL} as pillar_days from tenor_text""")
def q_pillar_days(spark, d):
    t = fx.tenor_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", "tenor", pillar_days("tenor").alias("pillar_days"))


@query("tenor_days", f"""
select l_orderkey, l_linenumber, tenor, cast(case
  when length(tenor) = 6 then abs(date_diff('day', date '{TENOR_AS_OF}', cast(try_strptime('01 ' || tenor, '%d %b %y') as date)))
  when tenor like '%/%' then abs(date_diff('day', date '{TENOR_AS_OF}', cast(try_strptime(tenor, '%d/%m/%Y') as date)))
  when length(tenor) in (2, 3) then {_PILLAR_SQL}
  else -1 end as int) as days
from tenor_text""")
def q_tenor_days(spark, d):
    t = fx.tenor_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", "tenor", tenor_days("tenor", TENOR_AS_OF).alias("days"))


_CODE_DAYS_SQL = """(case
  when tenor like '%Y%' and tenor like '%M%' and length(tenor) >= 4 then
    case when regexp_matches(tenor, '^(\\d+)Y(\\d+)M')
      then cast(regexp_extract(tenor, '^(\\d+)Y', 1) as int) * 365
         + cast(regexp_extract(tenor, '^\\d+Y(\\d+)M', 1) as int) * 30 end
  when regexp_full_match(tenor, '\\d+[DWMY]') then
    cast(regexp_extract(tenor, '^(\\d+)', 1) as int) * (case right(tenor, 1)
      when 'D' then 1 when 'W' then 7 when 'M' then 30 else 365 end)
end)"""


@query("tenor_code_days", f"""
select l_orderkey, l_linenumber, tenor, cast({_CODE_DAYS_SQL} as int) as code_days from tenor_text""")
def q_tenor_code_days(spark, d):
    t = fx.tenor_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", "tenor", tenor_code_days("tenor").alias("code_days"))


# ---------------------------------------------------------------- amounts and codes

@query("comma_decimal", """
select trade_id,
  cast(round(try_cast(replace(pay_text, ',', '.') as decimal(38,18)), 4) as double) as pay,
  cast(round(try_cast(replace(receive_text, ',', '.') as decimal(38,18)), 4) as double) as receive
from trades""")
def q_comma_decimal(spark, d):
    t = fx.trades(spark, d)
    return t.select("trade_id", r4(comma_decimal("pay_text")).alias("pay"),
                    r4(comma_decimal("receive_text")).alias("receive"))


_NOMINAL_SQL = """(case
  when r = 0 and p <> 0 then p
  when r <> 0 and p <> 0 then case
    when pay_ccy is distinct from 'EUR' and receive_ccy is not distinct from 'EUR' then p
    when pay_ccy is not distinct from 'EUR' and receive_ccy is distinct from 'EUR' then r
    when pay_ccy is distinct from 'EUR' and receive_ccy is distinct from 'EUR' then r
    else 0 end
  else 0 end)"""


@query("nominal", f"""
with t as (select trade_id, pay_ccy, receive_ccy,
  try_cast(replace(pay_text, ',', '.') as decimal(38,18)) as p,
  try_cast(replace(receive_text, ',', '.') as decimal(38,18)) as r from trades)
select trade_id, cast(round({_NOMINAL_SQL}, 4) as double) as nominal from t""")
def q_nominal(spark, d):
    t = fx.trades(spark, d)
    n = nominal(comma_decimal("pay_text"), comma_decimal("receive_text"), "pay_ccy", "receive_ccy")
    return t.select("trade_id", r4(n).alias("nominal"))


_VOL_CCY_SQL = """(case when risk_factor in ('EXOT_IRPH_1', 'EXOT_IRPH_2', 'EXOT_IRPH_3', 'SPIPC') then 'EUR'
  when risk_factor like 'TIIE%' or risk_factor like 'MX SWAPT' then 'MXN'
  else substring(risk_factor, 1, 3) end)"""


@query("vol_currency", f"""
select trade_id, line_no, risk_factor, {_VOL_CCY_SQL} as vol_currency from sens_vega""")
def q_vol_currency(spark, d):
    v = fx.sens_vega(spark, d)
    return v.select("trade_id", "line_no", "risk_factor", vol_currency("risk_factor").alias("vol_currency"))


@query("fx_exposure_rows", """
select trade_id, line_no, '' as currency, 0.0 as exposure from sens_fx where c1 is null and c2 is null
union all select trade_id, line_no, c1, cast(round(exposure_pl, 4) as double) from sens_fx where c1 is not null and c2 is null
union all select trade_id, line_no, c2, cast(round(exposure_opt, 4) as double) from sens_fx where c1 is null and c2 is not null
union all select trade_id, line_no, c1, cast(round(exposure_opt, 4) as double) from sens_fx where c1 = c2
union all select trade_id, line_no, c1, cast(round(exposure_pl, 4) as double) from sens_fx where c1 <> c2
union all select trade_id, line_no, c2, cast(round(exposure_opt, 4) as double) from sens_fx where c1 <> c2""")
def q_fx_exposure_rows(spark, d):
    s = fx.sens_fx(spark, d)
    e = s.select("trade_id", "line_no",
                 F.inline(fx_exposure_entries("c1", "exposure_pl", "c2", "exposure_opt")))
    return e.select("trade_id", "line_no", "currency", r4("amount").alias("exposure"))


# ---------------------------------------------------------------- joins

@query("join_trades", """
select s.trade_id, s.line_no, s.portfolio, t.booked_text, t.pay_ccy, t.receive_ccy
from sens_ir s join trades t on s.trade_id is not distinct from t.trade_id
                          and s.portfolio is not distinct from t.portfolio""")
def q_join_trades(spark, d):
    j = joins.join_trades(fx.sens_ir(spark, d), fx.trades(spark, d))
    return j.select("trade_id", "line_no", "portfolio", "booked_text", "pay_ccy", "receive_ccy")


_REF_SQL = "case when c_custkey % 50 = 0 then '' else 'R'||cast(c_custkey as string) end"
_SCOPE_SQL = f"""cpty_scope as (
  select 'C'||cast(c_custkey as string) as counterparty, code.ref_code, '0182' as entity, code.ref_code as short_name,
         code.contract, greatest(code.effective, date '{CPTY_FLOOR}') as filter_date
  from customer join (
    select {_REF_SQL} as ref_code, min('CT'||cast(c_custkey as string)) as contract,
           arg_min(date '1996-01-01' + cast(c_custkey%900 as int), 'CT'||cast(c_custkey as string)) as effective
    from customer where c_custkey % 6 = 0 group by 1) code on {_REF_SQL} = code.ref_code)"""


def _cpty_scope(spark, d):
    return counterparty_scope(fx.cpty_xml(spark, d), fx.perimeter(spark, d), CPTY_FLOOR)


@query("extract_roles", f"""
select 'C'||cast(c_custkey as string) as identifier, {_REF_SQL} as ref_code, 'MUREXID' as origin from customer
union all
select 'C'||cast(c_custkey as string), {_REF_SQL}, 'CALYPSOID' from customer where c_custkey % 11 = 0
union all
select 'K'||cast(c_custkey as string), {_REF_SQL}, 'CALYPSOID' from customer where c_custkey % 3 = 0""")
def q_extract_roles(spark, d):
    return extract_roles(fx.cpty_xml(spark, d))


@query("xml_rejects", """
select count(*) filter (where c_custkey % 13 <> 0) + count(*) filter (where c_custkey % 13 <> 0 and c_custkey % 11 = 0)
     + count(*) filter (where c_custkey % 13 <> 0 and c_custkey % 3 = 0) as n_roles,
       count(*) filter (where c_custkey % 13 = 0) as n_malformed from customer""")
def q_xml_rejects(spark, d):
    """X1 with every thirteenth document cut off: roles found and documents rejected."""
    cut = F.when(F.col("c_custkey") % 13 == 0, F.expr("left(doc, length(doc) - 9)")).otherwise(F.col("doc"))
    roles = parse_roles(fx.cpty_xml(spark, d).withColumn("doc", cut))
    return roles.agg(F.count_if(~F.col("malformed")).alias("n_roles"), F.count_if("malformed").alias("n_malformed"))


@query("counterparty_scope", f"""with {_SCOPE_SQL}
select counterparty, ref_code, entity, short_name, contract, strftime(filter_date, '%Y-%m-%d') as filter_date from cpty_scope""")
def q_counterparty_scope(spark, d):
    return _cpty_scope(spark, d).select("counterparty", "ref_code", "entity", "short_name", "contract",
                                         ymd("filter_date").alias("filter_date"))


@query("join_counterparty", f"""
with {_SCOPE_SQL}
select s.trade_id, s.line_no, s.counterparty, c.contract, strftime(c.filter_date, '%Y-%m-%d') as filter_date
from sens_ir s join trades t on s.trade_id is not distinct from t.trade_id and s.portfolio is not distinct from t.portfolio
join cpty_scope c on s.counterparty is not distinct from c.counterparty and s.entity is not distinct from c.entity
 and cast(try_strptime(t.booked_text, '%d/%m/%Y') as date) >= c.filter_date""")
def q_join_counterparty(spark, d):
    j = joins.with_trade_dates(joins.join_trades(fx.sens_ir(spark, d), fx.trades(spark, d)))
    j = joins.join_counterparty(j, _cpty_scope(spark, d))
    return j.select("trade_id", "line_no", "counterparty", "contract", ymd("filter_date").alias("filter_date"))


@query("join_pl", """
select s.trade_id, s.line_no, cast(round(p.market_value, 4) as double) as market_value,
       strftime(p.trade_date, '%Y-%m-%d') as trade_date
from sens_ir s join pl p on s.trade_id = p.trade_id and s.portfolio = p.portfolio
where p.market_value <> 0""")
def q_join_pl(spark, d):
    p = filters.pl_snapshot(fx.pl(spark, d))
    j = joins.join_pl(fx.sens_ir(spark, d), p, with_trade_date=True)
    return j.select("trade_id", "line_no", r4("market_value").alias("market_value"), ymd("trade_date").alias("trade_date"))


@query("keep_portfolios", """
select trade_id, line_no, portfolio from sens_ir
where portfolio in (select portfolio from portfolios where excluded = '0')""")
def q_keep_portfolios(spark, d):
    per = filters.portfolio_perimeter(fx.portfolios(spark, d))
    return joins.keep_portfolios(fx.sens_ir(spark, d), per).select("trade_id", "line_no", "portfolio")


@query("attach_match", """
select s.trade_id, s.line_no, m.match_id from sens_ir s join match_ids m on s.trade_id = m.trade_id""")
def q_attach_match(spark, d):
    j = joins.attach_match_id(fx.sens_ir(spark, d), fx.match_ids(spark, d))
    return j.select("trade_id", "line_no", "match_id")


# ---------------------------------------------------------------- dedup

@query("dedup_trades", """
select trade_id, line_no, cast(round(dv01_par, 4) as double) as dv01_par, currency, curve, strategy from (
  select *, row_number() over (partition by trade_id, line_no order by
    dv01_par nulls first, inflation_par nulls first, portfolio nulls first, counterparty nulls first,
    entity nulls first, source_system nulls first, family nulls first, grp nulls first, typ nulls first,
    version nulls first, currency nulls first, curve nulls first, inflation_curve nulls first,
    maturity_text nulls first, as_of nulls first, strategy nulls first) as rn
  from sens_ir) where rn = 1""")
def q_dedup_trades(spark, d):
    s = dedup.dedup_by(fx.sens_ir(spark, d), ["trade_id", "line_no"], order=["dv01_par", "inflation_par"])
    return s.select("trade_id", "line_no", r4("dv01_par").alias("dv01_par"), "currency", "curve", "strategy")


# ---------------------------------------------------------------- more scans and predicates

@query("scan", """
select o_orderkey, o_custkey, o_totalprice from orders where o_totalprice > 100000 and o_orderstatus = 'F'""")
def q_scan(spark, d):
    from ..sources.scan import scan
    return scan(spark, f"{d.rstrip('/')}/orders.parquet", fields=["o_orderkey", "o_custkey", "o_totalprice"],
                where=(F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "F"))


@query("load_xml", """
select c_custkey from customer where c_custkey % 3 = 0 or c_custkey % 11 = 0""")
def q_load_xml(spark, d):
    from ..sources.scan import load_xml
    return load_xml(fx.cpty_xml(spark, d), "doc", "CALYPSOID").select("c_custkey")


@query("trade_snapshot", """
select trade_id, portfolio, booked_text, pay_ccy, receive_ccy from trades where source_app = 'FRONT'""")
def q_trade_snapshot(spark, d):
    t = dedup.dedup_by(filters.trade_snapshot(fx.trades(spark, d)), ["trade_id", "portfolio"])
    return t.select("trade_id", "portfolio", "booked_text", "pay_ccy", "receive_ccy")


_PERIOD = (dt.datetime(2024, 1, 8, 18), dt.datetime(2024, 1, 15, 18))


@query("in_period", f"""
select path, app_id, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') as loaded_at from file_log
where loaded_at >= timestamp '{_PERIOD[0]}' and loaded_at < timestamp '{_PERIOD[1]}'""")
def q_in_period(spark, d):
    from .registry import ymdhms
    f = filters.in_period(fx.file_log(spark, d), "loaded_at", F.lit(_PERIOD[0]).cast("timestamp_ntz"),
                          F.lit(_PERIOD[1]).cast("timestamp_ntz"))
    return f.select("path", "app_id", ymdhms("loaded_at").alias("loaded_at"))
