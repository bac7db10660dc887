"""DuckDB SQL of the input tables (oracle side), one statement per table.

The same tables are built with the DataFrame API in :mod:`marginflow.sources.fixtures`.
"""

FIXTURE_SQL = {
    "trades": (
        """select 'T'||cast(o_orderkey as string) as trade_id, 'PF'||cast(o_custkey%20 as string) as portfolio, case when o_orderkey%10=0 then 'OTHER' else 'FRONT' end as source_app, lpad(cast(extract(day from o_orderdate) as string),2,'0')||'/'||lpad(cast(extract(month from o_orderdate) as string),2,'0')||'/'||cast(extract(year from o_orderdate) as string) as booked_text, case when o_orderkey%7=0 then '' else lpad(cast(extract(day from o_orderdate) as string),2,'0')||'/'||lpad(cast(extract(month from o_orderdate) as string),2,'0')||'/'||cast(extract(year from o_orderdate) as string) end as maturity_text, cast(o_orderkey%100000 as string)||','||lpad(cast(o_custkey%100 as string),2,'0') as pay_text, case when o_orderkey%3=0 then '0,00' else cast(o_custkey as string)||',50' end as receive_text, case o_orderkey%4 when 0 then 'EUR' when 1 then 'USD' when 2 then 'GBP' else 'MXN' end as pay_ccy, case o_custkey%4 when 0 then 'EUR' when 1 then 'USD' when 2 then 'GBP' else 'MXN' end as receive_ccy from orders"""
    ),
    "sens_ir": (
        """select 'T'||cast(l_orderkey as string) as trade_id, 'PF'||cast(o_custkey%20 as string) as portfolio, l_linenumber as line_no, 'C'||cast(o_custkey as string) as counterparty, case when l_suppkey%9=0 then '9999' else '0182' end as entity, 'front3' as source_system, case when l_partkey%5=0 then 'IRD' else 'IRX' end as family, 'CS' as grp, case when l_partkey%2=0 then '' else 'OPT' end as typ, case when l_linenumber%2=0 then '07' else '06' end as version, case l_suppkey%4 when 0 then 'EUR' when 1 then 'USD' when 2 then 'GBP' else 'MXN' end as currency, case when l_returnflag='R' then '' else 'CRV_'||l_returnflag end as curve, 'INF_'||l_linestatus as inflation_curve, lpad(cast(extract(day from l_shipdate) as string),2,'0')||'/'||lpad(cast(extract(month from l_shipdate) as string),2,'0')||'/'||cast(extract(year from l_shipdate) as string) as maturity_text, date '1998-06-01' as as_of, cast(case when l_linenumber=1 then 0 else l_partkey%1000-500 end as decimal(23,8)) as dv01_par, cast(case when l_linenumber=1 then 0 else l_suppkey%50 end as decimal(23,8)) as inflation_par, case when l_suppkey%6=0 then null when l_suppkey%3=0 then 'ST-'||cast(l_suppkey as string) else 'NS' end as strategy from lineitem join orders on l_orderkey=o_orderkey"""
    ),
    "sens_credit": (
        """select 'T'||cast(l_orderkey as string) as trade_id, 'PF'||cast(o_custkey%20 as string) as portfolio, l_linenumber as line_no, 'C'||cast(o_custkey as string) as counterparty, '0182' as entity, 'front3' as source_system, 'SEC'||cast(l_partkey as string) as security, 'CURVE'||cast(l_suppkey%8 as string) as curve, lpad(cast(extract(day from l_shipdate) as string),2,'0')||'/'||lpad(cast(extract(month from l_shipdate) as string),2,'0')||'/'||cast(extract(year from l_shipdate) as string) as maturity_text, date '1998-06-01' as as_of, cast(l_partkey%200-100 as decimal(23,8)) as cr01_par from lineitem join orders on l_orderkey=o_orderkey"""
    ),
    "sens_fx": (
        """select 'T'||cast(l_orderkey as string) as trade_id, 'PF'||cast(o_custkey%20 as string) as portfolio, l_linenumber as line_no, 'C'||cast(o_custkey as string) as counterparty, '0182' as entity, 'front3' as source_system, case when l_partkey%4=0 then 'FX' else 'OPT' end as grp, case when l_partkey%13=0 then null else case l_suppkey%4 when 0 then 'EUR' when 1 then 'USD' when 2 then 'GBP' else 'MXN' end end as c1, case when l_partkey%5=0 then null else case l_partkey%4 when 0 then 'EUR' when 1 then 'USD' when 2 then 'GBP' else 'MXN' end end as c2, 'EURUSD' as pair, cast(l_partkey%300-150 as decimal(23,8)) as delta, cast(case when l_linenumber%2=0 then 0 else l_suppkey%40 end as decimal(23,8)) as vega, cast(l_quantity as decimal(23,8)) as exposure_pl, cast(l_linenumber*10 as decimal(23,8)) as exposure_opt from lineitem join orders on l_orderkey=o_orderkey"""
    ),
    "sens_vega": (
        """select 'T'||cast(l_orderkey as string) as trade_id, l_linenumber as line_no, case l_suppkey%5 when 0 then 'EXOT_IRPH_1' when 1 then 'TIIE28' when 2 then 'USD-SW' when 3 then 'GBP-SW' else 'SPIPC' end as risk_factor, case l_linenumber%3 when 0 then 'SV' when 1 then 'CV' else '' end as vol_group, case l_partkey%5 when 0 then '1M' when 1 then '6M' when 2 then '1Y' when 3 then '5Y' else '10Y' end as option_tenor, case l_partkey%3 when 0 then '2Y' when 1 then '5Y' else '30Y' end as underlying_tenor, cast(l_quantity as decimal(23,8)) as vega from lineitem"""
    ),
    "tenor_text": (
        """select l_orderkey, l_linenumber, case l_linenumber%7 when 0 then '6M' when 1 then 'M6' when 2 then '18M' when 3 then 'Jun 24' when 4 then '31/12/2025' when 5 then '' else '1Y6M' end as tenor from lineitem"""
    ),
    "pl": (
        """select 'T'||cast(o_orderkey as string) as trade_id, 'PF'||cast(o_custkey%20 as string) as portfolio, o_orderdate as trade_date, cast(case when o_orderkey%11=0 then 0 else o_custkey%5000-2500 end as decimal(23,8)) as market_value from orders"""
    ),
    "cpty_xml": (
        """select c_custkey, '<GLOBAL><OPERATIVES><OPERATIVE>'||case when c_custkey%50=0 then '' else '<RDR_Code_Operative>R'||cast(c_custkey as string)||'</RDR_Code_Operative>' end||'<ROLES>'||case when c_custkey%7=0 then '<GROUP>' else '' end||'<ROLE_IDENTIFIER><Role_Identifier>C'||cast(c_custkey as string)||'</Role_Identifier><Role_Identifier_Context>MUREXID</Role_Identifier_Context>'||case when c_custkey%11=0 then '<Role_Identifier_Context>CALYPSOID</Role_Identifier_Context>' else '' end||'</ROLE_IDENTIFIER>'||case when c_custkey%3=0 then '<ROLE_IDENTIFIER><Role_Identifier>K'||cast(c_custkey as string)||'</Role_Identifier><Role_Identifier_Context>CALYPSOID</Role_Identifier_Context></ROLE_IDENTIFIER>' else '' end||case when c_custkey%7=0 then '</GROUP>' else '' end||'</ROLES></OPERATIVE></OPERATIVES></GLOBAL>' as doc from customer"""
    ),
    "perimeter": (
        """select 'K'||cast(c_custkey as string) as short_name, '0182' as entity, 'CT'||cast(c_custkey as string) as contract, date '1996-01-01' + cast(c_custkey%900 as int) as effective from customer where c_custkey%6=0"""
    ),
    "products": (
        """select cast(p_partkey as int) as product_id, p_size as weight, case when p_partkey%4=0 then 'N' else 'Y' end as eligible, case when p_partkey%5=0 then 'N' else 'Y' end as credit_risk, p_type as product_class, p_brand as schedule_class from part"""
    ),
    "trade_product": (
        """select 'T'||cast(o_orderkey as string) as trade_id, cast(1+o_orderkey%((select max(p_partkey) from part)+20) as int) as product_id from orders"""
    ),
    "portfolios": (
        """select distinct 'PF'||cast(c_custkey%20 as string) as portfolio, case when c_custkey%20<15 then '0' else '1' end as excluded from customer"""
    ),
    "match_ids": (
        """select 'T'||cast(o_orderkey as string) as trade_id, 'M'||cast(o_custkey as string) as match_id from orders where o_orderkey%2=0"""
    ),
    "grid": (
        """select * from (values ('ir',14,'2W'),('ir',30,'1M'),('ir',90,'3M'),('ir',180,'6M'),('ir',365,'1Y'),('ir',730,'2Y'),('ir',1095,'3Y'),('ir',1825,'5Y'),('ir',3650,'10Y'),('ir',5475,'15Y'),('ir',7300,'20Y'),('ir',10950,'30Y'),('cred',365,'1Y'),('cred',730,'2Y'),('cred',1095,'3Y'),('cred',1825,'5Y'),('cred',3650,'10Y')) g(grid_type,days,label)"""
    ),
    "vol_cv": (
        """select c.ccy as currency, case when c.ccy='USD' and t.label='2W' then '14D' else t.label end as tenor, t.days, case when (length(t.label)*7+t.days+c.k)%3=0 then null else cast(t.days%97+c.k as decimal(23,8)) end as vol from (values ('EUR',1),('USD',2),('GBP',3),('MXN',4)) c(ccy,k) cross join (values (14,'2W'),(30,'1M'),(90,'3M'),(180,'6M'),(365,'1Y'),(1095,'3Y'),(3650,'10Y')) t(days,label) union all select * from (values ('EUR','14D',14,40),('GBP','12M',365,7),('GBP','6M',180,99),('USD','30D',30,null)) e(ccy,label,days,vol)"""
    ),
    "vol_sv": (
        """select c.ccy as currency, t.label as tenor, t.days, u.ulabel as underlying, u.udays as underlying_days, case when (t.days+u.udays+c.k)%4=0 then null else cast(t.days%89+u.udays%13+c.k as decimal(23,8)) end as vol from (values ('EUR',1),('USD',2),('GBP',3),('MXN',4)) c(ccy,k) cross join (values (30,'1M'),(180,'6M'),(365,'1Y'),(1825,'5Y')) t(days,label) cross join (values (730,'2Y'),(1825,'5Y'),(3650,'10Y')) u(udays,ulabel) union all select * from (values ('EUR','30D',30,'2Y',730,50),('USD','12M',365,'5Y',1825,9),('GBP','6M',180,'5Y',1825,3)) e(ccy,label,days,ulabel,udays,vol)"""
    ),
    "vol_fx": (
        """select p.pair, 'FX' as vol_type, t.label as tenor, t.days, date '2019-05-20' as as_of, cast(t.days%11+1 as decimal(23,8)) as vol from (values ('EURUSD'),('EURGBP')) p(pair) cross join (values (7,'1W'),(14,'2W'),(60,'2M'),(400,'M13'),(12000,'33Y')) t(days,label)"""
    ),
    "file_log": (
        """select 'sta/'||event_type||'_'||cast(extract(year from ts) as string)||lpad(cast(extract(month from ts) as string),2,'0')||lpad(cast(extract(day from ts) as string),2,'0')||'.txt' as path, case when user_id%10=0 then 'margin' else 'ingest' end as app_id, ts as loaded_at, case when event_id%20=0 then 'Failed' else 'Processed' end as status from events where event_type<>'error' or extract(day from ts)%5<>0"""
    ),
    "masks": (
        """select * from (values ('common','.*sta/view_{FI}[.]txt$'),('common','.*sta/click_{FI}[.]txt$'),('rates','.*sta/error_{FI}[.]txt$'),('fx','.*sta/nosuch_{FI}[.]txt$')) m(load,mask)"""
    ),
}
