"""Input tables of the margin job, derived from the driver's TPC-H-style tables.

Each builder returns a lazy DataFrame over ``sf_dir``; the work grows with the
source tables. Config-sized tables (tenor grid, vol surfaces, file masks) are
small literal frames, exactly as a run's configuration would supply them.
The same tables are defined in DuckDB SQL in :mod:`marginflow.sources.fixture_sql`
for the oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fit_shuffles
from .scan import read_table

AS_OF = dt.date(1998, 6, 1)          # horizon date of the sensitivity feeds
FX_VOL_AS_OF = dt.date(2019, 5, 20)  # horizon date of the FX vol quotes


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _dmy(c: str) -> F.Column:
    return F.date_format(F.col(c), "dd/MM/yyyy")


def _ccy(k: F.Column) -> F.Column:
    return (F.when(k == 0, "EUR").when(k == 1, "USD").when(k == 2, "GBP").otherwise("MXN"))


def _trade(c: str) -> F.Column:
    return F.concat(F.lit("T"), _s(c))


def _portfolio(c: str) -> F.Column:
    return F.concat(F.lit("PF"), _s(F.col(c) % 20))


def trades(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        _trade("o_orderkey").alias("trade_id"),
        _portfolio("o_custkey").alias("portfolio"),
        F.when(k % 10 == 0, "OTHER").otherwise("FRONT").alias("source_app"),
        _dmy("o_orderdate").alias("booked_text"),
        F.when(k % 7 == 0, "").otherwise(_dmy("o_orderdate")).alias("maturity_text"),
        F.concat(_s(k % 100000), F.lit(","), F.lpad(_s(c % 100), 2, "0")).alias("pay_text"),
        F.when(k % 3 == 0, "0,00").otherwise(F.concat(_s(c), F.lit(",50"))).alias("receive_text"),
        _ccy(k % 4).alias("pay_ccy"),
        _ccy(c % 4).alias("receive_ccy"),
    )


def _lineitem_orders(spark: SparkSession, d: str, li_cols, o_cols=("o_orderkey", "o_custkey")) -> DataFrame:
    li = fit_shuffles(read_table(spark, d, "lineitem")).select(*li_cols)
    o = read_table(spark, d, "orders").select(*o_cols)
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))


def sens_ir(spark: SparkSession, d: str) -> DataFrame:
    j = _lineitem_orders(spark, d, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                    "l_returnflag", "l_linestatus", "l_shipdate"])
    p, s, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return j.select(
        _trade("l_orderkey").alias("trade_id"),
        _portfolio("o_custkey").alias("portfolio"),
        ln.alias("line_no"),
        F.concat(F.lit("C"), _s("o_custkey")).alias("counterparty"),
        F.when(s % 9 == 0, "9999").otherwise("0182").alias("entity"),
        F.lit("front3").alias("source_system"),
        F.when(p % 5 == 0, "IRD").otherwise("IRX").alias("family"),
        F.lit("CS").alias("grp"),
        F.when(p % 2 == 0, "").otherwise("OPT").alias("typ"),
        F.when(ln % 2 == 0, "07").otherwise("06").alias("version"),
        _ccy(s % 4).alias("currency"),
        F.when(F.col("l_returnflag") == "R", "").otherwise(F.concat(F.lit("CRV_"), F.col("l_returnflag"))).alias("curve"),
        F.concat(F.lit("INF_"), F.col("l_linestatus")).alias("inflation_curve"),
        _dmy("l_shipdate").alias("maturity_text"),
        F.lit(AS_OF).alias("as_of"),
        F.when(ln == 1, 0).otherwise(p % 1000 - 500).cast("decimal(23,8)").alias("dv01_par"),
        F.when(ln == 1, 0).otherwise(s % 50).cast("decimal(23,8)").alias("inflation_par"),
        F.when(s % 6 == 0, F.lit(None).cast("string"))
         .when(s % 3 == 0, F.concat(F.lit("ST-"), _s(s))).otherwise("NS").alias("strategy"),
    )


def sens_credit(spark: SparkSession, d: str) -> DataFrame:
    j = _lineitem_orders(spark, d, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"])
    return j.select(
        _trade("l_orderkey").alias("trade_id"),
        _portfolio("o_custkey").alias("portfolio"),
        F.col("l_linenumber").alias("line_no"),
        F.concat(F.lit("C"), _s("o_custkey")).alias("counterparty"),
        F.lit("0182").alias("entity"),
        F.lit("front3").alias("source_system"),
        F.concat(F.lit("SEC"), _s("l_partkey")).alias("security"),
        F.concat(F.lit("CURVE"), _s(F.col("l_suppkey") % 8)).alias("curve"),
        _dmy("l_shipdate").alias("maturity_text"),
        F.lit(AS_OF).alias("as_of"),
        (F.col("l_partkey") % 200 - 100).cast("decimal(23,8)").alias("cr01_par"),
    )


def sens_fx(spark: SparkSession, d: str) -> DataFrame:
    j = _lineitem_orders(spark, d, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"])
    p, s, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return j.select(
        _trade("l_orderkey").alias("trade_id"),
        _portfolio("o_custkey").alias("portfolio"),
        ln.alias("line_no"),
        F.concat(F.lit("C"), _s("o_custkey")).alias("counterparty"),
        F.lit("0182").alias("entity"),
        F.lit("front3").alias("source_system"),
        F.when(p % 4 == 0, "FX").otherwise("OPT").alias("grp"),
        F.when(p % 13 == 0, F.lit(None).cast("string")).otherwise(_ccy(s % 4)).alias("c1"),
        F.when(p % 5 == 0, F.lit(None).cast("string")).otherwise(_ccy(p % 4)).alias("c2"),
        F.lit("EURUSD").alias("pair"),
        (p % 300 - 150).cast("decimal(23,8)").alias("delta"),
        F.when(ln % 2 == 0, 0).otherwise(s % 40).cast("decimal(23,8)").alias("vega"),
        F.col("l_quantity").cast("decimal(23,8)").alias("exposure_pl"),
        (ln * 10).cast("decimal(23,8)").alias("exposure_opt"),
    )


def sens_vega(spark: SparkSession, d: str) -> DataFrame:
    li = fit_shuffles(read_table(spark, d, "lineitem"))
    p, s, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return li.select(
        _trade("l_orderkey").alias("trade_id"),
        ln.alias("line_no"),
        F.when(s % 5 == 0, "EXOT_IRPH_1").when(s % 5 == 1, "TIIE28").when(s % 5 == 2, "USD-SW")
         .when(s % 5 == 3, "GBP-SW").otherwise("SPIPC").alias("risk_factor"),
        F.when(ln % 3 == 0, "SV").when(ln % 3 == 1, "CV").otherwise("").alias("vol_group"),
        F.when(p % 5 == 0, "1M").when(p % 5 == 1, "6M").when(p % 5 == 2, "1Y")
         .when(p % 5 == 3, "5Y").otherwise("10Y").alias("option_tenor"),
        F.when(p % 3 == 0, "2Y").when(p % 3 == 1, "5Y").otherwise("30Y").alias("underlying_tenor"),
        F.col("l_quantity").cast("decimal(23,8)").alias("vega"),
    )


def tenor_text(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    k = F.col("l_linenumber") % 7
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(k == 0, "6M").when(k == 1, "M6").when(k == 2, "18M").when(k == 3, "Jun 24")
         .when(k == 4, "31/12/2025").when(k == 5, "").otherwise("1Y6M").alias("tenor"),
    )


def pl(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        _trade("o_orderkey").alias("trade_id"),
        _portfolio("o_custkey").alias("portfolio"),
        F.col("o_orderdate").cast("date").alias("trade_date"),
        F.when(k % 11 == 0, 0).otherwise(c % 5000 - 2500).cast("decimal(23,8)").alias("market_value"),
    )


def cpty_xml(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer")
    k = _s("c_custkey")

    def role(prefix, *contexts):
        tags = "".join(f"<Role_Identifier_Context>{c}</Role_Identifier_Context>" for c in contexts)
        return F.concat(F.lit("<ROLE_IDENTIFIER><Role_Identifier>" + prefix), k,
                        F.lit(f"</Role_Identifier>{tags}</ROLE_IDENTIFIER>"))

    def when(each, then, otherwise=""):
        c = [x if isinstance(x, Column) else F.lit(x) for x in (then, otherwise)]
        return F.when(F.col("c_custkey") % each == 0, c[0]).otherwise(c[1])

    # every 50th operative lacks its code, every 7th has its roles one level deeper,
    # every 11th identifier has two contexts
    doc = F.concat(
        F.lit("<GLOBAL><OPERATIVES><OPERATIVE>"),
        when(50, "", F.concat(F.lit("<RDR_Code_Operative>R"), k, F.lit("</RDR_Code_Operative>"))),
        F.lit("<ROLES>"), when(7, "<GROUP>"),
        when(11, role("C", "MUREXID", "CALYPSOID"), role("C", "MUREXID")),
        when(3, role("K", "CALYPSOID")),
        when(7, "</GROUP>"),
        F.lit("</ROLES></OPERATIVE></OPERATIVES></GLOBAL>"),
    )
    return c.select("c_custkey", doc.alias("doc"))


def perimeter(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer").where(F.col("c_custkey") % 6 == 0)
    return c.select(
        F.concat(F.lit("K"), _s("c_custkey")).alias("short_name"),
        F.lit("0182").alias("entity"),
        F.concat(F.lit("CT"), _s("c_custkey")).alias("contract"),
        F.date_add(F.lit(dt.date(1996, 1, 1)), (F.col("c_custkey") % 900).cast("int")).alias("effective"),
    )


def products(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("product_id"),
        F.col("p_size").alias("weight"),
        F.when(F.col("p_partkey") % 4 == 0, "N").otherwise("Y").alias("eligible"),
        F.when(F.col("p_partkey") % 5 == 0, "N").otherwise("Y").alias("credit_risk"),
        F.col("p_type").alias("product_class"),
        F.col("p_brand").alias("schedule_class"),
    )


def trade_product(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    last = read_table(spark, d, "part").agg(F.max("p_partkey").alias("last"))   # one row
    return o.join(F.broadcast(last)).select(
        _trade("o_orderkey").alias("trade_id"),
        (F.lit(1) + F.col("o_orderkey") % (F.col("last") + 20)).cast("int").alias("product_id"))


def portfolios(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer")
    return c.select(
        _portfolio("c_custkey").alias("portfolio"),
        F.when(F.col("c_custkey") % 20 < 15, "0").otherwise("1").alias("excluded"),
    ).distinct()


def match_ids(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").where(F.col("o_orderkey") % 2 == 0)
    return o.select(_trade("o_orderkey").alias("trade_id"),
                    F.concat(F.lit("M"), _s("o_custkey")).alias("match_id"))


def file_log(spark: SparkSession, d: str) -> DataFrame:
    # no error files on every fifth day: periods with the common set and no complete load
    e = read_table(spark, d, "events").where((F.col("event_type") != "error") | (F.dayofmonth("ts") % 5 != 0))
    return e.select(
        F.concat(F.lit("sta/"), F.col("event_type"), F.lit("_"), F.date_format("ts", "yyyyMMdd"),
                 F.lit(".txt")).alias("path"),
        F.when(F.col("user_id") % 10 == 0, "margin").otherwise("ingest").alias("app_id"),
        F.col("ts").alias("loaded_at"),
        F.when(F.col("event_id") % 20 == 0, "Failed").otherwise("Processed").alias("status"),
    )


# ---- configuration-sized tables (a run's settings, not data) ---------------------------

# Tenor grid vertices (type, days, label) in the 365-day convention.
GRID_ROWS = [
    ("ir", 14, "2W"), ("ir", 30, "1M"), ("ir", 90, "3M"), ("ir", 180, "6M"), ("ir", 365, "1Y"),
    ("ir", 730, "2Y"), ("ir", 1095, "3Y"), ("ir", 1825, "5Y"), ("ir", 3650, "10Y"),
    ("ir", 5475, "15Y"), ("ir", 7300, "20Y"), ("ir", 10950, "30Y"),
    ("cred", 365, "1Y"), ("cred", 730, "2Y"), ("cred", 1095, "3Y"), ("cred", 1825, "5Y"),
    ("cred", 3650, "10Y"),
]

# File masks per load (``{FI}`` / ``{FF}`` = period start / end, yyyyMMdd).
MASKS = {
    "common": [r".*sta/view_{FI}[.]txt$", r".*sta/click_{FI}[.]txt$"],
    "rates": [r".*sta/error_{FI}[.]txt$"],
    "fx": [r".*sta/nosuch_{FI}[.]txt$"],
}

_CCY_K = [("EUR", 1), ("USD", 2), ("GBP", 3), ("MXN", 4)]
_CV_TENORS = [(14, "2W"), (30, "1M"), (90, "3M"), (180, "6M"), (365, "1Y"), (1095, "3Y"), (3650, "10Y")]
_SV_TENORS = [(30, "1M"), (180, "6M"), (365, "1Y"), (1825, "5Y")]
_SV_UNDERLYINGS = [(730, "2Y"), (1825, "5Y"), (3650, "10Y")]
# Surface labels that share a day count with a grid label, stand in its place, or repeat a node.
_CV_EXTRA = [("EUR", "14D", 14, 40), ("GBP", "12M", 365, 7), ("GBP", "6M", 180, 99), ("USD", "30D", 30, None)]
_SV_EXTRA = [("EUR", "30D", 30, "2Y", 730, 50), ("USD", "12M", 365, "5Y", 1825, 9), ("GBP", "6M", 180, "5Y", 1825, 3)]
_FX_PAIRS = ["EURUSD", "EURGBP"]
_FX_TENORS = [(7, "1W"), (14, "2W"), (60, "2M"), (400, "M13"), (12000, "33Y")]


def grid(spark: SparkSession, d: str | None = None) -> DataFrame:
    return spark.createDataFrame(GRID_ROWS, "grid_type string, days int, label string")


def masks(spark: SparkSession, d: str | None = None) -> DataFrame:
    rows = [(load, m) for load, ms in MASKS.items() for m in ms]
    return spark.createDataFrame(rows, "load string, mask string")


def vol_cv(spark: SparkSession, d: str | None = None) -> DataFrame:
    rows = []
    for ccy, k in _CCY_K:
        for days, label in _CV_TENORS:
            vol = None if (len(label) * 7 + days + k) % 3 == 0 else days % 97 + k
            rows.append((ccy, "14D" if (ccy, label) == ("USD", "2W") else label, days, vol))
    rows += _CV_EXTRA
    return spark.createDataFrame(rows, "currency string, tenor string, days int, vol int") \
        .withColumn("vol", F.col("vol").cast("decimal(23,8)"))


def vol_sv(spark: SparkSession, d: str | None = None) -> DataFrame:
    rows = []
    for ccy, k in _CCY_K:
        for days, label in _SV_TENORS:
            for udays, ulabel in _SV_UNDERLYINGS:
                vol = None if (days + udays + k) % 4 == 0 else days % 89 + udays % 13 + k
                rows.append((ccy, label, days, ulabel, udays, vol))
    rows += _SV_EXTRA
    return spark.createDataFrame(
        rows, "currency string, tenor string, days int, underlying string, underlying_days int, vol int"
    ).withColumn("vol", F.col("vol").cast("decimal(23,8)"))


def vol_fx(spark: SparkSession, d: str | None = None) -> DataFrame:
    rows = [(p, "FX", label, days, FX_VOL_AS_OF, days % 11 + 1)
            for p in _FX_PAIRS for days, label in _FX_TENORS]
    return spark.createDataFrame(rows, "pair string, vol_type string, tenor string, days int, as_of date, vol int") \
        .withColumn("vol", F.col("vol").cast("decimal(23,8)"))
