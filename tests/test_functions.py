"""Scalar rules: the edge-case table of FIXTURES.md section 3."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from marginflow.functions import (comma_decimal, fx_exposure_entries, nominal, pillar_days,
                                  product_key, tenor_code_days, tenor_days, vol_currency)
from marginflow.operators import filters

AS_OF = dt.date(2019, 5, 20)


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_tenor_days(spark):
    got = one_col(spark, ["6M", "M6", "18M", "1W", "Jun 24", "31/12/2025", "", "1Y6M"],
                  lambda c: tenor_days(c, AS_OF))
    assert got == [180, 180, 540, 7, 1839, 2417, -1, -1]


def test_tenor_code_days(spark):
    assert one_col(spark, ["1Y6M", "12M", "2W", "1Y", "M6", ""], tenor_code_days) == [545, 360, 14, 365, None, None]


def test_pillar_days(spark):
    assert one_col(spark, ["6m", "s2", "A1", "d10", "X5", "5"], pillar_days) == [180, 14, 365, 10, None, None]


def test_comma_decimal(spark):
    got = one_col(spark, ["1,5", None, "x"], comma_decimal)
    assert got[0] == Decimal("1.5") and got[1] is None and got[2] is None


def test_nominal(spark):
    rows = [(100, 0, "USD", "EUR"), (100, 90, "USD", "EUR"), (100, 90, "EUR", "USD"),
            (100, 90, "USD", "GBP"), (100, 90, "EUR", "EUR"), (0, 90, "USD", "EUR"),
            (None, 90, "USD", "EUR")]
    df = spark.createDataFrame(rows, "p int, r int, pc string, rc string")
    got = [float(r[0]) for r in df.select(nominal("p", "r", "pc", "rc")).collect()]
    assert got == [100, 100, 90, 90, 0, 0, 0]


def test_vol_currency(spark):
    got = one_col(spark, ["EXOT_IRPH_1", "SPIPC", "TIIE28", "MX SWAPT", "USD-SW"], vol_currency)
    assert got == ["EUR", "EUR", "MXN", "MXN", "USD"]


def test_fx_exposure(spark):
    rows = [("EUR", 1, "USD", 2), ("EUR", 1, None, 2), (None, 1, "USD", 2), (None, 1, None, 2), ("EUR", 1, "EUR", 2)]
    df = spark.createDataFrame(rows, "c1 string, pl int, c2 string, opt int")

    def run(legacy):
        out = df.select(fx_exposure_entries("c1", "pl", "c2", "opt", legacy).alias("e")).collect()
        return [{x["currency"]: float(x["amount"]) for x in r["e"]} for r in out]

    assert run(False) == [{"EUR": 1, "USD": 2}, {"EUR": 1}, {"USD": 2}, {"": 0}, {"EUR": 2}]
    assert run(True)[2] == {"USD": 1}


def test_version_rule(spark):
    df = spark.createDataFrame([("IRD", "CS", "", "07"), ("IRD", "CS", "", "06"), ("IRX", "CS", "", "06"),
                                (None, "CS", "", "07")], "f string, g string, t string, version string")
    kept = filters.version_rule(df, product_key("f", "g", "t")).collect()
    assert [(r.f, r.version) for r in kept] == [("IRD", "07"), ("IRX", "06")]


def test_split_strategy(spark):
    df = spark.createDataFrame([("ST-1",), ("NS",), (None,)], "strategy string")
    w, wo = filters.split_strategy(df)
    assert [r[0] for r in w.collect()] == ["ST-1"] and [r[0] for r in wo.collect()] == ["NS"]
