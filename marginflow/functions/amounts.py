"""Amounts, codes and exposures (D7-D15) as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ._util import as_col

AMOUNT = DecimalType(23, 8)      # working amount type of the margin table
WIDE = DecimalType(38, 18)       # comma-decimal text and exposure map values

# Risk-factor names whose volatility currency is EUR.
EUR_VOL_FACTORS = ("EXOT_IRPH_1", "EXOT_IRPH_2", "EXOT_IRPH_3", "SPIPC")
# Risk-factor patterns whose volatility currency is MXN.
MXN_VOL_PATTERNS = ("TIIE%", "MX SWAPT")


def comma_decimal(c) -> Column:
    """``'1,5'`` -> 1.5 as decimal(38,18); null / malformed -> null."""
    return F.regexp_replace(as_col(c), ",", ".").try_cast(WIDE)


def nominal(pay, receive, pay_ccy, receive_ccy, base: str = "EUR") -> Column:
    """Which leg's amount is the trade notional.

    receive = 0 and pay <> 0 -> pay; both non-zero -> by currency
    (pay foreign & receive base -> pay; pay base & receive foreign -> receive;
    both foreign -> receive; both base -> 0); anything else -> 0.
    Currency tests are null-safe like the reference's object equality; null
    amounts fall through to 0.
    """
    p, r = as_col(pay), as_col(receive)
    pay_is_base = as_col(pay_ccy).eqNullSafe(F.lit(base))
    rec_is_base = as_col(receive_ccy).eqNullSafe(F.lit(base))
    zero = F.lit(0).cast(WIDE)
    by_ccy = (
        F.when(~pay_is_base & rec_is_base, p)
        .when(pay_is_base & ~rec_is_base, r)
        .when(~pay_is_base & ~rec_is_base, r)
        .otherwise(zero)
    )
    return (
        F.when((r == 0) & (p != 0), p)
        .when((r != 0) & (p != 0), by_ccy)
        .otherwise(zero)
    ).cast(WIDE)


def product_key(family, group, typ) -> Column:
    """``family-group-type`` (null if any part is null)."""
    return F.concat(as_col(family), F.lit("-"), as_col(group), F.lit("-"), as_col(typ))


def isin_qualifier(code) -> Column:
    """``ISIN:<code>``."""
    return F.concat(F.lit("ISIN:"), as_col(code))


def vol_currency(risk_factor) -> Column:
    """Volatility currency of a rates risk factor."""
    rf = as_col(risk_factor)
    mxn = None
    for pat in MXN_VOL_PATTERNS:
        mxn = rf.like(pat) if mxn is None else (mxn | rf.like(pat))
    return (
        F.when(rf.isin(*EUR_VOL_FACTORS), F.lit("EUR"))
        .when(mxn, F.lit("MXN"))
        .otherwise(F.substring(rf, 1, 3))
    )


def fx_exposure_entries(c1, pl, c2, opt, legacy: bool = False) -> Column:
    """FX exposure as ``ARRAY<STRUCT<currency, amount>>``.

    both currencies null -> [('', 0)]; only c1 -> [(c1, pl)];
    only c2 -> [(c2, opt)] (``legacy=True``: the reference's (c2, pl));
    both -> [(c1, pl), (c2, opt)], and when c1 = c2 the second wins.
    """
    c1, c2 = as_col(c1), as_col(c2)
    pl, opt = as_col(pl).cast(WIDE), as_col(opt).cast(WIDE)

    def entry(ccy, amt):
        return F.struct(ccy.alias("currency"), amt.alias("amount"))

    return (
        F.when(c1.isNull() & c2.isNull(), F.array(entry(F.lit(""), F.lit(0).cast(WIDE))))
        .when(c2.isNull(), F.array(entry(c1, pl)))
        .when(c1.isNull(), F.array(entry(c2, pl if legacy else opt)))
        .when(c1 == c2, F.array(entry(c1, opt)))
        .otherwise(F.array(entry(c1, pl), entry(c2, opt)))
    )


def fx_exposure(c1, pl, c2, opt, legacy: bool = False) -> Column:
    """D12 as a ``MAP<STRING, DECIMAL(38,18)>`` column (keys unique by construction)."""
    return F.map_from_entries(fx_exposure_entries(c1, pl, c2, opt, legacy))


def empty_exposure() -> Column:
    """The ``{'' -> 0}`` exposure of rows that carry no FX exposure."""
    return F.create_map(F.lit(""), F.lit(0).cast(WIDE))


def scale_by_vol(amount, vol) -> Column:
    """Amount x volatility, both as decimal(23,8), result decimal(23,8).

    Spark types the product decimal(38,7); the final cast keeps the margin
    table's (23,8) shape.
    """
    return (as_col(amount).cast(AMOUNT) * as_col(vol).cast(AMOUNT)).cast(AMOUNT)


def placeholder_product_id(trade, n_products: int = 150, first_id: int = 82) -> Column:
    """D14 demo default: a deterministic product id per trade when no mapping table exists."""
    return (F.pmod(F.hash(as_col(trade)), F.lit(n_products)) + first_id).cast("int")
