"""Feed builders (E1-E8): one sensitivity feed -> canonical margin rows, both models.

Every feed runs the same prefix (F1 scope -> J1 trades -> D1/D7/D8 dates and
nominal -> J2 counterparties) and then emits SIMM rows and Schedule rows
(PV + Notional, U3). The SIMM and Schedule branches read the same prefix;
Spark plans each branch from the shared lazy plan and AQE reuses the
exchanges where the plans coincide, so no manual cache is needed.

Input columns a feed does not carry fall back to the literal the reference
would have produced for it (``''``, 0 or null) through :func:`col_or`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (AMOUNT, comma_decimal, empty_exposure, fx_exposure, isin_qualifier, nominal,
                         product_key)
from ..functions._util import col_or
from ..operators import dedup, filters, joins, reshape
from ..operators.observe import observe_counts

# The 39 canonical columns of a sensitivity row (order is documentation only:
# every union is by name).
CANONICAL = [
    "entity", "portfolio", "trade_id", "trade_date", "vol_group_agg", "short_name", "issuer_code",
    "family", "grp", "currency_pair", "typ", "risk_type", "qualifier", "sector", "risk_factor",
    "label2", "amount_currency", "source_name", "amount", "amount_cup0", "source_system",
    "counterparty", "sens_maturity", "horizon_date", "strategy", "underlying_maturity",
    "contract", "filter_date", "maturity_date", "booked_date", "im_model", "direction",
    "skeleton", "pnlvar_delta_ir", "pnlvar_vega_ir", "pnlvar_delta_fx", "year", "month", "day",
]

def _zero():
    return F.lit(0).cast(AMOUNT)


def _no_str():
    return F.lit(None).cast("string")


def _no_date():
    return F.lit(None).cast("date")


# of a trade, made before J1 so that its texts are not shuffled and parsed with every sensitivity
_OF_TRADE = {c: c for c in ("booked_date", "maturity_date", "nominal", "pay_ccy")}


Step = Callable[[DataFrame], DataFrame]   # cuts a feed's plan (``materialize``) or leaves it as it is


def whole(df: DataFrame) -> DataFrame:
    return df


def booked_trades(trades: DataFrame) -> DataFrame:
    """The columns that J1 brings, by trade and portfolio: dates (D1/D2), nominal (D7/D8) and pay currency."""
    if "nominal" in trades.columns:
        return trades
    t = joins.with_trade_dates(trades, maturity_col="maturity_text").withColumn(
        "nominal", nominal(comma_decimal("pay_text"), comma_decimal("receive_text"), "pay_ccy", "receive_ccy"))
    return t.select("trade_id", "portfolio", *_OF_TRADE)


def _prefix(sens: DataFrame, trades: DataFrame, cpty: DataFrame, pl: DataFrame | None = None,
            entity: str = "0182", source: str = "front3", name: str = "", counters: dict | None = None,
            step: Step = whole) -> DataFrame:
    """F1 -> J1 -> dates + nominal -> (J4 for rates vega) -> J2, counted after each step.

    Rows of counterparties out of scope are told before J1 and go at once; with counters, which count them up to J2,
    they go on with their keys alone. ``step`` cuts the plan where fewer rows go on than came.
    """
    def point(df: DataFrame, step: str, *keys: str) -> DataFrame:
        return observe_counts(df, f"{name}.{step}", counters, keys)

    s = point(filters.in_scope(point(sens, "input", "entity", "source_system"), entity, source), "in_scope", "trade_id", "portfolio")
    reach = joins.counterparty_reach(cpty)
    s = (joins.within_reach(s, reach) if counters is None
         else joins.blank_beyond_reach(s, reach, ("trade_id", "portfolio", "entity")))
    s = step(s)
    t = booked_trades(trades)
    if counters is None:   # J2's keys first, its date once J1 has brought it: the rows stay where J1 shuffles them
        s = joins.join_counterparty(s, cpty, date_col=None)
    s = point(joins.join_trades(joins.with_trade_key(s), t, trade_cols=_OF_TRADE), "traded", "counterparty", "entity", "booked_date")
    if pl is not None:
        if counters is not None:   # J4 as a merge join may end before it has read, and so counted, every row of J1
            s = step(s)
        s = point(joins.join_pl(s, pl, with_trade_date=True), "priced", "counterparty", "entity", "booked_date")
    if counters is None:
        return s.where(F.col("booked_date") >= F.col("filter_date"))
    return point(joins.join_counterparty(step(s.where("_reached").drop("_reached")), cpty), "in_perimeter")


def _common(df: DataFrame) -> dict:
    """Columns every feed fills the same way."""
    horizon = col_or(df, "as_of", _no_date())
    return {
        "entity": F.col("entity"), "portfolio": F.col("portfolio"), "trade_id": F.col("trade_id"),
        "trade_date": col_or(df, "trade_date", _no_date()),
        "short_name": F.col("short_name"), "issuer_code": col_or(df, "issuer_code", F.lit("")),
        "family": col_or(df, "family", _no_str()), "grp": col_or(df, "grp", _no_str()),
        "typ": col_or(df, "typ", _no_str()), "amount_currency": F.lit("EUR"),
        "source_system": F.col("source_system"), "counterparty": F.col("counterparty"),
        "horizon_date": horizon, "strategy": col_or(df, "strategy", _no_str()),
        "contract": F.col("contract"), "filter_date": F.col("filter_date"),
        "maturity_date": F.col("maturity_date"), "booked_date": F.col("booked_date"),
        "direction": col_or(df, "direction", _no_str()), "skeleton": col_or(df, "skeleton", _no_str()),
        "year": F.year(horizon), "month": F.month(horizon), "day": F.dayofmonth(horizon),
    }


AMOUNT_COLUMNS = ("amount", "amount_cup0", "pnlvar_delta_ir", "pnlvar_vega_ir")


def _entry(cols: dict, fields, keep) -> F.Column:
    vals = [(cols[c].cast(AMOUNT) if c in AMOUNT_COLUMNS else cols[c]).alias(c) for c in fields]
    return F.struct(*vals, keep.alias("_keep"))


def _both_models(rows: DataFrame, simm_cols: dict, sched_cols: dict, pl: DataFrame | None,
                 varying_map: bool = False) -> DataFrame:
    """SIMM rows and Schedule rows (U3) of one feed in a single pass, then G5.

    ``rows`` are the feed's rows after its non-zero filter. With ``pl`` given,
    P&L is left-joined once (J3): every row emits its SIMM row, and rows with
    a P&L match also emit a PV row (market value) and a Notional row
    (nominal); duplicates from P&L fan-out collapse in the dedup exactly as
    in the reference's per-branch dedup. Without ``pl`` the rows already
    carry their P&L (J4, inner). One scan of the prefix feeds both models.
    """
    if pl is not None:
        p = joins.keyed_pl(pl.select("trade_id", "portfolio", "market_value")).withColumn("_pl_hit", F.lit(True))
        rows = rows.join(p, joins.TRADE_KEY, "left")
        hit = F.col("_pl_hit").isNotNull()
    else:
        hit = F.lit(True)
    fields = CANONICAL if varying_map else [c for c in CANONICAL if c != "pnlvar_delta_fx"]
    sched = dict(sched_cols, im_model=F.lit("Schedule"), sector=F.lit(""), label2=F.lit(""),
                 pnlvar_delta_fx=empty_exposure())
    entries = F.array(
        _entry(dict(simm_cols, im_model=F.lit("SIMM")), fields, F.lit(True)),
        _entry(dict(sched, risk_type=F.lit("PV"), amount=F.col("market_value")), fields, hit),
        _entry(dict(sched, risk_type=F.lit("Notional"), amount=F.col("nominal")), fields, hit),
    )
    # the key goes with the rows: they are together by it already, and the dedup needs no further shuffle
    out = rows.select(joins.TRADE_KEY, F.inline(F.filter(entries, lambda e: e["_keep"]))).drop("_keep")
    if varying_map:
        return dedup.dedup_canonical(out).select(*CANONICAL)
    out = out.dropDuplicates([joins.TRADE_KEY, *fields])
    return out.withColumn("pnlvar_delta_fx", empty_exposure()).select(*CANONICAL)


# ---------------------------------------------------------------- E1 / E2 rates delta

def rates_delta(sens: DataFrame, trades: DataFrame, cpty: DataFrame, pl: DataFrame,
                counters: dict | None = None, step: Step = whole) -> DataFrame:
    """E1 (SIMM) + E2 (Schedule) from a rates-delta feed
    (``dv01_par, inflation_par``; optional ``dv01_zero, inflation_zero, sensi_cross``)."""
    s = _prefix(sens, trades, cpty, name="rates_delta", counters=counters, step=step)
    s = filters.version_rule(s, product_key("family", "grp", "typ"))
    has_curve = F.col("curve") != ""
    cols = dict(_common(s))
    cols.update({
        "vol_group_agg": F.lit(""), "currency_pair": F.lit(""), "issuer_code": F.lit(""),
        "qualifier": F.col("currency"),
        "risk_factor": F.when(has_curve, F.col("curve")).otherwise(F.col("inflation_curve")),
        "sens_maturity": F.col("maturity_text"), "underlying_maturity": F.lit(""),
        "source_name": F.lit("DeltaIR"),
        "amount_cup0": col_or(s, "dv01_zero", _zero()) + col_or(s, "inflation_zero", _zero()),
        "pnlvar_vega_ir": _zero(), "pnlvar_delta_fx": empty_exposure(),
    })
    simm = dict(
        cols, amount=F.col("dv01_par") + F.col("inflation_par"),
        risk_type=F.when(has_curve, F.lit("Risk_IRCurve")).otherwise(F.lit("Risk_Inflation")),
        sector=F.when(has_curve, F.lit("1")).otherwise(F.lit("")),
        label2=F.when(has_curve, F.lit("OIS")).otherwise(F.lit("")),
        pnlvar_delta_ir=F.when(col_or(s, "sensi_cross", _no_str()).eqNullSafe(F.lit("Direct sensi")),
                               col_or(s, "dv01_zero", _zero())).otherwise(_zero()))
    nz = filters.nonzero(s, "dv01_par", "inflation_par")
    return _both_models(nz, simm, dict(cols, pnlvar_delta_ir=_zero()), pl)


# ---------------------------------------------------------------- E3 / E4 credit delta

def credit_delta(sens: DataFrame, trades: DataFrame, cpty: DataFrame, pl: DataFrame,
                 counters: dict | None = None, step: Step = whole) -> DataFrame:
    """E3 (SIMM) + E4 (Schedule) from a credit-delta feed (``security, curve, cr01_par``)."""
    s = _prefix(sens, trades, cpty, name="credit_delta", counters=counters, step=step)
    cols = dict(_common(s))
    cols.update({
        "vol_group_agg": F.lit(""), "currency_pair": F.lit(""),
        "qualifier": isin_qualifier(F.col("security")), "risk_factor": F.col("curve"),
        "sens_maturity": F.col("maturity_text"), "underlying_maturity": F.lit(""),
        "source_name": F.lit("DeltaCred"), "amount_cup0": _zero(),
        "pnlvar_delta_ir": _zero(), "pnlvar_vega_ir": _zero(), "pnlvar_delta_fx": empty_exposure(),
    })
    simm = dict(cols, amount=F.col("cr01_par"), risk_type=F.lit("Risk_CreditQ"), sector=F.lit("1"),
                label2=F.col("pay_ccy"))
    return _both_models(filters.nonzero(s, "cr01_par"), simm, cols, pl)


# ---------------------------------------------------------------- E5 / E6 FX delta + vega

def fx_risk(sens: DataFrame, trades: DataFrame, cpty: DataFrame, pl: DataFrame,
            legacy_exposure: bool = False, counters: dict | None = None, step: Step = whole) -> DataFrame:
    """E5 (SIMM) + E6 (Schedule) from an FX feed (``c1, c2, pair, delta, vega,
    exposure_pl, exposure_opt``); each row gives a delta leg and a vega leg (U4),
    and in the Schedule model each leg gives PV and Notional."""
    s = _prefix(sens, trades, cpty, name="fx_risk", counters=counters, step=step)
    cols = dict(_common(s))
    cols.update({
        "vol_group_agg": F.lit(""), "issuer_code": F.lit(""), "currency_pair": F.col("pair"),
        "qualifier": F.col("c1"), "risk_factor": F.col("c1"), "sector": F.lit(""),
        "sens_maturity": F.lit(""), "label2": F.lit(""), "underlying_maturity": F.lit(""),
        "amount_cup0": _zero(), "pnlvar_delta_ir": _zero(), "pnlvar_vega_ir": _zero(),
        "source_name": F.col("source_name"),
    })
    legs = reshape.fx_legs(filters.nonzero(s, "delta", "vega", mode="any"))
    exposure = F.when(F.col("risk_type") == "Risk_FX",
                      fx_exposure("c1", "exposure_pl", "c2", "exposure_opt", legacy_exposure)) \
        .otherwise(empty_exposure())
    simm = dict(cols, risk_type=F.col("risk_type"), amount=F.col("amount"), pnlvar_delta_fx=exposure)
    return _both_models(legs, simm, cols, pl, varying_map=True)


# ---------------------------------------------------------------- E7 / E8 rates vega

def rates_vega(sens: DataFrame, trades: DataFrame, cpty: DataFrame, pl: DataFrame,
               counters: dict | None = None, step: Step = whole) -> DataFrame:
    """E7 (SIMM) + E8 (Schedule) from a rates-vega feed (``risk_factor, vol_group,
    option_tenor, underlying_tenor, normal_vega, inflation_vega, yield_vega``; optional
    ``currency, normal_vega_pnl, yield_vega_pnl``). The amount is the three vegas' sum; the P&L amount
    leaves inflation out. The P&L join (with the trade date) runs before the counterparty join, so a
    row needs P&L in both models."""
    s = _prefix(sens, trades, cpty, pl=pl, name="rates_vega", counters=counters, step=step)
    cols = dict(_common(s))
    cols.update({
        "trade_date": F.col("trade_date"),
        "vol_group_agg": F.col("vol_group"), "issuer_code": F.lit(""), "currency_pair": F.lit(""),
        "qualifier": col_or(s, "currency", _no_str()), "sector": F.lit(""),
        "risk_factor": F.col("risk_factor"), "sens_maturity": F.col("option_tenor"),
        "underlying_maturity": F.col("underlying_tenor"), "label2": F.lit(""),
        "source_name": F.lit("VegaIR"), "amount_cup0": _zero(), "pnlvar_delta_ir": _zero(),
        "pnlvar_delta_fx": empty_exposure(),
    })
    vegas = ("normal_vega", "inflation_vega", "yield_vega")
    simm = dict(cols, risk_type=F.lit("Risk_IRVol"), amount=sum((F.col(c) for c in vegas[1:]), F.col(vegas[0])),
                pnlvar_vega_ir=col_or(s, "normal_vega_pnl", _zero()) + col_or(s, "yield_vega_pnl", _zero()))
    return _both_models(filters.nonzero(s, *vegas), simm, dict(cols, pnlvar_vega_ir=_zero()), None)
