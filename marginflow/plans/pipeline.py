"""The unified margin table, composed from the operators.

feeds (E1-E8) -> union (U1) -> product (J7) -> scope (F1) -> strategy split
(F6) -> dominant / plain products (J10 / J8, U6) -> portfolio perimeter (J11)
-> match id (J12) -> regulation constants (F16) -> model split (F9) ->
SIMM: bucketing + rescale (B3/B4), underlying snap (B5), vol routing and
scaling (F10, V1-V4, U7); Schedule: empty bucket, product-key qualifier,
schedule class -> union (U2) -> 40-column output (F14).

The rows up to the model split are written feed by feed and step by step, so
that the disk never holds the shuffles of the whole job. Small, bounded tables
(grid intervals, surfaces, products) are joined by equi keys and broadcast by
size; the feeds themselves are only ever shuffled on join / dedup keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import product_key, recode, tenor_days, vol_currency
from ..operators import bucketing, filters, joins, products, reshape
from ..operators import volatility as vol
from ..operators.observe import observe_counts
from ..session import materialize, scratch_tables, settle, shared_path
from . import feeds

# Regulation constants stamped on every row.
POST_REGULATIONS = "ESA"
COLLECT_REGULATIONS = "CFTC"
QUALIFIER_RECODE = {"UDI": "MXV"}

OUTPUT = [
    "entity", "portfolio", "trade_id", "match_id", "trade_date", "issuer_code", "counterparty_mx",
    "short_name", "contract", "im_model", "product_class", "post_regulations", "collect_regulations",
    "risk_type", "qualifier", "sector", "risk_factor", "sens_maturity", "bucket", "underlying_maturity",
    "label2", "amount_currency", "source_name", "amount", "amount_cup0", "source_system",
    "horizon_date", "booked_date", "maturity_date", "direction", "skeleton", "product_id",
    "dominant_product", "pnlvar_delta_ir", "pnlvar_vega_ir", "pnlvar_delta_fx", "year", "month",
    "day", "type_simm",
]


@dataclass
class MarginInputs:
    trades: DataFrame
    pl: DataFrame
    counterparties: DataFrame         # X2 output
    trade_product: DataFrame
    products: DataFrame
    portfolios: DataFrame             # F7 output (distinct perimeter portfolios)
    match_ids: DataFrame
    grid: DataFrame                   # tenor grid vertices
    vol_fx: DataFrame
    vol_cv: DataFrame
    vol_sv: DataFrame
    rates_delta: DataFrame | None = None
    credit_delta: DataFrame | None = None
    fx: DataFrame | None = None
    rates_vega: DataFrame | None = None


def build_feeds(inp: MarginInputs, counters: dict | None = None,
                step: feeds.Step = feeds.whole) -> list[Callable[[], DataFrame]]:
    """How to build each feed that is present."""
    makers = {"rates_delta": feeds.rates_delta, "credit_delta": feeds.credit_delta, "fx": feeds.fx_risk,
              "rates_vega": feeds.rates_vega}
    return [partial(make, getattr(inp, name), inp.trades, inp.counterparties, inp.pl, counters=counters, step=step)
            for name, make in makers.items() if getattr(inp, name) is not None]


def resolve_products(parts: Sequence[DataFrame], inp: MarginInputs, materialize_mode: str = "table",
                     counters: dict | None = None, paths: Sequence[str] | None = None) -> list[DataFrame]:
    """F6 -> J10 / J8 -> U6 -> J11 -> J12 -> F16 of each part of the rows that have a product.

    A strategy's dominant product (G1) is that of its rows in all parts. ``paths``: where each part is written.
    """
    spark = inp.products.sparkSession
    dominant = settle(spark, lambda: products.dominant_product(
        filters.split_strategy(reshape.union_feeds(*(u.select("strategy", "product_id") for u in parts)))[0], inp.products), materialize_mode)

    def resolved(u: DataFrame) -> DataFrame:
        with_s, without_s = filters.split_strategy(u)
        a = observe_counts(products.products_strategy(with_s, inp.products, dominant=dominant), "strategy_rows", counters).unionByName(
            observe_counts(products.products_plain(without_s, inp.products), "plain_rows", counters))
        a = observe_counts(joins.keep_portfolios(a, inp.portfolios), "in_portfolios", counters, ("trade_id",))
        a = joins.attach_match_id(a, inp.match_ids)
        return observe_counts(a.withColumns({"post_regulations": F.lit(POST_REGULATIONS),
                                             "collect_regulations": F.lit(COLLECT_REGULATIONS)}), "resolved", counters)

    return [settle(spark, partial(resolved, u), materialize_mode, path)
            for u, path in zip(parts, paths or [None] * len(parts))]


def resolved_rows(inp: MarginInputs, materialize_mode: str = "table", counters: dict | None = None) -> DataFrame:
    """E1-E8 -> J7 -> F1 -> products and match ids, feed by feed, then one union.

    Each join that moves whole rows is a step of its own, written once: the disk holds the shuffles of one step of one
    feed, beside the tables that are still to be read.
    """
    spark = inp.products.sparkSession
    store = partial(settle, spark, how=materialize_mode)

    def with_product(make: Callable[[], DataFrame]) -> DataFrame:
        rows = observe_counts(store(make), "unified_feeds", counters, ("trade_id",))
        u = filters.in_scope(joins.attach_product(rows, inp.trade_product))
        return observe_counts(u, "with_product", counters, ("strategy",))

    paths = [shared_path(spark) for _ in range(4)]   # kept; what is made on the way goes
    with scratch_tables(spark):
        shared = replace(inp, trades=store(lambda: feeds.booked_trades(inp.trades)), counterparties=store(lambda: inp.counterparties))
        makers = build_feeds(shared, counters, partial(materialize, how=materialize_mode))
        parts = [store(partial(with_product, make)) for make in makers]
        done = resolve_products(parts, inp, materialize_mode, counters, paths)
    if materialize_mode == "table" and all(part.schema == done[0].schema for part in done):
        return spark.read.parquet(*paths[:len(done)])   # one scan, which every branch reads
    return reshape.union_feeds(*done)


def simm_rows(simm: DataFrame, inp: MarginInputs, strict_vol: bool = True) -> DataFrame:
    """B3/B4 -> F15 -> B5 -> F10 -> V1/V3/V4 (one combined vol join) -> U7."""
    iv = bucketing.tenor_grid(inp.grid)
    days = tenor_days(F.col("sens_maturity"), F.col("horizon_date"))
    b = bucketing.allocate_by_risk_type(simm.withColumn("_days", days), "_days", "amount", iv)
    b = bucketing.rescale_by_allocation(b).drop("schedule_class")
    und_days = tenor_days(F.col("underlying_maturity"), F.col("horizon_date"))
    b = bucketing.nearest_tenor(b.withColumn("_und", und_days), "_und", iv, out_col="underlying_snapped")
    b = b.withColumns({
        "maturity_date": F.lit(None).cast("date"),
        "qualifier": recode(F.col("qualifier"), QUALIFIER_RECODE),
        "underlying_snapped": F.when(F.col("underlying_maturity") != "", F.col("underlying_snapped"))
                               .otherwise(F.lit("")),
        "vol_currency": vol_currency("risk_factor"),
    })
    r = vol.route_vol(b, strict=strict_vol)
    out = vol.scale_vegas(r, inp.vol_fx, inp.vol_cv, inp.vol_sv, iv)
    return out.drop("vol_branch", "underlying_snapped", "vol_currency")


def schedule_rows(sched: DataFrame) -> DataFrame:
    """Schedule model rows: no bucket, product-key qualifier, schedule product class."""
    return sched.withColumns({
        "bucket": F.lit(""),
        "qualifier": product_key("family", "grp", "typ"),
        "product_class": F.col("schedule_class"),
    }).drop("schedule_class")


def margin_table(inp: MarginInputs, app_id: str = "marginflow", strict_vol: bool = True,
                 materialize_mode: str = "table", counters: dict | None = None) -> DataFrame:
    """The 40-column margin table.

    The product-resolved rows are materialised once, a table per feed: both models and every
    volatility branch read them, and the plan above them stays small.
    ``counters`` (a dict) collects G11 row counts as ``Observation`` objects,
    filled by the jobs that run anyway.
    """
    a = resolved_rows(inp, materialize_mode, counters)
    simm, sched = filters.split_model(a)
    simm_out = observe_counts(simm_rows(simm, inp, strict_vol), "simm_rows", counters)
    out = reshape.union_feeds(simm_out, observe_counts(schedule_rows(sched), "schedule_rows", counters))
    out = out.withColumn("type_simm", F.lit(app_id)).withColumnRenamed("counterparty", "counterparty_mx")
    return observe_counts(out.select(*OUTPUT), "output", counters)
