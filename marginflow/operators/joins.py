"""Joins of the margin job.

Key columns of the right side are renamed before joining, so self-joins and
shared names never become ambiguous. Null-safe keys (``<=>``) are planned by
Spark as ordinary equi-join keys, so the choice between broadcast hash,
shuffle hash and sort-merge stays with Catalyst/AQE (and AQE splits skewed
partitions); we only force a broadcast for tables with a proven size bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_business_date

# trade snapshot column -> name it carries after J1 (the maturity is the trade's, not the sensitivity's)
TRADE_COLUMNS = {"booked_text": "booked_text", "maturity_text": "trade_maturity_text",
                 "pay_text": "pay_text", "receive_text": "receive_text",
                 "pay_ccy": "pay_ccy", "receive_ccy": "receive_ccy"}

TRADE_KEY = "_trade_key"
REACH_ROWS = 2_000_000   # counterparties whose hashes may be broadcast (some 64 MB a million)


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c if c in keys else c) for c in df.columns])


def null_safe_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                   right_keys: Sequence[str], how: str = "inner", extra=None,
                   right_cols: Sequence[str] | None = None) -> DataFrame:
    """Join on ``left_k <=> right_k`` for each key pair (plus optional residual condition).

    ``extra(l_cols, r_prefix)`` may add a residual predicate; ``right_cols``
    selects which right columns to carry (default: all non-key columns).
    """
    prefix = "_r_"
    r = _prefixed(right, right_keys, prefix)
    cond = None
    for lk, rk in zip(left_keys, right_keys):
        c = F.col(lk).eqNullSafe(F.col(prefix + rk))
        cond = c if cond is None else cond & c
    if extra is not None:
        cond = cond & extra
    keep = [c for c in (right_cols if right_cols is not None else right.columns) if c not in right_keys]
    out = left.join(r, cond, how)
    return out.select(*[left[c] for c in left.columns], *[r[c] for c in keep])


def with_trade_key(df: DataFrame, keys=("trade_id", "portfolio")) -> DataFrame:
    """``df`` with ``TRADE_KEY``: one text per (trade, portfolio), never null, a null unlike any text.

    Rows shuffled by it once serve J1, J3 / J4 and the dedup (G5) of a feed.
    """
    trade, book = (F.col(c).cast("string") for c in keys)
    key = F.concat(F.coalesce(trade, F.lit("")), F.coalesce(F.concat(F.lit("+"), book), F.lit("")),
                   F.lit("|"), F.coalesce(F.length(trade).cast("string"), F.lit("-")))
    return df.withColumn(TRADE_KEY, key)


def join_trades(sens: DataFrame, trades: DataFrame, keys=("trade_id", "portfolio"),
                trade_cols: dict[str, str] = TRADE_COLUMNS) -> DataFrame:
    """Sensitivities x trade snapshot, inner, null-safe on (trade, portfolio); by ``TRADE_KEY`` where ``sens`` has it."""
    right = trades.select(*keys, *[F.col(c).alias(a) for c, a in trade_cols.items()])
    if TRADE_KEY in sens.columns:
        return sens.join(with_trade_key(right, keys).drop(*keys), TRADE_KEY)
    return null_safe_join(sens, right, keys, keys)


def counterparty_reach(cpty: DataFrame, key: str = "counterparty") -> DataFrame | None:
    """Hashes of the counterparties (``_reach``) for a broadcast that tells rows which J2 is sure to drop;
    None beyond ``REACH_ROWS`` counterparties, where J2 alone decides."""
    if cpty.count() > REACH_ROWS:
        return None
    return F.broadcast(cpty.select(F.xxhash64(key).alias("_reach")).distinct())


def within_reach(sens: DataFrame, reach: DataFrame | None, key: str = "counterparty") -> DataFrame:
    """``sens`` without rows whose counterparty is not in ``reach``: before the joins of J1 shuffle them."""
    if reach is None:
        return sens
    return sens.join(reach, F.xxhash64(key) == F.col("_reach"), "left_semi")


def blank_beyond_reach(sens: DataFrame, reach: DataFrame | None, keep: Sequence[str], key: str = "counterparty") -> DataFrame:
    """Every row of ``sens`` with ``_reached``; beyond reach only the columns ``keep`` have their values, and null
    stays told from not null in ``key``."""
    if reach is None:
        return sens.withColumn("_reached", F.lit(True))
    out = sens.join(reach, F.xxhash64(key) == F.col("_reach"), "left").withColumn("_reached", F.col("_reach").isNotNull())
    blank = {c: F.when(F.col("_reached"), F.col(c)) for c in sens.columns if c not in keep}
    blank[key] = F.when(F.col("_reached") | F.col(key).isNull(), F.col(key)).otherwise("")
    return out.drop("_reach").withColumns(blank)


def join_counterparty(sens: DataFrame, cpty: DataFrame, date_col: str = "booked_date",
                      sens_keys=("counterparty", "entity"), cpty_keys=("counterparty", "entity"),
                      cpty_cols=("short_name", "contract", "filter_date")) -> DataFrame:
    """Sensitivities x in-scope counterparties, inner, null-safe on
    (counterparty, entity) with ``date_col >= filter_date`` as a residual
    (equi keys keep it a hash join; a null trade date drops the row).
    ``date_col`` None leaves the date to the caller."""
    right = cpty.select(*cpty_keys, *cpty_cols)
    extra = F.col(date_col) >= F.col("filter_date") if date_col else None
    return null_safe_join(sens, right, sens_keys, cpty_keys, extra=extra)


def join_pl(sens: DataFrame, pl: DataFrame, with_trade_date: bool = False,
            keys=("trade_id", "portfolio"), value_col: str = "market_value",
            date_col: str = "trade_date") -> DataFrame:
    """Sensitivities x P&L, inner equi on (trade, portfolio); adds the
    market value (and the trade date). P&L is not deduplicated: duplicates fan out."""
    cols = [*keys, value_col] + ([date_col] if with_trade_date else [])
    if TRADE_KEY in sens.columns:
        return sens.join(keyed_pl(pl.select(*cols), keys), TRADE_KEY)
    return sens.join(pl.select(*cols), list(keys), "inner")


def keyed_pl(pl: DataFrame, keys=("trade_id", "portfolio")) -> DataFrame:
    """P&L by ``TRADE_KEY`` instead of ``keys``; a row with a null among them meets none."""
    return with_trade_key(pl.dropna(subset=list(keys)), keys).drop(*keys)


def attach_product(df: DataFrame, trade_product: DataFrame, key: str = "trade_id",
                   product_col: str = "product_id") -> DataFrame:
    """Per-trade product id, inner on the trade."""
    return df.join(trade_product.select(key, product_col), key, "inner")


def keep_portfolios(df: DataFrame, perimeter: DataFrame, key: str = "portfolio") -> DataFrame:
    """Keep rows whose portfolio is in the perimeter set (left-semi: no fan-out)."""
    return df.join(perimeter.select(key), key, "left_semi")


def attach_match_id(df: DataFrame, matches: DataFrame, key: str = "trade_id",
                    match_col: str = "match_id") -> DataFrame:
    """Match id per trade, inner; duplicate match rows fan out as in the reference."""
    return df.join(matches.select(key, match_col), key, "inner")


def with_trade_dates(df: DataFrame, booked_col: str = "booked_text",
                     maturity_col: str = "trade_maturity_text") -> DataFrame:
    """D1/D2 applied after J1: booked and maturity dates as DATE (blank -> null)."""
    return df.withColumns({
        "booked_date": parse_business_date(booked_col),
        "maturity_date": parse_business_date(maturity_col),
    })
